"""Nearest neighbours by inner product over a permutation index.

Vectors are dealt into blocks. A block has its own pivots, distinct vectors of the block; every vector
is represented by the order of its ``PREFIX`` nearest pivots and posted, with its rank, in the inverted
file of each of them. A query walks the files of its own nearest pivots, which adds up, for the vectors
posted there, what the two orders share: with truncated orders the footrule distance is a constant less
twice the sum over shared pivots of (PREFIX - greater rank). Those of least footrule, ties included,
are candidates, and only for candidates is the inner product taken, in double precision.

The share of a block that becomes candidates falls with the size of the table, as ``share()`` says:
the more vectors there are, the nearer the nearest ones are and the more their orders agree.

The order is that of directions. As inner products also follow the norm, a block holds vectors of one
band of norms, within which the nearest directions are the nearest vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.plans.batches import groups
from geoloom.plans.materialize import materialize

PIVOTS, PREFIX, LEAST = 512, 32, 64
BLOCK, QUERY_BLOCK, BANDS, LENGTHS = 4096, 4096, 16, 10_000


def share(rows: int) -> float:
    """Part of the vectors that a query's inner products are taken with."""
    return min(1.0, 2.2 * max(rows, 1) ** -0.25)


def orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    near = -(x @ pivots.T)
    n = min(PREFIX, len(pivots))
    if n < len(pivots):
        some = np.argpartition(near, n - 1, 1)[:, :n]
        some.sort(1)
        near = np.take_along_axis(near, some, 1)
        return np.take_along_axis(some, np.argsort(near, 1, kind="stable"), 1)
    return np.argsort(near, 1, kind="stable")


class Index:
    """The inverted files of a block: for every pivot the rows that have it among their nearest, and its rank there."""

    def __init__(self, x: np.ndarray, pivots: int = PIVOTS):
        self.x = x
        _, first = np.unique(x, axis=0, return_index=True)
        chosen = x[np.sort(first)[: min(pivots, max(PREFIX, len(first) // 4))]]
        self.pivots = chosen / np.sqrt((chosen * chosen).sum(1))[:, None]
        order = orders(x, self.pivots)
        self.prefix = order.shape[1]
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        self.rows, self.worth = by // self.prefix, (self.prefix - by % self.prefix).astype(np.float64)
        self.begin = np.searchsorted(flat[by], np.arange(len(self.pivots) + 1)).tolist()

    def shared(self, order: np.ndarray) -> np.ndarray:
        """For the order of a query: the sum over shared pivots of prefix - greater rank, for every row."""
        files = [slice(self.begin[p], self.begin[p + 1]) for p in order.tolist()]
        worth = [np.minimum(self.worth[f], self.prefix - a) for a, f in enumerate(files)]
        return np.bincount(np.concatenate([self.rows[f] for f in files]), np.concatenate(worth), len(self.x))

    def candidates(self, order: np.ndarray, keep: int) -> np.ndarray:
        """The ``keep`` rows of least footrule distance, and those as near as the last of them."""
        if keep >= len(self.x):
            return np.arange(len(self.x))
        score = self.shared(order)
        return np.flatnonzero(score >= np.partition(score, len(score) - keep)[len(score) - keep])


def _search(nearest: int):
    def rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, ids = t["row"].to_numpy(), t["vec_id"].to_numpy()
        return row, ids, t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1 if len(ids) else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in groups(batches, ["cell"]):
            is_query = t["is_query"].to_numpy()
            (qrow, qid, q), (xrow, xid, x) = rows(t.filter(pa.array(is_query))), rows(t.filter(pa.array(~is_query)))
            if not len(qid) or not len(xid):
                continue
            index = Index(x)
            keep = max(LEAST, 2 * nearest, int(np.ceil(share(t["n"][0].as_py()) * len(x))))
            out = []
            for at, order in enumerate(orders(q, index.pivots)):
                near = index.candidates(order, keep)
                near = near[xrow[near] != qrow[at]]
                # the same order of additions for every pair, so that equal vectors tie
                score = (x[near] * q[at]).sum(1)
                if len(near) > nearest:
                    least = np.partition(score, len(near) - nearest)[len(near) - nearest]
                    near, score = near[score >= least], score[score >= least]
                best = np.lexsort((xid[near], -score))[:nearest]
                out.append((np.full(len(best), qrow[at]), np.full(len(best), qid[at]), xid[near][best], score[best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_row", "query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, nearest: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row): for each row whose vec_id is divisible by ``every``, its nearest others.

    vectors: vec_id and embedding (numbers); other columns are unused. Null, empty or zero vectors, vectors holding
    null or non-finite values and rows with a null id take no part. Vectors of each length are searched among
    their own. Rows that repeat an id are rows of their own: each is a candidate for the others, and each query row
    has its own ranking, told apart by query_row. Equal scores go to the smaller vec_id. An empty table, or one
    without queries, gives no rows.
    """
    double = F.transform("embedding", lambda e: e.cast("double"))
    clean = vectors.select("vec_id", F.col("embedding").alias("v"), F.size("embedding").alias("d"), F.sqrt(F.aggregate(double, F.lit(0.0), lambda s, e: s + e * e)).alias("norm")).where(
        "vec_id is not null and v is not null and d > 0 and forall(v, e -> e is not null and not isnan(cast(e as double)) and abs(cast(e as double)) < double('infinity')) and exists(v, e -> e <> 0)"
    )
    clean = materialize(clean.withColumn("row", F.monotonically_increasing_id()))
    query = F.col("vec_id") % every == 0
    of_length = clean.groupBy("d").agg(
        F.count("*").alias("n"), F.ceil(F.count(F.when(query, 1)) / QUERY_BLOCK).cast("int").alias("q_blocks"),
        F.percentile_approx("norm", [i / BANDS for i in range(BANDS + 1)], 10_000).alias("cuts"),
    ).where("q_blocks > 0")
    bounds = F.when(F.element_at("cuts", -1) > 1.01 * F.element_at("cuts", 1), F.array_distinct(F.slice("cuts", 2, BANDS - 1))).otherwise(F.array().cast("array<double>"))
    of_length = of_length.withColumn("bounds", bounds).drop("cuts")
    small = (lambda t: F.broadcast(t)) if of_length.count() <= LENGTHS else (lambda t: t)
    banded = clean.join(small(of_length), "d").withColumn("band", F.size(F.filter("bounds", lambda b: F.col("norm") > b)))
    # blocks of a length are numbered through its bands, at most BANDS of them
    sizes = banded.groupBy("d", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    first = F.sum("blocks").over(Window.partitionBy("d").orderBy("band")) - F.col("blocks")
    sizes = sizes.withColumn("first", first).withColumn("all_blocks", F.sum("blocks").over(Window.partitionBy("d")))
    each = Window.orderBy("d")  # one row for each length
    start = of_length.select("d", "q_blocks").join(sizes.groupBy("d").agg(F.sum("blocks").alias("b")), "d")
    start = start.select("d", (F.sum(F.col("b") * F.col("q_blocks")).over(each) - F.col("b") * F.col("q_blocks")).alias("start"))
    sizes = materialize(sizes.join(of_length.select("d", "q_blocks"), "d").join(start, "d"))
    cells = sizes.agg(F.sum(F.col("blocks") * F.col("q_blocks"))).first()[0]
    if not cells:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_row long")
    placed = banded.drop("q_blocks").join(small(sizes), ["d", "band"])
    block = F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))
    asked_of = placed.where(query).withColumn("q_block", F.pmod(F.xxhash64("row", F.lit(5)), F.col("q_blocks")))
    columns = ["cell", "is_query", "row", "vec_id", "v", "n"]
    posted = placed.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1))).withColumn("block", block).withColumn("is_query", F.lit(False))
    asked = asked_of.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1))).withColumn("is_query", F.lit(True))
    cell = (F.col("start") + F.col("block") * F.col("q_blocks") + F.col("q_block")).cast("long")
    both = posted.withColumn("cell", cell).select(columns).union(asked.withColumn("cell", cell).select(columns))
    tasks = min(cells, max(2000, cells // 64))
    dealt = both.repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int")).sortWithinPartitions("cell", "row")
    found = materialize(dealt.mapInArrow(_search(nearest), "query_row long, query_id long, vec_id long, score double"))
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score", "query_row")
