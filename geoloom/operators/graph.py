"""Connected components over an edge table.

Alternating large-star / small-star contraction (Kiveris et al., "Connected Components in MapReduce
and Beyond", 2014): every round is a pre-aggregated ``min`` per node and a join back, so a node with
a third of all edges is handled by partial aggregation and by adaptive skew-join splitting.
Each round is written to the shared folder, which bounds the lineage; rounds end once the edges are
stars, without one more that changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.plans.materialize import materialize, release


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of nodes that keep them from being stars: tied to several nodes below, or tied below and to nodes above."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    row = nodes.agg(F.sum("up").alias("n"), F.count_if(F.expr("up > 1 or up > 0 and down > 0")).alias("open")).first()
    return row["n"] or 0, row["open"]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a bounded edge table: (u, least node reached) for every node that isn't the least."""
    low: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := low.get(x, x)) != x:
            low[x] = x = low.get(up, up)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                low[max(a, b)] = min(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.int64()), pa.array([root(x) for x in low], pa.int64())], names=["u", "v"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, finish: int = 0) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reached.

    Once no more than ``finish`` edges are left, one task settles them; 0 keeps every round distributed.

    Self loops keep a lone node in the result. Rows with a null end are ignored; repeated edges and an
    empty table are fine.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    pairs = materialize(pairs)  # read twice below
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    work = materialize(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for done in range(max_rounds + 1):
        n, unsettled = _state(work)
        if not unsettled:
            break
        if n <= finish:
            work = materialize(work.repartition(1).mapInArrow(_solve, "u long, v long"))
            break
        if done == max_rounds:
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
        both = _both(work)
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        # large star: neighbours above u are tied to the least of u and its neighbours
        large = (
            both.where("v > u").join(low.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # small star: u and its lower neighbours are tied to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        following = materialize(small)
        release(work)
        work = following
    found = work.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
