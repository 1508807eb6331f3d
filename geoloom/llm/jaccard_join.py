"""N-gram Jaccard self-join by signature trees.

Two documents are linked when their sets of distinct word shingles reach the similarity. Equal sets
form one class at once, so copies are never compared. Classes that share a band of min-wise hashes
are drawn together into blocks; inside a block a signature tree (nodes: OR of token bitmaps and the
range of set sizes) is traversed against itself, pairs of nodes whose greatest possible overlap is
too small are dropped, and what remains is decided on the real sets. Classes that a block has already
joined are not compared again.

A block above ``chunk`` classes is dealt into chunks, each with the same few pivots. What hangs
together with the largest component of its block is settled; every other class is then compared with
all chunks of its block. No pair of classes in one block stays undecided, and no task holds more than
a chunk or two.

Sharing a band is the one randomised step: with 40 bands of 3 hashes a pair at similarity 0.75 shares
none with probability (1 - 0.75**3)**40 = 3e-10, less for closer pairs. Sets are compared as 64-bit
hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm import texthash
from geoloom.llm.tables import texts, wide_row_key
from geoloom.operators.graph import connected_components
from geoloom.plans.batches import groups
from geoloom.plans.materialize import materialize

BANDS, ROWS, BITS, FAN = 40, 3, 1024, 16
#: Type of the key of a row.
KEY = "struct<a:bigint,b:bigint>"


class SignatureTree:
    """A tree over token sets; every node holds the OR of its bitmaps and its range of sizes."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets])
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:1].tolist()))
        bits = np.zeros((len(sets), BITS // 64), np.uint64)
        for row, s in zip(bits, sets, strict=True):
            at = (s >> np.uint64(54)).astype(np.int64)
            np.bitwise_or.at(row, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        # tokens beyond the first on a bit: what an overlap can hold over the common bits
        self.bits, self.excess = bits, self.size - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.nodes: list[tuple] = []  # (children or None, members, bitmap, least size, greatest size, excess)
        level = [self._node(None, np.array(order[i : i + FAN])) for i in range(0, len(order), FAN)]
        while len(level) > 1:
            level = [self._node(level[i : i + FAN], None) for i in range(0, len(level), FAN)]
        self.root = level[0]

    def _node(self, children: list[int] | None, members: np.ndarray | None) -> int:
        if children is None:
            made = (None, members, np.bitwise_or.reduce(self.bits[members], 0), self.size[members].min(), self.size[members].max(), self.excess[members].max())
        else:
            below = [self.nodes[c] for c in children]
            made = (children, None, np.bitwise_or.reduce([n[2] for n in below], 0), min(n[3] for n in below), max(n[4] for n in below), max(n[5] for n in below))
        self.nodes.append(made)
        return len(self.nodes) - 1

    def pairs(self, percent: int, alike: list[int]) -> Iterator[tuple[int, int]]:
        """Pairs of members that may reach the similarity and aren't joined yet in ``alike``."""
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            ca, ma, ba, la, ha, ea = self.nodes[a]
            cb, mb, bb, lb, hb, eb = self.nodes[b]
            # overlap*100 >= percent*union and union = x+y-overlap, so overlap*(100+percent) >= percent*(x+y)
            most = min(int(np.bitwise_count(ba & bb).sum()) + min(ea, eb), ha, hb)
            if most * (100 + percent) < percent * (la + lb) or ha * 100 < percent * lb or hb * 100 < percent * la:
                continue
            if ca is None and cb is None:
                both = np.bitwise_count(self.bits[ma][:, None, :] & self.bits[mb][None, :, :]).sum(2).astype(np.int64)
                both += np.minimum(self.excess[ma][:, None], self.excess[mb][None, :])
                both = np.minimum(both, np.minimum(self.size[ma][:, None], self.size[mb][None, :]))
                keep = both * (100 + percent) >= percent * (self.size[ma][:, None] + self.size[mb][None, :])
                if a == b:
                    keep = np.triu(keep, 1)
                for i, j in zip(*np.nonzero(keep), strict=True):
                    yield int(ma[i]), int(mb[j])
            elif a == b:
                stack += [(ca[i], ca[j]) for i in range(len(ca)) for j in range(i, len(ca))]
            elif ca is None or cb is not None and hb - lb > ha - la:
                stack += [(a, c) for c in cb]
            else:
                stack += [(c, b) for c in ca]


def link(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the least index it hangs together with."""
    alike = list(range(len(sets)))

    def root(i: int) -> int:
        while alike[i] != i:
            alike[i] = alike[alike[i]]
            i = alike[i]
        return i

    if len(sets) > 1:
        for i, j in SignatureTree(sets).pairs(percent, alike):
            a, b = root(i), root(j)
            if a != b:
                x, y = sets[i], sets[j]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    alike[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def _features(k: int):
    rng = np.random.default_rng(20240607)
    xor, mul = rng.integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
    mul |= np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids, bands = [], [], []
            for text in texts(batch, "text"):
                s = texthash.shingles(text, k)
                counts.append(len(s))
                if not len(s):
                    ids.append(0)
                    bands.append([])
                    continue
                ids.append(int(texthash.mix(np.array([texthash.mix(s).sum() + np.uint64(len(s))], np.uint64)).view(np.int64)[0]))
                low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 1024):
                    low = np.minimum(low, ((s[at : at + 1024, None] ^ xor) * mul).min(0))
                m = low.reshape(BANDS, ROWS)
                key = np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    key = texthash.mix(key * np.uint64(0x9E3779B97F4A7C15) + m[:, r])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in ("r", "doc_id")), pa.array(counts, pa.int64()), pa.array(ids, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["r", "doc_id", "n_shingles", "class_id", "bands"],
            )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("r")), pa.array([pack.compress(t) for t in texts(batch, "text")], pa.binary())], names=["r", "packed"]
        )


def _sets(rows: pa.Table, k: int) -> tuple[list[int], list[np.ndarray]]:
    """Distinct classes of a group and their sets, in ascending order of the class."""
    unpack, found = zstandard.ZstdDecompressor(), {}
    for c, z in zip(rows["class_id"].to_pylist(), rows["packed"].to_pylist(), strict=True):
        if c not in found:
            found[c] = texthash.shingles(unpack.decompress(z), k)
    ids = sorted(found)
    return ids, [found[c] for c in ids]


def _links(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ["block", "chunk", "part"]):
            ids, sets = _sets(rows, k)
            low = link(sets, percent)
            divided = pa.array([rows["chunks"][0].as_py() > 1] * len(ids), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([ids[i] for i in low], pa.int64()), divided], names=["src", "dst", "divided"])

    return run


def _linked(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """rows: block, chunks, chunk, part, class_id, packed. (src, dst, divided) with the least class of each local component; divided: its block has more chunks."""
    return rows.repartition("block", "chunk", "part").sortWithinPartitions("block", "chunk", "part").mapInArrow(_links(k, percent), "src long, dst long, divided boolean")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75, chunk: int = 512) -> DataFrame:
    """(doc_id, n_shingles, component_id, r, component) for every row of ``docs`` (doc_id, text; other columns unused).

    component_id: the least doc_id among the documents reachable by links, itself included. component tells
    components apart even where ids are null or repeat; it is null for texts without shingles. r is wide_row_key(). Null or
    wordless texts have no shingles and stand alone. Equal texts are linked (similarity 1). Rows that
    repeat a doc_id each give a row; a null doc_id stays null where its class has no other. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    features = materialize(docs.select(wide_row_key().alias("r"), "doc_id", "text").mapInArrow(_features(k), f"r {KEY}, doc_id long, n_shingles long, class_id long, bands array<long>"))
    filled = features.where("n_shingles > 0")
    banded = filled.select("class_id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    near = banded.join(shared, "band").where("class_id <> low").select(F.col("low").alias("src"), F.col("class_id").alias("dst")).distinct()
    blocks = connected_components(near)
    blocks = materialize(blocks.select(F.col("node").alias("class_id"), F.col("component").alias("block")))
    sizes = blocks.groupBy("block").agg(F.count("*").alias("members"))
    first = filled.groupBy("class_id").agg(F.min("doc_id").alias("doc_id"))
    # doc_id may be null or repeat, so a text is fetched by the key of its row
    holder = filled.groupBy("class_id").agg(F.min("r").alias("r"))
    wanted = blocks.join(sizes, "block").join(holder, "class_id").select("class_id", "block", "members", "r")
    content = materialize(docs.select(wide_row_key().alias("r"), "text").mapInArrow(_packed, f"r {KEY}, packed binary").join(wanted, "r"))
    chunks = F.ceil(F.col("members") / chunk).cast("int")
    dealt = content.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int"))
    pivot = (F.col("class_id") == F.col("block")) | (F.pmod(F.xxhash64("class_id", F.lit(7)), F.greatest(F.lit(1), F.expr("members div 8"))) == 0)
    everywhere = F.when((F.col("chunks") > 1) & pivot, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))
    once = materialize(_linked(dealt.withColumn("chunk", F.explode(everywhere)).withColumn("part", F.lit(0)).select("block", "chunks", "chunk", "part", "class_id", "packed"), k, percent))
    # a block of one chunk is settled; rounds over the whole table are for what several tasks have linked
    divided = once.where("divided").select("src", "dst")
    labels = materialize(connected_components(divided))
    more = _rest(dealt.where("chunks > 1"), labels, k, percent, chunk)
    if more is not None:
        labels = materialize(connected_components(divided.union(more.select("src", "dst"))))
    labels = labels.union(once.where("not divided").select("src", "dst"))
    least = (
        first.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("class_id", "doc_id", F.coalesce("component", "class_id").alias("component"))
    )
    component = least.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = least.join(component, "component").select("class_id", "component_id", "component")
    return (
        features.select("r", "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class_id")).alias("class_id"))
        .join(ids, "class_id", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "r", "component")
    )


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the least doc_id.

    Texts without shingles all stay, rows that repeat doc_id and text become one.
    """
    found = jaccard_components(docs, k, percent)
    w = Window.partitionBy("component", F.when(F.col("component").isNull(), F.col("r"))).orderBy("doc_id", "r")
    kept = found.withColumn("n", F.row_number().over(w)).where("n = 1").select(F.col("r").alias("__r"))
    return docs.withColumn("__r", wide_row_key()).join(kept, "__r").dropDuplicates(["__r"]).select(*docs.columns)


def _rest(dealt: DataFrame, labels: DataFrame, k: int, percent: int, chunk: int) -> DataFrame | None:
    """Links of what isn't in the largest component of its divided block, with all chunks of the block."""
    marked = dealt.select("block", "chunks", "own", "class_id").join(labels, F.col("class_id") == F.col("node")).drop("node")
    counted = marked.groupBy("block", "component").agg(F.count("*").alias("n"))
    largest = counted.groupBy("block").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"))
    open_blocks = materialize(largest.where("top.n < n").select("block", F.col("top.component").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / chunk).cast("int").alias("parts")))
    if open_blocks.isEmpty():
        return None
    at = marked.join(open_blocks, "block").select("class_id", "parts", (F.col("component") != F.col("top")).alias("open"))
    rows = dealt.join(at, "class_id")
    part = F.pmod(F.xxhash64("class_id", F.lit(3)), F.col("parts")).cast("int")
    opened = rows.where("open").withColumn("part", part).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    facing = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("chunk", F.col("own"))
    columns = ["block", "chunks", "chunk", "part", "class_id", "packed"]
    return materialize(_linked(opened.select(columns).union(facing.select(columns)), k, percent))
