"""Shards of near equal bytes by a k-d tree over document metadata.

Documents of equal text form a unit with the least of its doc_ids, languages and sources; a unit is a
point with four dimensions (source, language, size, id) and weighs its bytes. From one node that holds
all units on, every node above the target bytes is split at the weighted median of its widest
dimension, a level of the tree at a time for all nodes together. The median is found by counting digits of the
key (the place on the dimension, then the text's hash, so units stay whole) over the whole table. A
node of one unit, or whose units can't be told apart, is a leaf whatever it weighs.

The target is a ``PARTS``-th of a shard. Leaves, largest first, are put together to shards: to the
lightest shard each. Only a leaf that outweighs a shard by itself has its copies divided.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.plans.materialize import materialize, release

PARTS, HOT = 32, 1024
PLACE, HASH, DIGIT = 20, 16, 12  # bits of a place, of the hash behind it, and of a digit
DIGITS = (PLACE + HASH) // DIGIT
DIMENSIONS = ("at_source", "at_lang", "at_size", "at_id")


def _number(column: Column, shared: int) -> Column:
    """Four bytes of a string behind the ``shared`` ones that all strings begin with, as a number that keeps their order."""
    return F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), shared + 1, 4)), 8, "0"), 16, 10).cast("double")


def _places(units: DataFrame) -> DataFrame:
    """The four places, from 0 to 2**PLACE - 1 from the least to the greatest value; null strings count as empty."""
    strings = {"at_source": "source", "at_lang": "lang"}
    ends = units.agg(*[f(c).alias(f"{n}_{c}") for c in strings.values() for n, f in (("low", F.min), ("high", F.max))]).first()
    for place, c in strings.items():
        low, high = ends[f"low_{c}"] or "", ends[f"high_{c}"] or ""
        a, b = low.encode(), high.encode()
        shared = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        units = units.withColumn(place, _number(F.col(c), shared))
    units = units.withColumn("at_size", F.log2("size")).withColumn("at_id", F.col("id"))
    r = units.agg(*[f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]).first()

    def spread(d: str):
        low, high = r[f"low_{d}"] or 0.0, r[f"high_{d}"] or 0.0
        return F.least(F.floor((F.col(d) - low) / max(high - low, 1e-9) * (1 << PLACE)), F.lit((1 << PLACE) - 1)).cast("long")

    return units.withColumns({d: spread(d) for d in DIMENSIONS})


def _units(rows: DataFrame) -> DataFrame:
    units = rows.groupBy("g", "size").agg(
        F.count("*").alias("n"), F.coalesce(F.min("doc_id"), F.lit(0)).cast("double").alias("id"),
        F.coalesce(F.min("lang"), F.lit("")).alias("lang"), F.coalesce(F.min("source"), F.lit("")).alias("source"),
    )
    return materialize(units.withColumn("w", F.col("n") * F.col("size")))


def _key(dimension: Column) -> Column:
    """Place on the node's widest dimension, then bits of the text's hash."""
    place = F.get(F.array(*DIMENSIONS), dimension)
    return F.shiftleft(place, HASH).bitwiseOR(F.shiftrightunsigned("g", 64 - HASH))


def _medians(units: DataFrame, open_nodes: dict[int, dict], spark) -> dict[int, tuple[int, int]]:
    """For each open node its widest dimension and the greatest key that goes left."""
    widest = {n: max(range(len(DIMENSIONS)), key=lambda i, s=s: (s["widths"][i], -i)) for n, s in open_nodes.items()}
    prefix, below = dict.fromkeys(open_nodes, 0), dict.fromkeys(open_nodes, 0)
    at_node = spark.createDataFrame([(n, d) for n, d in widest.items()], "node long, dimension int")
    keyed = units.join(F.broadcast(at_node), "node").withColumn("key", _key(F.col("dimension"))).select("node", "key", "w")
    last: dict[int, int] = {}
    for digit in range(DIGITS):
        shift = DIGIT * (DIGITS - 1 - digit)
        path = F.broadcast(spark.createDataFrame([*prefix.items()], "node long, path long"))
        here = keyed.join(path, "node").where(F.shiftright("key", shift + DIGIT) == F.col("path"))
        counted: dict[int, list] = {n: [] for n in open_nodes}
        for r in here.groupBy("node", F.shiftright("key", shift).bitwiseAND((1 << DIGIT) - 1).alias("digit")).agg(F.sum("w").alias("w")).collect():
            counted[r["node"]].append((r["digit"], r["w"]))
        for n, found in counted.items():
            found.sort()
            for at, w in found:  # noqa: B007
                if below[n] + w > open_nodes[n]["w"] / 2 or at == found[-1][0]:
                    break
                below[n] += w
            prefix[n] = prefix[n] << DIGIT | at
            last[n] = w
    # the units at the median go to the nearer side
    return {n: (widest[n], prefix[n] - (open_nodes[n]["w"] / 2 - below[n] < last[n] / 2)) for n in open_nodes}


def tree(units: DataFrame, target: float) -> tuple[DataFrame, dict[int, int]]:
    """``units`` with the leaf of each (node), and the bytes of every leaf; all nodes above ``target`` bytes are split.

    A tree has at most about 4 * total / target nodes besides single heavy units, whatever the number of units.
    """
    spark = units.sparkSession
    units = materialize(units.withColumn("node", F.lit(0).cast("long")))
    leaves: dict[int, int] = {}
    parent: dict[int, int] = {}  # bytes of the node that a node was split from
    made, first = 1, True
    while True:
        spans = units.groupBy("node").agg(F.sum("w").alias("w"), F.count("*").alias("n"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()
        open_nodes = {}
        for r in spans:
            if r["node"] in leaves:
                continue
            if r["w"] > target and r["n"] > 1 and r["w"] != parent.get(r["node"]):
                open_nodes[r["node"]] = {"w": r["w"], "widths": [r[d] for d in DIMENSIONS]}
            else:
                leaves[r["node"]] = r["w"]
        if not open_nodes:
            return units, leaves
        cuts = []
        for n, (d, key) in _medians(units, open_nodes, spark).items():
            cuts.append((n, d, key, made, made + 1))
            parent[made] = parent[made + 1] = open_nodes[n]["w"]
            made += 2
        cut = F.broadcast(spark.createDataFrame(cuts, "node long, dimension int, cut long, to_left long, to_right long"))
        node = F.when(F.col("cut").isNull(), F.col("node")).when(_key(F.col("dimension")) <= F.col("cut"), F.col("to_left")).otherwise(F.col("to_right"))
        following = materialize(units.join(cut, "node", "left").withColumn("node", node).select(units.columns))
        if not first:
            release(units)
        units, first = following, False


def deal(leaves: dict[int, int], shards: int) -> dict[int, list[int]]:
    """Shard of each leaf, the largest leaf first to the lightest shard; several shards for one that outweighs a shard."""
    total = sum(leaves.values())
    lightest = [(0, s) for s in range(shards)]
    of: dict[int, list[int]] = {}
    for w, leaf in sorted(((w, n) for n, w in leaves.items()), key=lambda x: (-x[0], x[1])):
        pieces = min(shards, 2 * -(-w * shards // total)) if w * shards > total else 1
        taken = [heapq.heappop(lightest) for _ in range(pieces)]
        for b, s in taken:
            heapq.heappush(lightest, (b + w // pieces, s))
        of[leaf] = [s for _, s in taken]
    return of


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, leaf) for every row of ``docs`` (doc_id, text, lang, source; other columns unused).

    size: UTF-8 bytes of the text and 1; a null text has none and counts as equal to an empty one. law is
    ``bytes``: the sizes of shards are near equal. slot numbers the rows of a shard from 0 without gaps. leaf
    is the node of the tree that holds the row. Null ids, languages and sources are places like others. Equal texts share a
    shard unless they outweigh one. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"), "lang", "source")
    units = _units(rows)
    sums = units.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("w"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    leafed, leaves = tree(_places(units).select("g", "size", "n", "w", *DIMENSIONS), sums["w"] / shards / PARTS)
    of = deal(leaves, shards)
    table = F.broadcast(docs.sparkSession.createDataFrame([*of.items()], "node long, among array<int>"))  # as many rows as the tree has leaves
    hot = (F.size("among") > 1) | (F.col("n") * HOT > sums["n"])
    found = materialize(leafed.join(table, "node").select("g", "size", F.col("node").alias("leaf"), "among", hot.alias("hot")))
    # texts of very many rows, no more than HOT and those that are divided, don't meet in one task
    apart = F.broadcast(found.where("hot"))
    rows = rows.drop("lang", "source")
    marked = rows.join(apart, ["g", "size"], "left")
    usual = marked.where("hot is null").drop("leaf", "among", "hot").join(found.where("not hot"), ["g", "size"])
    own_shard = F.get("among", F.pmod(F.xxhash64("doc_id", "g"), F.size("among")).cast("int"))
    placed = marked.where("hot").unionByName(usual).withColumn("shard", own_shard).drop("among", "hot")
    buckets = max(1, sums["n"] // 100_000)
    placed = placed.withColumn("h", F.xxhash64("doc_id", "g")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("h", "doc_id")) - 1
    return placed.withColumn("own", own).join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("own") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "leaf"
    )
