import random
import zlib

import pytest

from geoloom.llm import kd_shards

SCHEMA = "doc_id long, text string, lang string, source string, size string, shard string"


def corpus(n, copies, seed=1):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.randint(0, 900) + str(i), rng.choice(["en", "fr", None]), "s0" if rng.random() < 0.4 else f"s{rng.randint(1, 9)}", "a", "b") for i in range(n)]
    rows += [(n + i, "copy é" * 30, "en", "s0", "a", "b") for i in range(copies)]
    return [*rows, (-1, None, None, None, "a", "b"), (None, "", "en", "s1", "a", "b"), (3, rows[3][1], "en", "s1", "a", "b")]


@pytest.mark.parametrize("copies", [300, 6000])
def test_law_of_bytes(spark, copies):
    rows = corpus(3000, copies)
    got = kd_shards.shard(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    text = {d: (t or "").encode() for d, t, *_ in rows}
    total, of, filled = 0, {}, [0] * 8
    for r in got:
        b = text[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 1, zlib.crc32(b), "bytes", None)
        of.setdefault(b, set()).add(r["shard"])
        filled[r["shard"]] += r["size"]
        total += r["size"]
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(filled) and max(filled) <= 1.03 * total / 8 and min(filled) >= 0.97 * total / 8
    divided = [b for b, s in of.items() if len(s) > 1]
    assert len(divided) == (copies == 6000)  # only what outweighs a shard


def test_few_and_no_rows(spark):
    assert kd_shards.shard(spark.createDataFrame([], SCHEMA)).count() == 0
    got = kd_shards.shard(spark.createDataFrame([(1, "a", "en", "s", "", ""), (2, None, None, None, "", "")], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == [(1, 2), (2, 1)]


def brute_tree(units, target):
    """Leaves as sets of hashes: sort by key, cut at the weighted median, go on."""
    weight = sum(u["w"] for u in units)
    if weight <= target or len(units) == 1:
        return [frozenset(u["g"] for u in units)]
    widths = [max(u[d] for u in units) - min(u[d] for u in units) for d in kd_shards.DIMENSIONS]
    d = kd_shards.DIMENSIONS[widths.index(max(widths))]
    key = lambda u: (u[d], (u["g"] % (1 << 64)) >> (64 - kd_shards.HASH))
    units = sorted(units, key=key)
    below, at = 0, 0
    while below + units[at]["w"] <= weight / 2:
        below += units[at]["w"]
        at += 1
    if not weight / 2 - below < units[at]["w"] / 2:
        at += 1
    return brute_tree(units[:at], target) + brute_tree(units[at:], target)


def test_tree_equals_brute_force_and_holds_every_unit(spark):
    rows = spark.createDataFrame(corpus(1500, 200), SCHEMA)
    from pyspark.sql import functions as F

    text = F.coalesce("text", F.lit(""))
    units = kd_shards._places(kd_shards._units(rows.select("doc_id", F.octet_length(text).alias("size"), F.xxhash64(text).alias("g"), "lang", "source")))
    listed = [r.asDict() for r in units.collect()]
    target = sum(u["w"] for u in listed) / 60
    placed, leaves = kd_shards.tree(units, target)
    got = {}
    for r in placed.collect():
        got.setdefault(r["node"], set()).add(r["g"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, brute_tree(listed, target)))
    assert set(got) == set(leaves) and sum(map(len, got.values())) == len(listed)
    assert all(leaves[n] <= target or len(g) == 1 for n, g in got.items())


def test_order_of_strings_is_kept(spark):
    names = ["", "src-a", "src-ab", "src-b", "src-é", "src-zzzzzz", "t"]
    units = spark.createDataFrame([(i, 1, 1, float(i), "en", s) for i, s in enumerate(names)], "g long, size long, w long, id double, lang string, source string")
    at = {r["source"]: r["at_source"] for r in kd_shards._places(units).collect()}
    assert [at[n] for n in names] == sorted(at.values())
