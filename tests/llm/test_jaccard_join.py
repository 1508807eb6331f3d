import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import jaccard_join
from geoloom.operators import graph

SCHEMA = "doc_id long, text string, lang string, component_id string"


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 40, 120]))
        rows.append((1000 - i, " ".join(w)))
    return rows + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One two"), (5004, "one\ttwo "), (5005, "x " * 3000), (5005, "x " * 3000)]


def brute(rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets, low = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("chunk", [512, 4])
def test_matches_all_pairs(spark, chunk):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "en", "x") for d, t in rows], SCHEMA)
    got = sorted(tuple(r)[:3] for r in jaccard_join.jaccard_components(docs, chunk=chunk).collect())
    assert got == brute(rows)


def test_empty_table(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tree_prunes_without_losing_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2)
    sets = [np.unique(rng.choice(base, rng.integers(5, 300), replace=False)) for _ in range(90)]
    sets += [np.unique(np.r_[s[: int(len(s) * 0.9)], rng.integers(0, 1 << 63, 2, np.uint64)]) for s in sets[:30]]
    tree = jaccard_join.SignatureTree(sets)
    found = {tuple(sorted(p)) for p in tree.pairs(75, list(range(len(sets))))}
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                assert (j, i) in found
    assert len(found) < len(sets) * (len(sets) - 1) // 2


def test_one_of_each(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "en", "x") for d, t in rows], SCHEMA)
    got = jaccard_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted({c for _, _, c in brute(rows)})


def test_links_through_a_null_doc_id(spark):
    part = lambda a: " ".join(f"w{i}" for i in range(a, a + 100))
    rows = [(1, part(0)), (None, part(8)), (2, part(16))]  # the outer two are too far apart, 80 of 112
    docs = spark.createDataFrame([(d, t, "en", "x") for d, t in rows], SCHEMA)
    assert {r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()} == {1}
    assert jaccard_join.one_of_each(docs).count() == 1
    pair = spark.createDataFrame([(None, part(0), "en", "x"), (None, part(8), "en", "x")], SCHEMA)
    assert jaccard_join.one_of_each(pair).count() == 1


@pytest.mark.parametrize("same", ["a", "b"])
def test_rows_that_share_one_half_of_their_key_stay_apart(spark, monkeypatch, same):
    whole = jaccard_join.wide_row_key
    monkeypatch.setattr(jaccard_join, "wide_row_key", lambda: whole().withField(same, F.lit(0).cast("long")))
    test_one_of_each(spark)
    test_links_through_a_null_doc_id(spark)


def test_rounds_end_at_stars(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "materialize", lambda df, f=graph.materialize: written.append(1) or f(df))
    stars = spark.createDataFrame([(5, 1), (6, 1), (1, 9), (2, 7), (3, 3), (None, 4)], "src long, dst long")
    assert sorted(map(tuple, graph.connected_components(stars).collect())) == [(1, 1), (2, 2), (3, 3), (5, 1), (6, 1), (7, 2), (9, 1)]
    assert len(written) == 2  # the pairs and the edges, no round
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)], "src long, dst long")
    assert sorted(map(tuple, graph.connected_components(chain).collect())) == [(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 102)]
    with pytest.raises(RuntimeError, match="not settled"):
        graph.connected_components(chain, max_rounds=1)


def test_blocks_of_one_chunk_need_no_rounds(spark, monkeypatch):
    given = []
    monkeypatch.setattr(jaccard_join, "connected_components", lambda edges, f=jaccard_join.connected_components: given.append(edges.count()) or f(edges))
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "en", "x") for d, t in rows], SCHEMA)
    assert sorted(tuple(r)[:3] for r in jaccard_join.jaccard_components(docs).collect()) == brute(rows)
    assert given[0] > 0 and given[1:] == [0]
