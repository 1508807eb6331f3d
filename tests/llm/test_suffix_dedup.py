import hashlib
import random

import pytest

from geoloom.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, r long, kept string"


def brute(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for i, b in enumerate(texts):
        for s in range(len(b) - length + 1):
            seen.setdefault(b[s : s + length], []).append((i, s))
    gone = [bytearray(len(b)) for b in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + length] = b"\1" * length
    out = []
    for (d, _), b, g in zip(rows, texts, gone, strict=True):
        spans = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        out.append((d, len(b), sum(g), spans, hashlib.sha256(bytes(x for x, y in zip(b, g, strict=True) if not y)).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(30, 120))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [p[cut : len(p) - rng.randint(0, 60)], " ".join(word() for _ in range(rng.randint(0, 20)))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (3, rows[3][1]), (101, "a" * 700), (102, "ab" * 300 + "a" * 199), (103, None), (104, ""), (105, "x" * 200), (106, "é" * 150), (107, rows[5][1] * 2)]
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 2000), (2, 2000), (1, 2)])
def test_matches_every_window(spark, seed, hot):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA).repartition(3)
    assert sorted(tuple(r) for r in sd.digest(sd.remove_repeats(docs, hot=hot)).collect()) == brute(rows)


def test_segments_of_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefgh ", k=6000))
    rows = [(1, text), (2, "zz" + text[500:4000] + "yy" + text[100:320])]
    monkeypatch.setattr(sd, "SEGMENT", 1000)
    found = {}
    for d, t in rows:
        for g, s, a, high, low in sd.anchors(t.encode(), 200):
            for x in zip(g, a, high, low, strict=True):
                for o in range(x[3], x[2] + 1):
                    found.setdefault((d, int(x[1] - o)), []).append(x[0])
    assert all(len(v) == 1 for v in found.values())
    assert {s for d, s in found if d == 1} == set(range(6000 - 199))


def test_empty_table(spark):
    assert sd.digest(sd.remove_repeats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_loser_tree_merges_and_gives_common_prefixes():
    rng = random.Random(4)
    strings = ["".join(rng.choices("ab", k=rng.randint(0, 12))).encode() for _ in range(300)]
    runs = [sorted(strings[i::7]) for i in range(7)]
    coded = [[(n, t, None) for n, t in sd.front_code(r)] for r in runs]
    got = list(sd.merge_runs(coded))
    assert [x[1] for x in got] == sorted(strings)
    assert all(x[0] == sd.common(y[1], x[1]) for y, x in zip(got, got[1:], strict=False))
