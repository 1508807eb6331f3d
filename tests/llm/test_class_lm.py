import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from geoloom.llm import class_lm

SCHEMA = "doc_id long, text string, n_tokens string"


def corpus():
    rng = random.Random(2)
    a, b = [f"a{i}" for i in range(40)], [f"B{i}" for i in range(40)]
    rows = [(i, " \n".join(rng.choices(rng.choice([a, b]), k=rng.randint(1, 50))), "x") for i in range(300)]
    return rows + [(500, None, "x"), (501, "", "x"), (502, "unseen-1 a1 É", "x"), (4, rows[4][1], "x"), (4, rows[4][1], "x")]


def test_base_score_by_hand_and_gain_of_classes(spark, monkeypatch):
    for listed in (1 << 18, 30):
        monkeypatch.setattr(class_lm, "LISTED", listed)
        rows = corpus()
        got = class_lm.class_scores(spark.createDataFrame(rows, SCHEMA)).collect()
        assert len(got) == len(rows)
        split = lambda t: (t or "").encode().lower().split() + [b""]
        train = Counter(w for d, t, _ in rows if zlib.crc32(str(d).encode()) % 10 for w in split(t))
        n, v = sum(train.values()), len(train)
        want = {d: (len(split(t)), sum(w in train for w in split(t)), sum(math.log10((train.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in split(t))) for d, t, _ in rows}
        for r in got:
            tokens, known, base = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
            assert abs(r["base_score"] - base) < 1e-9 * max(1, abs(base))
            assert r["score"] < 0 and math.isfinite(r["perplexity"])
        held = [r for r in got if r["held_out"]]
        assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(0)
    kind = np.arange(60) % 3
    pairs = np.zeros((61, 61))
    at = 0
    for _ in range(20_000):
        to = rng.choice(np.flatnonzero(kind == (kind[at] + 1) % 3))
        pairs[at, to] += 1
        at = to
    of = class_lm.exchange(pairs, 4)
    assert of[-1] == 3 and all(len(set(of[:-1][kind == k])) == 1 for k in range(3))


def test_score_by_hand_and_the_model_is_normal(spark, monkeypatch):
    """Transitions and emissions counted by hand from the classes of the lexicon give the same scores."""
    for listed, frequent in ((1 << 18, 768), (20, 10)):
        monkeypatch.setattr(class_lm, "LISTED", listed)
        monkeypatch.setattr(class_lm, "FREQUENT", frequent)
        rows = corpus()
        train = [t for d, t, _ in rows if zlib.crc32(str(d).encode()) % 10]
        docs = spark.createDataFrame(rows, SCHEMA)
        learned = class_lm.learn_classes(spark.createDataFrame([(t,) for t in train], "text string"))
        lexicon = {bytes(r["w"]): (r["c"], r["class"]) for r in learned.lexicon.collect()}
        split = lambda t: (t or "").encode().lower().split() + [b""]
        assert {w: c for w, (c, _) in lexicon.items()} == Counter(w for t in train for w in split(t))
        of = lambda w: lexicon[w][1] if w in lexicon else learned.listed.spelled[class_lm.spelling(w)]
        table, k = np.zeros((class_lm.CLASSES, class_lm.CLASSES)), class_lm.CLASSES
        for t in train:
            at = of(b"")
            for w in split(t):
                table[at, of(w)] += 1
                at = of(w)
        kinds = np.bincount([c for _, c in lexicon.values()], minlength=k)
        share = (table.sum(0) + 0.1) / (table.sum() + 0.1 * k)
        step = (table + 2 * share) / (table.sum(1, keepdims=True) + 2)
        assert np.allclose(step.sum(1), 1)
        emit = lambda w: (lexicon.get(w, (0,))[0] + 0.1) / (table[:, of(w)].sum() + 0.1 * (kinds[of(w)] + 1))
        for c in set(c for _, c in lexicon.values()):  # the words of a class and its one unseen place
            assert abs(sum(emit(w) for w, (_, d) in lexicon.items() if d == c) + 0.1 / (table[:, c].sum() + 0.1 * (kinds[c] + 1)) - 1) < 1e-9
        want = {}
        for d, t, _ in rows:
            at, score = of(b""), 0.0
            for w in split(t):
                score += math.log10(step[at, of(w)] * emit(w))
                at = of(w)
            want[d] = score
        for r in class_lm.class_scores(docs).collect():
            assert abs(r["score"] - want[r["doc_id"]]) < 1e-8 * max(1, abs(r["score"]))


def test_words_beyond_the_head_are_clustered(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "FREQUENT", 8)
    rng = random.Random(4)
    kinds = [[f"{chr(97 + k)}{rng.randrange(1 << 30):x}" for _ in range(60)] for k in range(3)]
    heads = [["q0", "q1"], ["r0", "r1"], ["s0", "s1"]]
    rows = [(" ".join(x for i in range(200) for x in (rng.choice(heads[i % 3]), rng.choice(kinds[i % 3]))),) for _ in range(80)]
    learned = class_lm.learn_classes(spark.createDataFrame(rows, "text string"))
    of = {bytes(r["w"]).decode(): r["class"] for r in learned.lexicon.collect()}
    held = Counter((of[w], k) for k, words in enumerate(kinds) for w in words if w in of)
    best = {c: max(n for (d, _), n in held.items() if d == c) for c, _ in held}
    assert sum(best.values()) >= 0.97 * sum(held.values())  # by spelling alone, classes would mix the kinds
    by_spelling = Counter((int(learned.listed.spelled[class_lm.spelling(w.encode())]), k) for k, words in enumerate(kinds) for w in words)
    assert sum(max(n for (d, _), n in by_spelling.items() if d == c) for c in {c for c, _ in by_spelling}) < sum(best.values())


def test_empty_table(spark):
    assert class_lm.class_scores(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_are_split_in_two_passes(spark):
    """Learning rows are read as texts for the counts and once more for the places of their words, all others once."""
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.udf(seen, "string")("text"))
    assert len(class_lm.class_scores(docs).collect()) == len(rows)
    assert read.value == len(rows) + sum(zlib.crc32(str(d).encode()) % 10 > 0 for d, _, _ in rows)


def test_words_are_those_of_bytes():
    rows = ["", " ", "a", " A b\t\r\n\x0b\x0cC ", None, "\x1c x\x1fy\x85z\xa0\u2003\u3000w", "\u0130 \xc9 \xdf \u212a", "a\x00b \x00", "\n" * 5 + "end"]
    for column in (pa.array(rows), pa.array(rows).slice(2, 5), pa.array(rows[:2]), pa.array([None], pa.string()), pa.array([], pa.string()), pa.array([b"\xff A\xfe", b"\xc3 ", None])):
        flat, n = class_lm.words_of(column)
        want = [(t.encode() if isinstance(t, str) else t or b"").lower().split() for t in column.to_pylist()]
        assert flat.to_pylist() == [w for words in want for w in words] and n.tolist() == [len(w) for w in want]


def by_bucket(batches):
    """What a shuffle by the first column hands to one task, a few rows at a time."""
    rows = pa.Table.from_batches(batches)
    return rows.sort_by(rows.schema.names[0]).combine_chunks().to_batches(max_chunksize=3)


def test_packing_often_gives_the_same_counts_and_classes(monkeypatch):
    texts = [t for _, t, _ in corpus()] + ["rare-1 a1 rare-1", "rare-2 rare-1 B3"]
    plain = Counter(w for t in texts for w in (t or "").encode().lower().split())
    words = [w for w, _ in plain.most_common(30)]
    of = np.arange(30) % 5
    known = class_lm.Listed(words, np.array([plain[w] for w in words]), of, np.arange(class_lm.SPELLINGS) % 5, class_lm.CLASSES - 1, len(texts))

    class Shared:
        value = words

    class SharedList:
        value = known

    rows = pa.table({"id": range(len(texts)), "doc_id": range(len(texts)), "held_out": [False] * len(texts), "text": texts}).to_batches(max_chunksize=7)
    class_of = lambda w: int(of[words.index(w)]) if w in words else class_lm.spelling(w) % 5
    around = {w: np.zeros(2 * class_lm.CLASSES) for w in plain}
    for t in texts:
        path = (t or "").encode().lower().split()
        classes = [known.end, *map(class_of, path), known.end]
        for i, w in enumerate(path):
            around[w][classes[i]] += 1
            around[w][class_lm.CLASSES + classes[i + 2]] += 1
    table = np.random.default_rng(0).random((class_lm.CLASSES, class_lm.CLASSES)) * 100
    log = np.log(table + 0.01)
    want = {}
    for w, m in around.items():
        before, after = m[: class_lm.CLASSES], m[class_lm.CLASSES :]
        gain = before @ log + log @ after - before.sum() * np.log((table + 0.01).sum(0)) - after.sum() * np.log((table + 0.01).sum(1))
        want[w] = (plain[w], int(gain[:-1].argmax()) if plain[w] >= class_lm.LEAST else class_lm.spelling(w) % 5)
    coded = list(class_lm._coded(Shared)(iter(rows)))
    for held, keys, buckets in ((2_000_000, 3_000_000, 4096), (40, 60, 4096), (40, 60, 3)):
        for name, value in (("HELD", held), ("KEYS", keys), ("BUCKETS", buckets)):
            monkeypatch.setattr(class_lm, name, value)
        counts = {}
        for batch in class_lm._summed(iter(by_bucket(class_lm._counts(iter(rows))))):
            for bucket, joined, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts |= dict(zip([b""] if bucket < 0 else joined.split(b" "), np.frombuffer(n, np.int64).tolist(), strict=True))
        assert counts == plain | {b"": len(texts)}
        got = [r for b in class_lm._exchanged(table, known.spelled)(iter(by_bucket(class_lm._contexts(SharedList, 10, buckets)(iter(coded))))) for r in b.to_pylist()]
        assert len(got) == len(plain) - 10 and {r["w"]: (r["c"], r["class"]) for r in got} == {w: x for w, x in want.items() if w not in words[:10]}


def test_only_empty_texts(spark):
    got = class_lm.class_scores(spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \t ", "x"), (None, None, "x")], SCHEMA)).collect()
    assert [(r["n_tokens"], r["n_known"]) for r in got] == [(1, 1)] * 4 and all(math.isfinite(r["score"]) for r in got)


def test_texts_that_are_no_utf8(spark):
    docs = spark.createDataFrame([(i, bytearray(b"\xffA b " * (i + 1))) for i in range(20)], "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    assert {r["doc_id"]: r["n_tokens"] for r in class_lm.class_scores(docs).select("doc_id", "n_tokens").collect()} == {i: 2 * i + 3 for i in range(20)}
