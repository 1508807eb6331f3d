import random
import tracemalloc
import zlib

from geoloom.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, score string"
SYLLABLES = {"aa": ["the", "ing", "er", "th", "ou"], "bb": ["sch", "ein", "ü", "ung", "zu"], "cc": ["ción", "rr", "ñ", "que", "la"]}


def corpus(n=400):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(8, 60))), lang if i % 9 else None, "x"))
    return rows


def test_held_out_accuracy_and_odd_texts(spark):
    rows = corpus()
    odd = [(1000, None, "aa", "x"), (1001, "", "bb", "x"), (1002, "12 34 !?", "aa", "x"), (1003, "the " * 40_000, None, "x"), (None, "ein ung zu", "bb", "x"), (3, rows[3][1], "aa", "x")]
    got = li.query(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and truth.get(r["doc_id"])]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert len(held) > 50 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    assert li.query(spark.createDataFrame([], SCHEMA)).count() == 0
    got = li.query(spark.createDataFrame([(1, "some words", None, "x")], SCHEMA)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]


def test_penalty_makes_weights_sparse():
    rows = [(lang, *li.ngrams(t.encode())) for _, t, lang, _ in corpus(200) if lang]
    idf = li.np.ones(li.BUCKETS)
    loose, tight = (li.fit(sorted(SYLLABLES), idf, rows, l1=x) for x in (0.001, 0.2))
    assert (tight.weights != 0).sum() < (loose.weights != 0).sum()
    assert tight.temperature > 0


def test_sample_when_one_id_repeats_on_many_rows(spark, monkeypatch):
    least = spark.range(3000).selectExpr("min_by(id, pmod(xxhash64(id), 1L << 40)) as id").first()["id"]
    rows = [(10_000 + d, t, lang, "x") for d, t, lang, _ in corpus() if lang]
    rows += [(least, f"the ing er {i}", "aa", "x") for i in range(3000)] + [(5000, "ein ung zu", "bb", "x")] * 500
    seen, fit = [], li.fit
    monkeypatch.setattr(li, "fit", lambda languages, idf, sample, **k: seen.append(sample) or fit(languages, idf, sample, **k))
    docs = spark.createDataFrame(rows, SCHEMA)
    for d in (docs, docs.repartition(7)):
        li.learn(d, sample_rows=90)
    first, second = seen
    assert {x: sum(r[0] == x for r in first) for x in SYLLABLES} == dict.fromkeys(SYLLABLES, 30)
    assert [(a, list(b), list(c)) for a, b, c in first] == [(a, list(b), list(c)) for a, b, c in second]


def test_letters_of_all_planes_and_blocks():
    for text in ("\U000F0000 12", "\U0001F1E9\U000E0067\U000E007F", "1 2 3 !", ""):
        assert not len(li.ngrams(text.encode())[0])
    for text in ("\U00020000", "\U00031350", "a", "ß9"):
        assert len(li.ngrams(text.encode())[0])
    text = ("Ab, c  d9!é \U0001F600 xyz--" * 9 + "q").encode()
    whole = li.ngrams(text)
    for block in (1, 2, 3, 7, 50):
        got = li.ngrams(text, block)
        assert got[0].tolist() == whole[0].tolist() and got[1].tolist() == whole[1].tolist()
    assert len(li.ngrams(b"\xff\xfe abc")[0])


def test_sample_stays_in_arrays(spark, monkeypatch):
    """The driver holds the sample as Arrow sent it, not as lists of whole numbers."""
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(400)), "ab"[i % 2], "x") for i in range(400)], SCHEMA)
    kept = []
    monkeypatch.setattr(li, "fit", lambda languages, idf, rows: kept.append((languages, rows)))
    tracemalloc.start()
    li.learn(docs)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    (languages, rows), numbers = kept[0], sum(len(at) + len(n) for _, at, n in kept[0][1])
    assert languages == ["a", "b"] and len(rows) == 400 and numbers > 1_500_000
    want = sorted((r["lang"], int(li.ngrams(r["text"].encode())[1] @ li.ngrams(r["text"].encode())[0])) for r in docs.collect())
    assert sorted((x, int(at.astype(int) @ n)) for x, at, n in rows) == want
    assert most < 20 << 20, most
