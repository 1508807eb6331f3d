import random

from hypothesis import given, settings
from hypothesis import strategies as st

from geoloom.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, hits string, item_id string"


def distance(pattern, text):
    """Least edit distance of pattern to any substring of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_bit_parallel_distance(pattern, text):
    best, end = dc.Myers(pattern).best(text)
    assert best == distance(pattern, text)
    assert distance(pattern, text[:end]) == best


def test_matches_every_item_against_every_text(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgé", k=rng.randint(1, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 50)))) for i in range(12)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 80)))]
        if rng.random() < 0.5:
            p = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, len(p) // 10)):
                at = rng.randrange(len(p))
                p[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "yy"])
            parts += ["\n--" + "".join(p).upper(), " ".join(word() for _ in range(9))]
        rows.append((i, " ".join(parts), "", ""))
    rows += [(500, None, "", ""), (501, "", "", ""), (502, "z " * 50_000 + items[0][1], "", ""), (502, items[0][1], "", ""), (None, items[1][1], "", "")]
    bench = [*items, (90, None), (91, ""), (92, "short"), (None, "an item without any number at all"), (0, items[0][1])]
    got = sorted((r["doc_id"] is None, r["doc_id"], r["item_id"], r["distance"]) for r in dc.query(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bench, "item_id long, text string")).collect())
    want = []
    for d, t, *_ in rows:
        text = dc.normal(t or "")
        for i, item in [*items, (0, items[0][1])]:
            item = dc.normal(item)
            if (d == 502 and item in text) or (len(text) < 5000 and len(text) >= len(item) - dc.budget(len(item)) and distance(item, text) <= dc.budget(len(item))):
                want.append((d is None, d, i, 0 if d == 502 else distance(item, text)))
    assert got == sorted(want)


def test_blocks_of_a_large_benchmark_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one passage of the benchmark stands in here, and so on", "", "")], SCHEMA)
    bench = spark.createDataFrame([(i, f"passage of the benchmark stands in {'here' if i == 3 else 'no text at all ' + str(i)}") for i in range(6)], "item_id long, text string")
    monkeypatch.setattr(dc, "BLOCK_CHARS", 60)
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in dc.query(docs, bench).collect()] == [(1, 3, 0)]
    assert dc.query(docs, bench.limit(0)).count() == dc.query(docs.limit(0), bench).count() == 0


def test_budget_is_ten_percent():
    rng = random.Random(3)
    for length, edits in ((16, 1), (20, 2), (31, 3), (79, 7), (96, 9), (100, 10), (233, 23)):
        item = "".join(rng.choices("abcdefghijklmnop", k=length))
        matcher = dc.Matcher([(1, item)], dc.PERCENT)
        for n in (edits, edits + 1):
            p = list(item)
            for i in range(n):  # spread over the item, so no piece longer than the gaps survives
                p[(2 * i + 1) * length // (2 * n)] = "Z"
            assert [x[:2] for x in matcher.found("qq " + "".join(p) + " qq")] == ([(1, n)] if n == edits else [])


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=16, max_size=60), st.data())
def test_no_passage_within_the_budget_is_missed(item, data):
    p = list(item)
    for _ in range(len(item) // 10):
        at = data.draw(st.integers(0, len(p) - 1))
        p[at : at + data.draw(st.integers(0, 1))] = data.draw(st.sampled_from(["", "b", "xx"[:1]]))
    text = data.draw(st.text("abc", max_size=20)) + "".join(p) + data.draw(st.text("abc", max_size=20))
    best = distance(item, text)
    assert [x[:2] for x in dc.Matcher([(1, item)], dc.PERCENT).found(text)] == ([(1, best)] if best <= len(item) // 10 else [])


def test_short_items_match_exactly(spark):
    docs = spark.createDataFrame([(1, "A Short one.", "", ""), (2, "shorten", "", ""), (3, "他说短文在此了", "", ""), (4, "shart", "", "")], SCHEMA)
    bench = spark.createDataFrame([(7, "short"), (8, "短文"), (9, "!"), (10, None)], "item_id long, text string")
    assert sorted(map(tuple, dc.query(docs, bench).collect())) == [(1, 7, 0), (3, 8, 0)]


def test_invalid_bytes_and_other_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a passage of the benchmark stands here", "x", "kept")], "doc_id long, text string, hits string, hits_now string")
    docs = docs.withColumn("text", F.concat(F.expr("cast(x'FFFE20' as string)"), "text"))
    bench = spark.createDataFrame([(7, "passage of the benchmark stands"), (8, "nothing of this kind at all")], "item_id long, text string")
    got = dc.contamination(docs, bench).collect()
    assert [(r["hits_now"], [tuple(h) for h in r["hits"]]) for r in got] == [("kept", [(7, 0)])]
