import hashlib
import math
import random
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from geoloom.llm import pii_disclosure as pii

SCHEMA = "doc_id long, text string, spans string, r string"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    for k, (name, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            d = re.sub("[^0-9]", "", m[0])
            if name == "email" or name == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or name == "card" and 14 <= len(d) <= 19 and luhn(d) or name == "phone" and 10 <= len(d) <= 15:
                out.append((m.start(), k, m.end(), m[0]))
    return sorted(out)


def brute(rows):
    """Base spans and terms, the slow way."""
    texts = [t or "" for _, t, *_ in rows]
    word = r"[\p{L}\p{M}]+"
    near, entities, df = Counter(), Counter(), Counter()
    for i, t in enumerate(texts):
        df.update(set(regex.findall(word, t)))
        seen = {}
        for s, k, e, v in base(t):
            left, right = t[max(0, s - 60) : s], t[e : e + 60]
            left = re.sub(r"^\S*", "", left) if s > 60 else left
            right = re.sub(r"\S*$", "", right) if len(right) == 60 else right
            both = left + " " + right
            for rule in RULES.values():
                both = re.sub(rule, " ", both)
            key = (k, v.lower() if k == 0 else v if k == 1 else re.sub("[^0-9]", "", v))
            seen.setdefault(key, set()).update(regex.findall(word, both))
        for key, terms in seen.items():
            entities[key] += 1
            near.update((key, w) for w in terms)
    n, terms = len(texts), {}
    for (key, w), both in near.items():
        if both >= pii.SUPPORT and (bits := -math.log2(entities[key] / n)) > 0:
            share = math.log2(both * n / (df[w] * entities[key])) / bits
            if share >= pii.GENERALISE:
                terms[w] = max(share, terms.get(w, 0))
    out = []
    for d, t, *_ in rows:
        t = t or ""
        spans = [x[:3] for x in base(t)]
        listed = lambda x: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in x)
        digest = hashlib.sha256(listed(spans).encode()).hexdigest()
        more = [(m.start(), 4, m.end()) for m in regex.finditer(word, t) if m[0] in terms and not any(s < m.end() and m.start() < e for s, _, e in spans)]
        counts = Counter(pii.KINDS[k] for _, k, _ in spans + more)
        out.append((d is None, d, *(counts[k] for k in pii.KINDS), digest, listed(sorted(spans + more))))
    return sorted(out), terms


def corpus():
    rng = random.Random(11)
    words = ["alpha", "béta", "gamma", "delta", "Omega", "the", "in"]
    value = [
        lambda: f"{rng.choice('ab')}{rng.randint(1, 5)}@x-{rng.randint(1, 3)}.org", lambda: ".".join(str(rng.randint(0, 300)) for _ in range(rng.randint(3, 6))),
        lambda: "".join(rng.choice(["0", "4", "5", "7", " ", "-", "12", "31"]) for _ in range(rng.randint(8, 22))), lambda: f"+{rng.randint(1, 99)} ({rng.randint(1, 999)}) 555-{rng.randint(100, 99999)}", lambda: "4111 1111 1111 1111",
    ]
    rows = []
    for i in range(200):
        parts = [rng.choice(words + [f"w{i}"[1:] or "x"]) if rng.random() < 0.75 else rng.choice(value)() for _ in range(rng.randint(0, 40))]
        rows.append((i, rng.choice([" ", ", ", "\n", ""]).join(parts), "", ""))
    rows += [(300 + i, f"Report by Zaphod 😀 Beeblebrox writes to z@heart.gold about {rng.choice(words)} and Zaphod", "", "") for i in range(6)]
    odd = ["a@b.c%x@y.z a@b@c.d x..y@z.. @a.b", "1.2.3.4.5.6.7.8 01.002.0003.255 256.1.1.1 1.1.1.1.", "+1 +1-2 (333) 44.55-666) +" + "1" * 40, "😀é 10.0.0.1 ñ", "5" * 16 + "-" + "0" * 3, "a.b" * 3000 + "@x.y" + ".z" * 3000, "7 " * 4000 + " z@heart.gold", None, "", "4111-1111 1111-1111"]
    rows += [(400 + i, t, "", "") for i, t in enumerate(odd)]
    return [*rows, rows[7], (None, rows[8][1], "", "")]


def test_matches_brute_force_and_contract_patterns(spark):
    rows = corpus()
    want, terms = brute(rows)
    assert "Zaphod" in terms and "Beeblebrox" in terms and "the" not in terms
    got = sorted((r["doc_id"] is None, *r) for r in pii.query(spark.createDataFrame(rows, SCHEMA)).select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256", "spans").collect())
    assert got == want


def test_terms_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    rows = corpus()
    got = sorted((r["doc_id"] is None, *r) for r in pii.query(spark.createDataFrame(rows, SCHEMA)).select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256", "spans").collect())
    assert got == brute(rows)[0]


def test_sanitised_texts(spark):
    rows = corpus()
    got = pii.sanitise(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "spans", "r"]
    by = {r["doc_id"]: r["text"] for r in got.collect()}
    assert len(by) == len({r[0] for r in rows}) and by[407] is None and by[408] == ""
    assert by[300].startswith("   😀    [EMAIL]  ") and by[403] == "😀é [IP] ñ"
    assert not any(base(t) for t in by.values() if t)
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.query(empty).count() == pii.sanitise(empty).count() == 0


def test_entities_of_one_and_two_documents(spark):
    rows = [(i, f"you may ask for an ordinary text at home {i}", "", "") for i in range(1200)]
    rows += [(2000, "ask Trillian at t@one.org for an ordinary text", "", ""), (2001, "may ask at home", "", "")]
    rows += [(2010 + i, f"ask Marvin at m@two.org for an ordinary text{"!" * i}", "", "") for i in range(2)]
    got = {r["doc_id"]: r["spans"] for r in pii.query(spark.createDataFrame(rows, SCHEMA)).collect() if r["spans"]}
    assert got == {2000: "term:4:12,email:16:25", 2010: "term:4:10,email:14:23", 2011: "term:4:10,email:14:23"}


def test_places_in_long_texts(spark):
    text = "word " * 700 + "Slartibartfast 😀 s@far.org Slartibartfast" + ", other" * 600 + " Slartibartfast"
    rows = [(i, f"word other {i}", "", "") for i in range(1200)] + [(2000, text, "", "")]
    got = {r["doc_id"]: r["spans"] for r in pii.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = [f"term:{m.start()}:{m.end()}" for m in re.finditer("Slartibartfast", text)]
    assert [x for x in got[2000].split(",") if x.startswith("term")] == want


def test_terms_far_from_the_entity(spark):
    rows = [(i, f"you may ask for an ordinary text at home {i}", "", "") for i in range(1200)]
    text = "Zarniwoop says " + "an ordinary text " * 20 + "z@guide.org " + "at home " * 20
    rows.append((2000, text, "", ""))
    got = {r["doc_id"]: r["spans"] for r in pii.query(spark.createDataFrame(rows, SCHEMA)).collect() if r["spans"]}
    assert got == {2000: "term:0:9,term:10:14,email:355:366"}


def test_disclosure_of_whole_documents_by_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(["".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(30)] + [f"p{rng.randint(1, 400)}@q.org" for _ in range(rng.randint(0, 3))]) for _ in range(700)]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts + texts[:50])], SCHEMA)
    got = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(docs, pii.base_places(docs)).collect()}
    entities, df, both = Counter(), Counter(), Counter()
    for t in set(texts):
        held = {v.lower() for *_, v in base(t)}
        entities.update(held)
        df.update(set(regex.findall(r"[\p{L}\p{M}]+", t)))
        both.update((e, w) for e in held for w in set(regex.findall(r"[\p{L}\p{M}]+", re.sub(RULES["email"], " ", t))))
    n, want = len(set(texts)), {}
    for (e, w), x in both.items():
        share = math.log2((x - pii.DISCOUNT) * n / (df[w] * entities[e])) / math.log2(n / entities[e])
        if share >= pii.GENERALISE:
            want[w] = max(share, want.get(w, 0))
    assert want and got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)


@pytest.mark.parametrize("same", ["a", "b"])
def test_rows_that_share_one_half_of_their_key_stay_apart(spark, monkeypatch, same):
    whole = pii.wide_row_key
    monkeypatch.setattr(pii, "wide_row_key", lambda: whole().withField(same, F.lit(0).cast("long")))
    test_terms_far_from_the_entity(spark)
    rows = [(1, "a@b.org", "", ""), (2, "nothing", "", ""), (3, "c@d.org", "", "")]
    assert sorted((r["doc_id"], r["text"]) for r in pii.sanitise(spark.createDataFrame(rows, SCHEMA)).collect()) == [(1, "[EMAIL]"), (2, "nothing"), (3, "[EMAIL]")]
