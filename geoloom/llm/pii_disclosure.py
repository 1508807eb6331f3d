"""Personal data and the terms that disclose it, with DataFrame functions only.

Emails, IP addresses, card and phone numbers are found by pattern. Each distinct value is a protected
entity. For every entity the documents that hold both it and a term are counted, wherever in the text the
two stand, and over the whole corpus every such term's document frequency. A term t reveals of an entity
e the information log2(P(e|t) / P(e)) out of the -log2 P(e) bits that identify e. Where that share
reaches ``GENERALISE`` the term is generalised, from ``REMOVE`` on it is removed, at every place it stands,
whichever document. Entities and pairs count from one document on; against chance P(e|t) is estimated with
absolute discounting, (n_both - ``DISCOUNT``) / n_term, so one document tells 1.6 bits less than it seems to
(below some 240 documents in all that stays under ``GENERALISE``). Equal texts count as one document: a copy
is no further evidence.

Sanchez, Batet and Viejo, "Automatic general-purpose sanitization of textual documents" (2013), gives the
measure. Positions come from the pieces between matches, so they need no row-at-a-time code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.tables import wide_row_key
from geoloom.plans.materialize import materialize

KINDS = ("email", "ip", "card", "phone", "term")
GENERALISE, REMOVE, DISCOUNT = 0.8, 0.95, 2 / 3
SUPPORT = 3  # nothing is cut by it here; from so many documents on the tests compare with the plain estimate
BROADCAST_TERMS, BROADCAST_HASHES = 20_000, 1 << 20
RUN = 256  # words of a text whose places are found at a time
# Possessive forms of the contract's patterns: the classes that follow each other exclude each other, so
# nothing could be given back. A match starts where a run starts, or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"[\p{L}\p{M}]+"
PLACES = "array<struct<start:int,end:int,value:string>>"


def _matches(text: Column, pattern: Column | str) -> Column:
    """Places of all matches, in code points, from what stands between them."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"))
    pairs = F.filter(pairs, lambda p: p["hit"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out"))

    def step(done: Column, p: Column) -> Column:
        a = done["at"] + F.length(p["gap"])
        b = a + F.length(p["hit"])
        return F.struct(b.alias("at"), F.array_append(done["out"], F.struct(a.alias("start"), b.alias("end"), p["hit"].alias("value"))).alias("out"))

    return F.aggregate(pairs, start, step, lambda done: done["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.reverse(_digits(value))
    digits = F.transform(F.sequence(F.lit(1), F.length(back)), lambda i: F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(digits, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    """The places of each kind that pass its test."""
    valid = {
        "email": lambda p: F.lit(True),
        "ip": lambda p: p["value"].rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"),
        "card": lambda p: F.when(F.length(_digits(p["value"])).between(14, 19), _luhn(p["value"])).otherwise(False),
        "phone": lambda p: F.length(_digits(p["value"])).between(10, 15),
    }
    digit = text.rlike("[0-9]")
    worth = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": digit & F.contains(text, F.lit("+"))}
    return {k: F.when(worth[k], F.filter(_matches(text, PATTERNS[k]), valid[k])).otherwise(F.array().cast(PLACES)) for k in PATTERNS}


def _entity(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value))


def _words(text: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))


def base_places(docs: DataFrame) -> DataFrame:
    """r (row key), h (hash of the text), doc_id, the places of each kind, the entities and, beside any, the distinct terms of every row.

    Words inside personal data are no terms.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select(wide_row_key().alias("r"), F.xxhash64(text).alias("h"), "doc_id", text.alias("t")).select("r", "h", "doc_id", "t", *[c.alias(k) for k, c in _base(F.col("t")).items()])

    def values(kind: str) -> Column:
        return F.transform(kind, lambda p: _entity(kind, p["value"]))

    entities = F.array_distinct(F.concat(*[values(k) for k in PATTERNS]))
    rest = F.col("t")
    for p in PATTERNS.values():
        rest = F.regexp_replace(rest, p, " ")
    found = found.select("r", "h", "doc_id", "t", *PATTERNS, entities.alias("entities"))
    return found.select("r", "h", "doc_id", *PATTERNS, "entities", F.when(F.size("entities") > 0, _words(rest)).alias("terms"))


def _of_hash(words: DataFrame, terms: DataFrame) -> DataFrame:
    """``words`` without most of those that aren't in ``terms``, so that few are shuffled; all of them for very many terms."""
    if terms.count() > BROADCAST_HASHES:
        return words
    hashes = terms.select(F.xxhash64("term").alias("__h")).distinct()
    return words.join(F.broadcast(hashes), F.xxhash64("term") == F.col("__h"), "left_semi")


def _held_by(rows: DataFrame, name: str) -> DataFrame:
    """For each value of ``name`` its number of documents (h) and 128 bits that tell sets of documents apart."""
    return rows.groupBy(name).agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("y"))


def disclosing_terms(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(term, disclosure): the greatest share of any entity's information that a term reveals, from GENERALISE on.

    Entities that stand in the same documents, and terms that do, are compared once for all, so a document
    of many entities and rare words gives few pairs.
    """
    total = base.select("h").distinct().count()
    near = materialize(base.where(F.size("entities") > 0).dropDuplicates(["h"]).select("h", "entities", "terms"))
    entities, terms = near.select("h", F.explode("entities").alias("entity")), near.select("h", F.explode("terms").alias("term"))
    of_entity = _held_by(entities, "entity").groupBy("n", "x", "y").agg(F.min("entity").alias("entity")).select("entity", F.col("n").alias("n_entity"))
    most = of_entity.agg(F.max("n_entity")).first()[0] or 0
    of_near = materialize(_held_by(terms, "term"))
    whole = docs.select(F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t")).dropDuplicates(["h"])
    words = whole.select(F.explode(_words("t")).alias("term"))
    of_term = _of_hash(words, of_near).groupBy("term").agg(F.count("*").alias("n_term"))
    documents = float(max(total, 1))

    def possible(n_entity: Column) -> Column:
        """Whether the share can be reached: n_both is at most n and n_entity."""
        return F.col("n_term") * F.pow(n_entity / documents, F.lit(1 - GENERALISE)) * 0.999 <= F.least("n", n_entity) - DISCOUNT

    # of all entities one of n documents, or the largest if that has fewer, would reach it first
    can = materialize(of_near.join(of_term, "term").where(possible(F.least("n", F.lit(most)))))
    alike = ["n", "x", "y", "n_term"]
    one = can.groupBy(*alike).agg(F.min("term").alias("term"))
    left, right = terms.join(one.select("term", "n", "n_term"), "term"), entities.join(of_entity, "entity")
    pairs = left.join(right, "h").where(possible(F.col("n_entity"))).groupBy("term", "n_term", "entity", "n_entity").agg(F.count("*").alias("n_both"))
    information = -F.log2(F.col("n_entity") / documents)
    revealed = F.log2((F.col("n_both") - DISCOUNT) * documents / (F.col("n_term") * F.col("n_entity")))
    share = pairs.withColumn("share", F.when(information > 0, revealed / information).otherwise(0.0)).where(F.col("share") >= GENERALISE)
    best = share.groupBy("term").agg(F.max("share").alias("disclosure"))
    return can.join(one.join(best, "term").drop("term"), alike).select("term", "disclosure")


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(r, term places): where the terms stand in each text, as whole words."""
    whole = docs.select(wide_row_key().alias("r"), F.coalesce("text", F.lit("")).alias("t"))
    words = whole.select("r", F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))).alias("term"))
    held = words.join(F.broadcast(terms), "term") if terms.count() <= BROADCAST_TERMS else _of_hash(words, terms).join(terms, "term")
    held = held.groupBy("r").agg(F.collect_set(F.struct("term", "disclosure")).alias("held"))
    held = held.select("r", F.transform("held", lambda x: x["term"]).alias("terms"), F.map_from_entries("held").alias("told"))
    # a run ends behind a word, so no word is cut; each run is searched for the terms it holds only
    runs = F.regexp_extract_all("t", F.lit(rf"(?:[^\p{{L}}\p{{M}}]*+{WORD}+){{1,{RUN}}}+"), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,run:string>>").alias("out"))
    runs = F.aggregate(
        runs, start, lambda done, x: F.struct((done["at"] + F.length(x)).alias("at"), F.array_append(done["out"], F.struct(done["at"].alias("at"), x.alias("run"))).alias("out")), lambda done: done["out"]
    )

    def places(x: Column) -> Column:
        here = F.array_intersect(F.regexp_extract_all(x["run"], F.lit(WORD), F.lit(0)), F.col("terms"))
        # terms are letters and marks only, so they are their own pattern
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{M}])(?:"), F.array_join(here, "|"), F.lit(r")(?![\p{L}\p{M}])"))
        found = F.transform(_matches(x["run"], pattern), lambda p: F.struct((x["at"] + p["start"]).alias("start"), (x["at"] + p["end"]).alias("end"), F.col("told")[p["value"]].alias("disclosure")))
        return F.when(F.size(here) > 0, found).otherwise(F.array().cast("array<struct<start:int,end:int,disclosure:double>>"))

    return whole.dropDuplicates(["r"]).join(held, "r").select("r", F.flatten(F.transform(runs, places)).alias("term"))


def find(docs: DataFrame) -> DataFrame:
    """r, doc_id, spans (start, k, end, disclosure) for every row of ``docs`` (doc_id, text; other columns unused).

    k is the place in ``KINDS``. Spans are in code points, by start, then kind. Null texts are empty. Rows that
    repeat doc_id and text have the same spans each; an empty table gives no rows. Terms inside base spans
    add nothing.
    """
    base = materialize(base_places(docs))
    terms = materialize(disclosing_terms(docs, base))
    added = term_places(docs, terms)
    joined = base.drop("entities", "terms", "h").join(added, "r", "left")

    joined = joined.withColumn("known", _known({k: k for k in PATTERNS}))
    free = F.filter(
        F.coalesce("term", F.array().cast("array<struct<start:int,end:int,disclosure:double>>")),
        lambda p: ~F.exists("known", lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])),
    )
    more = F.transform(free, lambda p: F.struct(p["start"].alias("start"), F.lit(4).alias("k"), p["end"].alias("end"), p["disclosure"].alias("disclosure")))
    return joined.select("r", "doc_id", F.array_sort(F.concat("known", more)).alias("spans"))


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    found = find(docs)
    base = F.filter("spans", lambda s: s["k"] < 4)

    def count(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["k"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return found.select("doc_id", *[count(i) for i in range(len(KINDS))], F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its label; overlapping spans go as one."""
    label = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        shown = F.when((s["k"] == 4) & (s["disclosure"] >= REMOVE), F.lit("")).otherwise(F.get(label, s["k"]))
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), shown)).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def _known(places: dict) -> Column:
    """Places of the base kinds as spans, in order."""

    def one(k: int, found: Column | str) -> Column:
        return F.transform(found, lambda p: F.struct(p["start"].alias("start"), F.lit(k).alias("k"), p["end"].alias("end"), F.lit(1.0).alias("disclosure")))

    return F.concat(*[one(KINDS.index(k), c) for k, c in places.items()])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and disclosing terms in text replaced; all rows and columns stay.

    Base kinds become [EMAIL], [IP], [CARD], [PHONE]; generalised terms [TERM]; removed ones nothing. Where
    spans overlap, the first gives its label and all their text goes. What only shows once its neighbour
    is gone (a card number behind the digits of an address) is masked in two further passes. A null text
    stays null.
    """
    spans = find(docs).select("r", "spans").where(F.size("spans") > 0).dropDuplicates(["r"])
    out = docs.withColumn("__r", wide_row_key()).join(spans.select(F.col("r").alias("__r"), F.col("spans").alias("__spans")), "__r", "left")
    told = F.col("__spans").isNotNull() & F.col("text").isNotNull()
    out = out.withColumn("text", F.when(told, _masked(F.col("text"), F.col("__spans"))).otherwise(F.col("text")))
    for _ in range(2):
        out = out.withColumn("__more", F.when(told, F.array_sort(_known(_base(F.col("text"))))))
        out = out.withColumn("text", F.when(told & (F.size("__more") > 0), _masked(F.col("text"), F.col("__more"))).otherwise(F.col("text")))
    return out.select(*docs.columns)
