"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage of a document by at most ``budget(m)`` edits. Cut
into more than half as many parts, at least one part has one edit or none, so one of its halves survives
unchanged. One automaton finds all halves in one sweep over a text; where the other half stands beside
with one edit at most, Myers' bit-parallel algorithm (1999, in
Hyyro's form for words of any length) gives the least edit distance of the item to any substring.

Texts and items are compared in normal form: lower case, every run of characters other than letters and
digits as one space.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_CHARS`` characters, each block a
sweep over the documents, so what a task holds is bounded however large the benchmark is.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.tables import texts

BLOCK_CHARS = 4_000_000
PERCENT, SHORTEST = 10, 16
_other = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    return _other.sub(" ", text.lower()).strip()


def budget(length: int, percent: int = PERCENT) -> int:
    """Edits allowed: ``percent`` of the length; none for items shorter than ``SHORTEST``."""
    return length * percent // 100 if length >= SHORTEST else 0


def pieces(item: str, edits: int) -> list[tuple[int, str, str, bool]]:
    """(place, piece, other half of its part, whether that follows): one piece and its part survive ``edits``."""
    if not edits:
        return [(0, item, "", True)]
    n = 2 * (edits // 2 + 1)
    cuts = [i * len(item) // n for i in range(n + 1)]
    cut = [item[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(cuts[i], cut[i], cut[i ^ 1], i % 2 == 0) for i in range(n)]


def follows(text: str, at: int, want: str) -> bool:
    """Whether ``want`` stands in ``text`` from ``at`` on with one edit at most."""
    if text.startswith(want, at):
        return True
    i = 0
    while at + i < len(text) and i < len(want) and text[at + i] == want[i]:
        i += 1
    rest = want[i + 1 :]
    return text.startswith(rest, at + i + 1) or text.startswith(rest, at + i) or text.startswith(want[i:], at + i + 1)


def inside_word(text: str, a: int, b: int) -> bool:
    """Whether text[a:b] is cut out of a longer word of a script with cases, or of a longer number."""
    joins = lambda x, y: all(c.isdigit() or c.lower() != c.upper() for c in (x, y))
    return a > 0 and joins(text[a - 1], text[a]) or b < len(text) and joins(text[b - 1], text[b])


class Myers:
    """Least edit distance of a pattern to any substring of a text."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.full = (1 << self.length) - 1
        self.high = 1 << (self.length - 1)
        self.eq: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.eq[c] = self.eq.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end of the leftmost best substring)."""
        pv, mv, score, full, high, get = self.full, 0, self.length, self.full, self.high, self.eq.get
        low, at = score, 0
        for j, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            ph = ph << 1 & full  # a substring may start anywhere: no cost above the pattern
            mh = mh << 1 & full
            pv = mh | (full & ~(xv | ph))
            mv = ph & xv
            if score < low:
                low, at = score, j
        return low, at


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.items = [(i, t, budget(len(t), percent)) for i, t in items]
        self.myers: dict[int, Myers] = {}
        where: dict[str, list[tuple[int, int, str, bool]]] = {}
        for n, (_, t, edits) in enumerate(self.items):
            for at, piece, other, after in pieces(t, edits):
                where.setdefault(piece, []).append((n, at, other if after else other[::-1], after))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.any = bool(where)

    def found(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end) of the best passage for each item within its budget."""
        if not self.any:
            return []
        diagonals: dict[int, list[int]] = {}
        back = text[::-1]
        for end, (length, places) in self.automaton.iter(text):
            for n, at, other, after in places:
                if follows(text, end + 1, other) if after else follows(back, len(text) - (end - length + 1), other):
                    diagonals.setdefault(n, []).append(end - length + 1 - at)
        out = []
        for n, starts in diagonals.items():
            item_id, item, edits = self.items[n]
            best = None
            if len(item) < SHORTEST:
                ends = [s + len(item) for s in starts if not inside_word(text, s, s + len(item))]
                if ends:
                    out.append((item_id, 0, min(ends)))
                continue
            windows: list[list[int]] = []
            for s in sorted(set(starts)):  # overlapping windows are verified as one
                a, b = max(0, s - edits), min(len(text), s + len(item) + edits)
                if windows and a <= windows[-1][1]:
                    windows[-1][1] = max(b, windows[-1][1])
                else:
                    windows.append([a, b])
            for a, b in windows:
                if b - a < len(item) - edits:
                    continue
                m = self.myers.get(n)
                if m is None:
                    m = self.myers[n] = Myers(item)
                distance, end = m.best(text[a:b])
                if distance <= edits and (best is None or distance < best[0]):
                    best = (distance, a + end)
            if best:
                out.append((item_id, *best))
        return sorted(out)


_matchers: dict[str, Matcher] = {}  # of this worker, the last block used


def _match(shared, percent: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matchers.get(name)
        if matcher is None:
            _matchers.clear()
            matcher = _matchers[name] = Matcher(shared.value, percent)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))
        for batch in batches:
            at, hits = batch.schema.get_field_index("hits"), []
            for t, before in zip(texts(batch, "text"), batch.column(at).to_pylist(), strict=True):
                hits.append(before + [{"item_id": i, "distance": d} for i, d, _ in matcher.found(normal(t.decode("utf-8", "replace")))])
            columns = [pa.array(hits, kind) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in normal form, in blocks of bounded size, streamed to the driver."""
    held, size = [], 0
    for r in benchmark.select("item_id", "text").where("item_id is not null and text is not null").toLocalIterator():
        t = normal(r["text"])
        if not t:
            continue
        if held and size + len(t) > BLOCK_CHARS:
            yield held
            held, size = [], 0
        held.append((r["item_id"], t))
        size += len(t)
    yield held


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with a column hits (array of item_id, distance): the items that a passage of the text matches.

    docs: text and any other columns, which are kept (a column named hits is replaced). benchmark: item_id,
    text. Null and empty texts match nothing, bytes that aren't UTF-8 are read as replacement characters; null items and items without letters or digits
    are passed over; items of fewer than ``SHORTEST`` characters match exactly, not inside a word. Repeated rows each get their hits.
    """
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

    spark = docs.sparkSession
    kind = ArrayType(StructType([StructField("item_id", LongType()), StructField("distance", IntegerType())]))
    out = docs.drop("hits").withColumn("hits", F.array().cast(kind))
    for block in _blocks(benchmark):
        out = out.mapInArrow(_match(spark.sparkContext.broadcast(block), percent, uuid.uuid4().hex), out.schema)
    return out


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it contains: doc_id, item_id, distance."""
    found = contamination(docs.select("doc_id", "text"), benchmark).where(F.size("hits") > 0)
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.item_id", "h.distance")
