"""Scoring texts with a Brown class-based bigram model.

P(text) is the product over its tokens of P(class | class before) * P(token | class). Classes come from
exchange clustering (Kneser and Ney; Martin et al., 1998), which moves words between classes while the
likelihood of the corpus rises, in two steps: the ``FREQUENT`` commonest words, and all others by their
spelling (a checksum of the last three bytes), are exchanged on the driver, which gives a table of
classes; then every other word of ``LEAST`` occurrences or more is exchanged against that table by its own
counts of classes before and after it, all words of a round at once and distributed, as in Uszkoreit
and Brants, "Distributed word clustering for large scale class-based language modeling" (2008). Rarer words
keep the class of their spelling. Counts, neighbours and transitions come from all learning rows, and the
words that are clustered grow with the vocabulary.

Words of at least the count that keeps the list under ``LISTED`` words are looked up in the kernel from a
broadcast of that proven size; all others through a join with the whole lexicon. An unknown word has the
class of its spelling and shares one unseen place in it with all others.

Texts are split twice: learning rows for the counts, all rows for the places of their words in the list. These
are written once, as arrays, and all that follows works on them. Counts and neighbours of words are shuffled
by buckets of words, a row for all that a task holds of a bucket.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.language_id import held_out
from geoloom.plans.materialize import materialize

FREQUENT, SPELLINGS, CLASSES, LISTED, LEAST = 768, 256, 48, 1 << 18, 3
KEYS = 3_000_000  # contexts held before they are packed
HELD = 2_000_000  # tokens held before they are counted
BUCKETS, SHARE = 4096, 1 << 12  # buckets of words by checksum, at least, and words of one where their number is known; a shuffled row holds what a task has of a bucket
END = b""  # stands for the end of a text; no word is empty
DELTA, PRIOR = 0.1, 2.0
PAIR = np.dtype([("context", "u1"), ("n", "<u4")])


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, A-Z lowered, of all texts together, and how many each text has; null counts as empty."""
    texts = pc.fill_null(column.cast(options=pc.CastOptions(pa.string(), allow_invalid_utf8=True)), "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, n = parts.flatten().cast(pa.binary()), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at the ends leaves empty parts
    if not full.all():
        before = np.concatenate(([0], np.cumsum(full)))
        flat, n = flat.filter(pa.array(full)), np.diff(before[np.concatenate(([0], np.cumsum(n)))])
    return flat, n


def spelling(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SPELLINGS


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values: the bytes of values[bounds[i]:bounds[i + 1]]."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def _flat(column: pa.Array, kind: np.dtype | type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binary values together, and how many each value has."""
    column = column.cast(pa.binary())
    size = np.dtype(kind).itemsize
    n = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) // size
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind), n


def _joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """words[bounds[i]:bounds[i + 1]] with a space between any two."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), pa.scalar(b" ", pa.binary()))


def _apart(joined: list[bytes]) -> pa.Array:
    """The words of several joined values; none of these is empty but that of the end."""
    return pc.split_pattern(pa.array([b" ".join(joined)], pa.binary()), b" ").flatten()


def _padded(values: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' values with ``end`` before, between and after them, and where each value stands."""
    at = np.arange(len(values)) + np.repeat(np.arange(len(n)), n) + 1
    out = np.full(len(values) + len(n) + 1, end, np.int64)
    out[at] = values
    return out, at


def _dealt(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of words by bucket, the buckets that occur, and the bounds of each."""
    bucket = np.fromiter(map(zlib.crc32, words.to_pylist()), np.uint32, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, found.astype(np.int32), np.append(first, len(words))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each value of the first column, by which they are sorted; that value and the other columns."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != at:
                yield at, held
                held = []
            at = row[0]
            held.append(row[1:])
    if held:
        yield at, held


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Array] = []
    size = ends = 0
    names = ["bucket", "words", "n"]

    def out() -> pa.RecordBatch:
        found = pc.value_counts(pa.concat_arrays(held))
        words, n = found.field("values"), found.field("counts").to_numpy(zero_copy_only=False).astype(np.int64)
        order, bucket, bounds = _dealt(words, BUCKETS)
        return pa.RecordBatch.from_arrays([pa.array(bucket), _joined(words.take(pa.array(order)), bounds), _cut(n[order], bounds)], names=names)

    for batch in batches:
        flat, n = words_of(_column(batch, "text"))
        ends += len(n)
        size += len(flat)
        held.append(flat)
        if size > HELD:
            yield out()
            held, size = [], 0
    if size:
        yield out()
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([END], pa.binary()), _cut(np.array([ends]), np.array([0, 1]))], names=names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each bucket: its distinct words and their counts."""
    for bucket, rows in _groups(batches):
        found = _apart([w for w, _ in rows]).dictionary_encode()
        n = np.frombuffer(b"".join(n for _, n in rows), np.int64)
        c = np.bincount(found.indices.to_numpy(zero_copy_only=False), n).astype(np.int64)
        bounds = np.array([0, len(c)])
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), _joined(found.dictionary, bounds), _cut(c, bounds)], names=["bucket", "words", "n"])


def _level(c: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(c) * 16).astype(np.int64)


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = _flat(_column(batch, "n"), np.int64)[0]
        level, at, n = np.unique(_level(c), return_inverse=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(level), pa.array(n), pa.array(np.bincount(at, c, len(level)).astype(np.int64))], names=["level", "words", "tokens"])


def _commonest(lowest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = _flat(_column(batch, "n"), np.int64)[0]
            if len(c):
                at = pa.array(np.flatnonzero(_level(c) >= lowest))
                yield pa.RecordBatch.from_arrays([_apart(_column(batch, "words").to_pylist()).take(at), pa.array(c).take(at)], names=["w", "c"])

    return run


def _coded(shared):
    """Places of a text's words in the list, four bytes each, -1 less the spelling for one beyond it; those words apart, joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(shared.value)}
        for batch in batches:
            flat, n = words_of(_column(batch, "text"))
            found = flat.dictionary_encode()
            distinct = found.dictionary.to_pylist()
            code = np.fromiter(map(index.get, distinct, repeat(-1)), np.int32, len(distinct))
            rare = np.flatnonzero(code < 0)
            code[rare] = [-1 - spelling(distinct[i]) for i in rare.tolist()]
            ids = code[found.indices.to_numpy(zero_copy_only=False)]
            bounds = np.concatenate(([0], np.cumsum(n)))
            beyond = np.concatenate(([0], np.cumsum(ids < 0)))[bounds]
            rest = [_column(batch, c) for c in ("id", "doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays([*rest, _cut(ids, bounds), _joined(flat.filter(pa.array(ids < 0)), beyond)], names=["id", "doc_id", "held_out", "ids", "rare"])

    return run


def _by_code(listed: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """What is to be looked up by the codes of ``_coded``: those of spellings count from the end."""
    return np.concatenate((listed, spelled[::-1]))


def _neighbours(entry: np.ndarray, size: int):
    """Counts of each entry's neighbours, by entry; the last entry is the end, also before the first token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size * size, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            x, _ = _padded(*_looked_up(batch, entry), size - 1)
            held.append(x[:-1] * size + x[1:])
            if sum(map(len, held)) > HELD:
                seen += np.bincount(np.concatenate(held), minlength=size * size)
                held = []
        if held:
            seen += np.bincount(np.concatenate(held), minlength=size * size)
        bounds = np.arange(size + 1) * size
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), _cut(seen, bounds)], names=["entry", "n"])

    return run


def _looked_up(batch: pa.RecordBatch, by_code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, n = _flat(_column(batch, "ids"), np.int32)
    return by_code[ids], n


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for entry, rows in _groups(batches):
        n = sum(np.frombuffer(x, np.int64) for (x,) in rows)
        yield pa.RecordBatch.from_arrays([pa.array([entry], pa.int32()), _cut(n, np.array([0, len(n)]))], names=["entry", "n"])


def exchange(pairs: np.ndarray, classes: int, rounds: int = 8) -> np.ndarray:
    """Class of each entry from its neighbour counts; the last entry (the end) keeps the last class alone."""
    size = len(pairs)
    total = pairs.sum(1) + pairs.sum(0)
    of = np.empty(size, np.int64)
    order = np.argsort(-total[:-1], kind="stable")
    of[order] = np.arange(size - 1) % (classes - 1)
    of[-1] = classes - 1
    one = np.zeros((size, classes))
    one[np.arange(size), of] = 1
    right, left = pairs @ one, pairs.T @ one  # counts of each entry with classes after and before it
    table = one.T @ right
    xlogx = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)
    for _ in range(rounds):
        moved = 0
        for w in order:
            if not total[w]:
                continue
            a, own = of[w], pairs[w, w]
            r, lf = right[w].copy(), left[w].copy()
            r[a] -= own
            lf[a] -= own
            table[a] -= r
            table[:, a] -= lf
            table[a, a] -= own
            before = xlogx(table)
            rows = (xlogx(table + r[None, :]) - before).sum(1)
            columns = (xlogx(table + lf[:, None]) - before).sum(0)
            d = np.diag(table)
            corner = xlogx(d + r + lf + own) - xlogx(d + r) - xlogx(d + lf) + xlogx(d)
            out, into = table.sum(1) + lf, table.sum(0) + r  # what stands next to w keeps its own totals
            mass = xlogx(out + r.sum() + own) - xlogx(out) + xlogx(into + lf.sum() + own) - xlogx(into)
            gain = rows + columns + corner - mass
            gain[-1] = -np.inf
            b = int(gain.argmax()) if gain.max() > gain[a] + 1e-9 else int(a)
            table[b] += r
            table[:, b] += lf
            table[b, b] += own
            if b != a:
                moved += 1
                of[w] = b
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            break
    return of


@dataclass
class Listed:
    """What a kernel knows: the listed words with counts and classes, and the class of every spelling."""

    words: list[bytes]  # by descending count
    counts: np.ndarray
    of: np.ndarray
    spelled: np.ndarray
    end: int  # class of the end, and how many there are
    ends: int


def _contexts(shared, head: int, buckets: int):
    """Packed counts of the classes before (0..) and after (CLASSES..) each word beyond the ``head`` first listed ones, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Listed = shared.value
        listed, class_of = pa.array(known.words, pa.binary()), _by_code(known.of, known.spelled)
        held: list[np.ndarray] = []
        beyond: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # words beyond the list with the classes around them
        size = 0

        def flush() -> pa.RecordBatch:
            keys, words = [*held], listed
            if beyond:
                found = pa.concat_arrays([w for w, _, _ in beyond]).dictionary_encode()
                at = (found.indices.to_numpy(zero_copy_only=False).astype(np.int64) + len(listed)) * (2 * CLASSES)
                keys += [at + np.concatenate([b for _, b, _ in beyond]), at + CLASSES + np.concatenate([a for _, _, a in beyond])]
                words = pa.concat_arrays([listed, found.dictionary])
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            word = key // (2 * CLASSES)
            pairs = np.zeros(len(key), PAIR)
            pairs["context"], pairs["n"] = key % (2 * CLASSES), n
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            words, ends = words.take(pa.array(word[first])), np.append(first, len(key))
            order, bucket, bounds = _dealt(words, buckets)
            sizes = np.diff(ends)[order]
            pairs = np.frombuffer(b"".join(_cut(pairs, ends).take(pa.array(order)).to_pylist()), PAIR)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket), _joined(words.take(pa.array(order)), bounds), _cut(sizes.astype(np.uint8), bounds), _cut(pairs, np.concatenate(([0], np.cumsum(sizes)))[bounds])],
                names=["bucket", "words", "sizes", "packed"],
            )

        for batch in batches:
            ids, n = _flat(_column(batch, "ids"), np.int32)
            if not len(ids):
                continue
            x, at = _padded(class_of[ids], n, known.end)
            tail, rare = np.flatnonzero(ids >= head), np.flatnonzero(ids < 0)
            key = ids[tail].astype(np.int64) * (2 * CLASSES)
            held += [key + x[at[tail] - 1], key + CLASSES + x[at[tail] + 1]]
            if len(rare):
                beyond.append((_apart([w for w in _column(batch, "rare").to_pylist() if w]), x[at[rare] - 1], x[at[rare] + 1]))
            size += 2 * (len(tail) + len(rare))
            if size > KEYS:
                yield flush()
                held, beyond, size = [], [], 0
        if size:
            yield flush()

    return run


def _exchanged(table: np.ndarray, spelled: np.ndarray):
    """(w, c, class) from packed contexts by bucket: each word goes where its neighbours are likeliest, given the table of classes."""
    smooth = table + 0.01
    log, before_of, after_of = np.log(smooth), np.log(smooth.sum(0)), np.log(smooth.sum(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            found = _apart([w for w, _, _ in rows]).dictionary_encode()
            words, sizes = found.dictionary, np.frombuffer(b"".join(x for _, x, _ in rows), np.uint8)
            pairs = np.frombuffer(b"".join(x for _, _, x in rows), PAIR)
            word = np.repeat(found.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
            m = np.bincount(word * (2 * CLASSES) + pairs["context"], pairs["n"], len(words) * 2 * CLASSES).reshape(-1, 2 * CLASSES)
            c = m[:, :CLASSES].sum(1)
            of, often, rare = np.zeros(len(words), np.int32), np.flatnonzero(c >= LEAST), np.flatnonzero(c < LEAST)
            of[rare] = [spelled[spelling(w)] for w in words.take(pa.array(rare)).to_pylist()]
            before, after = m[often, :CLASSES], m[often, CLASSES:]
            # what the likelihood of the classes gains by one more word of these neighbours in a class
            gain = before @ log + after @ log.T - np.outer(c[often], before_of) - np.outer(after.sum(1), after_of)
            gain[:, -1] = -np.inf
            of[often] = gain.argmax(1)
            yield pa.RecordBatch.from_arrays([words, pa.array(c.astype(np.int64)), pa.array(of)], names=["w", "c", "class"])

    return run


@dataclass
class Classes:
    lexicon: DataFrame  # w, c, class of every word that was learned, the end among them
    listed: Listed
    n_tokens: int
    n_words: int


@dataclass
class Counted:
    """The listed words of a corpus by descending count, their counts, and what there is in all."""

    words: list[bytes]
    counts: np.ndarray
    ends: int
    n_tokens: int
    n_words: int


def count_words(training: DataFrame) -> Counted:
    """Counts of all words of ``training`` (text)."""
    dealt = training.select("text").mapInArrow(_counts, "bucket int, words binary, n binary").repartition("bucket").sortWithinPartitions("bucket")
    counts = materialize(dealt.mapInArrow(_summed, "bucket int, words binary, n binary"))
    ends = int(sum(np.frombuffer(r["n"], np.int64).sum() for r in counts.where("bucket < 0").collect()))
    counts = counts.where("bucket >= 0")
    levels = counts.mapInArrow(_levels, "level long, words long, tokens long").groupBy("level").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).orderBy(F.desc("level")).collect()
    lowest, listed = 1 << 20, 0
    for r in levels:
        listed += r["words"]
        if listed > LISTED:
            break
        lowest = r["level"]
    held = counts.mapInArrow(_commonest(lowest), "w binary, c long").toArrow()
    pairs = sorted(zip(held["c"].to_pylist(), held["w"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    n_tokens, n_words = ends + sum(r["tokens"] for r in levels), (ends > 0) + sum(r["words"] for r in levels)
    return Counted([w for _, w in pairs], np.array([c for c, _ in pairs], np.int64), ends, n_tokens, n_words)


def code(docs: DataFrame, counted: Counted) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with the places of their words in the list instead of texts, written once for all that follows."""
    shared = docs.sparkSession.sparkContext.broadcast(counted.words)
    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", "held_out", "text")
    return materialize(rows.mapInArrow(_coded(shared), "id long, doc_id long, held_out boolean, ids binary, rare binary"))


def cluster(coded: DataFrame, counted: Counted) -> Classes:
    """Classes of all words of the coded texts, which are those that were counted."""
    spark, words, count, ends = coded.sparkSession, counted.words, counted.counts, counted.ends
    frequent = min(FREQUENT, len(words))
    size = frequent + SPELLINGS + 1
    entry = np.array([i if i < frequent else frequent + spelling(w) for i, w in enumerate(words)], np.int64)
    by_code = _by_code(entry, np.arange(frequent, size - 1))
    neighbours = np.zeros((size, size))
    near = coded.select("ids").mapInArrow(_neighbours(by_code, size), "entry int, n binary").repartition("entry").sortWithinPartitions("entry")
    for r in near.mapInArrow(_added, "entry int, n binary").toArrow().to_pylist():
        neighbours[r["entry"]] = np.frombuffer(r["n"], np.int64)
    of = exchange(neighbours, CLASSES)
    spelled, end = of[frequent : size - 1], int(of[-1])
    known = Listed(words, count, of[entry], spelled, end, ends)
    one = np.zeros((size, CLASSES))
    one[np.arange(size), of] = 1
    contexts = _contexts(spark.sparkContext.broadcast(known), frequent, max(BUCKETS, counted.n_words // SHARE))
    packed = coded.select("ids", "rare").mapInArrow(contexts, "bucket int, words binary, sizes binary, packed binary")
    found = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_exchanged(one.T @ neighbours @ one, spelled), "w binary, c long, class int")
    first = [(w, int(c), int(k)) for w, c, k in zip(words[:frequent], count, known.of, strict=False)] + [(END, ends, end)] * (ends > 0)
    lexicon = materialize(found.union(spark.createDataFrame(first, "w binary, c long, class int")))
    least = int(count[-1]) if len(words) else 0
    final = lexicon.where((F.col("c") >= least) & (F.length("w") > 0)).select("w", "class").toArrow()  # the listed words: a list ends between two counts
    class_of = dict(zip(final["w"].to_pylist(), final["class"].to_pylist(), strict=True)) if words else {}
    known = Listed(words, count, np.array([class_of[w] for w in words], np.int64), spelled, end, ends)
    return Classes(lexicon, known, counted.n_tokens, counted.n_words)


def learn_classes(training: DataFrame) -> Classes:
    """Counts and classes of all words of ``training`` (text)."""
    counted = count_words(training)
    return cluster(code(training.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text"), counted), counted)


def _paths(shared):
    """The classes of a text's tokens, one byte each, its end not among them; words beyond the list by their spelling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Listed = shared.value
        class_of = _by_code(known.of, known.spelled).astype(np.uint8)
        log_count = _by_code(np.log10(known.counts + DELTA), np.zeros(SPELLINGS))
        end_log = math.log10(known.ends + DELTA)
        for batch in batches:
            ids, n = _flat(_column(batch, "ids"), np.int32)
            row = np.repeat(np.arange(len(n)), n)
            listed = np.bincount(row[ids >= 0], minlength=len(n)) + (known.ends > 0)
            log = np.bincount(row, log_count[ids], len(n)) + end_log
            rest = [_column(batch, c) for c in ("id", "doc_id", "held_out")]
            path = _cut(class_of[ids], np.concatenate(([0], np.cumsum(n))))
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n + 1), pa.array(listed, pa.int64()), pa.array(log, pa.float64()), path], names=["id", "doc_id", "held_out", "n_tokens", "n_known", "known", "path"])

    return run


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, at, w) of each word beyond the list."""
    for batch in batches:
        ids, n = _flat(_column(batch, "ids"), np.int32)
        beyond = np.flatnonzero(ids < 0)
        if len(beyond):
            row = np.repeat(np.arange(len(n)), n)[beyond]
            at = (beyond - (np.cumsum(n) - n)[row]).astype(np.int32)
            words = _apart([w for w in _column(batch, "rare").to_pylist() if w])
            yield pa.RecordBatch.from_arrays([_column(batch, "id").take(pa.array(row)), pa.array(at), words], names=["id", "at", "w"])


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path with the classes of ``more`` (at, class) put in, and without that column."""
    for batch in batches:
        path, n = _flat(_column(batch, "path"), np.uint8)
        more = _column(batch, "more")
        put = more.flatten()
        first = np.repeat(np.cumsum(n) - n, pc.fill_null(pc.list_value_length(more), 0).to_numpy(zero_copy_only=False))
        path = path.copy()
        path[first + put.field("at").to_numpy(zero_copy_only=False)] = put.field("class").to_numpy(zero_copy_only=False)
        names = [c for c in batch.schema.names if c not in ("path", "more")]
        yield pa.RecordBatch.from_arrays([*(_column(batch, c) for c in names), _cut(path, np.concatenate(([0], np.cumsum(n))))], names=[*names, "path"])


def _transitions(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            x, _ = _padded(*_flat(_column(batch, "path"), np.uint8), end)
            seen += np.bincount(x[:-1] * CLASSES + x[1:], minlength=CLASSES * CLASSES)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["pair", "n"])

    return run


def model(table: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 P(class | class before), log10 of what a count is divided by in each class), from transitions and distinct words."""
    share = (table.sum(0) + DELTA) / (table.sum() + DELTA * len(table))
    transition = np.log10((table + PRIOR * share) / (table.sum(1, keepdims=True) + PRIOR))
    return transition, np.log10(table.sum(0) + DELTA * (kinds + 1))


def _scores(transition: np.ndarray, divisor: np.ndarray, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, n = _flat(_column(batch, "path"), np.uint8)
            x, _ = _padded(path, n, end)
            # a step into each token and one into each end
            added = np.bincount(np.repeat(np.arange(len(n)), n + 1), transition[x[:-1], x[1:]] - divisor[x[1:]], len(n))
            names = [c for c in batch.schema.names if c != "path"]
            yield pa.RecordBatch.from_arrays([*(_column(batch, c) for c in names), pa.array(added, pa.float64())], names=[*names, "added"])

    return run


def class_scores(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text; other columns unused), null texts as empty.

    Learns from the rows whose crc32(doc_id as text) mod 10 isn't 0; a null doc_id isn't held out and teaches
    nothing. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigrams), score
    (log10 probability under the class model) and perplexity. An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select("doc_id", held_out(10, 0).alias("held_out"), "text")
    learns = "not held_out and doc_id is not null"
    counted = count_words(docs.where(learns))
    coded = code(docs, counted)
    learned = cluster(coded.where(learns), counted)
    n, v, end = learned.n_tokens, learned.n_words, learned.listed.end
    shared = spark.sparkContext.broadcast(replace(learned.listed, words=[]))
    paths = coded.drop("rare").mapInArrow(_paths(shared), "id long, doc_id long, held_out boolean, n_tokens long, n_known long, known double, path binary")
    rare = coded.select("id", "ids", "rare").mapInArrow(_rare, "id long, at int, w binary").join(learned.lexicon, "w", "left")
    more = rare.groupBy("id").agg(
        F.count("c").alias("more_known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(DELTA))).alias("more_log"),
        F.collect_list(F.when(F.col("class").isNotNull(), F.struct("at", "class"))).alias("more"),
    )
    joined = paths.join(more, "id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), (F.col("known") + F.coalesce("more_log", F.lit(0.0))).alias("known"), "path", "more"
    )
    filled = materialize(joined.mapInArrow(_filled, "doc_id long, held_out boolean, n_tokens long, n_known long, known double, path binary"))
    table, kinds = np.zeros(CLASSES * CLASSES), np.zeros(CLASSES)
    for r in filled.where(learns).select("path").mapInArrow(_transitions(end), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        table[r["pair"]] = r["n"]
    for r in learned.lexicon.groupBy("class").count().collect():
        kinds[r["class"]] = r["count"]
    transition, divisor = model(table.reshape(CLASSES, CLASSES), kinds)
    scored = filled.mapInArrow(_scores(transition, divisor, end), "doc_id long, held_out boolean, n_tokens long, n_known long, known double, added double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * math.log10(n + DELTA * (v + 1))).alias("base_score"), (F.col("known") + F.col("added")).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
