"""Removal of long byte strings that repeat, by a distributed sparse suffix array.

A byte goes when some string of ``length`` bytes that covers it also starts elsewhere in the corpus.

Suffixes are sampled by content: of every window of ``length`` bytes the start of its least-hashed
``GRAM``-byte string is the window's anchor, so equal windows have equal anchors at equal offsets, and
about one position in 75 is one. Anchors whose ``GRAM`` bytes occur once, and anchors whose whole
stretch of windows is the same at every occurrence, are settled by counting. The suffixes at all
other anchors are sorted: each task writes front-coded sorted runs (shared prefix length and tail),
runs are exchanged, and a loser tree that keeps for every entry its common prefix with the last
output merges them, so known prefixes are never compared again and the array of common prefixes comes
out with the order. From it and the texts left of the anchors follow the repeated windows exactly.

Anchor groups of more than ``hot`` different stretches aren't gathered: the suffixes of all their
windows are sorted by the same runs and trees, dealt by the window's hash, equal ones of a task
collapsed before the exchange.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import texthash
from geoloom.llm.tables import texts
from geoloom.plans.batches import groups
from geoloom.plans.materialize import materialize

GRAM, HOT = 50, 1024
SEGMENT, RUN, RUN_BYTES = 1 << 20, 40_000, 16 << 20
OTHER_BASE = 0xC2B2AE3D27D4EB4F


def anchors(text: bytes, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(gram hash, stretch hash, anchor, greatest offset, least offset) of each stretch of windows, a segment at a time."""
    width = length - GRAM + 1
    for at in range(0, max(0, len(text) - length + 1), SEGMENT):
        b = np.frombuffer(text, np.uint8)[at : at + SEGMENT + length - 1]
        n = len(b)
        pre, start = texthash.prefix(b), np.arange(n - GRAM + 1)
        h = texthash.ranges(pre, start, start + GRAM)
        key = ((h >> np.uint64(25)) << np.uint64(24) | start.astype(np.uint64)).astype(np.int64)
        m = len(key)
        padded = np.full(-(-m // width) * width, np.iinfo(np.int64).max)
        padded[:m] = key
        rows = padded.reshape(-1, width)
        down = np.minimum.accumulate(rows, 1).ravel()
        up = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        windows = m - width + 1
        a = np.minimum(up[:windows], down[width - 1 : width - 1 + windows]) & ((1 << 24) - 1)
        cut = np.flatnonzero(np.diff(a)) + 1
        first, last = np.concatenate(([0], cut)), np.concatenate((cut - 1, [windows - 1]))
        a = a[first]
        pre2 = texthash.prefix(b, OTHER_BASE)
        stretch = texthash.mix(texthash.ranges(pre2, first, last + length, OTHER_BASE) + (a - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (last - first).astype(np.uint64))
        yield h[a].view(np.int64), stretch.view(np.int64), a + at, a - first, a - last


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            rows = 0
            for key, text in zip(batch.column(batch.schema.get_field_index("r")).to_pylist(), texts(batch, "text"), strict=True):
                for g, s, a, high, low in anchors(text, length):
                    held.append((g, s, np.full(len(g), key), a << 16 | high << 8 | low))
                    rows += len(g)
                if rows > 200_000:
                    yield _rows(held)
                    held, rows = [], 0
            if held:
                yield _rows(held)

    def _rows(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*held, strict=True)], names=["gram", "stretch", "r", "pos"])

    return run


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> Iterator[tuple[int, bytes]]:
    last = b""
    for s in strings:
        n = common(last, s)
        yield n, s[n:]
        last = s


def merge_runs(runs: list[Iterable[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merge front-coded sorted runs of (shared, tail, payload) into (shared with the last output, string, payload).

    A loser tree: each waiting entry holds its common prefix with the last output; of two entries the one
    that shares more is the lesser, and only equal values make bytes beyond them be compared.
    """
    size = 1
    while size < len(runs):
        size *= 2
    streams = [iter(r) for r in runs] + [iter(())] * (size - len(runs))
    text: list[bytes | None] = [b""] * size
    shared, load = [0] * size, [None] * size

    def advance(i: int) -> None:
        entry = next(streams[i], None)
        if entry is None:
            text[i], shared[i] = None, -1
        else:
            shared[i] = entry[0]
            text[i] = text[i][: entry[0]] + entry[1]
            load[i] = entry[2]

    def less(i: int, j: int) -> bool:
        """Whether i goes before j; the loser's shared value becomes its common prefix with the winner."""
        if shared[i] != shared[j]:
            return shared[i] > shared[j]
        if text[i] is None:
            return True
        x, y = text[i], text[j]
        n = common(x, y, shared[i])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            shared[j] = n
            return True
        shared[i] = n
        return False

    for i in range(size):
        advance(i)
    loser = [0] * size

    def play(node: int) -> int:
        if node >= size:
            return node - size
        i, j = play(2 * node), play(2 * node + 1)
        if less(i, j):
            loser[node] = j
            return i
        loser[node] = i
        return j

    winner = play(1) if size > 1 else 0
    while text[winner] is not None:
        yield shared[winner], text[winner], load[winner]
        advance(winner)
        node = (winner + size) // 2
        while node:
            if less(loser[node], winner):
                winner, loser[node] = loser[node], winner
            node //= 2


def repeated(shared: list[int], lefts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each member of an anchor group in suffix order: (bytes left of the anchor, bytes right) of what repeats.

    shared[i]: common prefix of suffixes i-1 and i. Neighbouring clusters of the suffix order are joined
    in descending order of their common prefix, the lesser into the greater; for each member the longest
    common text to the left within its cluster is kept, which a sorted list of the left texts shows.
    """
    n = len(lefts)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n == 2:
        left = common(lefts[0], lefts[1])
        return [[(left, shared[1])]] * 2 if left + shared[1] >= length else out
    order = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for at, i in enumerate(order):
        rank[i] = at
    low, members, best = list(range(n)), [[r] for r in rank], [-1] * n

    def root(i: int) -> int:
        while low[i] != i:
            low[i] = low[low[i]]
            i = low[i]
        return i

    for at in sorted(range(1, n), key=lambda i: -shared[i]):
        right = shared[at]
        a, b = root(at - 1), root(at)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        into = members[a]
        for x in members[b]:
            i = order[x]
            to = bisect_left(into, x)
            for near in into[max(0, to - 1) : to + 1]:
                j = order[near]
                left = common(lefts[i], lefts[j])
                for y in (i, j):
                    if left > best[y]:
                        best[y] = left
                        if left + right >= length:
                            out[y].append((left, right))
            into.insert(to, x)
        members[b] = []
        low[b] = a
    return out


RUN_SCHEMA = "part int, run string, seq int, shared int, tail binary, before binary, single boolean, r long, anchor long"
SPAN_SCHEMA = "r long, start long, end long"


def _runs(length: int, parts: int, window_parts: int):
    """Front-coded sorted runs of the suffixes at the wanted anchors; part -1 holds spans that are settled already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unpack, task = zstandard.ZstdDecompressor(), TaskContext.get()
        made = 0
        held: list[tuple] = []  # part, suffix, before, single, r, anchor
        held_bytes = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held, held_bytes
            held.sort(key=lambda x: (x[0], x[1]))
            rows, seq, last, part = [], 0, b"", None
            name = f"{task.partitionId()}-{task.attemptNumber()}-{made}"
            made += 1
            at = 0
            while at < len(held):
                p, suffix, before, single, r, anchor = held[at]
                if p != part:
                    part, last, seq = p, b"", 0
                end = at + 1
                if p >= parts:  # windows of large groups: equal ones of this run are one entry
                    while end < len(held) and held[end][0] == p and held[end][1] == suffix:
                        end += 1
                    if end - at > 1 and len({x[4:] for x in held[at:end]}) > 1:
                        rows += [(-1, name, 0, 0, None, None, True, x[4], x[5]) for x in held[at:end] if x[3]]
                        single = False
                    else:
                        end = at + 1
                n = common(last, suffix)
                rows.append((p, name, seq, n, suffix[n:], before, single, r, anchor))
                last, seq, at = suffix, seq + 1, end
            held, held_bytes = [], 0
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in RUN_SCHEMA.split(", ")])

        for batch in batches:
            for r, z, wanted in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("r", "packed", "wanted")), strict=True):
                text = unpack.decompress(z)
                for w in wanted:
                    a, high, low = w["pos"] >> 16, w["pos"] >> 8 & 255, w["pos"] & 255
                    if not w["hot"]:
                        suffix, before = text[a : a - low + length], text[a - high : a][::-1]
                        held.append((w["gram"] % parts, suffix, before, w["copies"] == 1, r, a))
                        held_bytes += len(suffix) + len(before)
                    else:
                        b = np.frombuffer(text[a - high : a - low + length], np.uint8)
                        start = np.arange(high - low + 1)
                        where = texthash.ranges(texthash.prefix(b), start, start + length) % np.uint64(window_parts)
                        for i, p in enumerate(where.tolist()):
                            s = a - high + i
                            held.append((parts + int(p), text[s : s + length], None, w["copies"] == 1, r, s))
                            held_bytes += length
                    if len(held) >= RUN or held_bytes >= RUN_BYTES:
                        yield flush()
        if held:
            yield flush()

    return run


def _merged(length: int, parts: int):
    """Spans that repeat, from the runs of each part."""

    def stream(rows: pa.Table) -> list[Iterator]:
        by_run: dict[str, list] = {}
        for run, *entry in zip(*(rows[c].to_pylist() for c in ("run", "shared", "tail", "before", "single", "r", "anchor")), strict=True):
            by_run.setdefault(run, []).append((entry[0], entry[1], tuple(entry[2:])))
        return list(by_run.values())

    def anchored(merged: Iterator, spans: list[tuple]) -> None:
        shared, held = [], []

        def settle() -> None:
            if len(held) > 1:
                for got, (_, single, r, a) in zip(repeated(shared, [x[0] for x in held], length), held, strict=True):
                    if single:
                        spans.extend((r, a - left, a + right) for left, right in got)

        for n, _, load in merged:
            if n < GRAM:
                settle()
                shared, held = [], []
            if held and load[2:] == held[-1][2:] and load[0] == held[-1][0]:
                continue  # a repeated row brought the same anchor twice
            shared.append(n)
            held.append(load)
        settle()

    def windows(merged: Iterator, spans: list[tuple]) -> None:
        held: list[tuple] = []

        def settle() -> None:
            if any(not x[1] for x in held) or len({x[2:] for x in held}) > 1:
                spans.extend((r, s, s + length) for _, single, r, s in held if single)

        for n, _, load in merged:
            if n < length:
                settle()
                held = []
            held.append(load)
        settle()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), rows in groups(batches, ["part"]):
            spans: list[tuple] = []
            (anchored if part < parts else windows)(merge_runs(stream(rows)), spans)
            columns = list(zip(*spans, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["r", "start", "end"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        rest = [batch.column(batch.schema.get_field_index(c)) for c in ("r", "doc_id")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array([pack.compress(t) for t in texts(batch, "text")], pa.binary())], names=["r", "doc_id", "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for d, z, found in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "packed", "found")), strict=True):
            text, spans = unpack.decompress(z), []
            for s, e in sorted((x["start"], x["end"]) for x in found or ()):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(e, spans[-1][1])
                else:
                    spans.append([s, e])
            kept, at = [], 0
            for s, e in spans:
                kept.append(text[at:s])
                at = e
            kept = b"".join([*kept, text[at:]])
            rows.append((d, len(text), len(text) - len(kept), spans, kept))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.int64()),
             pa.array([x[3] for x in rows], pa.list_(pa.list_(pa.int64()))), pa.array([x[4] for x in rows], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = 200, hot: int = 2000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) for every row of ``docs`` (doc_id, text; other columns unused).

    spans: [start, end) of the maximal removed runs, in bytes; kept: the remaining bytes, which may cut a
    character. Null and empty texts count as empty; rows that repeat doc_id and text each give a row, and
    repeat each other. An empty table gives no rows. ``length`` is from 50 to 250.
    """
    if not GRAM <= length <= GRAM + 200:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 200}")
    # rows have numbers of their own, kept with the texts in the shared folder: no two rows are taken for one
    keyed = materialize(docs.select(F.monotonically_increasing_id().alias("r"), "doc_id", F.coalesce("text", F.lit("")).alias("text")))
    marks = materialize(keyed.select("r", "text").mapInArrow(_anchor_rows(length), "gram long, stretch long, r long, pos long"))
    often = marks.groupBy("gram").agg(F.count("*").alias("n"), F.min("stretch").alias("low"), F.max("stretch").alias("high")).where("n > 1")
    often = materialize(often.select("gram", "n", (F.col("low") != F.col("high")).alias("mixed")))
    found = materialize(_join_apart(marks, often, ["gram"]).select("gram", "stretch", "r", "pos", "mixed"))
    kinds = found.where("mixed").groupBy("gram", "stretch").agg(F.count("*").alias("copies"), F.min(F.struct("r", "pos")).alias("one"))
    kinds = materialize(kinds.select("gram", "stretch", "copies", "one.r", "one.pos"))
    windows = F.shiftright("pos", 8).bitwiseAND(255) - F.col("pos").bitwiseAND(255) + 1
    crowd = materialize(kinds.groupBy("gram").agg((F.count("*") > hot).alias("hot"), F.count("*").alias("n"), F.sum(windows).alias("windows")))
    sums = crowd.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("hot"), F.col("windows"))).alias("windows")).first()
    parts, window_parts = 1 + (sums["n"] or 0) // 10_000, 1 + (sums["windows"] or 0) // 40_000
    wanted = _join_apart(kinds, crowd.select("gram", "hot", "n"), ["gram"]).groupBy("r").agg(F.collect_list(F.struct("gram", "copies", "pos", "hot")).alias("wanted"))
    packed = keyed.mapInArrow(_pack, "r long, doc_id long, packed binary")
    runs = materialize(packed.select("r", "packed").join(wanted, "r").mapInArrow(_runs(length, parts, window_parts), RUN_SCHEMA))
    all_parts = parts + window_parts
    sorted_runs = runs.where("part >= 0").repartition(min(4 * all_parts, max(2000, all_parts // 16)), "part").sortWithinPartitions("part", "run", "seq")
    spans = sorted_runs.mapInArrow(_merged(length, parts), SPAN_SCHEMA)
    settled = runs.where("part = -1").select("r", F.col("anchor").alias("start"), (F.col("anchor") + length).alias("end"))
    copied = kinds.where("copies > 1").select("gram", "stretch", F.col("copies").alias("n"))
    whole = found.where("not mixed").select("r", "pos").union(_join_apart(found.where("mixed"), copied, ["gram", "stretch"]).select("r", "pos"))
    anchor, high, low = F.shiftright("pos", 16), F.shiftright("pos", 8).bitwiseAND(255), F.col("pos").bitwiseAND(255)
    counted = whole.select("r", (anchor - high).alias("start"), (anchor - low + length).alias("end"))
    by_row = counted.union(spans).union(settled).distinct().groupBy("r").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    return packed.join(by_row, "r", "left").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")


def _join_apart(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with ``keys`` (on, n rows of each, more); rows of very common keys aren't brought together in one task.

    Keys that hold over a ``HOT``-th of all rows, fewer than ``HOT`` whatever the size, are broadcast; the
    rest is joined as usual.
    """
    total = keys.agg(F.sum("n")).first()[0] or 0
    common_key = F.col("n") * HOT > total
    apart = F.broadcast(keys.where(common_key).withColumn("apart", F.lit(True)))
    marked = rows.join(apart, on, "left")
    more = [c for c in keys.columns if c not in on]
    usual = marked.where("apart is null").drop("apart", *more).join(keys.where(~common_key), on)
    return marked.where("apart").drop("apart").unionByName(usual)


def digest(result: DataFrame) -> DataFrame:
    """The query's columns, from remove_repeats()."""
    return result.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
