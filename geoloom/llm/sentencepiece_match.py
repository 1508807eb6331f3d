"""SentencePiece encoding and decoding by suffix-array matching.

The distinct segments of a batch (runs between places that no piece crosses) are concatenated and
indexed by a suffix array over as many leading bytes as a search needs; every piece of the vocabulary
is binary-searched for its range of occurrences, and the resulting edges (start, length, piece) are put
in order of position. For a unigram model the best path over the edges is relaxed from left to right.
For a BPE model a path of least cost isn't what the model defines: there the edges say which
neighbours may merge, and the best-scored merge of each segment, leftmost first, is taken until none is
left. Characters without a piece become byte pieces, if the model has them.

Tokenizers aren't trained here: the model file is a parameter and is broadcast as it is.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.tables import texts

SPACE = "▁"
FLUSH, REMEMBERED, LONG, GATHER = 400_000, 800_000, 400, 4 << 20
SEPARATOR = 0xFF  # in no UTF-8 text


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The pieces of a model, ready for matching."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(self.size)]
        is_byte = [sp.is_byte(i) for i in range(self.size)]
        self.unknown = sp.unk_id()
        self.byte_ids = np.full(256, self.unknown, np.int64)
        for i in range(self.size):
            if is_byte[i]:
                self.byte_ids[int(names[i][3:-1], 16)] = i
        plain = [i for i in range(self.size) if not special[i] and not is_byte[i]]
        self.ids = np.array(plain, np.int64)
        self.bytes = [names[i].encode() for i in plain]
        self.lengths = np.array([len(b) for b in self.bytes])
        self.longest = int(self.lengths.max())
        score = np.array([sp.get_score(i) for i in range(self.size)])
        self.score = score
        # a BPE model scores pieces by the order of their merges
        self.bpe = all(float(s).is_integer() for s in score[self.ids])
        self.priority = np.full(self.size + 1, 1 << 30, np.int64)
        self.priority[self.ids[np.lexsort((self.ids, -score[self.ids]))]] = np.arange(len(self.ids))
        inside = {c for b in self.bytes if len(t := b.decode()) > 1 for c in t}
        crossing = any(SPACE in t.lstrip(SPACE) for t in (b.decode() for b in self.bytes))
        stops = "" if "\n" in inside else "\n"
        self.segments = re.compile(rf"{SPACE}+[^{SPACE}{stops}]*|[^{SPACE}{stops}]+" + (f"|{stops}" if stops else "")) if not crossing else re.compile(r"(?s).+")
        self.low, self.high, self.rest = (self._key([b[k : k + 8] for b in self.bytes], pad) for k, pad in ((0, b"\0"), (0, b"\xff"), (8, b"\0")))
        self.mask = self._key([b"\xff" * min(8, max(0, len(b) - 8)) for b in self.bytes], b"\0")
        self.out = [b"" if special[i] else bytes([int(names[i][3:-1], 16)]) if is_byte[i] else names[i].encode() for i in range(self.size)]
        if self.unknown >= 0:
            self.out[self.unknown] = " ⁇ ".encode()
        self.out_length = np.array([len(x) for x in self.out])
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out_bytes = np.frombuffer(b"".join(self.out), np.uint8)

    @staticmethod
    def _key(parts: list[bytes], pad: bytes) -> np.ndarray:
        return np.array([int.from_bytes(p.ljust(8, pad), "big") for p in parts], np.uint64)

    def prepare(self, text: str) -> list[str]:
        """Segments of a text with the leading space that the model expects."""
        return self.segments.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def edges(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, index of the piece) of every occurrence of a piece in b, in order of position."""
        n = len(b)
        padded = np.concatenate((b, np.full(24, SEPARATOR, np.uint8))).astype(np.uint64)
        k = np.zeros(n + 9, np.uint64)
        for i in range(8):
            k = (k << np.uint64(8)) | padded[i : i + n + 9]
        first, second = k[:n], k[8:]
        suffixes = np.argsort(first)
        a = first[suffixes]
        low = np.searchsorted(a, self.low)
        count = np.searchsorted(a, self.high, "right") - low
        piece = np.repeat(np.arange(len(count)), count)
        start = suffixes[np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(len(piece))]
        # a range agrees on eight bytes; the rest of longer pieces is compared
        long = np.flatnonzero(self.lengths[piece] > 8)
        at, of = np.minimum(start[long], n), piece[long]
        fits = (second[at] & self.mask[of]) == self.rest[of] if n > 8 else self.lengths[of] <= 8
        raw = b.tobytes()
        for i in np.flatnonzero(fits & (self.lengths[of] > 16)).tolist():
            fits[i] = raw[at[i] : at[i] + self.lengths[of[i]]] == self.bytes[of[i]]
        wrong = long[~fits]
        start, piece = np.delete(start, wrong), np.delete(piece, wrong)
        edge = np.sort(start << 24 | self.lengths[piece] << 18 | piece) if self.longest < 64 and len(self.bytes) < 1 << 18 else None
        if edge is not None:
            return edge >> 24, edge >> 18 & 63, edge & ((1 << 18) - 1)
        order = np.lexsort((self.lengths[piece], start))
        return start[order], self.lengths[piece[order]], piece[order]

    def safe_cuts(self, segment: str, block: int) -> Iterator[str]:
        """``segment`` in parts of about ``block`` bytes, cut where no occurrence of a piece crosses.

        No token of either kind of model reaches across such a place, so the parts are encoded for themselves. A part
        grows beyond ``block`` only where pieces overlap without a gap.
        """
        raw, at, size = segment.encode(), 0, block
        while len(raw) - at > size:
            b = np.frombuffer(raw, np.uint8)[at : at + size]
            start, length, _ = self.edges(b)
            crossed = np.zeros(len(b) + 1, np.int32)  # how many pieces reach across the place before each byte
            np.add.at(crossed, start + 1, 1)
            np.add.at(crossed, start + length, -1)
            free = np.flatnonzero((np.cumsum(crossed)[:-1] == 0) & ((b & 0xC0) != 0x80))
            free = free[(free > 0) & (free <= len(b) - self.longest)]  # a piece may begin in sight and end out of it
            if len(free):
                cut = int(free[-1])
                yield raw[at : at + cut].decode()
                at, size = at + cut, block
            else:
                size *= 2
        yield raw[at:].decode()

    def encode_segments(self, segments: list[str]) -> list[np.ndarray]:
        raw = [s.encode() for s in segments]
        b = np.frombuffer(b"\xff".join([*raw, b""]), np.uint8)
        start, length, piece = self.edges(b)
        at = np.zeros((len(b) + 1, self.longest + 1), np.int32)  # 1 + id of the piece on a span
        at[start, length] = self.ids[piece] + 1
        begin = np.cumsum([0, *(len(r) + 1 for r in raw[:-1])])
        return self._merge(b, raw, begin, at) if self.bpe else [self._relax(b, at, s, s + len(r)) for s, r in zip(begin.tolist(), raw, strict=True)]

    def _spell(self, b: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ids of the spans; those without a piece become bytes, or the unknown piece."""
        width = end - start
        ids = np.where(width <= self.longest, at[start, np.minimum(width, self.longest)], 0).astype(np.int64) - 1
        if (ids < 0).any():
            ids = np.concatenate([self.byte_ids[b[s:e]] if i < 0 and self.byte_ids[0] != self.unknown else [i if i >= 0 else self.unknown] for i, s, e in zip(ids.tolist(), start.tolist(), end.tolist(), strict=True)])
        return ids.astype(np.int32)

    def _merge(self, b: np.ndarray, raw: list[bytes], begin: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(raw)
        starts = np.flatnonzero((b & 0xC0) != 0x80)
        starts = starts[b[starts] != SEPARATOR]
        size = np.array([len(r) for r in raw])
        of = np.searchsorted(begin, starts, "right") - 1
        end = np.concatenate((starts[1:], [0]))
        last = np.concatenate((of[1:] != of[:-1], [True]))
        end[last] = (begin + size)[of[last]]
        many = np.bincount(of, minlength=len(raw))
        slow = many[of] > LONG
        for g in np.unique(of[slow]).tolist():
            mine = of == g
            s, e = self._merge_long(starts[mine], end[mine], at)
            out[g] = self._spell(b, at, s, e)
        starts, end, of = starts[~slow], end[~slow], of[~slow]
        ready_s, ready_e, ready_of = [], [], []
        while len(starts):
            same = of[1:] == of[:-1]
            width = end[1:] - starts[:-1]
            found = np.where(same & (width <= self.longest), at[starts[:-1], np.minimum(width, self.longest)], 0) - 1
            rank = self.priority[found]  # -1: the extra last place, no piece
            key = np.append(rank << 32 | np.arange(len(rank)), 1 << 62)
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            best = np.minimum.reduceat(key, first)
            open_ = best >> 32 < 1 << 30
            left = best[open_] & ((1 << 32) - 1)
            end[left] = end[left + 1]
            keep = np.ones(len(starts), bool)
            keep[left + 1] = False
            alive = np.repeat(open_, np.diff(np.append(first, len(starts))))
            done = ~alive
            ready_s.append(starts[done])
            ready_e.append(end[done])
            ready_of.append(of[done])
            keep &= alive
            starts, end, of = starts[keep], end[keep], of[keep]
        if ready_s:
            s, e, of = np.concatenate(ready_s), np.concatenate(ready_e), np.concatenate(ready_of)
            width = e - s
            ids = np.where(width <= self.longest, at[s, np.minimum(width, self.longest)], 0).astype(np.int32) - 1
            order = np.argsort(of, kind="stable")
            s, e, ids, of = s[order], e[order], ids[order], of[order]
            groups = np.unique(of)
            cuts = np.searchsorted(of, groups)
            bad = np.unique(of[ids < 0])
            cuts = [*cuts.tolist(), len(ids)]
            for g, a, c in zip(groups.tolist(), cuts, cuts[1:], strict=False):
                out[g] = ids[a:c]
            for g in bad.tolist():
                mine = slice(np.searchsorted(of, g), np.searchsorted(of, g, "right"))
                out[g] = self._spell(b, at, s[mine], e[mine])
        return out

    def _merge_long(self, starts: np.ndarray, end: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges for one long segment, by a heap over linked neighbours."""
        s, e, n = starts.tolist(), end.tolist(), len(starts)
        before, after, gone = list(range(-1, n - 1)), [*range(1, n), -1], [False] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and e[j] - s[i] <= self.longest:
                found = at[s[i], e[j] - s[i]]
                if found:
                    heapq.heappush(heap, (int(self.priority[found - 1]), i, e[i], e[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            j = after[i]
            if gone[i] or e[i] != mid or j < 0 or e[j] != stop:
                continue
            e[i], gone[j], after[i] = stop, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        kept = [i for i in range(n) if not gone[i]]
        return np.array([s[i] for i in kept]), np.array([e[i] for i in kept])

    def _relax(self, b: np.ndarray, at: np.ndarray, begin: int, stop: int) -> np.ndarray:
        """Unigram model: the path of the greatest total score, edges taken in order of position."""
        worst = float(self.score[self.ids].min()) - 10.0
        best, back = [0.0] + [-np.inf] * (stop - begin), [0] * (stop - begin + 1)
        for i in range(stop - begin):
            if best[i] == -np.inf or b[begin + i] & 0xC0 == 0x80:
                continue
            row = at[begin + i, : stop - begin - i + 1]
            char = 1 + int((b[begin + i + 1 : stop] & 0xC0 == 0x80).tolist().index(False) if False in (b[begin + i + 1 : stop] & 0xC0 == 0x80).tolist() else stop - begin - i - 1)
            spans = [(int(w), float(self.score[row[w] - 1])) for w in np.flatnonzero(row)]
            if not row[char]:
                spans.append((char, worst))
            for w, score in spans:
                if best[i] + score > best[i + w]:
                    best[i + w], back[i + w] = best[i] + score, i
        ends, i = [], stop - begin
        while i:
            ends.append((begin + back[i], begin + i))
            i = back[i]
        ends.reverse()
        return self._spell(b, at, np.array([x for x, _ in ends]), np.array([y for _, y in ends]))

    def decode(self, ids: np.ndarray) -> str:
        length = self.out_length[ids]
        first = self.out_start[ids] - (np.cumsum(length) - length)
        text = self.out_bytes[np.repeat(first, length) + np.arange(length.sum())].tobytes().decode("utf-8", "replace").replace(SPACE, " ")
        return text.removeprefix(" ")


class Encoder:
    """Encodes texts; remembers a bounded number of segments, each as the bytes of its ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        self.known.update((s, ids.tobytes()) for s, ids in zip(new, self.vocabulary.encode_segments(new), strict=True))

    def _segments(self, text: str) -> list[str]:
        return [part for s in self.vocabulary.prepare(text) for part in (self.vocabulary.safe_cuts(s, FLUSH) if len(s) > FLUSH // 4 else (s,))]

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self._segments(t) for t in batch]
        known, new, size = self.known, [], 0
        for s in set().union(*cut).difference(known):
            new.append(s)
            size += len(s) + 4
            if size > FLUSH:
                self._learn(new)
                new, size = [], 0
        if new:
            self._learn(new)
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, segments)), np.int32) for segments in cut]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[str]]]:
    """Some batches at a time, with their texts: the more a suffix array covers, the less a search costs."""
    held, whole, size = [], [], 0
    for batch in batches:
        held.append(batch)
        for t in texts(batch, "text"):
            whole.append(t.decode("utf-8", "replace"))
            size += len(t)
        if size > GATHER:
            yield held, whole
            held, whole, size = [], [], 0
    if held:
        yield held, whole


def encode(docs: DataFrame, model_file: str | None = None, digest: bool = False) -> DataFrame:
    """``docs`` with token_ids (array<int>) appended, for a column text; a column of that name is replaced.

    With ``digest`` instead n_tokens, ids_sha256 (hex, of the ids as little-endian 32-bit integers) and
    round_trip (whether decoding gives the text back; U+2581 is read as a space). Null and empty texts
    have no tokens, and null ones round-trip. Repeated rows are encoded alike; an empty table gives no rows.
    """
    import hashlib

    from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

    with open(model_file or default_model(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    added = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("round_trip", BooleanType())] if digest else [StructField("token_ids", ArrayType(IntegerType()))]
    kept = [f for f in docs.schema.fields if f.name not in {a.name for a in added}]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(shared.value))
        for held, whole in _gathered(batches):
            ids, at = encoder.encode(whole), 0
            for batch in held:
                mine, own = ids[at : at + batch.num_rows], whole[at : at + batch.num_rows]
                at += batch.num_rows
                if digest:
                    back = [encoder.vocabulary.decode(x) == t for x, t in zip(mine, own, strict=True)]
                    more = [pa.array([len(x) for x in mine], pa.int64()), pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in mine], pa.string()), pa.array(back, pa.bool_())]
                else:
                    more = [pa.array(mine, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), *more], names=[*names, *(a.name for a in added)])

    return docs.select(*names).mapInArrow(run, StructType([*kept, *added]))


def decode(tokens: DataFrame, model_file: str | None = None) -> DataFrame:
    """``tokens`` with a column text decoded from token_ids appended (replaced if there); null ids give null."""
    with open(model_file or default_model(), "rb") as f:
        shared = tokens.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        vocabulary = Vocabulary(shared.value)
        return pa.array([None if x is None else vocabulary.decode(np.array(x, np.int64)) for x in ids.to_pylist()], pa.string())

    return tokens.withColumn("text", decoded("token_ids"))
