"""Vectorised byte hashing for Arrow-batch kernels.

Polynomial hashes modulo 2**64 by prefix sums, finished with a bijective mixer: the hash of any byte
range of a text costs two lookups. Long texts are worked through in blocks, so memory stays within a
fixed multiple of a block.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept for reuse."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        n = max(n, 1 << 17)
        up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        got = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return got


def prefix(b: np.ndarray, base: int = _BASE) -> np.ndarray:
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + U(1)) * powers(len(b), base)[0][: len(b)], out=out[1:])
    return out


def ranges(pre: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of b[start:end] for each pair, from prefix(b)."""
    return mix((pre[end] - pre[start]) * powers(len(pre), base)[1][start])


def words(text: bytes, block: int = 1 << 20) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, in order."""
    out = []
    b = np.frombuffer(text, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    at = 0
    while at < len(b):
        end = min(at + block, len(b))
        if end < len(b):  # end the block at white space, or let one long word lengthen it
            gap = np.flatnonzero(space[at:end])
            if len(gap) and gap[-1]:
                end = at + int(gap[-1])
            else:
                later = np.flatnonzero(space[end:])
                end = end + int(later[0]) if len(later) else len(b)
        x, s = b[at:end], space[at:end]
        edge = np.diff(np.concatenate(([0], (~s).view(np.int8), [0])))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(start):
            low = np.where((x >= 65) & (x <= 90), x + np.uint8(32), x)
            out.append(ranges(prefix(low), start, stop) ^ mix((stop - start).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: bytes, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; with fewer words, of the whole sequence."""
    w = words(text)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        h = mix(h * U(0xD6E8FEB86659FD93) + w[i : len(w) - n + 1 + i] + U(i + 1))
    if n < k:
        h = h ^ U(n)
    return np.unique(h)
