"""Vectorised text helpers for Arrow batches: words, 64-bit fingerprints of spans, shingles.

A text column is handled as the bytes and offsets Arrow already holds; no Python string is made.
Fingerprints are polynomial prefix sums modulo 2^64 over a random value per byte, finished by a
mixing step, so the fingerprint of any span costs one subtraction and one product.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at once (a longer text is a chunk of its own).
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
STEP = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


BYTE = mix(np.arange(1, 257, dtype=U) * U(BASE))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP^i and STEP^-i modulo 2^64 for i < n."""
    if n > len(_POWERS.get("up", ())):
        with np.errstate(over="ignore"):
            for k, v in (("up", STEP), ("down", pow(STEP, -1, 1 << 64))):
                x = np.full(max(n, CHUNK + 65536), v, U)
                x[0] = 1
                _POWERS[k] = np.multiply.accumulate(x)
    up, down = _POWERS["up"][:n], _POWERS["down"][:n]
    if n > 4 * CHUNK:  # of a giant text: not kept
        _POWERS.clear()
    return up, down


class Prints:
    """Fingerprints of spans of one byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE[data] * up[:-1], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, k: int) -> np.ndarray:
        """Of every k bytes in a row."""
        m = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:m]) * self.down[:m]) if m > 0 else np.zeros(0, U)


def text_chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of successive rows holding at most ``limit`` bytes together; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if not n:
        return
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if big else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word ``[^\\x20\\x09-\\x0D]+``; words do not cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, w[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, w[1:]
    start = np.flatnonzero(w & (~before | edge[:-1]))
    end = np.flatnonzero(w & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def word_prints(data: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of each word, A-Z lower-cased."""
    s, e, row = word_spans(data, offs)
    if lower and len(data):
        data = LOWER[data]
    return (Prints(data).spans(s, e) if len(s) else np.zeros(0, U)), row


@lru_cache(1)
def _shingle_weights(k: int) -> list:
    return [U(pow(BASE, j + 1, 1 << 64)) for j in range(k)]


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct k-word shingle fingerprints of all rows one after the other, count per row).

    A row with fewer than k words has its whole sequence as one shingle; without words, none.
    """
    rows = len(offs) - 1
    wh, row = word_prints(data, offs)
    words = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(words)))
    weights = _shingle_weights(k)
    h = np.zeros(max(0, len(wh) - k + 1), U)
    for j, w in enumerate(weights):
        h += wh[j:len(wh) - k + 1 + j] * w if len(h) else h
    h = mix(h)
    out, counts = [], np.zeros(rows, np.int64)
    for r in range(rows):
        a, m = first[r], words[r]
        if not m:
            continue
        if m >= k:
            x = np.sort(h[a:a + m - k + 1])
            x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        else:
            t = np.array([m], U)
            for j in range(m):
                t = t * U(BASE) + wh[a + j]
            x = mix(t ^ U(STEP))
        out.append(x)
        counts[r] = len(x)
    return (np.concatenate(out) if out else np.zeros(0, U)), counts
