"""Vectorised byte, word and shingle hashing over Arrow string columns.

Everything works on one flat byte buffer with document offsets, so that the cost of a
document is a few numpy passes and not a Python loop over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_M1, _M2 = U(0xD6E8FEB86659FD93), U(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_INV = pow(_BASE, -1, 1 << 64)
_RNG = np.random.Generator(np.random.PCG64(20240229))
_TAB = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_pw = _ipw = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(32))
    x *= _M1
    x ^= x >> U(32)
    x *= _M1
    x ^= x >> U(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i <= n."""
    global _pw, _ipw
    if len(_pw) <= n:
        size = max(1 << 16, 1 << n.bit_length())
        out = []
        for base in (_BASE, _INV):
            a = np.ones(1, np.uint64)
            while len(a) < size:
                a = np.concatenate((a, a * U(pow(base, len(a), 1 << 64))))
            out.append(a)
        _pw, _ipw = out
    return _pw, _ipw


def prefix(buf: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] the polynomial hash of buf[s:e], still scaled by BASE**s."""
    pw, _ = _powers(len(buf) + 1)
    out = np.empty(len(buf) + 1, np.uint64)
    out[0] = 0
    v = _TAB[buf]
    v *= pw[: len(buf)]
    np.cumsum(v, out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of the buffer behind prefix() p."""
    _, ipw = _powers(len(p))
    h = p[end] - p[start]
    h *= ipw[start]
    h ^= (end - start).astype(np.uint64) * _M2
    return mix(h)


def gram_hash(p: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-grams of the buffer behind prefix() p."""
    n = len(p) - k
    if n <= 0:
        return np.empty(0, np.uint64)
    _, ipw = _powers(len(p))
    h = p[k:] - p[:n]
    h *= ipw[:n]
    return mix(h)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while n * 2 <= w:
        a = np.minimum(a[:-n], a[n:])
        n *= 2
    return np.minimum(a[: -(w - n)], a[w - n :]) if w > n else a


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_string())
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, o, d = col.buffers()
    offs = np.frombuffer(o, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(d, np.uint8) if d is not None else np.empty(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def pieces(offs: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about so many bytes; a longer document is a range of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j
        i = j


def words(buf: np.ndarray, offs: np.ndarray, gaps: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ (or between other gaps), and each document's first word (plus the total)."""
    solid = ~gaps[buf]
    before = np.empty(len(buf) + 1, bool)
    before[0] = False
    before[1:] = solid
    inner = offs[(offs < len(buf))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before[:-1])
    after = np.empty(len(buf) + 1, bool)
    after[:-1] = solid
    after[-1] = False
    after[offs] = False
    ends = np.flatnonzero(solid & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def shingles(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct word k-shingles of each document as 64-bit hashes, and their offsets.

    A-Z is lower-cased. A document with fewer words has its whole sequence as one shingle;
    one without words has none.
    """
    low = LOWER[buf]
    s, e, first = words(low, offs)
    n_words = np.diff(first)
    if not len(s):
        return np.empty(0, np.uint64), np.zeros(len(offs), np.int64)
    w = span_hash(prefix(low), s, e)
    h = w.copy()
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    for j in range(1, k):
        h = h * U(0xA24BAED4963EE407)
        h[: len(w) - j] += w[j:]
    h = mix(h)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    left = np.repeat(first[1:], n_words) - np.arange(len(w))
    keep = left >= k
    keep[first[:-1][short]] = True
    for d in short:  # a few words each
        v = int(n_words[d]) * 7919 + 1
        for x in w[first[d] : first[d + 1]].tolist():
            v = (v * 0xA24BAED4963EE407 + x) & (1 << 64) - 1
        h[first[d]] = mix(np.array([v], np.uint64))[0]
    h, doc = h[keep], doc[keep]
    cut = np.searchsorted(doc, np.arange(len(n_words) + 1))
    out, sizes = [], np.zeros(len(n_words) + 1, np.int64)
    for d in range(len(n_words)):
        if cut[d] < cut[d + 1]:
            x = np.unique(h[cut[d] : cut[d + 1]])
            out.append(x)
            sizes[d + 1] = len(x)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.cumsum(sizes)
