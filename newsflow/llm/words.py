"""Words and word hashes of whole texts, for tasks that work on numpy arrays.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``.  Those separators are the
ASCII white space of ``bytes.split``, and ``bytes.lower`` changes A-Z only, so
UTF-8 bytes give the defined words and lower case directly.
"""

from __future__ import annotations

import numpy as np

# Odd multipliers of the polynomial word and shingle hashes and of the mixer.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MIX_A = 0xBF58476D1CE4E5B9
MIX_B = 0x94D049BB133111EB
CHUNK = 1 << 18          # bytes hashed at once, cut at white space

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def to_bytes(text: str | None, lower: bool = False) -> bytes:
    data = b"" if text is None else text.encode("utf-8", "surrogatepass")
    return data.lower() if lower else data


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base & (2**64 - 1))
        np.multiply.accumulate(out, out=out)
    return out


_TABLES: dict = {}


def _tables(n: int):
    """Powers and inverse powers of the byte base, at least ``n`` long."""
    size = max(CHUNK, 1 << (n - 1).bit_length()) + 1
    if _TABLES.get("size", 0) < size:
        _TABLES.update(size=size, up=_powers(BYTE_BASE, size), down=_powers(pow(BYTE_BASE, -1, 2**64), size))
    return _TABLES["up"], _TABLES["down"]


def _hash_chunk(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    inside = np.empty(len(a) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[a], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _tables(len(a))
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(MIX_B))


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word, in order.  Memory is bounded by ``CHUNK`` or the longest word."""
    if len(data) <= CHUNK:
        return _hash_chunk(data) if data else np.zeros(0, np.uint64)
    parts, at = [], 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        while to < len(data) and not _SPACE[data[to]]:
            to += 1
        parts.append(_hash_chunk(data[at:to]))
        at = to
    return np.concatenate(parts)


def window_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive words (none if there are fewer)."""
    n = len(w) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for j in range(size):
        out += w[j: j + n] * np.uint64(factor)
        factor = factor * WORD_BASE % 2**64
    return mix(out)


def sequence_hash(w: np.ndarray) -> np.uint64:
    """A 64-bit hash of the whole sequence of words."""
    return mix(np.array([(w * _powers(WORD_BASE, len(w))).sum(dtype=np.uint64) + np.uint64(len(w))], np.uint64))[0]


def shingle_set(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text counts whole; no word: empty."""
    w = word_hashes(data)
    if not len(w):
        return w
    return np.unique(window_hashes(w, size) if len(w) >= size else np.array([sequence_hash(w)], np.uint64))
