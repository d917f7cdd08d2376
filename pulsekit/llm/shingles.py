"""Hashes of words and word shingles for many texts at once, in numpy.

A byte's random 64-bit value times a power of an odd base, summed along the
buffer, gives the hash of any byte range by one difference and one product
(arithmetic modulo 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C13 | 3      # odd, 3 modulo 8
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


_table: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; one table per process, grown by doubling."""
    if len(_table[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _table[i] = np.cumprod(steps)
    return _table


#: Bytes of text that are hashed at once.
SLICE_BYTES = 900_000


def encoded(texts: list) -> list[bytes]:
    """Texts as UTF-8 with A-Z in lower case (null: empty)."""
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about SLICE_BYTES together."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def prefix(buffer: np.ndarray) -> np.ndarray:
    """Running sums for range hashes; one longer than ``buffer``."""
    out = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * powers(len(buffer) + 1)[0][:len(buffer)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of buffer[start:stop], the same wherever the bytes stand."""
    return mix((sums[stop] - sums[start]) * powers(len(sums))[1][start] + (stop - start).astype(np.uint64))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (one more entry than texts)."""
    buffer = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    if not len(buffer):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    gap = _GAP[buffer]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    offsets = np.concatenate([[0], np.searchsorted(start, ends)])
    return range_hash(prefix(buffer), start, stop), offsets


def shingle(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text in order; a text of fewer words gives one shingle, an empty one none."""
    n = np.diff(offsets)
    long = n >= k
    size = np.where(long, n - k + 1, n > 0)
    out_at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(out_at[-1], np.uint64)
    if len(words) >= k:
        run = words[: len(words) - k + 1].copy()
        for j in range(1, k):
            run = run * _STEP + words[j: len(words) - k + 1 + j]
        # a shingle belongs to the text of its first word and must end in it
        doc = np.repeat(np.arange(len(n)), n)[: len(run)]
        inside = np.arange(len(run)) + k <= offsets[doc + 1]
        keep = inside & long[doc]
        out[np.repeat(long, size)] = mix(run[keep] + np.uint64(k))
    for d in np.flatnonzero((n > 0) & ~long):
        h = 0
        for w in words[offsets[d]: offsets[d + 1]].tolist():
            h = (h * int(_STEP) + w + 1) % (1 << 64)
        out[out_at[d]] = mix(np.array([h], np.uint64))[0]
    return out, out_at
