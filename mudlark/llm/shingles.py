"""Word and shingle hashes of many texts at once, as vector steps over their concatenated bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers modulo 2**64: bytes of a word, words of a shingle.
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte multiplier and of its inverse, up to n at least."""
    if 0 not in _BYTES or len(_BYTES[0]) < n:
        inverse = pow(_BYTE, -1, 1 << 64)
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((_BYTE, inverse)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _BYTES[k] = np.cumprod(p)
    return _BYTES[0], _BYTES[1]


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, in order, and how many words each text has.

    A word's hash is a polynomial of its bytes modulo 2**64, scrambled; equal words have equal hashes.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    gap = _BREAK[data]
    edge = np.diff(gap.view(np.int8), prepend=np.int8(1))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    last = last[last > 0] if len(last) and len(first) and last[0] < first[0] else last
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    hashes = mixed((total[last] - total[first]) * inverse[first])
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    return hashes, np.diff(np.searchsorted(first, ends), prepend=0)


def shingle_sets(texts: list[bytes], size: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and how many each text has.

    A text of fewer words than ``size`` has its whole sequence as its one shingle; one without words has none.
    """
    words, counts = word_hashes(texts, lower)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(texts)), n)
    if not len(doc):
        return np.zeros(0, dtype=np.uint64), n
    begin = np.cumsum(counts) - counts
    at = begin[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    have = np.minimum(counts[doc], size)
    h = have.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    for k in range(size):
        h = h * np.uint64(_WORD) + np.where(have > k, padded[at + k], np.uint64(0))
    h = mixed(h)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(texts))


def in_slices(texts: list[bytes], most: int = 1_000_000) -> list[slice]:
    """Slices of a list of texts of about so many bytes each; a longer text stands alone."""
    out, begin, size = [], 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            out.append(slice(begin, i))
            begin, size = i, 0
        size += len(t) + 1
    return [*out, slice(begin, len(texts))] if len(texts) > begin else out


def byte_slices(texts: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """A column of texts as UTF-8, about so many bytes at a time (a longer text stands alone), each slice with the row
    where it begins; null counts as empty."""
    data = texts.cast(pa.large_binary())
    size = np.cumsum(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    begin = 0
    while begin < len(size):
        before = int(size[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(size, before + most, side="right")))
        yield begin, [t or b"" for t in data.slice(begin, end - begin).to_pylist()]
        begin = end
