"""Word and shingle hashes of Arrow text columns, computed on their bytes without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}
#: Bytes of text hashed at a time.
SLICE_BYTES = 1 << 18


def mix64(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, so that any of their bits may be used."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        grown[0] = 1
        have = _POWERS[base] = np.cumprod(grown)
    return have[:n]


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``most`` bytes; NULL is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, start, end) of every word. Words are runs of ASCII letters and digits, A-Z
    lower-cased, and bytes of non-ASCII characters; they never cross a document."""
    low = _LOWER[data]
    inside = _IS_WORD[low]
    n = len(low)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] |= inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] |= inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    # dividing by the power of the start (its inverse modulo 2**64) makes the hash free of place
    value = (sums[end] - sums[start]) * _powers(pow(_BASE, -1, 1 << 64), n + 1)[start]
    value = mix64(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return value, np.searchsorted(offsets, start, side="right") - 1, start, end


def shingle_sets(hashes: np.ndarray, doc: np.ndarray, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts): sorted distinct shingles of each document; ``starts`` has n_docs + 1 entries.

    A document of fewer words, but not none, has one shingle of all its words.
    """
    n = len(hashes)
    weights = _powers(0xC2B2AE3D27D4EB4F, size + 1)[1:]
    window = max(n - size + 1, 0)
    whole = np.zeros(window, dtype=np.uint64)
    for k in range(size):
        whole += hashes[k:k + window] * weights[k]
    fits = doc[:window] == doc[size - 1:size - 1 + window]
    values, owner = mix64(whole[fits]), doc[:window][fits]
    lengths = np.bincount(doc, minlength=n_docs) if n else np.zeros(n_docs, dtype=np.int64)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        firsts = np.searchsorted(doc, short)
        extra = np.array([np.sum(hashes[f:f + lengths[d]] * weights[:lengths[d]], dtype=np.uint64) + np.uint64(lengths[d])
                          for f, d in zip(firsts, short)], dtype=np.uint64)
        values, owner = np.concatenate([values, mix64(extra)]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        fresh = np.ones(len(values), dtype=bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(n_docs + 1))


def affix_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word) of the first and the last ``k`` bytes of each word longer than that, for each of ``lengths``."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    undo = _powers(pow(_BASE, -1, 1 << 64), n + 1)
    values, owners = [], []
    for k in lengths:
        word = np.flatnonzero(end - start > k)
        for tail, low in ((0, start[word]), (1, end[word] - k)):
            values.append(mix64((sums[low + k] - sums[low]) * undo[low] + np.uint64(2 * k + tail + 1)))
            owners.append(word)
    return np.concatenate(values), np.concatenate(owners)
