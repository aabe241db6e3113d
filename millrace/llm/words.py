"""Words and their 64-bit fingerprints from Arrow text columns, on whole arrays of bytes.

The word patterns of the operators only name ASCII separators, so the bytes of UTF-8 text can be
classified one by one: every byte of a multi-byte character belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # text handled at once; a longer document is handled alone
RUN_BYTES = 1 << 18  # of it, words whose fingerprints come from one running sum; a longer word has its own

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
# [^\x20\x09-\x0D]+
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = ~((_BYTES <= 0x2F) | ((_BYTES >= 0x3A) & (_BYTES <= 0x60)) | ((_BYTES >= 0x7B) & (_BYTES <= 0x7F)))

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


CODE = mix(_STEP * np.arange(1, 257, dtype=_U))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, RUN_BYTES + 1)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if size > RUN_BYTES + 1:
            return made[0], made[1]  # for one very long word; not kept
        _powers = (made[0], made[1])
    return _powers


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``size`` bytes each, or one row."""
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


@dataclass
class Words:
    """Words of some rows in order: row (from 0), byte range in ``data``, fingerprint of the bytes."""

    data: np.ndarray
    rows: int
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    fp: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def fingerprints(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial fingerprints of byte ranges, each after the one before, from running sums over ``RUN_BYTES`` of ``data``."""
    value, a = np.empty(len(start), _U), 0
    while a < len(start):
        base = int(start[a])
        b = max(int(np.searchsorted(end, base + RUN_BYTES, "right")), a + 1)
        run = data[base : int(end[b - 1])]
        power, inverse = powers(len(run) + 1)
        running = np.zeros(len(run) + 1, _U)
        np.cumsum(CODE[run] * power[: len(run)], out=running[1:])
        first, last = start[a:b] - base, end[a:b] - base
        value[a:b] = (running[last] - running[first]) * inverse[first]
        a = b
    return finished(value, end - start)


def finished(value: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Fingerprints from the sums of codes times powers, the first byte's power being 1, and the lengths."""
    return mix(value + _STEP * length.astype(_U))


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = True) -> Words:
    """Words of the rows that ``offsets`` cut out of ``data``; rows separate words."""
    base = int(offsets[0])
    data = data[base : int(offsets[-1])]
    data = LOWER[data] if lower else data
    bounds = (offsets - base).astype(np.int64)
    inside = table[data]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        begins[first] = inside[first]
        ends[:-1] &= ~inside[1:]
        last = bounds[1:][bounds[:-1] < bounds[1:]] - 1
        ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(bounds, start, "right") - 1
    return Words(data, len(offsets) - 1, row, start, end, fingerprints(data, start, end))


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of ``size`` consecutive words, and the range of them per row.

    A row with fewer words, but not none, has one: its whole sequence.
    """
    n = words.counts()
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.zeros(words.rows + 1, np.int64)
    np.cumsum(many, out=at[1:])
    first_word = np.cumsum(n) - n
    row = np.repeat(np.arange(words.rows), many)
    begin = first_word[row] + np.arange(at[-1]) - at[row]
    long = np.minimum(n[row], size)
    value = _U(0) + long.astype(_U)
    for k in range(size):
        has = k < long
        word = words.fp[np.minimum(begin + k, max(len(words.fp) - 1, 0))] if len(words.fp) else np.zeros(0, _U)
        value = mix(value * _STEP + np.where(has, word, _U(0)) + _U(k + 1))
    return value, at, begin


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
