"""Words, word hashes and window hashes of many texts at once, in numpy over Arrow's UTF-8 buffers.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are polynomials modulo 2**64 over random
byte values, finished by a bijective mix, so equal words always have equal hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20

IS_WORD = np.ones(256, bool)
IS_WORD[list(SEPARATORS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
RADIX = np.uint64(0x9E3779B97F4A7C15)
WINDOW_RADIX = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def second(x: np.ndarray) -> np.ndarray:
    """Another mix of the same 64 bits, for an independent window hash."""
    return mix(x ^ np.uint64(0x5851F42D4C957F2D))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the row offsets of a string array; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes; one row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))[1]
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words of each row."""
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    per_row = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return starts, ends, per_row


@lru_cache(maxsize=1)
def block_powers() -> tuple[np.ndarray, np.ndarray]:
    return long_powers(BLOCK_BYTES)


def long_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, RADIX, np.uint64), np.full(size, np.uint64(pow(int(RADIX), -1, 1 << 64)), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse."""
    return block_powers() if size <= BLOCK_BYTES else long_powers(size)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on, idle, while other stages run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    out = np.empty(len(starts), np.uint64)
    lengths = ends - starts
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(int(np.searchsorted(ends, base + BLOCK_BYTES, "right")), first + 1)
        size = int(ends[last - 1]) - base
        up, down = powers(size)
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUE[data[base:base + size]] * up[:size], out=sums[1:])
        begin = starts[first:last] - base
        out[first:last] = (sums[ends[first:last] - base] - sums[begin]) * down[begin]
        first = last
    return mix(out + lengths.astype(np.uint64))


def hashed_words(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows in order, and the number of words of each row."""
    data, offsets = text_buffers(column)
    if lower:
        data = LOWER[data]
    starts, ends, per_row = word_spans(data, offsets)
    return word_hashes(data, starts, ends), per_row


def window_sums(values: np.ndarray, length: int, radix: np.uint64) -> np.ndarray:
    """Rabin-Karp value of every window of ``length`` consecutive values, by doubling the window."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, width, power, left, step = None, 0, 1, radix, length, values
    shift = np.uint64(1)
    while left:
        if left & 1:
            part = step[done:done + n]
            out = part.copy() if out is None else out + part * shift
            done += width
            shift = shift * power
        left >>= 1
        if left:
            step = step[:-width] + step[width:] * power
            width *= 2
            power = power * power
    return out


def windows(words: np.ndarray, per_row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window that lies in one row: two independent hashes, and the number of windows of each row.

    A window starts at a word; windows of a row follow each other in word order.
    """
    counts = np.maximum(per_row - length + 1, 0)
    first = np.cumsum(per_row) - per_row
    at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    with np.errstate(over="ignore"):
        one = window_sums(words, length, WINDOW_RADIX[0])[at]
        two = window_sums(second(words), length, WINDOW_RADIX[1])[at]
    return mix(one), mix(two), counts


def shingle_sets(words: np.ndarray, per_row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ordered by row: two hashes, and the number of each row.

    A row with fewer words than ``length`` has its whole sequence as one shingle; a row without words has none.
    """
    one, two, counts = windows(words, per_row, length)
    row = np.repeat(np.arange(len(per_row)), counts)
    first = np.cumsum(per_row) - per_row
    short = np.flatnonzero((per_row > 0) & (per_row < length))
    if len(short):
        extra_one, extra_two = np.empty(len(short), np.uint64), np.empty(len(short), np.uint64)
        for size in range(1, length):
            some = np.flatnonzero(per_row[short] == size)
            if len(some):
                values = words[first[short[some]][:, None] + np.arange(size)]
                radix = np.array([WINDOW_RADIX[0] ** np.uint64(j) for j in range(size)], np.uint64)
                radix2 = np.array([WINDOW_RADIX[1] ** np.uint64(j) for j in range(size)], np.uint64)
                extra_one[some] = mix((values * radix).sum(1, dtype=np.uint64) + np.uint64(size))
                extra_two[some] = mix((second(values) * radix2).sum(1, dtype=np.uint64) + np.uint64(size))
        one, two, row = np.r_[one, extra_one], np.r_[two, extra_two], np.r_[row, short]
    order = np.argsort(one, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    one, two, row = one[order], two[order], row[order]
    fresh = np.ones(len(one), bool)
    fresh[1:] = (one[1:] != one[:-1]) | (row[1:] != row[:-1])
    return one[fresh], two[fresh], np.bincount(row[fresh], minlength=len(per_row))
