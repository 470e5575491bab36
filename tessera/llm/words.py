"""Words of whole texts as numpy arrays of 64-bit hashes.

A polynomial prefix sum over the bytes of a batch gives the hash of every word from two look-ups, and a
second prefix sum over the word hashes gives the Rabin-Karp hash of every run of words the same way.
All arithmetic is modulo 2**64 with odd multipliers, so a division by a power is a product with its inverse.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15 | 3, 0xD6E8FEB86659FD93
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, start: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U64) + U64(start)) * U64(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.concatenate([np.ones(1, U64), np.cumprod(np.full(size - 1, b, U64))]) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


BYTES, WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)
#: Bases of the second family, and the values of pairs of bytes.
PAIRS, PAIR_WORDS = Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)
PAIR_VALUES = seeds(1 << 16, 4049)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def byte_values(fold_ascii_case: bool) -> np.ndarray:
    values = seeds(256, 77)
    if fold_ascii_case:
        values[65:91] = values[97:123]
    return values


def slices(column: pa.Array, most: int = SLICE_BYTES):
    """(first row, bytes, offsets) of runs of rows of about ``most`` bytes; a null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of each word: the runs of bytes that are not in ``between``, within one row."""
    inside = ~between[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold_ascii_case: bool, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each row's first word and the total at the end)."""
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    begin, end = word_bounds(data, offsets, between)
    return span_hashes(data, begin, end, fold_ascii_case), np.searchsorted(begin, offsets)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, fold_ascii_case: bool) -> np.ndarray:
    """Hash of the bytes from each begin to its end."""
    up, down = BYTES.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(byte_values(fold_ascii_case)[data] * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U64))


def run_hashes(words: np.ndarray, begin: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Rabin-Karp hash of ``words[begin : begin + length]`` for every begin."""
    up, down = WORDS.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[:-1], out=sums[1:])
    return mix((sums[begin + length] - sums[begin]) * down[begin] + np.asarray(length).astype(U64))


def second_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Another hash of the bytes from each begin to its end, of one byte or more: made of pairs of bytes under other
    values and another base, so texts that the first family takes for equal are not equal here for the same reason."""
    pairs = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
    up, down = PAIRS.get(len(data) + 1)
    sums = np.zeros(len(data), U64)
    np.cumsum(PAIR_VALUES[pairs] * up[: len(pairs)], out=sums[1:])
    return mix((sums[end - 1] - sums[begin]) * down[begin] + PAIR_VALUES[data[begin]] + (end - begin).astype(U64))


def second_run_hashes(words: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    up, down = PAIR_WORDS.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[:-1], out=sums[1:])
    return mix((sums[begin + length] - sums[begin]) * down[begin] + U64(length))


def window_starts(first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index of every window that lies in one row, its row)."""
    counts = np.maximum(np.diff(first) - window + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][rows], rows
