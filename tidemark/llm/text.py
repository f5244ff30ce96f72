"""Words, lines and their hashes, read straight from Arrow string buffers.

A word is a run of bytes other than the six ASCII white-space characters
(``[^\\x20\\x09-\\x0D]+``).  No byte of a multi-byte UTF-8 character is one of them, so
words are found on bytes without decoding.  Nulls have no words.

Hashes are polynomials modulo 2**64 over random byte values, mixed at the end.  They are
a pure function of the bytes: the same on every machine and in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer document is taken whole.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_32 = np.uint64(32)
_29 = np.uint64(29)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240501)).integers(
    1, 1 << 63, 256, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), SLICE_BYTES + 1)
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            done = np.cumprod(steps)
            if base == _BASE:
                _powers = done
            else:
                _inverse_powers = done
    return _powers[:n], _inverse_powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word; a bijection."""
    h = h ^ (h >> _32)
    h = h * _MIX1
    h = h ^ (h >> _29)
    h = h * _MIX2
    return h ^ (h >> _32)


def mix_with(h: np.ndarray, salt) -> np.ndarray:
    steps = np.atleast_1d(np.asarray(salt)).astype(np.uint64) + np.uint64(1)
    return mix(h + np.uint64(0x632BE59BD9B4E019) * steps)


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for each ``values[start:end]``; equal sequences have equal hashes."""
    power, inverse = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width`` consecutive values, one for each start."""
    n = max(0, len(values) - width + 1)
    start = np.arange(n)
    return span_hashes(values, start, start + width)


class Text:
    """A few documents as one byte array: their words and lines as spans of it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw = data
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        self.docs = len(offsets) - 1
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge[1:-1] |= ~word[:-1] | ~word[1:]
        self.start = np.flatnonzero(word & edge[:-1])
        self.end = np.flatnonzero(word & edge[1:]) + 1
        self.is_word = word
        #: Words before each document, and in total.
        self.first = np.searchsorted(self.start, offsets)

    def word_hashes(self) -> np.ndarray:
        return span_hashes(_BYTE_VALUES[self.data], self.start, self.end)

    def words_per_doc(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), np.diff(self.first))

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each document."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def per_doc_of_words(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each document."""
        total = np.zeros(len(flags) + 1, np.float64 if flags.dtype.kind == "f" else np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.first[1:]] - total[self.first[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every line; lines end at ``\\n`` alone."""
        breaks = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]))
        doc_of_break = np.searchsorted(self.offsets, breaks, "right") - 1
        end = np.sort(np.concatenate([self.offsets[1:], breaks]))
        lines_in = 1 + np.bincount(doc_of_break, minlength=self.docs)
        return start, end, np.repeat(np.arange(self.docs), lines_in)

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return span_hashes(_BYTE_VALUES[self.data], start, end)

    def window_starts(self, width: int) -> np.ndarray:
        """Positions of words at which ``width`` words of one document start."""
        n = self.words_per_doc()
        inside = np.arange(len(self.start)) - np.repeat(self.first[:-1], n)
        return np.flatnonzero(inside + width <= np.repeat(n, n))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the borders of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n, at = len(column), column.offset
    _, offset_buffer, data_buffer = column.buffers()
    if n == 0 or offset_buffer is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offset_buffer, kind)[at : at + n + 1].astype(np.int64)
    if data_buffer is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes each, or a single row beyond it."""
    _, offsets = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(rows, max(row + 1, stop))
        yield row, stop
        row = stop


def texts(column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Text]]:
    """The column in slices: first row, row after the last, and their :class:`Text`."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = buffers(column)
    for row, stop in slices(column, limit):
        own = offsets[row : stop + 1]
        yield row, stop, Text(data[own[0] : own[-1]], own - own[0], lower)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column out of its flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
