"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes outside a set of separators; A-Z count as a-z. Its hash is a polynomial over
a table of random 64-bit values per byte, finished by a mixing step, and depends on the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
#: Bytes hashed at a time: keeps the working arrays near the processor.
CHUNK = 1 << 20

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space, ASCII punctuation and control characters.
NOT_ALPHANUMERIC = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of an ordered pair of hashes."""
    return mix(left * _U(0x9E3779B97F4A7C15) + (right ^ _U(0xD6E8FEB86659FD93)))


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTES[65:91] = _BYTES[97:123]
_BASE = 0x2545F4914F6CDD1D


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_POWERS = _powers(1 << 12)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins (one more than rows). Nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces_of(offsets: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Rows from and to, for stretches of rows of about ``size`` bytes; a longer row is one by itself."""
    before = offsets[:-1]
    edges = np.flatnonzero(np.diff(before // size, prepend=-1)).tolist()
    return list(zip(edges, [*edges[1:], len(before)]))


def parts_of(frames: Iterator[pa.RecordBatch], text: int | str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of rows with about ``size`` bytes of text, or one row of more, so that working arrays stay small."""
    for frame in frames:
        for a, b in pieces_of(as_bytes(frame.column(text))[1], size):
            yield frame.slice(a, b - a)


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; no word runs from one row into the next."""
    inside = ~separators[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each word."""
    global _POWERS
    n = len(starts)
    out = np.empty(n, _U)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        lengths = ends[at:to] - starts[at:to]
        longest = int(lengths.max())
        if longest > len(_POWERS):
            _POWERS = _powers(2 * longest)
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        values = _BYTES[data[place + np.repeat(starts[at:to], lengths)]] * _POWERS[place]
        out[at:to] = np.add.reduceat(values, first) + lengths.astype(_U)
        at = to
    return mix(out)


def hashed_words(column: pa.Array, separators: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and where each row's begin (one more than rows)."""
    data, offsets = as_bytes(column)
    starts, ends = word_spans(data, offsets, separators)
    return hash_spans(data, starts, ends), np.searchsorted(starts, offsets)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
