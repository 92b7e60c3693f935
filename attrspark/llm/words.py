"""Words and word hashes of whole Arrow batches, without a Python object per word.

A word is a run of bytes other than space and \\x09-\\x0D, with A-Z lower-cased. White
space is ASCII, so cutting UTF-8 at bytes never splits a character. A word hash is a
64-bit polynomial over table values of its bytes, mixed; equal words have equal hashes on
every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 4 << 20


def mix(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit moves every output bit."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


with np.errstate(over="ignore"):
    _VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FOLDED = _VALUE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2^64, as many as were needed."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def cover(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(20, int(n - 1).bit_length())
            for name, base in (("up", int(_MULTIPLIER)), ("down", pow(int(_MULTIPLIER), -1, 1 << 64))):
                row = np.full(size, base, dtype=np.uint64)
                row[0] = 1
                setattr(cls, name, np.cumprod(row, dtype=np.uint64))
        return cls.up, cls.down


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets in them) of runs of rows of about `limit`
    bytes each; a longer text is a run of its own. Nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a word never crosses a row."""
    solid = ~_SPACE[data]
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(solid) + 1, dtype=bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    """The hash of each span of bytes."""
    up, down = _Powers.cover(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, word offsets of the rows) for bytes and row offsets."""
    begins, ends = word_spans(data, offsets)
    return span_hashes(data, begins, ends, _FOLDED), np.searchsorted(begins, offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for k in range(1, size):
            out = mix(out * _MULTIPLIER) + words[k : k + n]
        return mix(out + np.uint64(size))
