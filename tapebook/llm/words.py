"""Words of whole text columns as numpy arrays, many documents at a time.

A block holds the UTF-8 bytes of some rows. Words are found with one table look-up per byte and
hashed with one running sum, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows are gathered into blocks of about so many bytes; one longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words split at ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

#: Bytes of words made of ASCII letters and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True

#: Bytes of words made of ASCII letters, ASCII digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, factor in enumerate((_BASE, _INVERSE)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing steps of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Block:
    """Rows ``first`` to ``first + rows`` of a batch; words are in text order, row by row."""

    first: int
    rows: int
    raw: np.ndarray
    """bytes as they are"""
    data: np.ndarray
    """lower-cased bytes"""
    offsets: np.ndarray
    """byte offset of each row, and the end"""
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    """words of each row"""
    bounds: np.ndarray
    """index of each row's first word, and the end"""

    @cached_property
    def sums(self) -> np.ndarray:
        """Running polynomial sums of the bytes, from which any stretch's hash follows."""
        powers, _ = _tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[: len(self.data)], out=sums[1:])
        return sums

    def stretch(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each stretch; equal bytes give equal hashes anywhere."""
        _, inverse = _tables(len(self.data) + 1)
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return self.stretch(self.starts, self.ends)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


class HashSet:
    """A set of 64-bit hashes that drops most others by a table of their low bits."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        bits = max(16, int(self.values.size).bit_length() + 4)
        self.mask = np.uint64((1 << bits) - 1)
        self.low = np.zeros(1 << bits, bool)
        self.low[(self.values & self.mask).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the hashes that are in the set, and their places in it."""
        near = np.flatnonzero(self.low[(hashes & self.mask).astype(np.int64)])
        if not near.size or not self.values.size:
            return near[:0], near[:0]
        at = np.minimum(np.searchsorted(self.values, hashes[near]), self.values.size - 1)
        real = self.values[at] == hashes[near]
        return near[real], at[real]


def string_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array without nulls (a null text is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, bytes and offsets of each block of a string column."""
    column = string_column(column)
    n = len(column)
    _, where, body = column.buffers()
    at = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    whole = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, last - first, whole[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_blocks(column: pa.Array, kind: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column, with A-Z in lower case and words of the bytes that ``kind`` marks."""
    for first, rows, raw, offsets in raw_blocks(column, limit):
        data = LOWER[raw]
        inside = kind[data]
        size = len(data)
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        heads = offsets[:-1]
        before[heads[heads < size]] = False
        after = np.zeros(size, bool)
        after[:-1] = inside[1:]
        tails = offsets[1:]
        after[tails[tails > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        bounds = np.searchsorted(starts, offsets)
        yield Block(first, rows, raw, data, offsets, starts, ends, np.diff(bounds), bounds)


def replace_columns(batch: pa.RecordBatch, drop: tuple[str, ...], **added: pa.Array) -> pa.RecordBatch:
    """The batch without ``drop`` and with ``added`` columns."""
    names = [n for n in batch.schema.names if n not in drop and n not in added]
    return pa.RecordBatch.from_arrays(
        [batch.column(batch.schema.get_field_index(n)) for n in names] + list(added.values()), names + list(added)
    )
