"""Bitmaps of a bounded size over hashed values, built by Spark and looked up with numpy.

A look-up may say yes by chance, never no wrongly. Bits grow with the number of values up to
``MOST_BITS``; beyond that more look-ups say yes by chance, and nothing else changes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .shared import shuffles_removed

#: 16 MB is the most that one bitmap takes.
MOST_BITS = 27
#: Filters of all buckets of a level take 32 MB at most; bits that a value sets in a filter.
FILTER_BITS, PROBES = 28, 4
_PAGE = 32768


def bitmap_levels(values: DataFrame, value: str, level: str, levels: int) -> list[np.ndarray]:
    """A bitmap for each level, of the ``value`` (64 hashed bits) of its rows."""
    with shuffles_removed(values.sparkSession):
        counts = {r[level]: r["count"] for r in values.groupBy(level).count().collect()}
    bits = [min(MOST_BITS, max(16, (16 * counts.get(k, 0)).bit_length())) for k in range(levels)]
    mask = F.element_at(F.array(*[F.lit((1 << b) - 1).cast("long") for b in bits]), F.col(level) + 1)
    place = F.col(value).bitwiseAND(mask) + 1
    pages = values.groupBy(level, F.bitmap_bucket_number(place).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    with shuffles_removed(values.sparkSession):
        pages = pages.collect()
    maps = [np.zeros((1 << b) // 8, np.uint8) for b in bits]
    for r in pages:
        at = (r["page"] - 1) * (_PAGE // 8)
        maps[r[level]][at : at + _PAGE // 8] |= np.frombuffer(bytes(r["bits"]), np.uint8)[: len(maps[r[level]])]
    return maps


def contains(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values.astype(np.uint64) & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _probes(values: np.ndarray, k: int, mask: np.ndarray | np.uint64) -> np.ndarray:
    """The place that probe ``k`` gives each value."""
    values = values.astype(np.uint64)
    return (values + np.uint64(k) * ((values >> np.uint64(32)) | np.uint64(1))) & mask


def filter_of(values: np.ndarray, most: int) -> np.ndarray:
    """A filter of some values, of 16 to 32 bits each and 2 ** ``most`` at most: each sets ``PROBES`` bits."""
    bits = min(most, max(6, (16 * len(values) - 1).bit_length()))
    marks = np.zeros(1 << bits, np.uint8)
    for k in range(PROBES):
        marks[_probes(values, k, np.uint64((1 << bits) - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little")


def filter_levels(rows: list, buckets: int, levels: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Each level that has filters: the level, its filters one after the other, where each bucket's begins (in bits) and
    the mask of its places. A bucket without a filter has one empty word of 64 bits."""
    found = []
    for level in range(levels):
        bits = {r["bucket"]: bytes(r["bits"]) for r in rows if r["level"] == level}
        if not bits:
            continue
        size = np.array([len(bits.get(k, b"")) * 8 or 64 for k in range(buckets)], np.uint64)
        first = np.concatenate([np.zeros(1, np.uint64), np.cumsum(size)[:-1]])
        data = np.frombuffer(b"".join(bits.get(k, bytes(8)) for k in range(buckets)), np.uint8)
        found.append((level, data, first, size - np.uint64(1)))
    return found


def level_in(maps: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], buckets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The highest level that may hold each value of a bucket, -1 for none. A later probe is for what passed the others."""
    found = np.full(len(values), -1, np.int8)
    for level, data, first, mask in maps:
        left = np.arange(len(values))
        for k in range(PROBES):
            place = first[buckets[left]] + _probes(values[left], k, mask[buckets[left]])
            left = left[(data[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        found[left] = level
    return found
