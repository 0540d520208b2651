"""Bitmaps of stored keys, kept per part of a table, that tell which parts an insert must read at all."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from . import keyed

#: Bits kept for each key: about one new key in so many is looked up among the stored keys for nothing.
BITS_PER_KEY = 32
#: Up to so many keys that may be stored are broadcast to the stored ones.
FEW = 100_000
#: Fixed value: bits of one bitmap of the engine's aggregate.
PAGE_BITS = 32_768


def _place(keys: Sequence[str]) -> tuple[Column, Column]:
    """(page, bit) of a key in a set of ``pages`` bitmaps."""
    digest = F.xxhash64(*keys)
    page = F.pmod(digest, F.col("pages"))
    bit = F.pmod(F.shiftrightunsigned(digest, 20), F.lit(PAGE_BITS)).cast("int")
    return page, bit


def key_bits(rows: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """(part, pages, page, bits): one bit per key digest, in as many bitmaps of 4 KB as the part's keys need.

    Keys are counted and gathered inside tasks first, and a part of any size is spread over its pages.
    The counts that are broadcast have one row per part, such as a calendar month.
    """
    sizes = rows.groupBy(F.col(part).alias("part")).agg(
        F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / PAGE_BITS).cast("long").alias("pages")
    )
    page, bit = _place(keys)
    sized = rows.withColumn("part", F.col(part)).join(F.broadcast(sizes), "part")
    return sized.groupBy("part", "pages", page.alias("page")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def _met(asked: DataFrame, bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``asked`` (part and keys) whose bit is set in one of their part's sets of pages."""
    sets = bits.select("part", "pages").distinct()
    page, bit = _place(keys)
    placed = asked.join(F.broadcast(sets), "part").withColumns({"page": page, "_bit": bit})
    met = placed.join(bits, ["part", "pages", "page"])
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.withColumn("_byte", byte).filter(F.expr("shiftright(_byte, _bit % 8) % 2 = 1"))


def maybe_stored(batch: DataFrame, bits: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """(part, *keys) of the batch's keys that the parts may hold; all others they certainly lack.

    ``bits`` is the union of what ``key_bits`` gave for each insert: a part may have several sets of
    pages, which are all asked. The batch meets single pages, never a part's keys.
    """
    asked = batch.select(F.col(part).alias("part"), *keys).distinct()
    return _met(asked, bits, keys).select("part", *keys).distinct()


def maybe_parts(batch: DataFrame, bits: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """(part, hits) of the parts that may hold a key of the batch, with how often they may; of each row only its part, a
    page and a bit move."""
    met = _met(batch.select(F.col(part).alias("part"), *keys), bits, keys)
    return met.groupBy("part").agg(F.count(F.lit(1)).alias("hits"))


def absent_rows(
    batch: DataFrame, bits: DataFrame, part: str, keys: Sequence[str], read: Callable[[list[str]], DataFrame], scratch: Scratch
) -> DataFrame:
    """Batch rows whose key is not stored in its part; ``read`` gives the stored rows of some parts, without
    the column ``part`` if a key has but one part.

    Only parts that may hold a key of the batch are read, and only their key columns; keys that the bitmaps
    name wrongly are told apart there. A batch of new keys reads no part at all. The list of parts
    (calendar months) comes to the driver. A key with a NULL is never stored, as in an equi-join. If up to ``FEW`` keys
    may be stored, the stored side is cut to them where it lies; else its keys move to the batch once. A batch
    that lies in partitions of its keys is not moved, and one that is kept is not made again.
    """
    keys = list(keys)
    asked = batch.dropna(subset=keys)
    hits = scratch.write(maybe_parts(asked, bits, part, keys), "parts").collect()
    if not hits:
        return batch
    stored = read(sorted(r.part for r in hits))
    on = [c for c in (part, *keys) if c in keys or c in stored.columns]
    if sum(r.hits for r in hits) > FEW:
        return batch.join(stored.select(*on), on, "left_anti")
    few = scratch.write(maybe_stored(asked, bits, part, keys).withColumnRenamed("part", part), "asked")
    return keyed.absent_rows(batch, stored, on, asked=F.broadcast(few))
