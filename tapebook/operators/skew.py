"""Joins and look-ups that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
"""A key on more rows than this is hot: its rows are dealt out over tasks of about this many."""
IDLE_SALTS = 1 << 20
"""Rows that ask for nothing are dealt out over so many salts."""


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_hash, _salts) of every key digest on more than ``hot_rows`` rows, by exact counts.

    Tasks count before the shuffle, so a hot key arrives as one count per task. The result has
    fewer rows than the input has ``hot_rows``-s, 16 bytes each.
    """
    counted = rows.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter(F.col("_n") > hot_rows).select(
        "_hash", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")
    )


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    where: Column | None = None,
    spread_by: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of many rows to a frame with **one row per key**; NULL key parts match each other.

    The rows of a hot key are salted, one salt per ``hot_rows`` of them, and its one look-up row is
    repeated for each salt. The list of hot keys is broadcast: it has at most one row per
    ``hot_rows`` input rows. Keys that are not hot meet as in a plain join, where the engine
    broadcasts a small look-up side. Rows that fail ``where`` match nothing and are spread as well.
    ``spread_by`` names columns that tell the rows of a hot key apart, such as an id; without it
    all columns do.
    """
    keys = list(keys)
    values = [c for c in lookup.columns if c not in keys]
    asking = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    hot = F.broadcast(hot_keys(rows.filter(asking), keys, hot_rows))
    # The digest leads the join key: sorting compares numbers and meets the key only on a tie.
    key = [F.xxhash64(*keys).alias("_hash"), F.struct(*keys).alias("_key")]
    salts = F.coalesce("_salts", F.lit(1))

    side = lookup.select(*key, *values).join(hot, "_hash", "left")
    side = side.select("_hash", "_key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"), *values)
    spread = F.xxhash64(*(spread_by or rows.columns))
    salt = F.when(~asking, -1 - F.pmod(spread, F.lit(IDLE_SALTS))).otherwise(F.pmod(spread, salts))
    asked = rows.select("*", *key).join(hot, "_hash", "left").withColumn("_salt", salt.cast("int"))
    found = asked.join(side, ["_hash", "_salt", "_key"], "left")
    return found.select(*rows.columns, *values)


def keep_keys(
    rows: DataFrame, wanted: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose key is in ``wanted`` (one row per key): a semi join that a hot key cannot stall."""
    flags = wanted.select(*keys).withColumn("_wanted", F.lit(True))
    return lookup_join(rows, flags, keys, hot_rows=hot_rows).filter("_wanted").drop("_wanted")


def next_marked(
    rows: DataFrame,
    keys: Sequence[str],
    page: str,
    within: Sequence[str],
    marked: Column,
    value: Column,
    out: str,
    pages_per_chunk: int = 1024,
) -> DataFrame:
    """For each row the ``value`` of the next marked row of its key, in (page, within) order.

    Two levels, so no task sorts a whole key: rows are ordered inside (key, chunk of pages),
    then one summary row per chunk is ordered inside the key. A chunk holds the rows of
    ``pages_per_chunk`` landed pages; a key has one summary row per chunk. NULL key parts
    count as equal.
    """
    order = [page, *within]
    base = (
        rows.withColumn("_hash", F.xxhash64(*keys))
        .withColumn("_key", F.struct(*keys))
        .withColumn("_chunk", F.floor(F.col(page) / pages_per_chunk))
        .withColumn("_mark", F.when(F.coalesce(marked, F.lit(False)), value))
    )
    # Descending order with a frame that only grows: one pass, where a frame that
    # starts after the row and runs to the end would be rescanned for each row.
    after = (
        W.partitionBy("_hash", "_key", "_chunk")
        .orderBy(*[F.col(c).desc() for c in order])
        .rowsBetween(W.unboundedPreceding, -1)
    )
    near = base.withColumn("_near", F.last("_mark", ignorenulls=True).over(after))

    first_here = F.min_by("_mark", F.when(F.col("_mark").isNotNull(), F.struct(*order)))
    later = (
        W.partitionBy("_hash", "_key")
        .orderBy(F.col("_chunk").desc())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    far = (
        base.groupBy("_hash", "_key", "_chunk").agg(first_here.alias("_first"))
        .withColumn("_far", F.last("_first", ignorenulls=True).over(later))
        .filter(F.col("_far").isNotNull())
        .select("_hash", "_key", "_chunk", "_far")
    )
    return near.join(far, ["_hash", "_key", "_chunk"], "left").select(
        *rows.columns, F.coalesce("_near", "_far").alias(out)
    )


def hash_rank(df: DataFrame, digest: str, out: str, bucket_chars: int = 3) -> DataFrame:
    """Exact 1-based position of each row in the order of a hexadecimal ``digest`` column.

    The leading characters split the rows into even buckets; only one count per bucket is
    ordered globally (16 ** ``bucket_chars`` rows at most), never the rows themselves.
    """
    bucketed = df.withColumn("_bucket", F.substring(digest, 1, bucket_chars))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_bucket").orderBy(digest)
    return (
        bucketed.withColumn("_at", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .select(*df.columns, (F.col("_before") + F.col("_at")).alias(out))
    )
