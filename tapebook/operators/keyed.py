"""Keyed table maintenance as pure functions: (target, batch) -> new target.

Targets hold one row per key. The batch side is the one that may be broadcast, so a small
batch never makes a large target move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key.

    Each task keeps one row per key before the shuffle (WindowGroupLimit in the plan), so a
    hot key costs one row per task. The result stays partitioned by the key, which a join
    that follows can use.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def absent_rows(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], asked: DataFrame | None = None
) -> DataFrame:
    """Batch rows whose key the target lacks.

    The target is first cut to the keys asked for. That join can broadcast the batch keys, so
    a small batch costs a scan of the target's key columns and no shuffle of it. ``asked``
    may name a cheaper frame with the same keys.
    """
    keys = list(keys)
    wanted = (batch if asked is None else asked).select(*keys)
    known = target.select(*keys).join(wanted, keys, "left_semi")
    return batch.join(known, keys, "left_anti")


def present_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in the batch."""
    keys = list(keys)
    return target.join(batch.select(*keys).distinct(), keys, "left_semi")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks. Both sides shrink to distinct rows before they meet."""
    return a.distinct().join(b.distinct(), a.columns, "left_anti")


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that both sides have."""
    return a.distinct().join(b.distinct(), a.columns, "left_semi")


def insert_if_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], *order: Column | str
) -> DataFrame:
    """Stored rows win over new ones, earlier batch rows over later ones."""
    fresh = absent_rows(
        first_per_key(batch, keys, *order), target, keys, asked=batch.select(*keys).distinct()
    )
    return target.unionByName(fresh.select(*target.columns))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """Batch rows replace stored ones; ``order`` puts the winning batch row first."""
    keys = list(keys)
    latest = first_per_key(batch, keys, *order) if order else batch
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(latest.select(*target.columns))


def update_keys(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Set columns on the rows whose key is in the batch.

    Expressions see the target's columns and the batch's as ``new_<column>``. Of batch rows that
    repeat a key the largest counts, column by column, so the target keeps one row per key.
    """
    keys = list(keys)
    incoming = _incoming(_largest_per_key(batch, keys), keys).withColumn("_hit", F.lit(True))
    joined = target.join(incoming, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def delete_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(batch.select(*keys), list(keys), "left_anti")


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    matched: Mapping[str, Column],
    inserted: Mapping[str, Column],
) -> DataFrame:
    """Update matched rows and insert the others, in one outer join.

    For the small state tables (symbols, failures, exclusions). Expressions see the target's
    columns and the batch's as ``new_<column>``; columns left out keep their value on a match
    and are NULL on an insert. Of batch rows that repeat a key the largest counts, column by column.
    """
    keys = list(keys)
    stored = target.withColumn("_stored", F.lit(True))
    joined = stored.join(_incoming(_largest_per_key(batch, keys), keys).withColumn("_hit", F.lit(True)), keys, "full_outer")

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        kept = F.col(c)
        return (
            F.when(F.col("_stored").isNull(), inserted.get(c, F.lit(None)))
            .when(F.col("_hit"), matched.get(c, kept))
            .otherwise(kept)
            .cast(target.schema[c].dataType)
            .alias(c)
        )

    return joined.select(*[merged(c) for c in target.columns])


def _largest_per_key(batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; sums are made before the shuffle, and a row that is alone stays as it is."""
    others = [c for c in batch.columns if c not in keys]
    if not others:
        return batch.distinct()
    return batch.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_row")).select(*keys, "_row.*")


def _incoming(batch: DataFrame, keys: list[str]) -> DataFrame:
    return batch.select(*keys, *[F.col(c).alias(f"new_{c}") for c in batch.columns if c not in keys])
