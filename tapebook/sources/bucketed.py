"""Tables laid out in buckets of their key, so that the stored side of a keyed operation never moves.

The engine's own writer makes the buckets and its planner knows them: joins and anti joins on the key
(``operators.keyed``) read the table in place and only shuffle the batch, into as many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed


@dataclass(frozen=True)
class Buckets:
    """Layout of a table. Keys are unique, so buckets grow alike; choose ``count`` for a few hundred megabytes each."""

    keys: tuple[str, ...]
    count: int

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows moved to the task of their bucket."""
        return rows.repartition(self.count, *self.keys)


def write_bucketed(rows: DataFrame, name: str, path: str, layout: Buckets, *, in_place: bool = False) -> DataFrame:
    """Write a table and return it. Rows are moved to their buckets once, unless they lie there already
    (``in_place``, as what ``upsert`` gives), so there is one file per bucket."""
    placed = rows if in_place else layout.dealt(rows)
    writer = placed.write.bucketBy(layout.count, *layout.keys).sortBy(*layout.keys)
    writer.format("parquet").option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, layout: Buckets) -> DataFrame:
    """Make a table known to a session whose catalog lacks it, from its files."""
    if not spark.catalog.tableExists(name):
        keys = ", ".join(f"`{k}`" for k in layout.keys)
        columns = spark.read.parquet(path).schema
        declared = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns)
        spark.sql(
            f"CREATE TABLE {name} ({declared}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {layout.count} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def upsert(target: DataFrame, batch: DataFrame, layout: Buckets, *order: Column | str) -> DataFrame:
    """Batch rows replace stored ones; ``order`` puts the winning batch row first. The rows of the result
    lie in their buckets, so it can be written in place.

    The batch is cut to one row per key before it moves, so a hot key costs one row per task. A key
    with a NULL meets no stored row, as in an equi-join.
    """
    keys = list(layout.keys)
    latest = layout.dealt(keyed.first_per_key(batch, keys, *order).select(*target.columns))
    values = {c: F.col(f"new_{c}") for c in target.columns if c not in keys}
    return keyed.merge(target, latest, keys, matched=values, inserted=values)


def insert_if_absent(target: DataFrame, batch: DataFrame, layout: Buckets, *order: Column | str) -> DataFrame:
    """Batch rows whose key is not stored, the first by ``order`` of each key; they lie in their buckets."""
    keys = list(layout.keys)
    latest = layout.dealt(keyed.first_per_key(batch, keys, *order).select(*target.columns))
    return latest.join(target.select(*keys).hint("merge"), keys, "left_anti")
