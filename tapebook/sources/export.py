"""CSV export of whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import TABLES
from .store import SnapshotStore


def write_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV parts with a header; NULL and empty text are both written empty."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str], rows_per_part: int = 1_000_000) -> DataFrame:
    """The table as sorted CSV parts without headers, whose lines one behind the other are the sorted
    table, and their list: (position, part, n_lines, columns), also written as ``<path>/_list`` in JSON.

    Rows are dealt out by ranges of ``order`` and sorted within each part, so no task holds more than
    about a part, but for rows that are equal in all of ``order``. Part names ascend with the ranges.
    """
    spark = df.sparkSession
    parts = max(1, -(-df.count() // rows_per_part))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").option("header", False).option("emptyValue", "").option("escape", '"').csv(f"{path}/parts")
    names = spark.read.text(f"{path}/parts").select(F.col("_metadata.file_name").alias("part"))
    counted = names.groupBy("part").agg(F.count(F.lit(1)).alias("n_lines"))
    place = W.orderBy("part")  # one row per part
    listed = counted.select((F.row_number().over(place)).alias("position"), "part", "n_lines", F.lit(",".join(df.columns)).alias("columns"))
    listed.write.mode("overwrite").json(f"{path}/_list")
    return spark.read.schema(listed.schema).json(f"{path}/_list")


def read_sorted_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of the parts of ``write_sorted_csv`` one behind the other. A line break inside a
    value makes a line of its own."""
    listed = spark.read.schema("position int, part string, n_lines long").json(f"{path}/_list")
    before = W.orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    starts = listed.select("part", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("_before"))
    lines = spark.read.text(f"{path}/parts").select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
    )
    inside = W.partitionBy("part").orderBy("_block", "_id")
    placed = lines.withColumn("_at", F.row_number().over(inside)).join(F.broadcast(starts), "part")
    return placed.select((F.col("_before") + F.col("_at")).alias("line_no"), "line")


def export_csv(store: SnapshotStore, out_dir: str, tables: Iterable[str] | None = None) -> list[str]:
    """Write every table, or the named ones, below ``out_dir``; returns the folders."""
    written = []
    for name in tables or TABLES:
        path = f"{out_dir.rstrip('/')}/{name}"
        write_csv(store.read(name), path)
        written.append(path)
    return written
