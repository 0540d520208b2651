"""Intermediate tables and session settings of the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tapebook.session import scratch_root

#: Rows and bytes handed to Python at a time, so that a batch of long texts stays small.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20
#: Setting of the engine: a query's shuffle files are removed at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go when they are done, not when the driver happens to
    collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, lets executors be lost,
    and tells the planner the size."""
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/llm/{uuid.uuid4().hex}-{name}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` gave, once nothing that is still to be read comes from them."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of whole texts small. A session's own lower limits stay."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b"))
        if now > most or now <= 0:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
