"""State between micro-batches, kept by the engine's state store instead of being read again from tables.

``failure_ledger`` is a streaming aggregation in update mode; ``insert_new`` forgets repeated keys with
``dropDuplicatesWithinWatermark``. Each micro-batch owns one folder, which a replay writes again with the
same rows, so a restart from the checkpoint changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ..operators import key_bits
from ..schemas import TICKER_FAILURES
from ..session import Scratch
from ..sources.store import month_of

BATCH = "batch"
DIGEST = ["_key_1", "_key_2"]
#: The state is unloaded when a task commits; no batch without rows; shuffle files of a write inside a batch go at its end.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def failure_ledger(failures: DataFrame) -> DataFrame:
    """Failure ledger of landed failures (ticker, job_name, reason, error_class, error_message, failed_at).

    The same expression runs over a table and over a stream, whose state is one row per symbol and job. All
    columns are counts and extremes by ``failed_at``, so the order in which rows arrive, and how late,
    makes no difference. Of failures at one moment the largest text counts; a NULL class or message
    does not replace a known one.
    """

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("failed_at", c))).alias(c)

    return failures.groupBy("ticker", "job_name").agg(
        F.to_date(F.max("failed_at")).alias("failure_date"),
        last("reason"),
        last("error_class"),
        last("error_message"),
        F.min("failed_at").alias("first_seen_at"),
        F.max("failed_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias("fail_count"),
    )


def keep_changes(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that a streaming aggregation changed, batch by batch, until the landed files are used up."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        rows.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key; tasks keep one row per key before the shuffle."""
    changes = spark.read.parquet(path)
    others = [c for c in changes.columns if c not in (*keys, BATCH)]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*others), BATCH).alias("_row"))
    return newest.select(*keys, "_row.*")


def stream_failures(failures: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the ledger of a stream of failures; ``read_failures`` gives it."""
    return keep_changes(failure_ledger(failures), path, checkpoint)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return TICKER_FAILURES.conform(current_rows(spark, path, TICKER_FAILURES.keys))


def _digest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with 128 bits (``DIGEST``, two hashes of different seeds) for a key of any columns; NULLs are equal to
    each other and to nothing else."""
    parts = [x for c in keys for x in (F.col(c).isNull(), F.col(c))]
    return rows.withColumns({c: F.xxhash64(F.lit(seed), *parts) for seed, c in enumerate(DIGEST)})


def first_arrivals(rows: DataFrame, keys: Sequence[str], remember: str) -> DataFrame:
    """Rows whose key did not come within the time ``remember``, by the clock of the micro-batches.

    The time of arrival is the event time, so no row is ever late and none is dropped for its date. The
    state holds a digest per key, and forgets it some time after it came.
    """
    marked = _digest(rows, keys).withColumn("_arrived", F.current_timestamp())
    return marked.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(DIGEST).drop("_arrived")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that a query started inside keeps; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def insert_new(
    rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], date: str, remember: str = "30 days"
) -> StreamingQuery:
    """Insert-or-ignore of a stream: of each key one row is kept, whenever its repetitions come.

    Repetitions within ``remember`` meet the state. Later ones pass it and meet the bitmaps of all
    inserted keys (per month of ``date``, which must follow from the key): months that may hold a key
    are read, a batch of new keys reads none. What passes the state is kept on the executors' disks, in the state's
    partitions, so that only stored keys move to meet it. Rows of one key in one batch are taken as equal, as keys are
    digests of content; any one of them stays. NULL keys are equal.

    A task reads its partition's state from the checkpoint and lets it go when it commits, so that no executor's heap
    holds the whole state between batches: memory is bounded by partitions, not by keys. Each batch goes through the whole
    state anyway, to forget. No batch is run just to forget keys.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession  # that of the query, with its settings

        def earlier(folder: str) -> DataFrame:
            return spark.read.parquet(f"{path}/{folder}").filter(F.col(BATCH) < number)

        spark.sparkContext._jvm.System.gc()  # shuffle files of the batch before go when nothing refers to them
        batch = batch.withColumn("month", month_of(date)).persist(StorageLevel.DISK_ONLY)
        with Scratch(spark, f"{path}/_work") as scratch:
            fresh = batch
            # The first batch writes its folders even if it is empty, so later ones find them.
            if number > 0:
                fresh = key_bits.absent_rows(
                    batch, earlier("bits"), "month", DIGEST,
                    lambda months: _digest(earlier("rows").filter(F.col("month").isin(months)), keys).select(*DIGEST),
                    scratch,
                )
            fresh = fresh.drop(*DIGEST)
            folder = f"{path}/rows/{BATCH}={number}"
            fresh.write.mode("overwrite").option("compression", "zstd").parquet(folder)
            inserted = _digest(spark.read.schema(fresh.schema).parquet(folder), keys)
            key_bits.key_bits(inserted, "month", DIGEST).write.mode("overwrite").parquet(f"{path}/bits/{BATCH}={number}")
        batch.unpersist()

    with _settings(rows.sparkSession, STATE_SETTINGS):
        return (
            first_arrivals(rows, keys, remember).writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def inserted_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop(BATCH, "month")
