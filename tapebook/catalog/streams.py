"""Streams over the driver's tables, several micro-batches each, with state between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import stateful
from .registry import TX_SQL, day_text, disclosures, query, shared_path, table

BATCHES = 3


def _landed(spark: SparkSession, rows: DataFrame, kind: str) -> DataFrame:
    """The rows as files that land in ``BATCHES`` micro-batches; each task deals its own rows out."""
    path = shared_path(spark, f"{kind}-landing")
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64(*rows.columns), F.lit(BATCHES)).cast("int"))
    dealt.write.partitionBy("slice").option("compression", "zstd").parquet(path)
    n_files = len(spark.read.schema(dealt.schema).parquet(path).inputFiles())
    reader = spark.readStream.schema(dealt.schema).option("maxFilesPerTrigger", max(1, -(-n_files // BATCHES)))
    return reader.parquet(path).drop("slice")


@query(
    "streamed_failures",
    """SELECT CAST(o_custkey AS VARCHAR) AS ticker, 'price' AS job_name, strftime(max(o_orderdate), '%Y-%m-%d') AS failure_date,
    max_by(o_orderpriority, (o_orderdate, o_orderpriority)) AS reason,
    max_by(o_orderpriority, (o_orderdate, o_orderpriority)) FILTER (o_orderpriority <> '5-LOW') AS error_class,
    strftime(min(o_orderdate), '%Y-%m-%d') AS first_seen, count(*) AS fail_count
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""",
)
def streamed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure ledger of a stream: filled orders stand for failures of their customer."""
    failures = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.lit("price").alias("job_name"),
        F.col("o_orderpriority").alias("reason"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("error_class"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("o_orderdate").cast("timestamp").alias("failed_at"),
    )
    path = shared_path(spark, "failures")
    stateful.stream_failures(_landed(spark, failures, "failures"), f"{path}/rows", f"{path}/check").awaitTermination()
    return stateful.read_failures(spark, f"{path}/rows").select(
        "ticker", "job_name", day_text("failure_date").alias("failure_date"), "reason", "error_class",
        day_text("first_seen_at").alias("first_seen"), "fail_count",
    )


@query(
    "streamed_inserts",
    f"WITH {TX_SQL} SELECT transaction_id, filing_date FROM tx GROUP BY ALL",
)
def streamed_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-or-ignore of a stream that brings every disclosure twice; the state forgets at once, so that
    later batches also meet the bitmaps."""
    rows = disclosures(spark, sf_dir).select("transaction_id", "filing_date")
    path = shared_path(spark, "inserts")
    stateful.insert_new(
        _landed(spark, rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), "inserts").drop("copy"), path, f"{path}/check", ["transaction_id", "filing_date"], "filing_date",
        remember="0 seconds",
    ).awaitTermination()
    return stateful.inserted_rows(spark, path).select("transaction_id", day_text("filing_date").alias("filing_date"))
