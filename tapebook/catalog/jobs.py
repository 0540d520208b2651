"""Whole runs of the price job, and exports, over the driver's tables."""

from __future__ import annotations

from dataclasses import asdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import fill_defaults
from ..plans.pricing import PriceResult, run_prices
from ..schemas import TICKER_DATA
from ..sources.export import read_sorted_lines, write_sorted_csv
from ..sources.store import SnapshotStore
from .registry import bars, bars_sql, day_text, query, shared_path, table

RUN = datetime(2024, 1, 25, 23, 0)
FIRST, LAST = "2024-01-20", "2024-01-25"

#: Stored symbols: customers in credit. The feed has the bars of all users.
_KNOWN_SQL = f"""known AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_acctbal > 0),
  {bars_sql('b')},
  feed AS (SELECT * FROM b WHERE date BETWEEN DATE '{FIRST}' AND DATE '{LAST}')"""


def _run(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, PriceResult]:
    """A store of its own after one run of the price job, which asks for all symbols at once."""
    store = SnapshotStore(spark, shared_path(spark, "store"))
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("ticker"))
    store.commit({"ticker_data": fill_defaults(known, TICKER_DATA, RUN)})
    feed = bars(spark, sf_dir).withColumns(
        {"batch_id": F.lit(None).cast("string"), "adj_close": F.lit(None).cast("double"), "volume": F.col("volume").cast("double")}
    )
    return store, run_prices(store, feed, RUN, requests=known.withColumn("batch_id", F.lit("all")), term_days=5)


def _priced(spark: SparkSession, sf_dir: str) -> SnapshotStore:
    return _run(spark, sf_dir)[0]


@query(
    "price_run",
    f"""WITH {_KNOWN_SQL}
  SELECT ticker, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume FROM feed WHERE ticker IN (SELECT ticker FROM known)""",
)
def price_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that a run stores."""
    stored = _priced(spark, sf_dir).read("pricing_data")
    return stored.select("ticker", day_text("date").alias("date"), "open", "high", "low", "close", "volume")


@query(
    "price_run_failures",
    f"""WITH {_KNOWN_SQL}
  SELECT ticker, 'price' AS job_name, 'YFMissingTicker' AS error_class, 1 AS fail_count FROM known
  WHERE ticker NOT IN (SELECT ticker FROM feed)""",
)
def price_run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of the symbols that the feed lacks."""
    return _priced(spark, sf_dir).read("ticker_failures").select("ticker", "job_name", "error_class", "fail_count")


@query(
    "price_run_orphans",
    f"""WITH {_KNOWN_SQL}
  SELECT ticker, 'pricing_data' AS table_name, 'ticker has no row in ticker_data' AS violations, count(*) AS n_rows
  FROM feed WHERE ticker NOT IN (SELECT ticker FROM known) GROUP BY ticker""",
)
def price_run_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of symbols that are not stored, from the rejected rows."""
    rejected = _priced(spark, sf_dir).read("rejected_rows")
    ticker = F.get_json_object("row_data", "$.ticker").alias("ticker")
    return rejected.groupBy(ticker, "table_name", "violations").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "price_run_counters",
    f"""WITH {_KNOWN_SQL}
  SELECT (SELECT count(*) FROM known) AS requested, (SELECT count(DISTINCT ticker) FROM feed WHERE ticker IN (SELECT ticker FROM known)) AS priced,
    (SELECT count(*) FROM feed WHERE ticker IN (SELECT ticker FROM known)) AS price_rows,
    (SELECT count(*) FROM feed WHERE ticker NOT IN (SELECT ticker FROM known)) AS quarantined""",
)
def price_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a run, taken from its writes."""
    counters = asdict(_run(spark, sf_dir)[1])
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counters.items()])


@query(
    "csv_export",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS line_no,
    o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || strftime(o_orderdate, '%Y-%m-%d') AS line FROM orders""",
)
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as sorted CSV parts, read again line by line."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", day_text("o_orderdate").alias("o_orderdate"))
    path = shared_path(spark, "export")
    write_sorted_csv(orders, path, ["o_orderdate", "o_orderkey"], rows_per_part=4000)
    return read_sorted_lines(spark, path)
