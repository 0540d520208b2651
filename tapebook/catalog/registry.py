"""Registry and the stand-in frames shared by the registered queries.

The driver's tables are not disclosures, so each query maps them to the shape an operator
works on: order lines stand for disclosures, customers for symbols, events for price ticks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, rules
from ..operators.prices import daily_bars
from ..session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = datetime(2001, 6, 1, 12, 0, 0)


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/tapebook/{kind}-{uuid.uuid4().hex}"


def day_text(c: Column | str) -> Column:
    return F.to_date(c).cast("string")


def labels() -> Column:
    """Trade label of an order line."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    shipped = F.when(flag == "N", "P - Purchase").when(flag == "A", "S - Sale").otherwise("S - Sale+OE")
    open_ = F.when(flag == "A", "F - Tax").when(flag == "R", "Z - Other")
    return F.when(status == "F", shipped).otherwise(open_)


LABEL_SQL = """CASE WHEN l_linestatus = 'F' THEN CASE l_returnflag WHEN 'N' THEN 'P - Purchase'
 WHEN 'A' THEN 'S - Sale' ELSE 'S - Sale+OE' END
 ELSE CASE l_returnflag WHEN 'A' THEN 'F - Tax' WHEN 'R' THEN 'Z - Other' END END"""


def disclosures(spark: SparkSession, sf_dir: str, *, hashed: bool = False) -> DataFrame:
    """Order lines as typed disclosures. Natural key = (order, line), with a NULL part on line 3.

    Stored tables hold their ids, so most queries take a plain one; ``hashed`` computes the
    content id of a landed row.
    """
    plain = F.concat_ws("/", "ticker", "sec_tx_code", "title", F.col("price").cast("string"))
    line = F.col("l_linenumber").cast("string")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", F.lit("https://www.sec.gov"), "l_orderkey", "l_linenumber").alias("source_url"),
        F.to_date("l_shipdate").alias("filing_date"),
        F.lit(None).cast("date").alias("trade_date"),
        F.col("l_orderkey").cast("string").alias("ticker"),
        F.when(F.col("l_linenumber") != 3, F.concat(F.lit("Insider "), line)).alias("insider_name"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("title"),
        labels().alias("trade_type"),
        line.alias("sec_tx_code"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_returnflag").alias("x_flags"),
    )
    return rows.withColumns(
        {
            "value": rules.trade_value(F.col("price"), F.col("qty")),
            "is_open_market": rules.open_market_flag(F.col("trade_type")),
            "classification": rules.classification(F.col("trade_type")),
            "transaction_id": identity.transaction_id() if hashed else plain,
            "source": F.lit("openinsider"),
            "scraped_at": F.col("filing_date").cast("timestamp"),
            "is_active": F.lit(1),
            "superseded_by": F.lit(None).cast("string"),
            "superseded_at": F.lit(None).cast("timestamp"),
        }
    )


_TX0_SQL = f"""tx0 AS (
  SELECT 'https://www.sec.gov/' || l_orderkey || '/' || l_linenumber AS source_url,
         strftime(l_shipdate, '%Y-%m-%d') AS filing_date,
         CAST(l_orderkey AS VARCHAR) AS ticker,
         CASE WHEN l_linenumber <> 3 THEN 'Insider ' || l_linenumber END AS insider_name,
         l_partkey || '-' || l_suppkey AS title,
         {LABEL_SQL} AS trade_type,
         CAST(l_linenumber AS VARCHAR) AS sec_tx_code,
         l_extendedprice AS price, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS x_flags
  FROM lineitem)"""
TX_SQL = f"""{_TX0_SQL},
tx AS (SELECT *, ticker || '/' || sec_tx_code || '/' || title || '/' || price AS transaction_id FROM tx0)"""
HASHED_TX_SQL = f"""{_TX0_SQL},
tx AS (
  SELECT *, sha256(source_url || '|' || filing_date || '||' || ticker || '|' || coalesce(insider_name, '')
    || '|' || title || '|' || coalesce(trade_type, '') || '|' || CAST(price AS VARCHAR) || '|' || qty
    || '|' || x_flags) AS transaction_id
  FROM tx0)"""


def bars(spark: SparkSession, sf_dir: str, *event_types: str, but: str | None = None) -> DataFrame:
    """Daily bars per user, from the ticks of the given event types, or of all ``but`` one, or of all."""
    ticks = table(spark, sf_dir, "events").withColumn("symbol", F.col("user_id").cast("string"))
    if event_types:
        ticks = ticks.filter(F.col("event_type").isin(*event_types))
    if but:
        ticks = ticks.filter(~F.col("event_type").eqNullSafe(but))
    return daily_bars(ticks, "symbol", "ts", "value", "event_id")


def bars_sql(name: str, *event_types: str, but: str | None = None) -> str:
    where = f"WHERE event_type IN ({', '.join(repr(t) for t in event_types)})" if event_types else ""
    where = f"WHERE event_type IS DISTINCT FROM {but!r}" if but else where
    return f"""{name} AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, count(*) AS volume
  FROM events {where} GROUP BY ALL)"""
