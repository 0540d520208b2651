"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed, prices, quality
from ..operators.skew import lookup_join
from ..plans.pricing import work_list
from ..sources import feeds
from ..sources.feeds import metadata_columns
from .registry import TX_SQL, bars, bars_sql, day_text, disclosures, query, table

SINCE = "2001-01-01"


def _orders(spark: SparkSession, sf_dir: str, *more: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to a day, which are the stored rows, and those from it on, which are the batch."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", *more)
    recent = F.col("o_orderdate") >= F.lit(SINCE).cast("timestamp_ntz")
    return orders.filter(~recent).drop("o_orderdate"), orders.filter(recent).drop("o_orderdate")


@query(
    "new_keys_anti",
    f"""SELECT o_orderkey, o_custkey FROM orders n WHERE o_orderdate >= DATE '{SINCE}' AND NOT EXISTS (SELECT 1 FROM orders o
  WHERE o.o_custkey = n.o_custkey AND o.o_orderpriority = n.o_orderpriority AND o.o_orderdate < DATE '{SINCE}')""",
)
def new_keys_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent orders of a (customer, priority) without an older one."""
    old, new = _orders(spark, sf_dir, "o_orderpriority")
    return keyed.absent_rows(new, old, ["o_custkey", "o_orderpriority"]).drop("o_orderpriority")


@query(
    "semi_update",
    f"""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate < DATE '{SINCE}' AND o_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '{SINCE}')""",
)
def semi_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older orders of customers with a recent one."""
    old, new = _orders(spark, sf_dir)
    return keyed.present_keys(old, new, ["o_custkey"])


@query(
    "set_difference",
    """SELECT p_brand AS ticker FROM part EXCEPT SELECT 'Brand#' || s_nationkey FROM supplier""",
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker"))
    returned = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Brand#"), "s_nationkey").alias("ticker"))
    return keyed.difference(requested, returned)


@query(
    "set_intersection",
    """SELECT p_brand AS ticker FROM part INTERSECT SELECT 'Brand#' || s_nationkey FROM supplier""",
)
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker"))
    returned = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Brand#"), "s_nationkey").alias("ticker"))
    return keyed.intersection(requested, returned)


@query(
    "fk_orphans",
    """SELECT CAST(l_orderkey AS VARCHAR) AS key, count(*) AS n_rows FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL""",
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    orphans = quality.orphan_keys(table(spark, sf_dir, "lineitem"), parent, "l_orderkey", "o_orderkey")
    return orphans.withColumn("key", F.col("key").cast("string"))


@query(
    "fk_quarantine",
    f"""WITH {TX_SQL} SELECT transaction_id, ticker IN (
    SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P') AS accepted FROM tx""",
)
def fk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").cast("string").alias("ticker")
    )
    child = disclosures(spark, sf_dir).select("transaction_id", "ticker")
    marked = quality.mark_orphans(child, parent, "ticker", "ticker")
    return marked.select("transaction_id", (~F.col("_orphan")).alias("accepted"))


@query(
    "enrich_left",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ticker, c_name AS short_name, c_mktsegment AS sector,
    CAST(c_nationkey AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS website
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols from orders, details from JSON metadata that lacks some symbols and some keys."""
    seen = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("ticker")).distinct()
    info = F.to_json(
        F.struct(
            F.col("c_name").alias("shortName"), F.col("c_mktsegment").alias("sector"),
            F.col("c_nationkey").cast("string").alias("country"),
        )
    )
    metadata = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("ticker"), info.alias("info")
    )
    return seen.join(metadata_columns(metadata), "ticker", "left").select(
        "ticker", "short_name", "sector", "country", "website"
    )


def _any_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON metadata with nested values and values that are no text."""
    rating = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    tags = F.when(F.col("c_nationkey") > 10, F.array("c_mktsegment"))
    info = F.struct(F.col("c_name").alias("shortName"), rating.alias("rating"), (F.col("c_acctbal") > 0).alias("credit"), tags.alias("tags"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("ticker"), F.to_json(info).alias("info"))


@query(
    "metadata_paths",
    """SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_name AS short_name, c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS nation,
    CASE WHEN c_nationkey > 10 THEN '["' || c_mktsegment || '"]' END AS tags, CAST(NULL AS BIGINT) AS city FROM customer""",
)
def metadata_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values by their paths, nested ones and lists included; a path that is absent is NULL."""
    paths = {
        "short_name": ("$.shortName", "string"), "segment": ("$.rating.segment", "string"), "nation": ("$.rating.nation", "bigint"),
        "tags": ("$.tags", "string"), "city": ("$.rating.segment", "bigint"),
    }
    return feeds.metadata_paths(_any_metadata(spark, sf_dir), paths)


@query(
    "metadata_unknown_keys",
    """SELECT 'rating' AS key, 'object' AS kind, count(*) AS n_rows FROM customer
  UNION ALL SELECT 'credit', 'boolean', count(*) FROM customer
  UNION ALL SELECT 'tags', 'array', count(*) FROM customer WHERE c_nationkey > 10""",
)
def metadata_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.unknown_keys(_any_metadata(spark, sf_dir))


@query(
    "max_date_writeback",
    """SELECT CAST(c_custkey AS VARCHAR) AS ticker, strftime(greatest(
    CASE WHEN c_acctbal > 0 THEN DATE '2000-06-01' END, max(o_orderdate)), '%Y-%m-%d') AS last_price_date
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal""",
)
def max_date_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.when(F.col("c_acctbal") > 0, F.lit("2000-06-01").cast("date")).alias("last_price_date"),
    )
    batch = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"), F.to_date("o_orderdate").alias("date")
    )
    updated = prices.write_back_latest(tickers, prices.latest_dates(batch))
    return updated.select("ticker", day_text("last_price_date").alias("last_price_date"))


@query(
    "point_price_lookup",
    f"""WITH {bars_sql('p', but='purchase')}
  SELECT event_id, round_even(p.close * 1000, 0) / 1000 AS close_on_date, round_even(p.low * 1000, 0) / 1000 AS low_on_date
  FROM events e LEFT JOIN p ON p.ticker = CAST(e.user_id AS VARCHAR) AND p.date = CAST(e.ts AS DATE)""",
)
def point_price_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a trade; all but purchases make the prices."""
    trades = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("trade_date")
    )
    found = prices.price_on_date(trades, bars(spark, sf_dir, but="purchase"), "trade_date")
    return found.select("event_id", "close_on_date", "low_on_date")


@query(
    "null_safe_match",
    """WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS p, o_orderdate
    FROM orders),
  latest AS (SELECT s, p, max(o_orderdate) AS d FROM o WHERE o_orderdate < DATE '1999-01-01' GROUP BY ALL)
  SELECT o.o_orderkey, strftime(latest.d, '%Y-%m-%d') AS last_before
  FROM o LEFT JOIN latest ON o.s IS NOT DISTINCT FROM latest.s AND o.p IS NOT DISTINCT FROM latest.p""",
)
def null_safe_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order meets the one summary row of its key; NULL key parts are equal."""
    keys = ["s", "p"]
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("s"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
        F.to_date("o_orderdate").alias("d"),
    )
    latest = orders.filter("d < date'1999-01-01'").groupBy(*keys).agg(F.max("d").alias("last_before"))
    return lookup_join(orders.drop("d"), latest, keys).select(
        "o_orderkey", day_text("last_before").alias("last_before")
    )


@query(
    "work_list_union",
    """SELECT ticker, bool_and(f) AS include_actions FROM (
    SELECT c_name AS ticker, true AS f FROM customer
    UNION ALL SELECT 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), false FROM supplier) GROUP BY ticker""",
)
def work_list_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    equities = table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker"))
    indexes = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("ticker")
    )
    return work_list(equities, indexes)
