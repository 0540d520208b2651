"""Daily bars: reshaping, casting, rounding, rolling statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import extremes, prices
from .registry import AS_OF, bars, bars_sql, day_text, query, table


@query(
    "ohlc_wide_to_long",
    """SELECT event_type AS ticker, strftime(ts, '%Y-%m-%d') AS date, min(value) AS low, max(value) AS high,
    CAST(count(*) AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS close FROM events GROUP BY ALL""",
)
def ohlc_wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day with a column per (event type, field) -> one row per (type, day)."""
    events = table(spark, sf_dir, "events")
    wide = events.groupBy(F.to_date("ts").alias("date")).pivot("event_type").agg(
        F.min("value").alias("Low"), F.max("value").alias("High"), F.count("value").alias("Volume")
    )
    wide = wide.select("date", *[F.col(f"`{c}`").alias("|".join(c.rsplit("_", 1))) for c in wide.columns if c != "date"])
    long = prices.drop_empty_days(prices.wide_to_long(wide).filter(F.col("volume") > 0))
    return long.select("ticker", day_text("date").alias("date"), "low", "high", "volume", "close")


@query(
    "drop_all_null",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN value END AS open,
    CASE WHEN event_type = 'click' THEN value END AS close FROM events WHERE event_type IN ('view', 'click')""",
)
def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan = F.lit(float("nan"))
    feed = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", F.col("value")).alias("open"),
        F.when(F.col("event_type") == "click", F.col("value")).otherwise(nan).alias("close"),
        *[F.lit(None).cast("double").alias(c) for c in ("high", "low", "adj_close", "volume")],
    )
    kept = prices.drop_empty_days(feed)
    return kept.select("event_id", "open", text.null_if_nan(F.col("close")).alias("close"))


@query(
    "ohlcv_cast",
    """SELECT CAST(event_id AS VARCHAR) AS ticker, strftime(ts, '%Y-%m-%d') AS date, nullif(value, 0) AS close,
    CASE WHEN event_type <> 'error' THEN CAST(trunc(value) AS BIGINT) END AS volume, 'yahoo' AS source FROM events""",
)
def ohlcv_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan = F.lit(float("nan"))
    feed = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("ticker"),
        F.col("ts").alias("date"),
        *[F.lit(None).cast("double").alias(c) for c in ("open", "high", "low", "adj_close")],
        F.when(F.col("value") == 0, nan).otherwise(F.col("value")).alias("close"),
        F.when(F.col("event_type") == "error", nan).otherwise(F.col("value")).alias("volume"),
    )
    return prices.cast_prices(feed, AS_OF).select(
        "ticker", day_text("date").alias("date"), "close", "volume", "source"
    )


@query(
    "round3",
    "SELECT event_id, round_even(value / 7 * 1000, 0) / 1000 AS rounded FROM events",
)
def round3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", text.round3(F.col("value") / 7).alias("rounded"))


@query(
    "daily_bars",
    f"""WITH {bars_sql('b')} SELECT ticker, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume FROM b""",
)
def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).withColumn("date", day_text("date"))


_STATS_SQL = f"""{bars_sql('b')},
  r AS (SELECT ticker, date, min(low) OVER span AS low_52w, max(high) OVER span AS high_52w,
      list_reduce(list(close) OVER five, lambda x, y: x + y) / count(*) OVER five AS avg_50,
      list_reduce(list(close) OVER ten, lambda x, y: x + y) / count(*) OVER ten AS avg_200
    FROM b WINDOW
      span AS (PARTITION BY ticker ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
      five AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
      ten AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""


@query(
    "rolling_52w",
    f"""WITH {_STATS_SQL} SELECT ticker, strftime(date, '%Y-%m-%d') AS date,
  round_even(low_52w * 1000, 0) / 1000 AS low_52w, round_even(high_52w * 1000, 0) / 1000 AS high_52w FROM r""",
)
def rolling_52w(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shorter frames, since the ticks span 30 days."""
    stats = prices.price_stats(bars(spark, sf_dir), range_days=6, short_rows=5, long_rows=10)
    return stats.select("ticker", day_text("date").alias("date"), "low_52w", "high_52w")


@query(
    "sliding_extremes",
    f"""WITH {bars_sql('b')}, d AS (
    SELECT ticker, date, CASE WHEN volume % 3 > 0 THEN low END AS low, CASE WHEN volume % 5 > 0 THEN high END AS high FROM b)
  SELECT ticker, strftime(date, '%Y-%m-%d') AS date, min(low) OVER span AS low, max(high) OVER span AS high FROM d
  WINDOW span AS (PARTITION BY ticker ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
)
def sliding_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range of a week up to each bar, by blocks; some lows and highs are NULL."""
    low, high = F.when(F.col("volume") % 3 > 0, F.col("low")), F.when(F.col("volume") % 5 > 0, F.col("high"))
    found = extremes.sliding_extremes(bars(spark, sf_dir), ["ticker"], "date", 6, {"low": low}, {"high": high})
    return found.withColumn("date", day_text("date"))


@query(
    "moving_avg_50_200",
    f"""WITH {_STATS_SQL} SELECT ticker, strftime(date, '%Y-%m-%d') AS date,
  round_even(avg_50 * 1000, 0) / 1000 AS avg_50, round_even(avg_200 * 1000, 0) / 1000 AS avg_200 FROM r""",
)
def moving_avg_50_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = prices.price_stats(bars(spark, sf_dir), range_days=6, short_rows=5, long_rows=10)
    return stats.select("ticker", day_text("date").alias("date"), "avg_50", "avg_200")


@query(
    "price_range_stats",
    f"""WITH {_STATS_SQL} SELECT ticker, strftime(date, '%Y-%m-%d') AS date, low_52w, high_52w FROM r
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""",
)
def price_range_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = prices.latest_stats(bars(spark, sf_dir), range_days=6, short_rows=5, long_rows=10)
    return latest.select("ticker", day_text("date").alias("date"), "low_52w", "high_52w")


@query(
    "latest_date_update",
    f"""WITH {bars_sql('b')} SELECT ticker, strftime(max(date), '%Y-%m-%d') AS last_price_date FROM b GROUP BY ticker""",
)
def latest_date_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental form: the maximum of the early ticks, moved on by the later ones."""
    daily = bars(spark, sf_dir).select("ticker", "date")
    early = prices.latest_dates(daily.filter("date < date'2024-01-20'"))
    tickers = daily.select("ticker").distinct().join(early, "ticker", "left")
    tickers = tickers.withColumnRenamed("last_date", "last_price_date")
    later = prices.latest_dates(daily.filter("date >= date'2024-01-20'"))
    updated = prices.write_back_latest(tickers, later)
    return updated.withColumn("last_price_date", day_text("last_price_date"))
