"""Daily prices: reshaping, casting, upserts, look-ups and rolling statistics."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import clock, text
from ..schemas import PRICE_FIELDS, PRICING_DATA
from .keyed import insert_if_absent, update_keys, upsert
from .skew import HOT_ROWS, lookup_join

KEY = ("ticker", "date")

# Field names of a wide feed -> price columns.
WIDE_FIELDS = {
    "Open": "open", "High": "high", "Low": "low", "Close": "close",
    "Adj Close": "adj_close", "Volume": "volume",
}


def wide_to_long(wide: DataFrame, symbol: str | None = None, sep: str = "|") -> DataFrame:
    """One row per (ticker, date) from one column per (ticker, field).

    Headers are ``<ticker>|<Field>``; a frame for a single ``symbol`` has bare field names.
    Each input row fans out where it is, so nothing is shuffled.
    """
    fields: dict[str, dict[str, str]] = defaultdict(dict)
    for header in wide.columns:
        ticker, _, name = (symbol or "", "", header) if symbol else header.rpartition(sep)
        if ticker and name in WIDE_FIELDS:
            fields[ticker][WIDE_FIELDS[name]] = header

    def entry(ticker: str, have: dict[str, str]) -> Column:
        values = [
            (F.col(f"`{have[c]}`") if c in have else F.lit(None)).cast("double").alias(c)
            for c in PRICE_FIELDS
        ]
        return F.struct(F.lit(ticker).alias("ticker"), *values)

    entries = F.array(*[entry(t, have) for t, have in fields.items()])
    return wide.select(F.col("date").cast("date").alias("date"), F.explode(entries).alias("e")).select(
        "e.ticker", "date", *[f"e.{c}" for c in PRICE_FIELDS]
    )


def has_price() -> Column:
    """Is at least one price field present (NaN counts as absent)?"""
    return F.coalesce(*[text.to_double(F.col(c)) for c in PRICE_FIELDS]).isNotNull()


def drop_empty_days(feed: DataFrame) -> DataFrame:
    return feed.filter(has_price())


def cast_prices(feed: DataFrame, as_of: datetime, source: str = "yahoo") -> DataFrame:
    """Feed rows in the stored shape: doubles, whole volumes, NaN as NULL, source and fetch time."""
    values = [text.to_double(F.col(c)).alias(c) for c in PRICE_FIELDS if c != "volume"]
    return feed.select(
        "ticker", F.col("date").cast("date").alias("date"), *values,
        text.to_long(F.col("volume")).alias("volume"),
        F.lit(source).alias("source"),
        clock.at(as_of).alias("fetched_at"),
    )


def upsert_prices(prices: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch bars replace stored ones.

    A landed feed has one bar per symbol and day; if it repeats one, the most recent fetch wins,
    then the larger volume and close, so that the outcome does not depend on file order.
    """
    order = [
        F.col(c).desc_nulls_last()
        for c in ("fetched_at", "volume", "close", "open", "high", "low", "adj_close")
    ]
    return upsert(prices, batch, KEY, *order)


def insert_prices_if_absent(
    prices: DataFrame, feed: DataFrame, as_of: datetime, term_days: int | None = None
) -> DataFrame:
    """Open and close only, to three places; stored days are never changed.

    ``term_days`` cuts the feed to the window that ends at ``as_of``.
    """
    if term_days is not None:
        feed = feed.filter(clock.in_window(F.col("date"), clock.price_window(as_of, term_days)))
    batch = PRICING_DATA.conform(
        cast_prices(drop_empty_days(feed), as_of).select(
            "ticker", "date",
            text.round3(F.col("open")).alias("open"),
            text.round3(F.col("close")).alias("close"),
            "source", "fetched_at",
        )
    )
    order = [F.col("close").asc_nulls_last(), F.col("open").asc_nulls_last()]
    return insert_if_absent(prices, batch, KEY, *order)


def latest_dates(prices: DataFrame) -> DataFrame:
    return prices.groupBy("ticker").agg(F.max("date").alias("last_date"))


def write_back_latest(tickers: DataFrame, priced: DataFrame) -> DataFrame:
    """Move ``last_price_date`` forward for the symbols in ``priced`` (ticker, last_date).

    Prices are never deleted, so the later of the stored and the batch date equals the
    maximum over the whole history, which is not read.
    """
    later = F.greatest("last_price_date", "new_last_date")
    return update_keys(tickers, priced, ["ticker"], {"last_price_date": later})


def price_on_date(trades: DataFrame, prices: DataFrame, on: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each trade with the close and low of its day, to three places; NULL without a bar."""
    bars = prices.select(
        "ticker",
        F.col("date").alias(on),
        text.round3(F.col("close")).alias("close_on_date"),
        text.round3(F.col("low")).alias("low_on_date"),
    )
    return lookup_join(trades, bars, ["ticker", on], hot_rows=hot_rows)


def price_stats(
    prices: DataFrame, range_days: int = 364, short_rows: int = 50, long_rows: int = 200
) -> DataFrame:
    """Range and moving averages up to each bar, to three places.

    The range looks back ``range_days`` calendar days, the averages ``short_rows`` and
    ``long_rows`` bars; NaN counts as absent. One window partition is one symbol's bars, at most
    one per calendar day by the table key, so no partition grows with the feed.
    """
    by_day = W.partitionBy("ticker").orderBy(F.unix_date("date"))
    span = by_day.rangeBetween(-range_days, 0)
    low, high, close = (text.null_if_nan(F.col(c)) for c in ("low", "high", "close"))

    def average(rows: int) -> Column:
        return text.round3(F.avg(close).over(by_day.rowsBetween(1 - rows, 0)))

    return prices.select(
        "ticker",
        "date",
        text.round3(F.min(low).over(span)).alias("low_52w"),
        text.round3(F.max(high).over(span)).alias("high_52w"),
        average(short_rows).alias("avg_50"),
        average(long_rows).alias("avg_200"),
    )


def latest_stats(
    prices: DataFrame, range_days: int = 364, short_rows: int = 50, long_rows: int = 200
) -> DataFrame:
    """The statistics of ``price_stats`` as of each symbol's last bar.

    Bars are numbered from the last one back and summed up; no running frame is kept for the
    bars before.
    """
    back = W.partitionBy("ticker").orderBy(F.col("date").desc())
    low, high, close = (text.null_if_nan(F.col(c)) for c in ("low", "high", "close"))
    recent = prices.select(
        "ticker", "date", low.alias("low"), high.alias("high"), close.alias("close"),
        F.row_number().over(back).alias("_nth"), F.first("date").over(back).alias("_last"),
    )
    near = F.col("date") >= F.date_sub("_last", range_days)
    recent = recent.filter(near | (F.col("_nth") <= max(short_rows, long_rows)))

    def average(rows: int) -> Column:
        return text.round3(F.avg(F.when(F.col("_nth") <= rows, F.col("close"))))

    return recent.groupBy("ticker").agg(
        F.max("_last").alias("date"),
        text.round3(F.min(F.when(near, F.col("low")))).alias("low_52w"),
        text.round3(F.max(F.when(near, F.col("high")))).alias("high_52w"),
        average(short_rows).alias("avg_50"),
        average(long_rows).alias("avg_200"),
    )


def daily_bars(ticks: DataFrame, ticker: str, ts: str, value: str, tie: str) -> DataFrame:
    """Open, high, low, close and tick count per symbol and day, from single ticks.

    Partial aggregates run before the shuffle, so a hot symbol-day costs one row per task.
    """
    order = F.struct(ts, tie)
    return ticks.groupBy(F.col(ticker).alias("ticker"), F.to_date(ts).alias("date")).agg(
        F.min_by(value, order).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, order).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
