"""Corporate actions: splits and dividends in one table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, text
from ..schemas import CORPORATE_ACTIONS
from .keyed import upsert


def _rows(df: DataFrame, kind: str, ratio: Column, cash: Column, as_of: datetime, source: str) -> DataFrame:
    return CORPORATE_ACTIONS.conform(
        df.select(
            "ticker",
            F.col("action_date").cast("date").alias("action_date"),
            F.lit(kind).alias("action_type"),
            ratio.alias("split_ratio"),
            cash.alias("dividend_cash"),
            F.lit(source).alias("source"),
            clock.at(as_of).alias("fetched_at"),
        )
    )


def split_rows(splits: DataFrame, as_of: datetime, source: str = "yahoo") -> DataFrame:
    """Splits with a ratio; a missing ratio or one of zero is no split."""
    ratio = text.to_double(F.col("ratio"))
    return _rows(splits.filter(ratio.isNotNull() & (ratio != 0)), "SPLIT", ratio, F.lit(None), as_of, source)


def dividend_rows(dividends: DataFrame, as_of: datetime, source: str = "yahoo") -> DataFrame:
    """Dividends with an amount; zero counts."""
    cash = text.to_double(F.col("cash"))
    return _rows(dividends.filter(cash.isNotNull()), "DIVIDEND", F.lit(None), cash, as_of, source)


def action_rows(splits: DataFrame, dividends: DataFrame, as_of: datetime, source: str = "yahoo") -> DataFrame:
    return split_rows(splits, as_of, source).unionByName(dividend_rows(dividends, as_of, source))


def upsert_actions(actions: DataFrame, batch: DataFrame) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in ("fetched_at", "split_ratio", "dividend_cash")]
    return upsert(actions, batch, CORPORATE_ACTIONS.keys, *order)
