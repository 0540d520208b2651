"""The run's clock. Operators take ``as_of`` and never read the wall clock."""

from __future__ import annotations

from datetime import datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market time zone and the time of day from which today's bar is final.
MARKET_ZONE = ZoneInfo("America/New_York")
CUTOFF = time(16, 10)


def at(as_of: datetime) -> Column:
    """``as_of`` as a timestamp literal; a naive value is taken as UTC."""
    aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    micros = (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def day(as_of: datetime) -> Column:
    """UTC calendar day of ``as_of``."""
    aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    return F.lit(aware.astimezone(timezone.utc).date())


def price_window(as_of: datetime, term_days: int) -> tuple[str, str]:
    """First day and exclusive last day to load, in market time.

    Today's bar counts only from the cut-off on.
    """
    aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    local = aware.astimezone(MARKET_ZONE)
    today = local.date()
    end = today if local.time() < CUTOFF else today + timedelta(days=1)
    return (today - timedelta(days=term_days)).isoformat(), end.isoformat()


def in_window(date: Column, window: tuple[str, str]) -> Column:
    start, end = window
    return (date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date"))
