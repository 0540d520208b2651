"""The symbol and index tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..schemas import INDEX_DATA, TICKER_DATA
from ..sources.feeds import metadata_columns
from .keyed import absent_rows, first_per_key, merge
from .quality import fill_defaults


def seen_symbols(batch: DataFrame) -> DataFrame:
    """One row per symbol of a disclosure batch, with the first company name in page order."""
    return first_per_key(
        batch.filter(F.col("ticker").isNotNull()).select("ticker", "company_name", "page_id", "pos"),
        ["ticker"], "page_id", "pos",
    ).select("ticker", "company_name")


def new_symbols(batch: DataFrame, tickers: DataFrame) -> DataFrame:
    return absent_rows(seen_symbols(batch), tickers, ["ticker"])


def ingest_tickers(
    tickers: DataFrame, batch: DataFrame, metadata: DataFrame, as_of: datetime
) -> DataFrame:
    """Insert unseen symbols with their metadata and bump ``last_seen_at`` of the known ones."""
    now = clock.at(as_of)
    details = metadata_columns(metadata)
    seen = seen_symbols(batch).join(details, "ticker", "left")
    inserted = {c: F.col(f"new_{c}") for c in seen.columns if c != "ticker"}
    return merge(
        tickers, seen, ["ticker"],
        matched={"last_seen_at": now},
        inserted=inserted | {"first_seen_at": now, "last_seen_at": now},
    )


def ensure_tickers(
    tickers: DataFrame, symbols: DataFrame, as_of: datetime, name_col: str | None = None
) -> DataFrame:
    """Placeholder rows for symbols that are not stored yet; the name fills both name columns."""
    from ..functions.text import strip

    name = F.col(name_col) if name_col else F.lit(None).cast("string")
    placeholders = (
        symbols.select(
            strip(F.col("ticker").cast("string")).alias("ticker"),
            name.alias("company_name"),
            name.alias("short_name"),
        )
        .filter(F.length("ticker") > 0)
    )
    one_each = first_per_key(placeholders, ["ticker"], F.col("company_name").asc_nulls_last())
    fresh = absent_rows(one_each, tickers, ["ticker"])
    return tickers.unionByName(fill_defaults(fresh, TICKER_DATA, as_of))


def upsert_indexes(
    indexes: DataFrame, batch: DataFrame, metadata: DataFrame | None = None, overwrite: bool = False
) -> DataFrame:
    """Insert unseen indexes; with ``overwrite`` the names of known ones are replaced too."""
    named = first_per_key(
        batch.select("ticker", "index_name"), ["ticker"], F.col("index_name").asc_nulls_last()
    )
    if metadata is None:
        enriched = named.withColumn("short_name", F.lit(None).cast("string"))
    else:
        enriched = named.join(metadata_columns(metadata).select("ticker", "short_name"), "ticker", "left")
    new = {"index_name": F.col("new_index_name"), "short_name": F.col("new_short_name")}
    return INDEX_DATA.conform(
        merge(indexes, enriched, ["ticker"], matched=new if overwrite else {}, inserted=new)
    )
