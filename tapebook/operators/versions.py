"""Which version of a disclosure is the active one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, rules
from ..schemas import NATURAL_KEY
from .skew import HOT_ROWS, lookup_join, next_marked


def _retire(rows: DataFrame, by: str, when: Column, as_of: Column) -> DataFrame:
    """Deactivate the rows for which ``when`` holds and point them to the id in ``by``."""
    hit = F.coalesce(when, F.lit(False))
    changes = {
        "is_active": F.when(hit, 0).otherwise(F.col("is_active")).cast("int"),
        "superseded_by": F.when(hit, F.col(by)).otherwise(F.col("superseded_by")),
        "superseded_at": F.when(hit, as_of).otherwise(F.col("superseded_at")),
    }
    return rows.withColumns(changes).drop(by)


def best_versions(rows: DataFrame) -> DataFrame:
    """Winner per natural key, for the keys that have an active amendment.

    Amendments rank before originals, so the winner is the best amendment: latest filing,
    then latest scrape, then highest id. Only amendment rows are grouped, and each task
    pre-aggregates its own.
    """
    ranking = F.struct("filing_date", "scraped_at", "transaction_id")
    return (
        rows.filter((F.col("is_active") == 1) & rules.counts_as_amendment(F.col("x_flags")))
        .groupBy(*NATURAL_KEY)
        .agg(F.max(ranking).alias("best"))
        .select(*NATURAL_KEY, F.col("best.transaction_id").alias("winner_id"))
    )


def find_losers(rows: DataFrame, best: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row with the ``winner_id`` of its key; NULL when its group stays as it is."""
    return lookup_join(
        rows, best_versions(rows) if best is None else best, NATURAL_KEY,
        where=F.col("is_active") == 1, spread_by=["transaction_id"], hot_rows=hot_rows,
    )


def reconcile_amendments(
    rows: DataFrame, as_of: datetime, best: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keep one active row in every natural-key group that holds an active amendment.

    ``best`` may hand in ``best_versions(rows)`` from files, so that their size is known when the
    join is planned: a small set is then broadcast and the rows do not move.
    """
    judged = find_losers(rows, best, hot_rows)
    beaten = (F.col("is_active") == 1) & (F.col("winner_id") != F.col("transaction_id"))
    return _retire(judged, "winner_id", beaten, clock.at(as_of))


def first_amendments(fresh: DataFrame) -> DataFrame:
    """First new amendment of each natural key, in page order."""
    return (
        fresh.filter(rules.marks_amendment(F.col("x_flags")))
        .groupBy(*NATURAL_KEY)
        .agg(F.min_by("transaction_id", F.struct("page_id", "pos")).alias("retired_by"))
    )


def supersede(
    target: DataFrame,
    fresh: DataFrame,
    as_of: datetime,
    *,
    first_new: DataFrame | None = None,
    pages_per_chunk: int = 1024,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Append ``fresh`` rows as if inserted one by one in (page_id, pos) order.

    Each new amendment retires the active rows of its key that came before it: a stored row
    is retired by the first new amendment of its key, a new row by the next one after it.
    ``fresh`` must hold no stored ids; it carries ``page_id`` and ``pos``. ``first_new`` may hand
    in ``first_amendments(fresh)`` from files.
    """
    first_new = first_amendments(fresh) if first_new is None else first_new
    stored = lookup_join(
        target, first_new, NATURAL_KEY,
        where=F.col("is_active") == 1, spread_by=["transaction_id"], hot_rows=hot_rows,
    )
    new = next_marked(
        fresh, NATURAL_KEY, "page_id", ["pos"], rules.marks_amendment(F.col("x_flags")),
        F.col("transaction_id"), "retired_by", pages_per_chunk,
    ).select(*target.columns, "retired_by")
    retired = (F.col("is_active") == 1) & F.col("retired_by").isNotNull()
    now = clock.at(as_of)
    return _retire(stored, "retired_by", retired, now).unionByName(
        _retire(new, "retired_by", retired, now)
    )


def amendment_audit(fresh: DataFrame, merged: DataFrame) -> DataFrame:
    """New amendments that did not retire exactly one row, with their key and the count.

    Amendments and the retired rows that point to them meet in one count, not in a join.
    """
    new = fresh.filter(rules.marks_amendment(F.col("x_flags"))).select(
        "transaction_id", F.struct(*NATURAL_KEY).alias("_key"), F.lit(0).cast("long").alias("_n")
    )
    retired = merged.filter(F.col("superseded_by").isNotNull()).select(
        F.col("superseded_by").alias("transaction_id"), F.lit(None).cast(new.schema["_key"].dataType).alias("_key"),
        F.lit(1).cast("long").alias("_n"),
    )
    counted = new.unionByName(retired).groupBy("transaction_id").agg(
        F.max("_key").alias("_key"), F.sum("_n").alias("n_retired")
    )
    wrong = counted.filter(F.col("_key").isNotNull() & (F.col("n_retired") != 1))
    return wrong.select("transaction_id", "_key.*", "n_retired")
