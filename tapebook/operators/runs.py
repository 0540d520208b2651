"""Run log, counters and table counts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..schemas import RUNS
from .keyed import first_per_key

if TYPE_CHECKING:
    from ..sources.store import SnapshotStore


def next_run_id(runs: DataFrame) -> int:
    return int(scalar(runs.agg(F.max("run_id")), 0)) + 1


def run_record(
    runs: DataFrame,
    run_id: int,
    job: str,
    started_at: datetime,
    *,
    finished_at: datetime | None = None,
    status: str = "RUNNING",
    rows_inserted: int = 0,
    rows_updated: int = 0,
    error_message: str | None = None,
) -> DataFrame:
    """The run log with the record of ``run_id`` added or replaced."""
    row = runs.sparkSession.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(job).alias("job_name"),
        clock.at(started_at).alias("started_at"),
        (clock.at(finished_at) if finished_at else F.lit(None)).alias("finished_at"),
        F.lit(status).alias("status"),
        F.lit(rows_inserted).alias("rows_inserted"),
        F.lit(rows_updated).alias("rows_updated"),
        F.lit(error_message).alias("error_message"),
    )
    return runs.filter(~F.col("run_id").eqNullSafe(run_id)).unionByName(RUNS.conform(row))


def start_run(store: SnapshotStore, job: str, as_of: datetime) -> int:
    """Add a RUNNING record under the next id and return the id. The id is taken from the log that
    the commit replaces, so runs that start together get ids of their own."""
    taken: list[int] = []

    def started(log: DataFrame) -> DataFrame:
        taken.append(next_run_id(log))
        return run_record(log, taken[-1], job, as_of)

    store.publish({}, {}, log=started)
    return taken[-1]


def latest_records(log: DataFrame, key: str, *order: object) -> DataFrame:
    """The last record of each run in an append-only log; ``order`` puts the last one first."""
    return first_per_key(log, [key], *order)


def scalar(df: DataFrame, default: object = None) -> object:
    """First cell, or the default when there is none or it is NULL."""
    row = df.limit(1).collect()
    return default if not row or row[0][0] is None else row[0][0]


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of several tables, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def label_ingest(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Batch keys with how many of their rows are inserted (0 or 1) and skipped."""
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = target.select(*keys).join(per_key.select(*keys), keys, "left_semi")
    known = known.distinct().withColumn("_known", F.lit(1))
    return per_key.join(known, keys, "left").select(
        *keys,
        F.when(F.col("_known").isNull(), 1).otherwise(0).alias("inserted"),
        (F.col("n_rows") - F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("skipped"),
    )


def ingest_counters(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"),
    )
