"""Defaults, constraints and references of the declared tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..schemas import AS_OF, AS_OF_DATE, REJECTED_ROWS, TABLES, Table
from .skew import lookup_join


def fill_defaults(df: DataFrame, table: Table, as_of: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Give omitted or NULL columns their declared default and conform to the schema.

    Columns in ``keep`` are carried along behind the declared ones.
    """

    def value(default: object) -> Column:
        if default is AS_OF:
            return clock.at(as_of)
        return clock.day(as_of) if default is AS_OF_DATE else F.lit(default)

    filled = {
        c: F.coalesce(F.col(c), value(d)) if c in df.columns else value(d)
        for c, d in table.defaults.items()
    }
    return table.conform(df.withColumns(filled) if filled else df, keep)


def _breaches(table: Table) -> dict[str, Column]:
    """Constraint name -> is it broken? A check on NULL passes."""
    missing = {f"{c} is required": F.col(c).isNull() for c in table.required}
    return missing | {f"{n} check": ~F.coalesce(check(), F.lit(True)) for n, check in table.checks.items()}


def violations(table: Table) -> Column:
    """Names of the broken constraints of a row."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in _breaches(table).items()]))


def split_valid(df: DataFrame, table: Table, *, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with ``violations``). ``fail_fast`` raises on the first bad row.

    The test is one chain of comparisons; names are collected for the bad rows only.
    """
    bad = reduce(Column.__or__, _breaches(table).values())
    if fail_fast:
        message = F.concat(F.lit(f"{table.name}: "), F.array_join(violations(table), ", "))
        checked = df.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        return checked, df.filter(F.lit(False)).withColumn("violations", violations(table))
    return df.filter(~bad), df.filter(bad).withColumn("violations", violations(table))


def split_references(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows whose references are met, orphans with ``violations``), by the table's declared references.

    A NULL refers to nothing. ``parents`` holds the tables that are referred to; those not given are not
    checked. A row is an orphan by the first reference that isn't met. Keys without a parent are few as a
    rule, and counted before they move; a hot one is split by the engine's skew join.
    """
    bad = df.filter(F.lit(False)).withColumn("violations", F.array().cast("array<string>"))
    for column, name in table.references.items():
        if name in parents:
            lacking = orphan_keys(df, parents[name], column, TABLES[name].keys[0]).select(F.col("key").alias(column))
            told = F.array(F.lit(f"{column} has no row in {name}"))
            bad = bad.unionByName(df.join(lacking, column, "left_semi").select(*df.columns).withColumn("violations", told))
            df = df.join(lacking, column, "left_anti").select(*df.columns)
    return df, bad


def rejects(bad: DataFrame, table_name: str, job: str, as_of: datetime) -> DataFrame:
    """Rows for ``rejected_rows`` from rows with ``violations``: the whole row as JSON, and the reasons."""
    row = F.to_json(F.struct(*[F.col(c) for c in bad.columns if c != "violations"]), {"ignoreNullFields": "false"})
    told = bad.select(F.array_join("violations", ", ").alias("violations"), row.alias("row_data"))
    one_each = told.groupBy("violations", "row_data").agg(F.count(F.lit(1)).alias("n_rows"))
    return REJECTED_ROWS.conform(
        one_each.withColumns(
            {
                "job_name": F.lit(job),
                "table_name": F.lit(table_name),
                "rejected_on": clock.day(as_of),
                "rejected_at": clock.at(as_of),
                "reject_id": F.sha2(F.concat_ws("|", F.lit(f"{job}|{table_name}|{as_of.isoformat()}"), "row_data"), 256),
            }
        )
    )


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct child keys that have no parent, with the number of rows that use them.

    The child is counted per key before it moves, so a hot key arrives as a few counts.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return used.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def mark_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """The child rows with ``_orphan``: the key is set and has no parent."""
    orphans = orphan_keys(child, parent, child_key, parent_key).select(
        F.col("key").alias(child_key), F.lit(True).alias("_orphan")
    )
    marked = lookup_join(child, orphans, [child_key], where=F.col(child_key).isNotNull())
    return marked.withColumn("_orphan", F.col("_orphan").isNotNull())
