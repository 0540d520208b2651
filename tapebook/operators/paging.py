"""Screening, pages of a sorted result and fixed-size batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import hash_rank

DIRECT_ROWS = 100_000
"""Up to so many rows before a page's end, tasks keep the first rows themselves."""
BUCKETS = 4096
"""Buckets that a round counts; so many counts at most reach the driver."""


@dataclass(frozen=True)
class By:
    """Order by a column; NULL is the smallest value, as the engine has it."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        c = F.col(self.column)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()


def page_of(
    df: DataFrame, order: Sequence[By], page: int, size: int, *, tie: Sequence[str] | None = None, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Page number ``page`` (from 1) of a sorted result, in order.

    Rows that are equal in all of ``order`` come in the order of a hash of ``tie`` (default: all
    columns; none needed if the order ends with a key), so pages never share or lose a row. A page near
    the front is a distributed top-k. Beyond ``direct_rows`` its first and last row are found by
    counting (``row_at``), and the rows between them are filtered and sorted as any range: no task and
    no driver holds the rows before the page, and a page of any size is sorted by all tasks.
    """
    skip, end = (page - 1) * size, page * size
    rows, order = _with_keys(df, order, df.columns if tie is None else tie)
    sort = [k.sort() for k in order]
    if end <= direct_rows:
        return rows.orderBy(*sort).offset(skip).limit(size).select(*df.columns)
    total = df.count()
    if size < 1 or skip >= total:
        return df.limit(0)
    end = min(end, total)
    first, first_at = row_at(rows, order, skip, direct_rows)
    last, last_at = row_at(rows, order, end - 1, direct_rows)
    within = _within(rows, order, first, last)
    if first_at == last_at:  # equal rows only
        return within.limit(end - skip).select(*df.columns)
    # Equal rows may stand on both sides of an end of the page; as many as belong to it are taken.
    at_first, at_last = _same(order, first), _same(order, last)
    here = within.filter(at_first)
    if skip > first_at:
        here = here.limit(here.count() - (skip - first_at))
    inner = within.filter(~at_first & ~at_last)
    whole = here.unionByName(inner).unionByName(within.filter(at_last).limit(end - last_at))
    return whole.orderBy(*sort).select(*df.columns)


def _with_keys(df: DataFrame, order: Sequence[By], tie: Sequence[str]) -> tuple[DataFrame, list[By]]:
    """Instants as microseconds, doubles with one zero, and the tie's hash, as further columns of free
    names to order by."""
    keys, stem = list(order), "_" * (1 + max(len(c) for c in df.columns))
    for k, by in enumerate(keys):
        kind, c = df.schema[by.column].dataType, F.col(by.column)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(f"{stem}{k}", F.unix_micros(c.cast("timestamp")))
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            df = df.withColumn(f"{stem}{k}", F.when(c == 0, F.lit(0.0)).otherwise(c))
        else:
            continue
        keys[k] = By(f"{stem}{k}", by.descending)
    if tie:
        df = df.withColumn(f"{stem}tie", F.xxhash64(*tie))
        keys.append(By(f"{stem}tie"))
    return df, keys


def row_at(df: DataFrame, order: Sequence[By], rank: int, direct_rows: int = DIRECT_ROWS) -> tuple[dict, int]:
    """The values of ``order`` of the row at ``rank`` (from 0), and the rank of the first row with these values.

    Order statistic by counting. A round counts the rows of up to ``BUCKETS`` ranges of one column's values
    and keeps the range that holds the rank; a range of one value fixes the column, and the next one
    decides. Filters on plain columns reach the scan. A range of at most ``direct_rows`` rows is ordered.
    """
    before, fixed, rows = 0, {}, df
    for key in order:
        low = high = None  # least and greatest value in play
        while True:
            counts = _bucket_counts(rows, df.schema[key.column].dataType, key.column, low, high)
            held, at = 0, before
            for _, n, low, high in sorted(counts, key=lambda c: c[0], reverse=key.descending):
                if at + n > rank:
                    held, before = n, at
                    break
                at += n
            rows = rows.filter(_between(key.column, low, high))
            if low == high or _is_nan(low):
                fixed[key.column] = low
                break
            if held <= direct_rows:
                top = rows.select(*[k.column for k in order]).orderBy(*[k.sort() for k in order])
                row = top.offset(rank - before).limit(1).first().asDict()
                return row, before + rows.filter(_after(order, row, False)).count()
    return fixed, before


def _lit(value: object) -> Column:
    """A literal; a date by its number, which holds for all years."""
    return F.date_from_unix_date(F.lit((value - date(1970, 1, 1)).days)) if isinstance(value, date) else F.lit(value)


def _is_nan(value: object) -> bool:
    return isinstance(value, float) and value != value


def _between(column: str, low: object, high: object) -> Column:
    c = F.col(column)
    if low is None:
        return c.isNull()
    return c.eqNullSafe(_lit(low)) if low == high or _is_nan(low) else c.between(_lit(low), _lit(high))


def _bucket_counts(rows: DataFrame, kind: T.DataType, column: str, low: object, high: object) -> list[tuple]:
    """(number, rows, least value, greatest value) of ranges of the column's values, in their order. NULL
    comes first, then minus infinity, values, infinity and NaN, each in a range of its own."""
    c = F.col(column)
    if low is None:
        plain = F.when(~c.isin(float("inf"), float("-inf"), float("nan")), c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c
        ends = rows.agg(F.min(plain).alias("low"), F.max(plain).alias("high")).first()
        low, high = ends.low, ends.high
    number = F.lit(1) if low is None else _bucket(c, kind, low, high).cast("int")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = F.when(F.isnan(c), BUCKETS + 3).when(c == float("inf"), BUCKETS + 2).when(c == float("-inf"), 0).otherwise(number)
    found = rows.groupBy(F.when(c.isNull(), -1).otherwise(number).alias("number")).agg(
        F.count(F.lit(1)).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")
    )
    return [tuple(r) for r in found.collect()]


def _bucket(c: Column, kind: T.DataType, low: object, high: object) -> Column:
    """A number from 1 to ``BUCKETS`` that never falls as the value grows; different for ``low`` and ``high``."""
    apart = F.when(c == _lit(low), 1).otherwise(2)
    if low == high:
        return F.lit(1)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # The six bytes behind the beginning that all values between share.
        a, b = (x.encode() if isinstance(x, str) else bytes(x) for x in (low, high))
        shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        ends = [int.from_bytes(x[shared : shared + 6].ljust(6, b"\0"), "big") for x in (a, b)]
        six = F.rpad(F.hex(F.substring(c.cast("binary"), shared + 1, 6)), 12, "0")
        place = F.conv(six, 16, 10).cast("double") - float(ends[0])
        width = float(ends[1] - ends[0])
    elif isinstance(kind, T.DateType):
        place, width = F.datediff(c, _lit(low)).cast("double"), float((high - low).days)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        place, width = c.cast("double") / 2 - low / 2, high / 2 - low / 2
    elif isinstance(kind, T.BooleanType):
        return apart
    else:  # whole numbers and decimals, by their exact differences
        exact = c.cast("decimal(38,0)") if isinstance(kind, T.IntegralType) else c
        place, width = (exact - F.lit(Decimal(low))).cast("double"), float(Decimal(high) - Decimal(low))
    if width <= 0:  # too near each other for the measure
        return apart
    return F.least(F.floor(place / width * BUCKETS) + 1, F.lit(BUCKETS))


def _same(order: Sequence[By], row: dict) -> Column:
    return reduce(Column.__and__, [F.col(k.column).eqNullSafe(_lit(row[k.column])) for k in order])


def _after(order: Sequence[By], row: dict, after: bool) -> Column:
    """Does a row come after (or before) the given one?"""
    out = F.lit(False)
    for k in reversed(order):
        c, v = F.col(k.column), _lit(row[k.column])
        if row[k.column] is None:
            beyond = c.isNotNull() if after != k.descending else F.lit(False)
        else:
            beyond = F.coalesce(c > v, F.lit(False)) if after != k.descending else c.isNull() | (c < v)
        out = beyond | (c.eqNullSafe(v) & out)
    return out


def _within(df: DataFrame, order: Sequence[By], first: dict, last: dict) -> DataFrame:
    """The rows from one row to another, both included. The range of the leading column reaches the scan."""
    lead = order[0].column
    low, high = (last[lead], first[lead]) if order[0].descending else (first[lead], last[lead])
    if low is not None and high is not None:
        df = df.filter(F.col(lead) >= _lit(low)).filter(F.col(lead) <= _lit(high))
    return df.filter(~_after(order, first, False) & ~_after(order, last, True))


def screen(
    tx: DataFrame,
    today: date,
    *,
    look_back_days: int = 730,
    codes: Sequence[str] = ("P", "S"),
    page: int = 1,
    size: int = 500,
) -> DataFrame:
    """Recent disclosures of the wanted codes, newest first, one page of any number and size."""
    recent = F.date_sub(F.lit(today), look_back_days)
    wanted = tx.filter((F.col("filing_date") >= recent) & F.col("sec_tx_code").isin(*codes))
    return page_of(wanted, [By("filing_date", descending=True), By("transaction_id")], page, size, tie=())


def assign_batches(symbols: DataFrame, size: int = 50) -> DataFrame:
    """(batch_id, ticker): batches of exactly ``size`` symbols but for the last, in hash order."""
    ranked = hash_rank(
        symbols.select("ticker").distinct().withColumn("_digest", F.sha2(F.col("ticker").cast("string"), 256)),
        "_digest", "_at",
    )
    batch = F.floor((F.col("_at") - 1) / size).cast("string")
    return ranked.select(batch.alias("batch_id"), "ticker")
