"""Declared tables: columns, keys, checks, defaults and references.

Everything is read with these schemas; nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "info": T.MapType(T.StringType(), T.StringType()),
}

AS_OF = object()
"""Default marker: the run's ``as_of`` timestamp."""
AS_OF_DATE = object()
"""Default marker: the calendar day of ``as_of``."""


def struct(spec: str) -> T.StructType:
    """``struct("ticker:string, date:date")`` -> ``StructType``."""
    fields = []
    for item in spec.split(","):
        name, kind = item.strip().split(":")
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    checks: dict[str, Callable[[], Column]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)
    month_of: str | None = None
    """Date column whose month lays the table out on disk, for the large tables."""

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def empty(self, spark: SparkSession) -> DataFrame:
        """No rows, which the planner knows, so joins with them vanish from plans."""
        none = spark.range(1).filter(F.lit(False))
        return none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def conform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Exactly the declared columns, in order, with the declared types; then ``keep``."""
        have = set(df.columns)
        return df.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema.fields
            ],
            *keep,
        )


def _one_of(column: str, *values: object) -> Callable[[], Column]:
    return lambda: F.col(column).isin(*values)


def _at_least_zero(column: str) -> Callable[[], Column]:
    return lambda: F.col(column) >= 0


# Allowed codes of the enumerated columns.
CLASSIFICATIONS = ("OPEN_MARKET", "OPTION_EXERCISE", "OTHER", "UNKNOWN")
ACTION_TYPES = ("SPLIT", "DIVIDEND")
EVENT_TYPES = ("TICKER_CHANGE", "NAME_CHANGE")
EXCLUSION_STATUSES = ("EXCLUDED", "DELISTED", "NO_DATA", "BAD_TICKER", "MANUAL", "TEMP")

TICKER_DATA = Table(
    "ticker_data",
    struct(
        "ticker:string, company_name:string, short_name:string, sector:string, industry:string,"
        "exchange:string, website:string, cik:string, currency:string, country:string,"
        "first_seen_at:timestamp, last_seen_at:timestamp, status:string, status_reason:string,"
        "last_price_date:date, last_price_attempt_at:timestamp"
    ),
    keys=("ticker",),
    required=("ticker", "first_seen_at", "last_seen_at"),
    defaults={"first_seen_at": AS_OF, "last_seen_at": AS_OF},
)

INDEX_DATA = Table(
    "index_data",
    struct("ticker:string, index_name:string, short_name:string"),
    keys=("ticker",),
    required=("ticker",),
)

RUNS = Table(
    "runs",
    struct(
        "run_id:long, job_name:string, started_at:timestamp, finished_at:timestamp,"
        "status:string, rows_inserted:long, rows_updated:long, error_message:string"
    ),
    keys=("run_id",),
    required=("run_id", "job_name", "started_at", "status", "rows_inserted", "rows_updated"),
    defaults={"started_at": AS_OF, "status": "RUNNING", "rows_inserted": 0, "rows_updated": 0},
)

INSIDER_DATA = Table(
    "insider_data",
    struct(
        "transaction_id:string, source:string, scraped_at:timestamp, filing_date:date,"
        "trade_date:date, ticker:string, insider_name:string, title:string, trade_type:string,"
        "sec_tx_code:string, x_flags:string, is_open_market:int, classification:string,"
        "price:double, qty:long, value:double, is_active:int, superseded_by:string,"
        "superseded_at:timestamp, source_url:string"
    ),
    keys=("transaction_id",),
    required=(
        "transaction_id", "source", "scraped_at", "filing_date", "ticker", "is_active", "source_url",
    ),
    checks={
        "is_open_market": _one_of("is_open_market", 0, 1),
        "classification": _one_of("classification", *CLASSIFICATIONS),
        "price": _at_least_zero("price"),
        "qty": _at_least_zero("qty"),
        "is_active": _one_of("is_active", 0, 1),
    },
    # Fixed value: the default source label of stored disclosures.
    defaults={"source": "openinsider", "scraped_at": AS_OF, "is_active": 1},
    references={"ticker": "ticker_data"},
    month_of="trade_date",
)

PRICING_DATA = Table(
    "pricing_data",
    struct(
        "ticker:string, date:date, open:double, high:double, low:double, close:double,"
        "adj_close:double, volume:long, source:string, fetched_at:timestamp"
    ),
    keys=("ticker", "date"),
    required=("ticker", "date", "source", "fetched_at"),
    checks={"volume": _at_least_zero("volume")},
    # Fixed value: the default source label of prices and corporate actions.
    defaults={"source": "yahoo", "fetched_at": AS_OF},
    references={"ticker": "ticker_data"},
    month_of="date",
)

CORPORATE_ACTIONS = Table(
    "corporate_actions",
    struct(
        "ticker:string, action_date:date, action_type:string, split_ratio:double,"
        "split_numerator:double, split_denominator:double, dividend_cash:double,"
        "source:string, fetched_at:timestamp"
    ),
    keys=("ticker", "action_date", "action_type"),
    required=("ticker", "action_date", "action_type", "source", "fetched_at"),
    checks={
        "action_type": _one_of("action_type", *ACTION_TYPES),
        "split_ratio": lambda: F.col("split_ratio") > 0,
        "dividend_cash": _at_least_zero("dividend_cash"),
    },
    defaults={"source": "yahoo", "fetched_at": AS_OF},
    references={"ticker": "ticker_data"},
    month_of="action_date",
)

TICKER_EVENTS = Table(
    "ticker_events",
    struct(
        "event_id:long, old_ticker:string, new_ticker:string, event_date:date, event_type:string,"
        "old_name:string, new_name:string, source:string, noted_at:timestamp"
    ),
    keys=("event_id",),
    required=("event_id", "event_date", "event_type", "source", "noted_at"),
    checks={"event_type": _one_of("event_type", *EVENT_TYPES)},
    defaults={"source": "manual", "noted_at": AS_OF},
)

TICKER_FAILURES = Table(
    "ticker_failures",
    struct(
        "ticker:string, job_name:string, failure_date:date, reason:string, error_class:string,"
        "error_message:string, first_seen_at:timestamp, last_seen_at:timestamp, fail_count:long"
    ),
    keys=("ticker", "job_name"),
    required=("ticker", "job_name", "failure_date", "first_seen_at", "last_seen_at", "fail_count"),
    defaults={
        "failure_date": AS_OF_DATE, "first_seen_at": AS_OF, "last_seen_at": AS_OF, "fail_count": 1,
    },
)

TICKER_EXCLUSIONS = Table(
    "ticker_exclusions",
    struct(
        "ticker:string, status:string, reason:string, source:string, excluded_at:timestamp,"
        "expires_at:timestamp, is_active:int"
    ),
    keys=("ticker",),
    required=("ticker", "status", "source", "excluded_at", "is_active"),
    checks={
        "status": _one_of("status", *EXCLUSION_STATUSES),
        "is_active": _one_of("is_active", 0, 1),
    },
    defaults={"status": "EXCLUDED", "source": "system", "excluded_at": AS_OF, "is_active": 1},
)

REJECTED_ROWS = Table(
    "rejected_rows",
    struct(
        "reject_id:string, job_name:string, table_name:string, violations:string, row_data:string,"
        "n_rows:long, rejected_on:date, rejected_at:timestamp"
    ),
    keys=("reject_id",),
    required=("reject_id", "job_name", "table_name", "violations", "rejected_on", "rejected_at"),
    month_of="rejected_on",
)
"""Rows that a job left out, as JSON, with the reasons; equal rows of one run are one row with a count."""

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        TICKER_DATA, INDEX_DATA, RUNS, INSIDER_DATA, PRICING_DATA, CORPORATE_ACTIONS,
        TICKER_EVENTS, TICKER_FAILURES, TICKER_EXCLUSIONS, REJECTED_ROWS,
    )
}

# Landing inputs.
PAGES = struct("page_id:long, url:string, html:string")
PAGE_FILES = struct("path:string, modificationTime:timestamp, length:long, content:binary")
OHLCV_LONG = struct(
    "batch_id:string, ticker:string, date:date, open:double, high:double, low:double,"
    "close:double, adj_close:double, volume:double"
)
SPLITS = struct("ticker:string, action_date:timestamp, ratio:double")
DIVIDENDS = struct("ticker:string, action_date:timestamp, cash:double")
METADATA = struct("ticker:string, info:info")
REQUESTS = struct("batch_id:string, ticker:string, include_actions:boolean")
BATCH_STATUS = struct("batch_id:string, error_class:string, error_message:string")
INDEX_SEED = struct("ticker:string, index_name:string")

NATURAL_KEY = ("ticker", "insider_name", "trade_date", "sec_tx_code")
PRICE_FIELDS = ("open", "high", "low", "close", "adj_close", "volume")
