"""Feed outcomes per requested symbol, the failure ledger and automatic exclusion."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, rules
from ..schemas import TICKER_EXCLUSIONS, TICKER_FAILURES
from .keyed import delete_keys, first_per_key, merge, update_keys
from .prices import has_price
from .skew import HOT_ROWS, lookup_join

# Reason and class of each kind of failure.
BATCH_ERROR_REASON = "yfinance download exception (batch)"
EMPTY_BATCH = ("yfinance download returned empty dataframe (batch)", "YFEmptyBatch")
MISSING_TICKER = ("yfinance download did not return ticker (missing column group)", "YFMissingTicker")
NO_ROWS = ("yfinance returned ticker group but no OHLCV rows (all-NaN)", "YFNoRows")
NOTHING_USABLE = ("Pricing download returned no rows after normalization", "YFNoNormalizedRows")
EXCLUSION_REASON = "AUTO: >=3 failures with no price history"
EXCLUDED_STATUS_REASON = "AUTO: NO_DATA (>=3 failures)"


def active_exclusions(exclusions: DataFrame, as_of: datetime) -> DataFrame:
    return exclusions.filter(rules.exclusion_in_force(clock.at(as_of)))


def drop_excluded(symbols: DataFrame, exclusions: DataFrame, as_of: datetime) -> DataFrame:
    return delete_keys(symbols, active_exclusions(exclusions, as_of), ["ticker"])


def feed_counts(feed: DataFrame) -> DataFrame:
    """Rows and usable rows per returned symbol, pre-aggregated in each task; per batch and symbol if
    the feed tells batches apart (``batch_id``)."""
    keys = [c for c in ("batch_id", "ticker") if c in feed.columns]
    return feed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(has_price(), 1).otherwise(0)).alias("n_usable"),
    )


def _label(kind: tuple[str, str], seq: int) -> Column:
    reason, error_class = kind
    return F.struct(
        F.lit(seq).alias("seq"),
        F.lit(reason).alias("reason"),
        F.lit(error_class).alias("error_class"),
        F.lit(None).cast("string").alias("error_message"),
    )


def feed_outcomes(
    requests: DataFrame, returned: DataFrame, batch_status: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(batch_id, ticker, n_usable, batch_usable, labels, succeeded) per requested symbol.

    ``returned`` is ``feed_counts`` of the feed; with batch ids, rows count for their own batch only,
    and rows without an id for every batch. ``labels`` lists the failures of the symbol in
    the order they are recorded. A batch with an error class failed as a whole, whatever rows it
    left. Repeated requests count once; of repeated states of a batch the first error counts.
    """
    once = requests.select("batch_id", "ticker").distinct()
    if "batch_id" in returned.columns:
        own = once.join(returned.filter("batch_id IS NOT NULL"), ["batch_id", "ticker"], "left")
        loose = returned.filter("batch_id IS NULL").select("ticker", F.col("n_rows").alias("_r"), F.col("n_usable").alias("_u"))
        both = own.join(loose, "ticker", "left")
        counted = both.select(
            "batch_id", "ticker",
            (F.coalesce("n_rows", F.lit(0)) + F.coalesce("_r", F.lit(0))).alias("n_rows"),
            (F.coalesce("n_usable", F.lit(0)) + F.coalesce("_u", F.lit(0))).alias("n_usable"),
        )
    else:
        counted = once.join(returned, "ticker", "left")
    batch_status = first_per_key(
        batch_status.select("batch_id", "error_class", "error_message"), ["batch_id"],
        F.col("error_class").asc_nulls_last(), F.col("error_message").asc_nulls_last(),
    )
    asked = (
        counted
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
        .withColumn("n_usable", F.coalesce("n_usable", F.lit(0)))
    )
    batches = (
        asked.groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("batch_symbols"),
            F.sum("n_rows").alias("batch_rows"),
            F.sum("n_usable").alias("batch_usable"),
        )
        .join(batch_status, "batch_id", "left")
    )
    rows = lookup_join(asked, batches, ["batch_id"], hot_rows=hot_rows)

    failed_batch = F.col("error_class").isNotNull()
    error = F.struct(
        F.lit(0).alias("seq"), F.lit(BATCH_ERROR_REASON).alias("reason"), "error_class", "error_message"
    )
    returned_rows = F.col("n_rows") > 0
    single_labels = F.array_compact(
        F.array(
            F.when(~returned_rows, _label(MISSING_TICKER, 1)),
            F.when(
                returned_rows & (F.col("n_usable") == 0) & (F.col("batch_symbols") > 1), _label(NO_ROWS, 2)
            ),
            F.when(returned_rows & (F.col("batch_usable") == 0), _label(NOTHING_USABLE, 3)),
        )
    )
    labels = (
        F.when(failed_batch, F.array(error))
        .when(F.col("batch_rows") == 0, F.array(_label(EMPTY_BATCH, 0)))
        .otherwise(single_labels)
    )
    return rows.select(
        "batch_id",
        "ticker",
        "n_usable",
        F.when(failed_batch, 0).otherwise(F.col("batch_usable")).alias("batch_usable"),
        labels.alias("labels"),
        (~failed_batch & (F.col("n_usable") > 0)).alias("succeeded"),
    )


def failure_batch(outcomes: DataFrame) -> DataFrame:
    """One row per failed symbol: last reason, last known class and message, number of failures."""
    each = outcomes.select("ticker", F.explode("labels").alias("l")).select("ticker", "l.*")

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq")))

    return each.groupBy("ticker").agg(
        F.max_by("reason", "seq").alias("reason"),
        last("error_class").alias("error_class"),
        last("error_message").alias("error_message"),
        F.count(F.lit(1)).alias("n_failures"),
    )


def upsert_failures(failures: DataFrame, batch: DataFrame, job: str, as_of: datetime) -> DataFrame:
    """Add to the failure ledger: counts grow, known class and message survive a NULL."""
    now, today = clock.at(as_of), clock.day(as_of)
    rows = batch.withColumn("job_name", F.lit(job))
    latest = {"failure_date": today, "reason": F.col("new_reason"), "last_seen_at": now}
    return TICKER_FAILURES.conform(
        merge(
            failures, rows, ["ticker", "job_name"],
            matched=latest | {
                "error_class": F.coalesce("new_error_class", "error_class"),
                "error_message": F.coalesce("new_error_message", "error_message"),
                "fail_count": F.col("fail_count") + F.col("new_n_failures"),
            },
            inserted=latest | {
                "error_class": F.col("new_error_class"),
                "error_message": F.col("new_error_message"),
                "first_seen_at": now,
                "fail_count": F.col("new_n_failures"),
            },
        )
    )


def roll_up_failures(tickers: DataFrame, batch: DataFrame, as_of: datetime) -> DataFrame:
    """Show the latest failure on the symbol row; unknown symbols are added on watch."""
    now = clock.at(as_of)
    return merge(
        tickers, batch.select("ticker", "reason"), ["ticker"],
        matched={
            "status": rules.status_after_failure(F.col("status")),
            "status_reason": F.coalesce("new_reason", "status_reason"),
            "last_price_attempt_at": now,
        },
        inserted={
            "first_seen_at": now, "last_seen_at": now, "status": F.lit("WATCH"),
            "status_reason": F.col("new_reason"), "last_price_attempt_at": now,
        },
    )


def touch_attempts(tickers: DataFrame, attempted: DataFrame, as_of: datetime) -> DataFrame:
    return update_keys(
        tickers, attempted.select("ticker"), ["ticker"], {"last_price_attempt_at": clock.at(as_of)}
    )


def touch_successes(tickers: DataFrame, priced: DataFrame, as_of: datetime) -> DataFrame:
    """Record success for the symbols in ``priced`` (ticker and, optionally, last_date)."""
    now = clock.at(as_of)
    changes = {
        "last_seen_at": now,
        "last_price_attempt_at": now,
        "status": rules.status_after_success(F.col("status")),
        "status_reason": F.lit(None).cast("string"),
    }
    if "last_date" in priced.columns:
        changes["last_price_date"] = F.greatest("last_price_date", "new_last_date")
    return update_keys(tickers, priced, ["ticker"], changes)


def clear_failures(failures: DataFrame, succeeded: DataFrame, job: str) -> DataFrame:
    done = succeeded.select("ticker").withColumn("job_name", F.lit(job))
    return delete_keys(failures, done, ["ticker", "job_name"])


def record_success(
    tickers: DataFrame, failures: DataFrame, priced: DataFrame, job: str, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    return touch_successes(tickers, priced, as_of), clear_failures(failures, priced, job)


def never_priced_failures(
    failures: DataFrame, tickers: DataFrame, job: str, threshold: int = 3
) -> DataFrame:
    """Symbols with at least ``threshold`` failures of a job and no price ever."""
    failing = failures.filter((F.col("job_name") == job) & (F.col("fail_count") >= threshold))
    unpriced = tickers.filter(F.col("last_price_date").isNull())
    return failing.select("ticker", "fail_count").join(unpriced.select("ticker"), "ticker")


def evaluate_health(
    failures: DataFrame, tickers: DataFrame, exclusions: DataFrame, job: str, as_of: datetime, threshold: int = 3
) -> tuple[DataFrame, DataFrame]:
    """(exclusions, tickers) after excluding the symbols that fail and never had a price."""
    doomed = never_priced_failures(failures, tickers, job, threshold).select("ticker")
    renewed = {"status": F.lit("NO_DATA"), "excluded_at": clock.at(as_of), "is_active": F.lit(1)}
    excluded = merge(
        exclusions, doomed, ["ticker"],
        matched=renewed,
        inserted=renewed | {"reason": F.lit(EXCLUSION_REASON), "source": F.lit("system")},
    )
    marked = update_keys(
        tickers, doomed, ["ticker"],
        {"status": F.lit("EXCLUDED"), "status_reason": F.lit(EXCLUDED_STATUS_REASON)},
    )
    return TICKER_EXCLUSIONS.conform(excluded), marked
