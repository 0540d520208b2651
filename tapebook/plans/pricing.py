"""The price job: landed feeds -> prices, corporate actions, symbol health."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock, text
from ..operators import actions, health, paging, prices, quality, symbols
from ..operators.keyed import upsert
from ..operators.skew import keep_keys
from ..schemas import BATCH_STATUS, CORPORATE_ACTIONS, DIVIDENDS, PRICING_DATA, SPLITS
from ..session import Observed, Scratch
from ..sources.store import SnapshotStore

logger = logging.getLogger(__name__)

JOB = "price"
"""Job name in the failure ledger (fixed value)."""


@dataclass(frozen=True)
class PriceResult:
    requested: int
    priced: int
    price_rows: int
    quarantined: int


def work_list(tickers: DataFrame, indexes: DataFrame) -> DataFrame:
    """(ticker, include_actions): every symbol once; indexes are priced without actions."""
    equities = text.clean_symbols(tickers).withColumn("include_actions", F.lit(True))
    index_symbols = text.clean_symbols(indexes).withColumn("include_actions", F.lit(False))
    both = equities.unionByName(index_symbols)
    return both.groupBy("ticker").agg(F.min("include_actions").alias("include_actions"))


def run_prices(
    store: SnapshotStore,
    feed: DataFrame,
    as_of: datetime,
    *,
    splits: DataFrame | None = None,
    dividends: DataFrame | None = None,
    batch_status: DataFrame | None = None,
    requests: DataFrame | None = None,
    term_days: int = 5,
    batch_size: int = 50,
    source: str = "yahoo",
    threshold: int = 3,
    streams: dict[str, int] | None = None,
) -> PriceResult:
    """Price every symbol that is not excluded, from one landed feed, in one pass.

    ``requests`` (batch_id, ticker) says which symbols were asked for together; without it the
    work list is cut into batches of ``batch_size``. With requests, feed rows that carry a batch id
    count for their own batch. Only the months of the window are rewritten. Rows that break a
    constraint or name no stored symbol go to ``rejected_rows`` in the same commit; ``streams`` are micro-batch ids to keep with it.
    """
    with Scratch(store.spark, f"{store.root}/_work") as scratch:
        result = _price(
            store, scratch, feed, as_of, splits, dividends, batch_status, requests,
            term_days, batch_size, source, threshold, streams,
        )
    logger.info("%s: %s", JOB, result)
    return result


def _price(
    store: SnapshotStore,
    scratch: Scratch,
    feed: DataFrame,
    as_of: datetime,
    splits: DataFrame | None,
    dividends: DataFrame | None,
    batch_status: DataFrame | None,
    requests: DataFrame | None,
    term_days: int,
    batch_size: int,
    source: str,
    threshold: int,
    streams: dict[str, int] | None,
) -> PriceResult:
    spark = store.spark
    base = store.manifest()
    splits = splits if splits is not None else spark.createDataFrame([], SPLITS)
    dividends = dividends if dividends is not None else spark.createDataFrame([], DIVIDENDS)
    status = batch_status if batch_status is not None else spark.createDataFrame([], BATCH_STATUS)

    indexes = store.read("index_data")
    tickers = symbols.ensure_tickers(store.read("ticker_data"), indexes, as_of, "index_name")
    exclusions = store.read("ticker_exclusions")
    work = scratch.write(health.drop_excluded(work_list(tickers, indexes), exclusions, as_of), "work")
    asked = requests.select("batch_id", "ticker").distinct() if requests is not None else paging.assign_batches(work, batch_size)
    asked = asked.join(work, "ticker", "left_semi")

    window = clock.price_window(as_of, term_days)
    in_window = feed.filter(clock.in_window(F.col("date"), window))
    asked_for, priced = Observed(n_rows=F.count(F.lit(1))), Observed(n_rows=F.count(F.lit(1)))
    outcomes = scratch.write(
        health.feed_outcomes(asked, health.feed_counts(in_window if requests is not None else in_window.drop("batch_id")), status),
        "outcomes", asked_for,
    )
    failed = health.failure_batch(outcomes)
    succeeded = scratch.write(outcomes.filter("succeeded").select("ticker").distinct(), "succeeded", priced)

    usable = keep_keys(prices.drop_empty_days(in_window), succeeded, ["ticker"])
    shaped = PRICING_DATA.conform(prices.cast_prices(usable, as_of, source))
    usable_rows = Observed(n_rows=F.count_if(F.size(quality.violations(PRICING_DATA)) == 0))
    bad_rows, bad_action_rows = Observed(n_rows=F.count(F.lit(1))), Observed(n_rows=F.count(F.lit(1)))
    batch = scratch.write(shaped, "prices", usable_rows)
    good, bad = quality.split_valid(batch, PRICING_DATA)
    unknown = PRICING_DATA.conform(prices.cast_prices(prices.drop_empty_days(in_window), as_of, source))
    _, orphans = quality.split_references(unknown, PRICING_DATA, {"ticker_data": tickers})
    bad = scratch.write(bad.unionByName(orphans), "bad_prices", bad_rows)
    target = store.read("pricing_data", store.months_in("pricing_data", batch))
    new_prices = prices.upsert_prices(target, good)

    with_actions = outcomes.filter(F.col("batch_usable") > 0).select("ticker").distinct().join(
        work.filter("include_actions"), "ticker", "left_semi"
    )
    all_actions = scratch.write(actions.action_rows(splits, dividends, as_of, source), "all_actions")
    landed = scratch.write(keep_keys(all_actions, with_actions, ["ticker"]), "actions")
    good_actions, bad_actions = quality.split_valid(landed, CORPORATE_ACTIONS)
    _, orphan_actions = quality.split_references(all_actions, CORPORATE_ACTIONS, {"ticker_data": tickers})
    bad_actions = scratch.write(bad_actions.unionByName(orphan_actions), "bad_actions", bad_action_rows)
    stored_actions = store.read("corporate_actions", store.months_in("corporate_actions", landed))
    new_actions = actions.upsert_actions(stored_actions, good_actions)
    rejected = quality.rejects(bad, "pricing_data", JOB, as_of).unionByName(
        quality.rejects(bad_actions, "corporate_actions", JOB, as_of)
    )
    stored_rejects = store.read("rejected_rows", store.months_in("rejected_rows", rejected))

    failures = health.upsert_failures(store.read("ticker_failures"), failed, JOB, as_of)
    failures = scratch.write(health.clear_failures(failures, succeeded, JOB), "failures")
    last = succeeded.join(prices.latest_dates(good), "ticker", "left")
    tickers = health.touch_attempts(tickers, work, as_of)
    tickers = health.roll_up_failures(tickers, failed, as_of)
    tickers = scratch.write(health.touch_successes(tickers, last, as_of), "tickers")
    new_exclusions, tickers = health.evaluate_health(failures, tickers, exclusions, JOB, as_of, threshold)

    store.commit(
        {
            "pricing_data": new_prices,
            "corporate_actions": new_actions,
            "ticker_failures": failures,
            "ticker_exclusions": new_exclusions,
            "ticker_data": tickers,
            "rejected_rows": upsert(stored_rejects, rejected, ["reject_id"]),
        },
        base,
        streams,
    )
    return PriceResult(
        requested=asked_for["n_rows"],
        priced=priced["n_rows"],
        price_rows=usable_rows["n_rows"],
        quarantined=bad_rows["n_rows"] + bad_action_rows["n_rows"],
    )
