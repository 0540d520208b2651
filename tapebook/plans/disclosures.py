"""The disclosure job: landed pages -> symbols, disclosures, indexes and a run record."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality, runs, symbols, versions
from ..operators.keyed import absent_rows, first_per_key, upsert
from ..schemas import INSIDER_DATA
from ..session import Observed, Scratch
from ..sources import feeds, html
from ..sources.store import SnapshotStore

logger = logging.getLogger(__name__)

JOB = "inside_scrape"
"""Job name in the run log (fixed value)."""


@dataclass(frozen=True)
class IngestResult:
    run_id: int
    tickers_inserted: int
    inserted: int
    skipped: int
    deactivated: int
    reconciled: int
    indexes_inserted: int
    quarantined: int


def _inactive() -> Column:
    return F.count_if(F.col("is_active") == 0)


def run_disclosures(
    store: SnapshotStore,
    pages: DataFrame,
    metadata: DataFrame,
    as_of: datetime,
    *,
    index_rows: DataFrame | None = None,
    fail_fast: bool = False,
    record_pages_without_table: bool = False,
    reconcile_all: bool = False,
    streams: dict[str, int] | None = None,
) -> IngestResult:
    """Ingest landed pages.

    Rows that break a constraint go to ``rejected_rows`` in the same commit; with ``fail_fast`` they
    end the run. A page without the table ends the run, unless ``record_pages_without_table``
    sends it there too. Pages may be landed bytes (``body``, and ``charset`` if the server declared one);
    those that can't be decoded go there as well. ``streams`` are micro-batch ids to keep with the commit.

    The parsed batch is written once to the shared folder; every later step reads only the
    columns it needs from there. All versions of a disclosure share its trade date, so only the
    trade months of the batch are read and rewritten. ``reconcile_all`` goes over every month.
    """
    run_id = runs.start_run(store, JOB, as_of)
    try:
        with Scratch(store.spark, f"{store.root}/_work") as scratch:
            result = _ingest(
                store, scratch, pages, metadata, as_of, run_id, index_rows, fail_fast,
                record_pages_without_table, reconcile_all, streams,
            )
    except Exception as error:
        message = str(error)
        store.publish({}, {}, log=lambda log: runs.run_record(
            log, run_id, JOB, as_of, finished_at=as_of, status="FAILED", error_message=message
        ))
        logger.exception("%s failed, run %d", JOB, run_id)
        raise
    logger.info("%s: %s", JOB, result)
    return result


def _ingest(
    store: SnapshotStore,
    scratch: Scratch,
    pages: DataFrame,
    metadata: DataFrame,
    as_of: datetime,
    run_id: int,
    index_rows: DataFrame | None,
    fail_fast: bool,
    record_pages_without_table: bool,
    reconcile_all: bool,
    streams: dict[str, int] | None,
) -> IngestResult:
    base = store.manifest()
    undecodable = None
    if "body" in pages.columns:
        pages, undecodable = feeds.decode_pages(pages, fail_fast=fail_fast)
    scanned = pages if record_pages_without_table else html.require_table(pages)
    parsed = html.normalize_disclosures(html.extract_disclosures(scanned))
    seen = Observed(n_rows=F.count(F.lit(1)))
    batch = scratch.write(
        quality.fill_defaults(parsed, INSIDER_DATA, as_of, keep=("page_id", "pos", "company_name")), "batch", seen
    )
    good, bad = quality.split_valid(batch, INSIDER_DATA, fail_fast=fail_fast)
    tickers = store.read("ticker_data")
    symbols_after = Observed(n_rows=F.count(F.lit(1)))
    ticker_entry, written_tickers = store.stage("ticker_data", symbols.ingest_tickers(tickers, batch, metadata, as_of), symbols_after)
    good, orphans = quality.split_references(good, INSIDER_DATA, {"ticker_data": written_tickers})
    bad = bad.unionByName(orphans)
    rejected = quality.rejects(bad, "insider_data", JOB, as_of)
    if record_pages_without_table:
        lost = html.pages_without_table(pages).drop("html").withColumn("violations", F.array(F.lit("no table on the page")))
        rejected = rejected.unionByName(quality.rejects(lost, "pages", JOB, as_of))
    if undecodable is not None:
        rejected = rejected.unionByName(quality.rejects(undecodable, "pages", JOB, as_of))
    refused = Observed(n_rows=F.sum("n_rows"), n_broken=F.sum(F.when(F.col("table_name") == "insider_data", F.col("n_rows"))))
    rejected = scratch.write(rejected, "rejected", refused)

    indexes = store.read("index_data")
    seeds = index_rows if index_rows is not None else feeds.index_seed(store.spark)
    new_indexes = symbols.upsert_indexes(indexes, seeds, metadata)

    months = store.months_in("insider_data", batch)
    target = store.read("insider_data", months)
    one_each = first_per_key(good, ["transaction_id"], "page_id", "pos")
    new = Observed(n_rows=F.count(F.lit(1)))
    fresh = scratch.write(
        absent_rows(one_each, target, ["transaction_id"], asked=good.select("transaction_id").distinct()), "fresh", new
    )
    first_new = scratch.write(versions.first_amendments(fresh), "first_new")
    superseded, reconciled = Observed(n_inactive=_inactive()), Observed(n_inactive=_inactive())
    merged = scratch.write(versions.supersede(target, fresh, as_of, first_new=first_new), "merged", superseded)
    before = target.agg(_inactive()).first()[0]

    others = 0
    if reconcile_all:
        untouched = store.read("insider_data", [m for m in base.get("insider_data", {}) if m not in set(months)])
        others = untouched.agg(_inactive()).first()[0]
        merged = merged.unionByName(untouched)
    best = scratch.write(versions.best_versions(merged), "best")
    entry, _ = store.stage("insider_data", versions.reconcile_amendments(merged, as_of, best), reconciled)
    indexes_after = Observed(n_rows=F.count(F.lit(1)))
    index_entry, _ = store.stage("index_data", new_indexes, indexes_after)
    stored_rejects = store.read("rejected_rows", store.months_in("rejected_rows", rejected))
    reject_entry, _ = store.stage("rejected_rows", upsert(stored_rejects, rejected, ["reject_id"]))

    n_bad = refused["n_rows"]
    result = IngestResult(
        run_id=run_id,
        tickers_inserted=symbols_after["n_rows"] - tickers.count(),
        inserted=new["n_rows"],
        skipped=seen["n_rows"] - refused["n_broken"] - new["n_rows"],
        deactivated=superseded["n_inactive"] - before,
        reconciled=reconciled["n_inactive"] - others - superseded["n_inactive"],
        indexes_inserted=indexes_after["n_rows"] - indexes.count(),
        quarantined=n_bad,
    )
    store.publish(
        {"insider_data": entry, "ticker_data": ticker_entry, "index_data": index_entry, "rejected_rows": reject_entry},
        base,
        streams,
        log=lambda log: runs.run_record(
            log, run_id, JOB, as_of,
            finished_at=as_of,
            status="SUCCESS",
            rows_inserted=result.tickers_inserted + result.inserted + result.indexes_inserted,
            rows_updated=result.deactivated + result.reconciled,
        ),
    )
    if n_bad:
        logger.warning("%s: %d rows went to rejected_rows", JOB, n_bad)
    return result
