"""Incremental runs: a file stream of landed pages or prices that calls the batch jobs.

The id of each micro-batch is kept in the commit that holds its rows, under the checkpoint's path,
so a batch that is replayed after a failure is skipped. Ids are content hashes and prices are keyed,
so corrections may arrive any time later, and no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.disclosures import run_disclosures
from ..plans.pricing import run_prices
from ..schemas import OHLCV_LONG, PAGE_FILES, PAGES
from ..sources import feeds
from ..sources.store import SnapshotStore


def _drain(
    source: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def disclosure_batch(
    store: SnapshotStore, batch: DataFrame, number: int, stream: str, metadata: DataFrame, as_of: datetime
) -> None:
    """Ingest one micro-batch, unless a commit already holds it."""
    if number > store.last_batch(stream) and not batch.isEmpty():
        run_disclosures(store, batch, metadata, as_of, streams={stream: number})


def price_batch(
    store: SnapshotStore, batch: DataFrame, number: int, stream: str, as_of: datetime, **options: object
) -> None:
    """Price one micro-batch, unless a commit already holds it."""
    if number > store.last_batch(stream) and not batch.isEmpty():
        run_prices(store, batch, as_of, streams={stream: number}, **options)


def stream_disclosures(
    store: SnapshotStore,
    landing: str,
    checkpoint: str,
    metadata: DataFrame,
    clock: Callable[[], datetime],
    fmt: str = "parquet",
    max_files: int = 1000,
) -> StreamingQuery:
    """Ingest the page files that have landed since the last call. With ``fmt="binaryFile"`` each file is
    one page of raw bytes."""
    raw = fmt == "binaryFile"
    reader = store.spark.readStream.format(fmt).option("maxFilesPerTrigger", max_files)
    landed = reader.schema(PAGE_FILES if raw else PAGES).load(landing)
    pages = feeds.page_files(landed) if raw else landed

    def handle(batch: DataFrame, number: int) -> None:
        disclosure_batch(store, batch, number, checkpoint, metadata, clock())

    return _drain(pages, handle, checkpoint)


def stream_prices(
    store: SnapshotStore,
    landing: str,
    checkpoint: str,
    clock: Callable[[], datetime],
    fmt: str = "parquet",
    **options: object,
) -> StreamingQuery:
    """Price from the feed files that have landed since the last call.

    They are taken as one feed: symbols absent from all of them count as missing.
    """
    feed = store.spark.readStream.schema(OHLCV_LONG).format(fmt).load(landing)

    def handle(batch: DataFrame, number: int) -> None:
        price_batch(store, batch, number, checkpoint, clock(), **options)

    return _drain(feed, handle, checkpoint)
