"""Token counts: an exact histogram of encoded lengths and its suffix sums."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import codec, vocabulary
from .shared import small_batches, written

#: Lengths of one block of the suffix sums; sums run over blocks and then inside each block.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """``n_tokens`` of every row's whole text; null counts as empty, which has none."""
    paths = paths or vocabulary()
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codec(*paths)
        for batch in batches:
            lengths = [len(book.encode(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(body.alias("body")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents of each length: ``n_tokens``, ``n_docs``. Partly counted before the shuffle, and written,
    since what follows reads it twice and would encode every text twice."""
    return written(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit, exact totals over all documents.

    ``docs_over`` and ``tokens_over``: documents longer than the limit and their tokens, from sums
    that run from the longest down. From them follow ``docs_fit``, ``quantile`` (share of documents
    that fit), ``truncated_total`` (tokens left when each document is cut at the limit) and
    ``tokens_cut``. An empty histogram gives no rows. Sums over blocks of lengths come first, so no
    task orders more than one row per block, or the lengths of one block.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total(column: str, window: Window) -> F.Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    blocks = blocks.select(
        "block",
        total("docs", above).alias("docs_above"),
        total("tokens", above).alias("tokens_above"),
        total("docs", everything).alias("total_docs"),
        total("tokens", everything).alias("total_tokens"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    docs_over = F.col("docs_above") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0))
    tokens_over = F.col("tokens_above") + F.coalesce(F.sum(tokens).over(longer), F.lit(0))
    cut = F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")
    return (
        rows.join(blocks, "block")
        .withColumn("docs_over", docs_over)
        .withColumn("tokens_over", tokens_over)
        .select(
            "n_tokens",
            "n_docs",
            (F.col("total_docs") - F.col("docs_over")).alias("docs_fit"),
            "docs_over",
            "tokens_over",
            ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")).alias("quantile"),
            (F.col("total_tokens") - cut).alias("truncated_total"),
            cut.alias("tokens_cut"),
            "total_docs",
            "total_tokens",
        )
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Answers for any context limits, also lengths that no document has: ``context_limit``,
    ``docs_over``, ``truncated_total``. A limit is answered by the largest length up to it (its
    over-counts hold until the next length) or, below the shortest, by the totals."""
    asked = F.explode(F.array(*[F.lit(int(c)).cast("long") for c in limits]))
    below = sums.select(asked.alias("context_limit"), "*").groupBy("context_limit").agg(
        F.max_by(
            F.when(F.col("n_tokens") <= F.col("context_limit"), F.struct("docs_over", "tokens_over")),
            F.when(F.col("n_tokens") <= F.col("context_limit"), F.col("n_tokens")),
        ).alias("over"),
        F.max("total_docs").alias("total_docs"),
        F.max("total_tokens").alias("total_tokens"),
    )
    docs_over = F.coalesce("over.docs_over", "total_docs")
    tokens_over = F.coalesce("over.tokens_over", "total_tokens")
    return below.select(
        "context_limit",
        docs_over.alias("docs_over"),
        (F.col("total_tokens") - tokens_over + docs_over * F.col("context_limit")).alias("truncated_total"),
    )


def length_quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row ``n_tokens``: the smallest length that at least ``share`` of the documents fit in."""
    return sums.filter(F.col("docs_fit") >= F.lit(share) * F.col("total_docs")).agg(F.min("n_tokens").alias("n_tokens"))
