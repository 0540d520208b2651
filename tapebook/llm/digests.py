"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import free_name, partitions, written

#: At most so many runs meet in one merge.
FAN_IN = 16


def digest_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, a row number, the partition it was read in, and the text's digest.

    Texts are told apart by SHA-256, byte length and a second hash together. Null is the empty text.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("part"),
        F.sha2(body.cast("binary"), 256).alias("sha"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.xxhash64(body).alias("check"),
    )


KEY = ("sha", "n_bytes", "check")


def tree_shape(slots: int) -> tuple[int, int]:
    """Fan-in and rounds of a tree over at least ``slots`` runs."""
    rounds = max(1, math.ceil(math.log(max(2, slots), FAN_IN)))
    return math.ceil(max(2, slots) ** (1 / rounds)), rounds


def merge_runs(rows: DataFrame, slots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge the runs of all partitions; returns (first runs, merged runs).

    Each of ``slots`` runs holds one row per digest: the row that stays (largest id, then largest
    row number) and the number of copies. In round r a run hands every digest on to the run whose
    number agrees with its own but for digit r, which the digest decides; so at most ``FAN_IN`` runs
    meet in a merge, each round works on all runs at once, and after the last one every digest is in
    one run. A digest that a third of all rows share is one row per run from the start.
    """
    fan, rounds = tree_shape(slots or partitions(rows.sparkSession))
    total = fan**rounds
    home = F.pmod(F.xxhash64("sha"), F.lit(total)).cast("int")

    first = rows.groupBy(F.pmod("part", F.lit(total)).alias("slot"), *KEY).agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("size")
    )
    runs = first
    for r in range(rounds):
        step = fan**r
        own = F.floor(F.col("slot") / step) % fan
        meant = F.floor(home / step) % fan
        runs = (
            runs.withColumn("slot", (F.col("slot") + (meant - own) * step).cast("int"))
            .repartition(total, "slot")
            .groupBy("slot", *KEY)
            .agg(F.max("keep").alias("keep"), F.sum("size").alias("size"))
        )
    return first, runs.drop("slot")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document, copies included: ``doc_id``, ``keep_id`` (the largest id of its equal
    texts), ``group_size``, ``kept`` and ``text_sha256``.

    Of rows that repeat an id as well, one is kept; a null id stays only if all are null. A null
    text equals the empty one. An empty table gives no rows; other columns are ignored. The digests
    are written once, so texts are read once. What a group keeps goes back to its rows by
    (partition, digest): a large group is dealt out over the partitions that hold it.
    """
    rows = written(digest_rows(docs, text, doc_id), "digests")
    fan, rounds = tree_shape(partitions(rows.sparkSession))
    first, merged = merge_runs(rows)
    answers = first.select("slot", *KEY).join(merged, list(KEY))
    return (
        rows.withColumn("slot", F.pmod("part", F.lit(fan**rounds)))
        .join(answers, ["slot", *KEY])
        .select(
            "doc_id",
            F.col("keep.doc_id").alias("keep_id"),
            F.col("size").alias("group_size"),
            (F.col("row") == F.col("keep.row")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def distinct_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that ``exact_groups`` keeps, with all their columns.

    A kept row is found again by its id and digest together; where whole rows repeat, one is taken.
    """
    mark = free_name(docs, "_row_key")
    turn = free_name(docs, "_turn")

    def key(identity: Column, sha: Column) -> Column:
        return F.concat_ws(":", sha, F.coalesce(identity.cast("string"), F.lit("null")))

    kept = exact_groups(docs, text, doc_id).filter("kept")
    kept = kept.select(key(F.col("doc_id"), F.col("text_sha256")).alias(mark))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = docs.withColumn(mark, key(F.col(doc_id), F.sha2(body.cast("binary"), 256)))
    return (
        marked.join(kept, mark, "left_semi")
        .withColumn(turn, F.row_number().over(Window.partitionBy(mark).orderBy(mark)))
        .filter(F.col(turn) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
