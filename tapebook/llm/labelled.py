"""Which labelled rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    identity = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")) % folds


def known_labels(labels: DataFrame, label: str, doc_id: str = "doc_id", folds: int = 5) -> DataFrame:
    """(labelled_id, label) of all labelled documents of class 0 or 1 that aren't held out (fold 0 is)."""
    return (
        labels.select(F.col(doc_id).alias("labelled_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("labelled_id").isNotNull() & F.col("label").isin(0, 1) & (fold("labelled_id", folds) != 0))
        .groupBy("labelled_id")
        .agg(F.max("label").alias("label"))
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, text: str = "text", doc_id: str = "doc_id", folds: int = 5, per_class: int = 3000
) -> DataFrame:
    """``text`` and ``label`` of at most ``per_class`` labelled documents of each class (0 and 1) that
    aren't held out (fold 0 is), the same ones at every run: those of the smallest hashes.

    Ids are chosen first, so only their texts are read out; the ids are few enough to be broadcast.
    """
    known = known_labels(labels, label, doc_id, folds)
    order = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    chosen = known.filter("label = 0").orderBy(*order).limit(per_class)
    chosen = chosen.union(known.filter("label = 1").orderBy(*order).limit(per_class))
    bodies = docs.select(F.col(f"`{doc_id}`").alias("labelled_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return bodies.join(F.broadcast(chosen), "labelled_id").select("text", "label")


def class_counts(labels: DataFrame, label: str, doc_id: str = "doc_id", folds: int = 5) -> tuple[int, int]:
    """Labelled documents of class 0 and 1 that aren't held out."""
    counts = {
        r.label: r.n
        for r in labels.filter(F.col(doc_id).isNotNull() & (fold(doc_id, folds) != 0))
        .groupBy(F.col(label).cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    return counts.get(0, 0), counts.get(1, 0)
