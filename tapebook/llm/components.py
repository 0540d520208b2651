"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapebook.operators.skew import lookup_join

from .shared import discard, shuffles_removed, written

#: A node on more edges than this is hot: its edges are dealt out over tasks when they look up its minimum.
HOT_EDGES = 2048


def _settled(edges: DataFrame) -> bool:
    """Do the edges form stars: no node has two smaller ones, and none has a smaller and a larger one?
    Each component is then one star around its smallest node, since rounds never part what is linked."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    counted = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    with shuffles_removed(edges.sparkSession):
        return counted.filter((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it is linked with) of every node of ``edges``
    (columns ``a`` and ``b``, any order, repeats and loops allowed).

    Large-star and small-star rounds in turn: every node hands its neighbours the smallest node it
    knows, until each points at the smallest of its component. Each round is written to the shared
    folder, and removed when the next one is there. A node with very many neighbours is a pre-aggregated minimum, which its edges look up in
    as many tasks as they need.
    """
    smaller, larger = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    edges = written(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    while not _settled(edges):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = lookup_join(both, least, ["a"], spread_by=["b"], hot_rows=HOT_EDGES).filter("b > a")
        large = written(large.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = lookup_join(large, least, ["a"], spread_by=["b"], hot_rows=HOT_EDGES).filter("b <> m")
        small = handed.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        before, edges = edges, written(small.distinct(), "edges")
        discard(before, large)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.union(centres)
