"""Final winners of chains of supersession, by pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .skew import HOT_ROWS, lookup_join


def _halve(state: DataFrame, hot_rows: int) -> DataFrame:
    """Every pointer moves on to where its target points: paths are half as many steps long."""
    ahead = state.select(
        F.col("id").alias("at"), F.col("at").alias("_at"), F.col("hops").alias("_hops"), F.col("least").alias("_least"),
        F.col("done").alias("_done"),
    )
    joined = lookup_join(state, ahead, ["at"], where=~F.col("done"), spread_by=["id"], hot_rows=hot_rows)
    return joined.select(
        "id",
        F.coalesce("_at", "at").alias("at"),
        (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
        F.least("least", F.coalesce("_least", "least")).alias("least"),
        (F.col("done") | F.coalesce("_done", F.lit(True))).alias("done"),
    )


def _active(state: DataFrame) -> int:
    return state.filter(~F.col("done")).count()


def follow_links(
    links: DataFrame, scratch: Scratch, source: str = "id", target: str = "next", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Where each chain ends: (``source``, ``target``, ``final_id``, ``hops``, ``cycle_id``).

    ``links`` has one row per ``source``, which names its successor or NULL. ``final_id`` is the last
    of the successors and ``hops`` their number; a row without a successor is its own end, 0 hops
    away. A chain that runs into a cycle has no end: its ``final_id`` and ``hops`` are NULL, and
    ``cycle_id`` is the smallest id on the cycle. A row with a NULL ``source`` is left out.

    Only links that are themselves somebody's target are followed in rounds, which halve the chains
    that are left: 1,000 links take ten rounds. Each round is a look-up join that a hot target cannot
    stall, written to the shared folder. All rows then meet the resolved ones once. A round in which
    no chain ends proves that what is left leads into cycles, since a chain that is still open has links
    at every distance from its end; those few are followed until paths are longer than they are many.
    """
    rows = links.select(F.col(source).alias("id"), F.col(target).alias("next")).filter(F.col("id").isNotNull())
    chained = rows.filter(F.col("next").isNotNull())
    targets = chained.select(F.col("next").alias("id")).distinct()
    inner = scratch.write(chained.join(targets, "id", "left_semi").select("id", F.col("next").alias("at")), "inner")
    further = inner.select(F.col("id").alias("at"), F.lit(True).alias("_further"))
    state = scratch.write(
        lookup_join(inner, further, ["at"], spread_by=["id"], hot_rows=hot_rows).select(
            "id", "at", F.lit(1).cast("long").alias("hops"), F.col("id").alias("least"), F.col("_further").isNull().alias("done")
        ),
        "links-0",
    )
    rounds, active, before = 0, _active(state), None
    while active and active != before:
        rounds += 1
        state = scratch.write(_halve(state, hot_rows), f"links-{rounds}")
        before, active = active, _active(state)
    # What is left leads into cycles. Go on until every path is longer than the number of rows left.
    while active and (1 << rounds) < 2 * active:
        rounds += 1
        state = scratch.write(_halve(state, hot_rows), f"links-{rounds}")
    # Now every path holds its whole cycle and ends on it: the least id of the end's path is the cycle's.
    on_cycle = state.filter(~F.col("done")).select(F.col("id").alias("at"), F.col("least").alias("cycle_id"))
    ended = state.select("id", F.when(F.col("done"), F.col("at")).alias("end"), F.when(F.col("done"), F.col("hops")).alias("hops"), "at")
    known = lookup_join(ended, on_cycle, ["at"], spread_by=["id"], hot_rows=hot_rows).select(
        F.col("id").alias("next"), F.col("end").alias("_end"), F.col("hops").alias("_hops"), F.col("cycle_id").alias("_cycle"), F.lit(True).alias("_met")
    )
    met = lookup_join(rows, scratch.write(known, "resolved"), ["next"], where=F.col("next").isNotNull(), spread_by=["id"], hot_rows=hot_rows)
    here = F.col("_met").isNull()
    return met.select(
        F.col("id").alias(source),
        F.col("next").alias(target),
        F.when(here, F.coalesce("next", "id")).otherwise(F.col("_end")).alias("final_id"),
        F.when(here, F.col("next").isNotNull().cast("long")).otherwise(F.col("_hops") + 1).alias("hops"),
        F.col("_cycle").alias("cycle_id"),
    )


def final_versions(rows: DataFrame, scratch: Scratch, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stored disclosures with ``final_id`` (the version that still stands, itself if active), ``hops``
    and ``cycle_id``: ``superseded_by`` may name a version that a later run retired too."""
    ends = follow_links(rows, scratch, "transaction_id", "superseded_by", hot_rows).drop("superseded_by")
    return rows.join(ends, "transaction_id", "left")
