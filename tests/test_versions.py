from __future__ import annotations

import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, tx
from tapebook.catalog import QUERIES
from tapebook.functions import rules
from tapebook.functions.identity import packed_id
from tapebook.operators import skew, versions
from tapebook.schemas import INSIDER_DATA, NATURAL_KEY


def state(df):
    return {r["transaction_id"]: (r["is_active"], r["superseded_by"]) for r in df.collect()}


def row(id_, flags=None, filed=1, page=1, pos=1, **extra):
    return {"transaction_id": id_, "x_flags": flags, "filing_date": date(2024, 1, filed), "page_id": page, "pos": pos} | extra


def test_reconcile_keeps_best_amendment(spark):
    rows = tx(spark, [row("o", "D"), row("a1", "A", 2), row("a2", "DA", 3),
                      row("x", "D", sec_tx_code="S"), row("y", None, sec_tx_code="S"),
                      row("l", "a", 1, ticker="L"), row("m", "D", 2, ticker="L"),
                      row("old", "A", 9, is_active=0, superseded_by="z")])
    got = state(versions.reconcile_amendments(rows.select(*INSIDER_DATA.columns), AS_OF))
    assert got["a2"] == (1, None) and got["a1"] == (0, "a2") and got["o"] == (0, "a2")
    assert got["x"] == got["y"] == (1, None)
    assert got["l"] == (1, None) and got["m"] == (0, "l")
    assert got["old"] == (0, "z")


def test_reconcile_null_key_parts_group(spark):
    rows = tx(spark, [row("o", "D", insider_name=None), row("a", "A", insider_name=None), row("n", "D", insider_name="N")])
    got = state(versions.reconcile_amendments(rows.select(*INSIDER_DATA.columns), AS_OF))
    assert got["o"] == (0, "a") and got["n"] == (1, None)


def test_insert_order_decides(spark):
    target = INSIDER_DATA.empty(spark)
    fresh = tx(spark, [row("newer", "A", 20, pos=1), row("older", "A", 10, pos=2)])
    got = state(versions.supersede(target, fresh, AS_OF))
    assert got == {"newer": (0, "older"), "older": (1, None)}


def test_audit(spark):
    target = tx(spark, [row("o", "D")]).select(*INSIDER_DATA.columns)
    fresh = tx(spark, [row("a", "A", pos=1), row("lone", "A", ticker="Z"), row("d", "D", ticker="Q"),
                       row("d2", "D", ticker="Q", pos=2), row("q", "A", ticker="Q", pos=3)])
    merged = versions.supersede(target, fresh, AS_OF)
    got = {r["transaction_id"]: r["n_retired"] for r in versions.amendment_audit(fresh, merged).collect()}
    assert got == {"lone": 0, "q": 2}


def random_rows(rng, n, stored):
    rows = []
    for i in range(n):
        rows.append(row(
            f"{'s' if stored else 'n'}{i:04d}", rng.choice([None, "D", "A", "DA", "a"]), rng.randint(1, 28),
            page=rng.choice([0, 1, 2, 3, 500, 5000, 5001, 90000]), pos=i,
            # One key holds a third of the rows.
            ticker="HOT" if rng.random() < 0.33 else rng.choice("TUV"),
            insider_name=rng.choice([None, "I"]), sec_tx_code=rng.choice([None, "P"]),
            trade_date=rng.choice([None, date(2024, 1, 1)]), is_active=rng.choice([1, 1, 0]) if stored else 1,
            scraped_at=datetime(2024, 1, rng.randint(1, 3)),
        ))
    return rows


def insert_loop(stored, fresh):
    """Row-by-row insertion."""
    table = {r["transaction_id"]: dict(r, superseded_by=None) for r in stored}
    for r in sorted(fresh, key=lambda r: (r["page_id"], r["pos"])):
        if "A" in (r["x_flags"] or ""):
            for other in table.values():
                if other["is_active"] and all(other.get(k) == r.get(k) for k in NATURAL_KEY):
                    other.update(is_active=0, superseded_by=r["transaction_id"])
        table[r["transaction_id"]] = dict(r, superseded_by=None)
    return {k: (v["is_active"], v["superseded_by"]) for k, v in table.items()}


def reconcile_loop(table):
    groups = {}
    for r in table:
        if r["is_active"]:
            groups.setdefault(tuple(r.get(k) for k in NATURAL_KEY), []).append(r)
    out = {r["transaction_id"]: (r["is_active"], None) for r in table}
    for rows in groups.values():
        amended = [r for r in rows if "a" in (r["x_flags"] or "").lower()]
        if amended:
            best = max(amended, key=lambda r: (r["filing_date"], r["scraped_at"], r["transaction_id"]))
            out |= {r["transaction_id"]: (0, best["transaction_id"]) for r in rows if r is not best}
    return out


@pytest.mark.parametrize("seed, hot_rows", [(1, skew.HOT_ROWS), (2, 20)])
def test_supersede_equals_row_loop(spark, seed, hot_rows):
    rng = random.Random(seed)
    stored, fresh = random_rows(rng, 300, True), random_rows(rng, 500, False)
    target = tx(spark, stored).select(*INSIDER_DATA.columns)
    got = versions.supersede(target, tx(spark, fresh), AS_OF, pages_per_chunk=64, hot_rows=hot_rows)
    assert state(got) == insert_loop(stored, fresh)


@pytest.mark.parametrize("hot_rows", [skew.HOT_ROWS, 20])
def test_reconcile_equals_row_loop_and_is_idempotent(spark, hot_rows):
    rng = random.Random(3)
    rows = random_rows(rng, 600, True)
    once = versions.reconcile_amendments(
        tx(spark, rows).select(*INSIDER_DATA.columns), AS_OF, hot_rows=hot_rows)
    assert state(once) == reconcile_loop(rows)
    shuffled = tx(spark, rng.sample(rows, len(rows))).select(*INSIDER_DATA.columns)
    assert state(versions.reconcile_amendments(shuffled, AS_OF)) == state(once)
    assert state(versions.reconcile_amendments(once, AS_OF)) == state(once)


def test_next_marked_without_marks(spark):
    rows = tx(spark, [row("a", "D"), row("b", None, pos=2)])
    got = skew.next_marked(rows, NATURAL_KEY, "page_id", ["pos"], rules.marks_amendment(F.col("x_flags")),
                           F.col("transaction_id"), "n")
    assert [r["n"] for r in got.collect()] == [None, None]


def test_lookup_join_hot_and_cold(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("c").alias("j"),
    )
    lookup = spark.createDataFrame([(None, "hot", 1), ("1", "c", 2), ("9", "c", 3)], "k string, j string, v int")
    expected = {(None, "hot"): 1, ("1", "c"): 2}
    for hot_rows, n_hot in ((500, 1), (100, 8), (10**9, 0)):
        assert skew.hot_keys(rows, ["k", "j"], hot_rows).count() == n_hot
        got = skew.lookup_join(rows, lookup, ["k", "j"], where=F.col("id") < 2500, hot_rows=hot_rows).collect()
        assert len(got) == 3000
        assert all(r["v"] == (expected.get((r["k"], r["j"])) if r["id"] < 2500 else None) for r in got)


def test_hot_rows_are_spread(spark):
    """With a hot key, no join partition gets its whole group."""
    rows = spark.range(20000).select("id", F.lit("hot").alias("k"))
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew.lookup_join(rows, lookup, ["k"], hot_rows=1000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20000 and len(sizes) == 4 and max(sizes) < 10000


def test_many_hot_keys_are_all_split(spark):
    rows = spark.range(40_000).select("id", (F.col("id") % 400).cast("string").alias("k"))
    hot = skew.hot_keys(rows, ["k"], 30)
    assert hot.count() == 400 and {r["_salts"] for r in hot.collect()} == {4}
    lookup = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    joined = skew.lookup_join(rows, lookup, ["k"], hot_rows=30)
    assert joined.filter("v = id % 400").count() == 40_000
    assert "SinglePartition" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hash_rank(spark):
    df = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("d"))
    got = skew.hash_rank(df, "d", "at", bucket_chars=1).orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(1, 501))
    assert [r["d"] for r in got] == sorted(r["d"] for r in got)


def test_packed_ids_have_the_same_winners(spark):
    """Ids as bytes sort as their letters do, so reconciliation retires the same rows; the flagship moves bytes."""
    rows = spark.range(300).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        (F.col("id") % 40).cast("string").alias("ticker"), F.lit(None).cast("string").alias("insider_name"), F.lit("P").alias("sec_tx_code"),
        F.lit("2024-01-18").cast("date").alias("trade_date"), F.lit("2024-01-18").cast("date").alias("filing_date"),
        F.lit(1.0).alias("price"), F.lit(1).cast("bigint").alias("qty"), F.lit("t").alias("title"), F.lit("P - Purchase").alias("trade_type"),
        F.lit(None).cast("timestamp").alias("scraped_at"), F.when(F.col("id") % 3 == 0, "A").otherwise("D").alias("x_flags"),
        F.lit(1).alias("is_active"), F.lit(None).cast("string").alias("superseded_by"), F.lit(None).cast("timestamp").alias("superseded_at"),
    )
    ids = ("transaction_id", "superseded_by")
    packed = rows.withColumns({c: packed_id(c) for c in ids})
    as_of = datetime(2024, 2, 1)
    got = versions.reconcile_amendments(packed, as_of).withColumns({c: F.lower(F.hex(c)) for c in ids})
    want = versions.reconcile_amendments(rows, as_of)
    columns = [*ids, "is_active"]
    assert sorted(map(repr, got.select(*columns).collect())) == sorted(map(repr, want.select(*columns).collect()))
    assert want.filter("is_active = 0").count() > 100

    flagship = QUERIES["active_after_reconcile"](spark, "/root/testdata/sf0.001")
    stored = spark.read.parquet(os.path.dirname(flagship.inputFiles()[0]))
    assert stored.schema["transaction_id"].dataType.typeName() == "binary"
