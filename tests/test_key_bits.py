from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tapebook.operators import key_bits
from tapebook.session import Scratch

KEYS = ["a", "b"]


@pytest.fixture
def scratch(spark, tmp_path):
    return Scratch(spark, str(tmp_path))


def frame(spark, first, last, month="m1"):
    return spark.range(first, last).select(F.lit(month).alias("month"), F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"))


def no_read(months):
    raise AssertionError(f"read {months}")


def test_new_keys_read_no_part(spark, scratch):
    bits = key_bits.key_bits(frame(spark, 0, 20), "month", KEYS)
    batch = frame(spark, 1000, 1008)  # few against 32,768 bits
    assert key_bits.absent_rows(batch, bits, "month", KEYS, no_read, scratch).count() == 8
    other = frame(spark, 0, 20, "m2")
    assert key_bits.absent_rows(other, bits, "month", KEYS, no_read, scratch).count() == 20


def test_no_key_is_missed_and_wrong_hits_are_told_apart(spark, scratch, monkeypatch):
    monkeypatch.setattr(key_bits, "BITS_PER_KEY", 2)  # many wrong hits, several pages
    stored = frame(spark, 0, 60_000).unionByName(frame(spark, 0, 10, "m2"))
    bits = key_bits.key_bits(stored.repartition(5), "month", KEYS)
    assert {(r.part, r.pages) for r in bits.collect()} == {("m1", 4), ("m2", 1)} and bits.count() == 5
    batch = frame(spark, 50_000, 80_000).unionByName(frame(spark, 5, 15, "m2")).unionByName(frame(spark, 5, 15, "m3"))
    asked = []

    def read(months):
        asked.append(months)
        return stored.filter(F.col("month").isin(months))

    assert key_bits.maybe_stored(batch, bits, "month", KEYS).filter("part = 'm1'").count() > 11_000
    fresh = key_bits.absent_rows(batch, bits, "month", KEYS, read, scratch)
    assert sorted((r["month"], r["n"]) for r in fresh.groupBy("month").agg(F.count("*").alias("n")).collect()) == [("m1", 20_000), ("m2", 5), ("m3", 10)]
    assert asked == [["m1", "m2"]]


def test_bitmaps_of_several_inserts(spark, scratch):
    bits = key_bits.key_bits(frame(spark, 0, 10), "month", KEYS).unionByName(key_bits.key_bits(frame(spark, 10, 5000), "month", KEYS))
    batch = frame(spark, 0, 5000).unionByName(frame(spark, 0, 10))
    found = key_bits.maybe_stored(batch, bits, "month", KEYS)
    assert found.count() == 5000


def test_nulls_and_empty_sides(spark, scratch):
    nothing = frame(spark, 0, 0)
    bits = key_bits.key_bits(frame(spark, 0, 5), "month", KEYS)
    none = spark.createDataFrame([("m1", None, "k1")], "month string, a long, b string")
    assert key_bits.absent_rows(none, bits, "month", KEYS, no_read, scratch).count() == 1
    assert key_bits.absent_rows(nothing, bits, "month", KEYS, no_read, scratch).count() == 0
    assert key_bits.absent_rows(frame(spark, 0, 5), key_bits.key_bits(nothing, "month", KEYS), "month", KEYS, no_read, scratch).count() == 5


def test_a_batch_in_partitions_of_its_keys_is_not_moved(spark, scratch):
    """Only the stored keys are shuffled, once; and of the rows that ask the bitmaps no key is."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        stored = frame(spark, 0, 500)
        bits = key_bits.key_bits(stored, "month", KEYS)
        batch = frame(spark, 400, 600).repartition(4, *KEYS).persist()
        fresh = key_bits.absent_rows(batch, bits, "month", KEYS, lambda months: stored.select(*KEYS), scratch)
        names = []

        def walk(node):
            names.append(node.nodeName())
            if node.nodeName() == "AdaptiveSparkPlan":
                return walk(node.initialPlan())
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        walk(fresh._jdf.queryExecution().executedPlan())
        assert names.count("Exchange") == 1
        assert sorted(r.a for r in fresh.collect()) == list(range(500, 600))
        asked = key_bits.maybe_parts(batch, bits, "month", KEYS)
        assert [r.part for r in asked.collect()] == ["m1"]
        batch.unpersist()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
