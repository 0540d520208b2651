from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tapebook.operators import key_bits
from tapebook.streaming import stateful

FAILURES = "ticker string, job_name string, reason string, error_class string, error_message string, failed_at timestamp"
ROWS = "id string, day date, note string"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def same(a, b):
    return sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(map(repr, b.select(*sorted(b.columns)).collect()))


def drain_failures(spark, tmp_path):
    landed = spark.readStream.schema(FAILURES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stateful.stream_failures(landed, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    return stateful.read_failures(spark, str(tmp_path / "out"))


def test_ledger_after_restarts_and_late_rows_equals_the_batch(spark, tmp_path):
    batches = [
        [("A", "price", "r1", "C1", None, at(5)), ("B", "price", "r1", None, "m", at(5)), ("A", "price", "r2", None, None, at(6))],
        [("A", "price", "r3", "C3", None, at(2)), ("C", "price", None, None, None, at(3))],  # late
        [("A", "other", "r4", "C4", "m4", at(9)), ("B", "price", "r5", "C5", None, at(9)), ("A", "price", "r2", None, None, at(6))],
    ]
    for batch in batches:
        land(spark, batch, FAILURES, str(tmp_path / "in"))
        got = drain_failures(spark, tmp_path)  # every call is a restart from the checkpoint
    whole = stateful.failure_ledger(spark.read.schema(FAILURES).parquet(str(tmp_path / "in")))
    assert same(got.select(*whole.columns), whole)
    row = got.filter("ticker = 'A' AND job_name = 'price'").first()
    assert (row.fail_count, row.reason, row.error_class, row.failure_date) == (4, "r2", "C1", date(2024, 1, 6))
    assert (row.first_seen_at, row.last_seen_at) == (at(2), at(6))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """A batch whose commit was lost after its folder was written runs again."""
    land(spark, [("A", "price", "r", "C", None, at(5))], FAILURES, str(tmp_path / "in"))
    drain_failures(spark, tmp_path)
    land(spark, [("A", "price", "r", "C", None, at(6))], FAILURES, str(tmp_path / "in"))
    drain_failures(spark, tmp_path)
    for name in ("1", ".1.crc"):
        (tmp_path / "check" / "commits" / name).unlink()
    got = drain_failures(spark, tmp_path)
    assert [(r.ticker, r.fail_count) for r in got.collect()] == [("A", 2)]


def drain_inserts(spark, tmp_path, remember):
    landed = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stateful.insert_new(landed, str(tmp_path / "out"), str(tmp_path / "check"), ["id", "day"], "day", remember).awaitTermination()
    return stateful.inserted_rows(spark, str(tmp_path / "out"))


@pytest.mark.parametrize("remember", ["30 days", "0 seconds"])
def test_inserts_keep_each_key_once(spark, tmp_path, remember):
    jan, dec = date(2024, 1, 18), date(2023, 12, 4)
    batches = [
        [("a", jan, "x"), ("b", jan, None), ("a", jan, "x"), (None, None, "n")],
        [("a", jan, "x"), ("c", dec, "late"), ("", jan, "empty")],
        [("c", dec, "late"), (None, None, "n"), ("a", dec, "other key"), (None, jan, "m"), ("", jan, "empty")],
    ]
    for batch in batches:
        land(spark, batch, ROWS, str(tmp_path / "in"))
        got = drain_inserts(spark, tmp_path, remember)
    assert same(got, spark.read.schema(ROWS).parquet(str(tmp_path / "in")).distinct())
    for name in ("2", ".2.crc"):
        (tmp_path / "check" / "commits" / name).unlink()
    assert drain_inserts(spark, tmp_path, remember).count() == 7


def test_a_batch_of_new_keys_reads_no_rows(spark, tmp_path, monkeypatch):
    asked = []
    exact = key_bits.absent_rows

    def watched(batch, bits, part, keys, read, scratch):
        return exact(batch, bits, part, keys, lambda months: asked.append(months) or read(months), scratch)

    monkeypatch.setattr(key_bits, "absent_rows", watched)
    jan, feb = date(2024, 1, 18), date(2024, 2, 4)
    for batch in ([("a", jan, "x")], [("b", feb, "y")], [("a", jan, "x"), ("a", feb, "z")]):
        land(spark, batch, ROWS, str(tmp_path / "in"))
        got = drain_inserts(spark, tmp_path, "0 seconds")
    assert got.count() == 3 and asked == [["2024-01"]]


def test_empty_first_batch(spark, tmp_path):
    land(spark, [], ROWS, str(tmp_path / "in"))
    land(spark, [("a", date(2024, 1, 18), "x")], ROWS, str(tmp_path / "in"))
    assert drain_inserts(spark, tmp_path, "1 hour").count() == 1


@pytest.mark.parametrize("few", [0, 100_000])
def test_a_batch_passes_the_state_once(spark, tmp_path, monkeypatch, few):
    """The look-up of stored keys reads what is kept of the batch, never its source again; the state is unloaded by
    the query's own settings, which the caller's session doesn't get."""
    setting, seen = "spark.sql.streaming.stateStore.unloadOnCommit", []
    monkeypatch.setattr(key_bits, "FEW", few)
    exact = key_bits.absent_rows

    def nodes(node):
        inner = node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else None
        below = [inner] if inner else [node.children().apply(k) for k in range(node.children().size())]
        return [node.nodeName(), *(name for x in below for name in nodes(x))]

    def watched(batch, *args):
        fresh = exact(batch, *args)
        seen.append((batch.sparkSession.conf.get(setting), nodes(fresh._jdf.queryExecution().executedPlan())))
        return fresh

    monkeypatch.setattr(key_bits, "absent_rows", watched)
    day = date(2024, 1, 18)
    for batch in ([("a", day, "x"), ("b", day, "y")], [("a", day, "x"), ("c", day, "z")], [("b", day, "y"), ("c", day, "z")]):
        land(spark, batch, ROWS, str(tmp_path / "in"))
        got = drain_inserts(spark, tmp_path, "0 seconds")
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c"]
    assert len(seen) == 2 and all(value == "true" for value, _ in seen)
    assert all("InMemoryTableScan" in names and not any("ExistingRDD" in n for n in names) for _, names in seen)
    assert spark.conf.get(setting) == "false"


def test_digests_tell_keys_apart(spark):
    keys = [(None, None), ("", None), (None, ""), ("", ""), ("a", "bc"), ("ab", "c"), ("abc", None), (None, "abc"), ("a", None), (None, "a")]
    rows = stateful._digest(spark.createDataFrame(keys * 2, "a string, b string"), ["a", "b"])
    assert rows.select(*stateful.DIGEST).distinct().count() == len(keys)
    assert all(rows.select(c).distinct().count() == len(keys) for c in stateful.DIGEST)
