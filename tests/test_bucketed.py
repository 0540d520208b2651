from __future__ import annotations

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from tapebook.operators import keyed
from tapebook.sources import bucketed

LAYOUT = bucketed.Buckets(("a", "b"), 6)
ROWS = "a long, b string, v long"


@pytest.fixture
def target(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    rows = spark.range(1000).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"), F.col("id").alias("v"))
    stored = bucketed.write_bucketed(rows.repartition(5), name, str(tmp_path / "t"), LAYOUT)
    assert len(glob.glob(str(tmp_path / "t" / "*.parquet"))) == 6
    yield stored
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moves(df) -> list[tuple[bool, str]]:
    """(does it move the stored table?, description) of each shuffle in a plan."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if "Exchange" in name:
            found.append(("FileScan" in node.toString(), node.simpleString(50)))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def batch_of(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_the_stored_side_never_moves(spark, target, no_broadcast):
    batch = batch_of(spark, [(1, "k1", -1)])
    for df in (
        bucketed.upsert(target, batch, LAYOUT, "v"),
        bucketed.insert_if_absent(target, batch, LAYOUT, "v"),
        keyed.absent_rows(LAYOUT.dealt(batch), target, ["a", "b"]),
        keyed.present_keys(target, LAYOUT.dealt(batch), ["a", "b"]),
    ):
        found = moves(df)
        assert found and not [text for stored, text in found if stored], found
    plain = spark.read.parquet(target.inputFiles()[0].rsplit("/", 1)[0])
    assert [text for stored, text in moves(bucketed.upsert(plain, batch, LAYOUT, "v")) if stored]


def test_changes_equal_the_plain_operators(spark, target, tmp_path):
    batch = batch_of(spark, [(1, "k1", -1), (1, "k1", -5), (2, "other", 7), (5000, "k", 1), (None, "k3", 2), (3, None, None), (999, "k999", None)])
    plain = keyed.upsert(target, batch, ["a", "b"], "v")
    changed = bucketed.upsert(target, batch, LAYOUT, "v")

    def rows(df):
        return sorted(map(tuple, df.select("a", "b", "v").collect()), key=repr)

    assert rows(changed) == rows(plain) and changed.count() == 1004
    name, path = f"n_{uuid.uuid4().hex}", str(tmp_path / "n")
    written = bucketed.write_bucketed(changed, name, path, LAYOUT, in_place=True)
    assert rows(written) == rows(plain) and len(glob.glob(f"{path}/*.parquet")) == 6
    spark.sql(f"DROP TABLE {name}")
    again = bucketed.open_bucketed(spark, name, path, LAYOUT)
    assert rows(again) == rows(plain) and not [t for stored, t in moves(again.groupBy("a", "b").count()) if stored]
    assert rows(bucketed.open_bucketed(spark, name, path, LAYOUT)) == rows(plain)
    spark.sql(f"DROP TABLE {name}")
    fresh = bucketed.insert_if_absent(target, batch, LAYOUT, "v")
    assert rows(fresh) == rows(keyed.insert_if_absent(target, batch, ["a", "b"], "v").exceptAll(target))


def test_empty_sides(spark, target, tmp_path):
    nothing = batch_of(spark, [])
    assert bucketed.upsert(target, nothing, LAYOUT, "v").count() == 1000
    assert bucketed.insert_if_absent(target, nothing, LAYOUT, "v").count() == 0
    name = f"e_{uuid.uuid4().hex}"
    empty = bucketed.write_bucketed(nothing, name, str(tmp_path / "e"), LAYOUT)
    assert bucketed.upsert(empty, batch_of(spark, [(1, "x", 2)]), LAYOUT, "v").count() == 1
    spark.sql(f"DROP TABLE {name}")
