from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tapebook.operators.extremes import sliding_extremes


@pytest.mark.parametrize("range_days", [0, 1, 6, 50, 364])
def test_equals_looking_at_every_row(spark, range_days):
    """Gaps, NULL values, days before 1970, one row only, a NULL key."""
    rng = random.Random(range_days)
    rows = []
    for key in ("a", "b", None, "lone"):
        days = rng.sample(range(-400, 900), 1 if key == "lone" else 300)
        rows += [(key, date(1970, 1, 1) + timedelta(days=d), rng.choice([None, rng.randint(0, 99)]), rng.randint(0, 99)) for d in days]
    df = spark.createDataFrame(rows, "k string, day date, low int, high int").repartition(3)
    got = sliding_extremes(df, ["k"], "day", range_days, {"low": F.col("low")}, {"high": F.col("high")}).collect()
    assert len(got) == len(rows)
    found = {(r.k, r.day): (r.low, r.high) for r in got}
    for key, day, _, _ in rows:
        near = [r for r in rows if r[0] == key and day - timedelta(days=range_days) <= r[1] <= day]
        lows = [r[2] for r in near if r[2] is not None]
        assert found[key, day] == (min(lows, default=None), max(r[3] for r in near))


def test_one_exchange_and_growing_frames_only(spark):
    df = spark.range(10).select(F.lit("a").alias("k"), F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day"), "id")
    plan = sliding_extremes(df, ["k"], "day", 364, {"low": F.col("id")}, {})._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding" in plan and "-364" not in plan.replace("day", "")
    assert plan.count("Exchange hashpartitioning(k") <= 2 and "rangepartitioning" not in plan


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, day date, v int")
    assert sliding_extremes(df, ["k"], "day", 5, {"low": F.col("v")}, {}).collect() == []
