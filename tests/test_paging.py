from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapebook.operators import paging
from tapebook.operators.paging import By

KINDS = {
    "i": ("int", lambda r: r.choice([None, r.randint(-5, 5), r.randint(-(2**31), 2**31 - 1)])),
    "l": ("long", lambda r: r.choice([r.randint(-(2**63), 2**63 - 1), 2**62 + r.randint(0, 9)])),
    "d": ("double", lambda r: r.choice([None, math.inf, -math.inf, math.nan, 0.0, -0.0, 1e300, -1e308, 1.7e308, r.gauss(0, 1), 5e-324])),
    "s": ("string", lambda r: r.choice([None, "", "a", "a\0", "a\0\0", "prefix" + "é漢😀"[r.randint(0, 2)] * r.randint(0, 9), str(r.random())])),
    "t": ("timestamp", lambda r: datetime(2024, 1, 1) + timedelta(microseconds=r.randint(0, 10) * r.choice([1, 10**12]))),
    "y": ("date", lambda r: r.choice([None, date(1, 1, 1), date(9999, 1, 1), date(2024, 1, r.randint(1, 28))])),
    "m": ("decimal(38,10)", lambda r: Decimal(r.randint(-(10**20), 10**20)) / 1000),
    "b": ("boolean", lambda r: r.choice([None, True, False])),
}


def _texts(rows):
    return [repr(r).replace("=-0.0", "=0.0") for r in rows]


@pytest.mark.parametrize("order", ["i", "-l-s", "d", "-d", "s", "-t", "yi", "-m", "b-s"])
def test_every_page_of_every_type(spark, order, monkeypatch):
    """A page that is found by counting is that of the sorted rows; few buckets make for several rounds."""
    monkeypatch.setattr(paging, "BUCKETS", 16)
    rng = random.Random(order)
    names = order.replace("-", "")
    data = [tuple(KINDS[k][1](rng) for k in names) + (n // 2,) for n in range(90)]
    df = spark.createDataFrame(data, ", ".join(f"c{k} {KINDS[k][0]}" for k in names) + ", n long").coalesce(2).cache()
    by = [By(f"c{k}", descending=f"-{k}" in order) for k in names]
    whole = paging.page_of(df, by, 1, 1000).collect()
    found = paging.page_of(df, by, 2, 37, direct_rows=6).collect()
    assert _texts(found) == _texts(whole[37:74]) and len(whole) == 90
    df.unpersist()


def test_equal_rows_on_both_sides_of_a_page(spark):
    df = spark.createDataFrame([(1, "x")] * 50 + [(0, "y")] * 3 + [(2, "z")] * 40, "k int, v string").repartition(5)
    sizes = [paging.page_of(df, [By("k")], p, 20, direct_rows=2).groupBy("v").count().collect() for p in range(1, 7)]
    assert [sorted(tuple(r) for r in s) for s in sizes] == [
        [("x", 17), ("y", 3)], [("x", 20)], [("x", 13), ("z", 7)], [("z", 20)], [("z", 13)], [],
    ]


def test_offsets_beyond_an_int(spark):
    """Five thousand million rows, of which one task holds few."""
    many = spark.range(3_000_000)
    page = paging.page_of(many, [By("id", descending=True)], 2_990, 1000, tie=())
    assert [r.id for r in page.limit(3).collect()] == [3_000_000 - 2_989_000 - 1 - k for k in range(3)]
    assert paging.page_of(many, [By("id")], 5_000_000, 1000, tie=()).collect() == []  # from 5,000,000,000 on
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "offset" not in plan.lower()


def test_rank_of_equal_values(spark):
    df = spark.createDataFrame([(k % 3,) for k in range(300)], "k int")
    assert [paging.row_at(df, [By("k")], r, 1) for r in (0, 99, 100, 299)] == [({"k": 0}, 0), ({"k": 0}, 0), ({"k": 1}, 100), ({"k": 2}, 200)]


def test_names_that_are_taken(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "_tie int, __tie string")
    assert [tuple(r) for r in paging.page_of(df, [By("_tie", True)], 2, 1, direct_rows=0).collect()] == [(2, "b")]
