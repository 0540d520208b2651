"""Every registered query against its SQL equivalent, over whole tables."""

from __future__ import annotations

import os

import pytest

import oracle
from __spark_entry__ import entry
from tapebook.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem = oracle.compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR)
    # The smallest data set has no second screening page.
    assert problem is None or (problem, name) == ("no rows", "screen_page")


def test_entry(spark):
    rows = {r["x_flags"]: r for r in entry(spark).collect()}
    assert set(rows) == {"A", "N", "R"} and all(r["n_active"] <= r["n_rows"] for r in rows.values())


def test_plans_have_no_python_and_no_cross_joins(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert word not in plan, f"{word} in {name}"
