from __future__ import annotations

import hashlib

from pyspark.sql import functions as F, types as T

from tapebook.llm import digests

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("sha", T.StringType()),  # clashes with a name the operator uses
    ]
)


def groups(spark, rows):
    return [r.asDict() for r in digests.exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()]


def test_largest_id_stays_and_null_is_empty(spark):
    rows = [(1, "a", "x"), (2, "a", None), (3, None, "x"), (4, "", "x"), (5, "b", "x"), (6, "a ", "x")]
    got = {r["doc_id"]: r for r in groups(spark, rows)}
    assert {k: v["keep_id"] for k, v in got.items()} == {1: 2, 2: 2, 3: 4, 4: 4, 5: 5, 6: 6}
    assert {k for k, v in got.items() if v["kept"]} == {2, 4, 5, 6}
    assert got[1]["group_size"] == 2
    assert got[3]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repeated_rows_and_null_ids(spark):
    got = groups(spark, [(1, "a", "x"), (1, "a", "x"), (None, "a", "x"), (None, "n", "x")])
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "None", "None"]
    assert [r["doc_id"] for r in got if r["kept"]].count(1) == 1
    assert all(r["group_size"] == 3 for r in got if r["keep_id"] == 1)
    assert [r["kept"] for r in got if r["keep_id"] is None] == [True]


def test_empty_table(spark):
    assert groups(spark, []) == []
    assert digests.distinct_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_group_over_many_runs(spark):
    docs = spark.range(3000, numPartitions=7).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 500).cast("string"))).alias("text"),
    )
    rows = digests.digest_rows(docs)
    for slots in (1, 5, 40):
        _, merged = digests.merge_runs(rows, slots)
        got = {r["keep"]["doc_id"]: r["size"] for r in merged.collect()}
        expected = {}
        for i in range(3000):
            expected.setdefault("hot" if i % 3 == 0 else i % 500, []).append(i)
        assert got == {max(v): len(v) for v in expected.values()}


def test_kept_rows_keep_their_columns(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (3, None, "z"), (None, "q", "w"), (None, "q", "w")]
    kept = digests.distinct_documents(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "sha"]
    assert sorted((str(r.doc_id), r.sha) for r in kept.collect()) == [("2", "y"), ("3", "z"), ("None", "w")]


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    digests.distinct_documents(docs).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
