from __future__ import annotations

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import types as T
from test_contamination import brute as contamination_brute
from test_jaccard import brute as jaccard_brute, near_copies

from tapebook.llm import bpe, toxicity

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    passage = " ".join(f"b{i}" for i in range(30))
    rows = [(i + 1000, t, None, "s", 1) for i, (_, t, _) in enumerate(near_copies(3, groups=6, most=4))]
    rows += [(i, f"plain number {i} " + " ".join(f"p{i}x{k}" for k in range(20)), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, f"number {i} is an idiot " + " ".join(f"t{i}x{k}" for k in range(20)), "en", "s", 1) for i in range(60)]
    rows += [(200, "same text", None, None, None), (201, "same text", None, None, None), (201, "same text", None, None, None)]
    rows += [(300, passage, "en", "s", 1), (301, passage + " " + " ".join(f"q{k}" for k in range(900)), "en", "s", 1)]
    rows += [(400, None, None, None, None), (None, "null id", None, None, None), (401, "", None, None, None)]
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 1, 1) for i in range(60)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([("i", passage)], "item_id string, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows


def test_run_equals_brute_force(spark, folder):
    root, rows = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{root}/labels.parquet"))
    import pyarrow as pa

    kept = [r for r, s in zip(rows, model.scores(pa.array([r[1] for r in rows], pa.string()))) if s < 0.5]
    assert {r[0] for r in rows} - {r[0] for r in kept} == set(range(100, 160))
    last: dict = {}
    for r in kept:
        if r[1] or "" not in last or (r[0] or -1) > (last[""][0] or -1):
            old = last.get(r[1] or "")
            if old is None or (r[0] if r[0] is not None else -1) >= (old[0] if old[0] is not None else -1):
                last[r[1] or ""] = r
    kept = list(last.values())
    triples = [(r[0], r[1], None) for r in kept]
    smallest = {d: c for d, n, c in jaccard_brute(triples) if n}
    kept = [r for r in kept if smallest.get(str(r[0]), str(r[0])) == str(r[0])]
    judged = contamination_brute([(r[0], r[1], None) for r in kept], [("i", " ".join(f"b{i}" for i in range(30)))])
    dirty = {d for d, n, hit, _ in judged if hit and 20 * hit >= n}
    kept = [r for r in kept if str(r[0]) not in dirty]
    book = bpe.codec(*bpe.vocabulary())
    want = sorted((str(r[0]), hashlib.sha256(np.array(book.encode(r[1] or ""), "<u4").tobytes()).hexdigest()) for r in kept)
    got = corpus_pipeline.run(spark, root)
    found = got.collect()
    assert sorted((str(r.doc_id), r.ids_sha256) for r in found) == want
    assert "300" in dirty and "301" not in dirty


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder, tmp_path):
    root, _ = folder
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        assert out.collect() == []
        assert name == "bpe" or out.columns == DOCUMENTS.names


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
