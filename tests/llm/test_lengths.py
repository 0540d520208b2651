from __future__ import annotations

import math

import pytest
from pyspark.sql import types as T

from tapebook.llm import bpe, lengths

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])


@pytest.fixture(scope="module")
def sums(spark):
    texts = ["", None, "a", "one two three", "x" * 5000, "word " * 3000, "a", "the end", "word " * 3000]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    book = bpe.codec(*bpe.vocabulary())
    counts = sorted(len(book.encode(t or "")) for t in texts)
    return lengths.suffix_sums(lengths.length_histogram(lengths.encoded_lengths(docs))).cache(), counts


def test_suffix_sums(sums):
    table, counts = sums
    got = {r.n_tokens: r.asDict() for r in table.collect()}
    assert sorted(got) == sorted(set(counts))
    for limit, row in got.items():
        over = [c for c in counts if c > limit]
        assert row["n_docs"] == counts.count(limit)
        assert (row["docs_over"], row["tokens_over"]) == (len(over), sum(over))
        assert row["truncated_total"] == sum(min(c, limit) for c in counts)
        assert row["tokens_cut"] == sum(c - limit for c in over)
        assert row["docs_fit"] == len(counts) - len(over)
        assert math.isclose(row["quantile"], row["docs_fit"] / len(counts))
        assert (row["total_docs"], row["total_tokens"]) == (len(counts), sum(counts))


def test_any_limit(sums):
    table, counts = sums
    limits = [0, 1, 2, 3, 100, 1024, 2048, 10**6]
    for r in lengths.at_limits(table, limits).collect():
        assert r.docs_over == sum(c > r.context_limit for c in counts)
        assert r.truncated_total == sum(min(c, r.context_limit) for c in counts)


def test_quantiles(sums):
    table, counts = sums
    for share in (0.1, 0.5, 0.75, 1.0):
        want = counts[math.ceil(share * len(counts)) - 1]
        assert lengths.length_quantile(table, share).first().n_tokens == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lengths.suffix_sums(lengths.length_histogram(lengths.encoded_lengths(docs))).collect() == []
