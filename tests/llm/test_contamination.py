from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F, types as T

from tapebook.llm import contamination as con

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("matches", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("text", T.StringType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text, _ in docs:
        w, hit, named = words(text), set(), set()
        for item_id, body in items:
            v = words(body)
            k = min(13, len(v))
            grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in grams:
                    hit.update(range(i, i + k))
                    named.add(item_id or "")
        out.append((str(doc_id), len(w), len(hit), sorted(named)))
    return sorted(out)


def found(spark, docs, items):
    marked = con.find_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    count, matches = marked.columns[-2:]
    assert (count, matches) == ("n_words", "matches_")  # the clashing column keeps its name
    rows = marked.withColumn("hit", con.covered(F.col(matches))).collect()
    for r in rows:
        w = words(r.text)
        bodies = [words(b) for i, b in items]
        for m in r[matches]:
            run = w[m.start : m.start + m.length]
            assert any(v[m.item_start : m.item_start + m.length] == run for v in bodies)
    return sorted((str(r.doc_id), r[count], r.hit, sorted({m.item_id for m in r[matches]})) for r in rows)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cé", "d1", "日本", "of"][: rng.randint(1, 6)]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(n))

    items = [(f"i{k}", text(rng.choice([0, 1, 2, 5, 12, 13, 14, 30]))) for k in range(6)]
    docs = [(k, text(rng.randint(0, 60)), None) for k in range(8)]
    for k in range(8, 16):
        body = rng.choice(items)[1]
        docs.append((k, text(rng.randint(0, 20)) + body.upper() + text(rng.randint(0, 20)), "x"))
    return docs, items


@pytest.mark.parametrize("seed", range(5))
def test_equals_brute_force(spark, seed):
    docs, items = random_case(seed)
    assert found(spark, docs, items) == brute(docs, items)


def test_nulls_repeats_and_long_texts(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = [
        (1, None, None), (2, "", None), (None, item, "x"), (3, item + " x " + item, "x"), (3, item + " x " + item, "x"),
        (4, "w5 " * 50000 + item, None), (5, " ".join(f"w{i}" for i in range(12)), None),
    ]
    items = [("i", item), ("i", item), ("j", None), ("k", ""), (None, item), ("l", "!!")]
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(1, "some text", None)]
    assert found(spark, docs, []) == [("1", 2, 0, [])]
    assert found(spark, [], [("i", "a b")]) == []


def test_several_blocks(spark, monkeypatch):
    docs, items = random_case(11)
    monkeypatch.setattr(con, "ITEM_BLOCK_BYTES", 40)
    assert found(spark, docs, items) == brute(docs, items)


def test_clean_documents(spark):
    item = " ".join(f"w{i}" for i in range(13))
    docs = [(1, item + " x" * 247, None), (2, item + " x" * 248, "keep"), (3, None, None), (4, "plain", None)]
    kept = con.clean_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame([("i", item)], ITEMS))
    assert kept.columns == DOCS.names
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_words_that_repeat(spark):
    """Ends of one item and one text that are all alike: only matches that begin as early as they can are kept."""
    import resource
    import time

    tests = con.TestItems.build([("i", "x " * 2000), ("j", "x y " * 700)])
    start, before = time.process_time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    counts, matches = con._search_column(con.pa.array(["x " * 20_000, "x y " * 3000 + "x " * 40]), tests)
    assert counts == [20_000, 6040]
    assert time.process_time() - start < 30
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500 * 1024
    # one match per place of the text for the item's first word, one per place of the item for the text's
    assert len(matches[0]) == 20_000 - 12 + 2000 - 13
    assert max(m["length"] for m in matches[0]) == 2000 and max(m["length"] for m in matches[1]) == 1400
    docs, items = [(1, "x " * 60, None), (2, "x y " * 30 + "x " * 20, "x")], [("i", "x " * 30), ("j", "x y " * 10)]
    assert found(spark, docs, items) == brute(docs, items)


def test_matches_in_small_parts(spark, monkeypatch):
    docs, items = random_case(2)
    monkeypatch.setattr(con, "MATCHES", 3)
    tests = con.TestItems.build([(i, b) for i, b in items if b])
    _, matches = con._search_column(con.pa.array([t for _, t, _ in docs]), tests)
    monkeypatch.undo()
    _, whole = con._search_column(con.pa.array([t for _, t, _ in docs]), tests)
    key = lambda m: sorted(map(repr, m))
    assert list(map(key, matches)) == list(map(key, whole))
