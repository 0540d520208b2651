from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tapebook.llm import bag_search

DOCS, ITEMS = "doc_id long, text string, m long, bag string", "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item, text in items:
        scored = []
        for i, b in bags:
            if b:
                m = 10 + (90 * sum(b.values()) * n) // total
                s = sum(
                    math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in set(terms(text)) if b[t]
                )
                if s > 0:
                    scored.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored)[:top], 1):
            out.add((item, rank, i, -s))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 7, "clash") for i, t in docs], DOCS).repartition(6)


def search(spark, docs, items, **more):
    got = bag_search.search(frame(spark, docs), spark.createDataFrame(items, ITEMS), **more).collect()
    out = {tuple(r) for r in got}
    assert len(out) == len(got)
    return out


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["Été", "漢字", "A1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(n)]
    docs += [(n + i, "w1 w2 w2, W3!") for i in range(80)] + [(2 * n + i, "nothing of that") for i in range(50)]
    docs += [(3 * n, None), (3 * n + 1, ""), (3 * n + 2, "--- ..."), (3 * n + 3, "w1 " * 5000), (None, "w5 w6"), (-4, "w5 w6")]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 15)))) for k in range(12)]
    items += [(50, "w2 w3 w2"), (51, ""), (52, None), (53, "unknown words"), (54, "w5"), (54, "w6")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert search(spark, docs, items) == brute(docs, items)


def test_small_passes_and_blocks(spark, monkeypatch):
    """Passes of few products, and items in several blocks, give the same rows."""
    import tapebook.llm.contamination as contamination

    docs, items = corpus(3, 120)
    want = brute(docs, items)
    monkeypatch.setattr(bag_search, "PRODUCTS", 5)
    monkeypatch.setattr(bag_search, "CELLS", 40)
    monkeypatch.setattr(contamination, "ITEM_BLOCK_BYTES", 150)
    assert len(list(contamination.item_blocks(spark.createDataFrame(items, ITEMS)))) > 1
    assert search(spark, docs, items) == want


def test_a_class_is_scored_once(spark):
    docs = [(i, "w1 w2 and more" if i % 3 else "W2, w1 or less") for i in range(90)]
    words = bag_search.Vocabulary.of([(1, "w1 w2")])
    found = bag_search.bags(frame(spark, docs).select("doc_id", "text"), words)
    classes = bag_search.classes(found, bag_search.statistics(found, words)).collect()
    assert [r.members for r in classes] == [list(range(10))]


def test_nothing_to_find(spark):
    docs, items = corpus(1, 20)
    assert search(spark, [], items) == set()
    assert search(spark, docs, []) == set()
    assert search(spark, [(1, None), (2, "...")], items) == set()
    assert search(spark, [(1, "only w1"), (2, "only w1")], [(1, "w1")], top=1) == brute([(1, "only w1"), (2, "only w1")], [(1, "w1")], top=1)
