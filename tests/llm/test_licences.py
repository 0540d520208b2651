from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from tapebook.llm import licences
from tapebook.llm.automaton import SuffixAutomaton
from tapebook.llm.queries import op12_licence_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
tokens = st.lists(st.integers(0, 3), max_size=14)


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@given(st.lists(tokens, min_size=1, max_size=4), tokens)
@settings(max_examples=300, deadline=None)
def test_matching_statistics(sequences, text):
    found = SuffixAutomaton(sequences)
    for end, (state, length) in enumerate(found.statistics(text), 1):
        def holds(which, size):
            s = sequences[which]
            return [e for e in range(size, len(s) + 1) if s[e - size : e] == text[end - size : end]]

        sizes = {w: max(k for k in range(end + 1) if holds(w, k) or k == 0) for w in range(len(sequences))}
        assert length == max(sizes.values())
        got = found.longest_by_sequence(state, length, 1)
        assert {w: (n, sorted(e)) for w, (n, e) in got.items()} == {w: (k, holds(w, k)) for w, k in sizes.items() if k}


def brute(text, templates, phrases, seed, gap, share):
    """Places of phrases, and spans, by comparing all places."""
    doc = words(text)
    places = sorted((label, s, len(words(p))) for label, p in phrases for s in range(len(doc)) if words(p) and doc[s : s + len(words(p))] == words(p))
    spans, best = set(), 0.0
    for which, (label, body) in enumerate(templates):
        t = words(body)
        longest = {}  # end in the text -> longest stretch that ends there
        for e in range(1, len(doc) + 1):
            for e2 in range(1, len(t) + 1):
                k = 0
                while k < min(e, e2) and doc[e - 1 - k] == t[e2 - 1 - k]:
                    k += 1
                if k and k >= longest.get(e, (0, []))[0]:
                    longest[e] = (k, [e2] if k > longest.get(e, (0, []))[0] else longest[e][1] + [e2])
        anchors = [
            (e - k, e, e2) for e, (k, ends) in longest.items() if k >= seed and longest.get(e + 1, (0,))[0] != k + 1 for e2 in ends
        ]
        gained = {}
        for s, e, e2 in sorted(anchors, key=lambda a: (a[1], a[2])):
            options = [(e - s, -s)]
            for (s0, f0, f2), (v, root) in gained.items():
                if f0 < e and f2 < e2 and s - f0 <= gap:
                    options.append((v + min(e - s, e - f0, e2 - f2), -root))
            value, root = max(options)
            gained[s, e, e2] = (value, -root)
        by_root = {}
        for (s, e, e2), (v, root) in sorted(gained.items(), key=lambda x: x[0][1]):
            if v > by_root.get(root, (0, 0))[0]:
                by_root[root] = (v, e)
        for root, (v, e) in by_root.items():
            best = max(best, v / len(t))
            if v / len(t) >= share:
                spans.add((label, which, root, e, v))
    kept = []
    for label, which, start, end, v in sorted(spans, key=lambda s: (-s[4] / len(words(templates[s[1]][1])), -s[4], s[2], s[1])):
        taken = {w for other, _, s, e, _ in kept if other != label for w in range(s, e)}
        if 2 * len(taken & set(range(start, end))) <= end - start:
            kept.append((label, which, start, end, v))
    return len(doc), places, set(kept), 1.0 if places else best


SMALL = (("x", "a b c d e f g h"), ("y", "c d e f a b"), ("z", "a b a b a b"), ("x", "g h i"))
FEW = (("p", "b c"), ("q", "d e f"))


def check(spark, texts, templates, phrases, seed, gap, share):
    frame = spark.createDataFrame([(i, t, "n", "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string, spans string").repartition(3)
    got = licences.scan(frame, templates=templates, phrases=phrases, seed=seed, gap=gap, share=share).collect()
    assert len(got) == len(texts)
    for r in got:
        d = r.asDict(recursive=True)
        n, places, spans, cover = brute(texts[r.doc_id], templates, phrases, seed, gap, share)
        assert (d["n_words"], d["spans"], d["n_words_"]) == ("n", "clash", n)
        assert sorted((p["label"], p["start"], p["length"]) for p in d["places"]) == places, texts[r.doc_id]
        assert {(s["label"], s["template"], s["start"], s["end"], s["covered"]) for s in d["spans_"]} == spans, texts[r.doc_id]
        assert d["cover"] == pytest.approx(cover)


@pytest.mark.parametrize("seed,gap,share", [(2, 3, 0.7), (3, 0, 0.5), (1, 5, 0.9)])
def test_equals_comparing_all_places(spark, seed, gap, share):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices("abcdefghi" + "u" * rng.randint(0, 6), k=rng.randint(0, 40))) for _ in range(150)]
    texts += ["A-b, c D; e f G h", "a b c u d e f g h", None, "", "u v w", "a b " * 30]
    check(spark, texts, SMALL, FEW, seed, gap, share)


def test_single_words_and_no_templates(spark):
    texts = ["a", "u a u a a", "b", "", None]
    check(spark, texts, (), (("p", "a"), ("empty", "...")), 3, 2, 0.5)
    check(spark, texts, (("t", "a a"),), (), 1, 2, 0.5)


def test_notices(spark):
    notice = dict((label, text) for label, text in reversed(licences.TEMPLATES))
    filled = notice["mit"].replace("Software", "Software,").upper()
    cut = " ".join(words(notice["mit"])[:20] + ["really", "truly"] + words(notice["mit"])[21:])
    texts = [
        "words before " + filled + " and after", cut, "See our license. We permit nothing of the sort", "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0", "Licensed under the Apache License, Version 2.0", "the MIT License", None,
        "word " * 20_000 + notice["gpl"] + " word" * 20_000, notice["lgpl"],
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(frame).withColumn("labels", licences.label_text(licences.F.col("places"), licences.F.col("spans"))).collect()}
    assert [got[k].labels for k in range(10)] == ["mit", "mit", "", "cc-by-nc", "cc-by", "apache", "mit", "", "gpl", "gpl,lgpl"]  # the phrase gives gpl too
    assert got[0].spans[0].start == 2 and got[0].spans[0].share == 1 and not got[0].places
    assert 0.8 < got[1].cover < 1 and got[6].cover == 1
    assert got[8].n_words == 40_000 + len(words(notice["gpl"])) and got[8].places[0].label == "gpl"


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op12_licence_scan(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        doc = words(texts[r.doc_id])
        places = sorted((s, label) for label, p in licences.PHRASES for s in range(len(doc)) if doc[s : s + len(p.split())] == p.split())
        assert (r.n_words, r.n_base) == (len(doc), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
