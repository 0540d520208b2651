from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tapebook.llm import lm_scores as S, recurrent as R

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.StringType())])


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^ \t-\r]+", lowered), None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def corpus(n=250, seed=2):
    rng = random.Random(seed)
    kinds = [["the", "of", "and", "water", "house"], ["der", "und", "die", "wasser", "haus"]]
    rows = []
    for i in range(n):
        words = rng.choice(kinds)
        text = [rng.choice(words) if rng.random() < 0.8 else f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice([" ", "\n"]).join(text).title(), None))
    return rows


def check(spark, rows, parts=3):
    counts = Counter(t for i, text, _ in rows if not held_out(i) for t in tokens(text))
    total = sum(counts.values())
    base = total + 0.5 * (len(counts) + 1)
    want = sorted(
        (
            (str(i), held_out(i), len(tokens(text)), sum(t in counts for t in tokens(text)), total, sum(math.log10((counts[t] + 0.5) / base) for t in tokens(text)))
            for i, text, _ in rows
        ),
        key=lambda r: (r[0], r[2], r[5]),
    )
    got = S.score(spark.createDataFrame(rows, SCHEMA).repartition(parts), sample=100).collect()
    found = sorted(
        ((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=lambda r: (r[0], r[2], r[5])
    )
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5] for f in found], [w[5] for w in want])
    assert all(r.score <= 1e-9 for r in got)
    return got


def test_counts_and_base_scores(spark, monkeypatch):
    rows = corpus()
    rows += [(900, None, "x"), (901, "", None), (None, "the of", "x"), (902, "The of " * 30000, None), (1, rows[1][1], None)]
    monkeypatch.setattr(S, "CHUNK_TOKENS", 2000)  # several chunks in a task
    got = check(spark, rows)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_no_training_texts_and_empty_table(spark):
    only_held_out = [(i, "some words here", None) for i in range(60) if held_out(i)]
    check(spark, only_held_out, 1)
    assert S.score(spark.createDataFrame([], SCHEMA)).collect() == []


def trained(size=70):
    rng = np.random.default_rng(1)
    model = R.Recurrent(size)
    texts = [np.append(rng.integers(1, size + 1, rng.integers(1, 90)), 0) for _ in range(60)]
    model.train(texts, 1)
    return model, texts


def plain_score(model, text):
    """One text by itself, word after word, with whole softmaxes."""
    state, before, total = np.zeros((1, R.HIDDEN), np.float32), np.zeros(1, np.int64), 0.0
    w = model.weights
    for t in text:
        state = model.step(before, state)[0]
        logits = (state @ w["class"] + w["class_bias"])[0].astype(float)
        group = t // R.CLASS_WORDS if t < model.size else model.classes
        total += logits[group] - np.log(np.exp(logits).sum())
        if t < model.size:
            logits = (state @ w["word"][group] + w["word_bias"][group])[0].astype(float)
            total += logits[t % R.CLASS_WORDS] - np.log(np.exp(logits).sum())
        before = np.array([t])
    return total


def test_lockstep_windows_equal_one_text_at_a_time(monkeypatch):
    model, texts = trained()
    texts = texts + [np.zeros(1, np.int64), np.append(np.full(500, 3), 0)]
    monkeypatch.setattr(R, "LANES", 7)
    got = model.text_scores(texts)
    assert np.allclose(got, [plain_score(model, t) for t in texts], rtol=1e-4)


def test_chances_sum_to_one():
    model, _ = trained()
    hidden = np.random.default_rng(0).normal(0, 0.5, (3, R.HIDDEN)).astype(np.float32)
    total = sum(np.exp(model.log_probabilities(hidden, np.full(3, t))) for t in range(model.size + 1))
    assert np.allclose(total, 1, atol=1e-4)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(4)
    model = R.Recurrent(40)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    tokens_, targets = rng.integers(0, 41, (3, 6)), rng.integers(0, 41, (3, 6))
    state = rng.normal(0, 0.3, (3, R.HIDDEN))
    _, slopes, _ = model.loss_and_slopes(tokens_, targets, state)
    for name, weight in model.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in weight.shape)
            old = weight[at]
            weight[at] = old + 1e-5
            up = model.loss_and_slopes(tokens_, targets, state)[0]
            weight[at] = old - 1e-5
            down = model.loss_and_slopes(tokens_, targets, state)[0]
            weight[at] = old
            assert slopes[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(0)
    texts = [np.append(np.resize(rng.permutation([1, 2, 3]), 40), 0) for _ in range(200)]
    model = R.Recurrent(10)
    losses = model.train(texts, 3)
    assert losses[-1] < losses[0] * 0.8


def test_every_training_text_is_trained_on(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_TOKENS", 500)
    rows = [(i, "one two three four " * (1 + i % 7), None) for i in range(1700)]  # more than the former sample
    rows.append((None, "five six", None))
    want = sum(len(tokens(t)) for i, t, _ in rows if not held_out(i))
    seen, plain = [], S.averaged

    def spied(blocks, model, *others):
        seen.append(blocks.selectExpr("sum(n) AS n").first().n or 0)
        before = model.flat()
        after = plain(blocks, model, *others)
        assert not np.array_equal(before, after.flat())
        return after

    monkeypatch.setattr(S, "averaged", spied)
    S.score(spark.createDataFrame(rows, SCHEMA)).count()
    assert sum(seen) == R.ROUNDS * want


@pytest.mark.parametrize("scale", [1, 60])
def test_slopes_do_not_depend_on_pieces_and_marks(monkeypatch, scale):
    rng = np.random.default_rng(6)
    model = R.Recurrent(200)
    model.weights = {k: v.astype(np.float64) * (scale if k in ("class", "word") else 1) for k, v in model.weights.items()}
    stream = np.minimum(rng.zipf(1.3, (9, 41)) - 1, 200)  # some words are most of all, so is the place of the others
    tokens_, targets, start = stream[:, :-1], stream[:, 1:], np.zeros((9, R.HIDDEN))
    loss, slopes, last = model.loss_and_slopes(tokens_, targets, start)
    plain, state = 0.0, start
    for t in range(40):
        state = model.step(tokens_[:, t], state * (tokens_[:, t] != 0)[:, None])[0]
        for lane, word in enumerate(targets[:, t]):
            group = min(word // R.CLASS_WORDS, model.classes) if word < model.size else model.classes
            logits = state[lane] @ model.weights["class"] + model.weights["class_bias"]
            plain += np.log(np.exp(logits - logits[group]).sum())
            if word < model.size:
                logits = state[lane] @ model.weights["word"][group] + model.weights["word_bias"][group]
                plain += np.log(np.exp(logits - logits[word % R.CLASS_WORDS]).sum())
    assert loss == pytest.approx(plain / targets.size)
    assert np.allclose(last, state)
    for columns, marked, safe in ((7, 14, 60.0), (512, 0, 0.0), (40, 500, 1e9)):
        for name, value in (("COLUMNS", columns), ("MARKED", marked), ("SAFE", safe)):
            monkeypatch.setattr(R, name, value)
        again, found, _ = model.loss_and_slopes(tokens_, targets, start)
        assert again == pytest.approx(loss)
        assert all(np.allclose(found[k], slopes[k], rtol=1e-6, atol=1e-12) for k in slopes)


def test_a_window_moves_little_memory():
    model, rng = R.Recurrent(2048), np.random.default_rng(0)
    words = rng.integers(0, 2049, (R.TRAIN_LANES, R.WINDOW + 1))
    tracemalloc.start()
    for _ in range(2):
        model.loss_and_slopes(words[:, :-1], words[:, 1:], np.zeros((R.TRAIN_LANES, R.HIDDEN), np.float32))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 28e6  # 34 MB while slopes had arrays beside those of the gates


def test_rows_are_summed_by_key():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 500):
        keys, rows = np.sort(rng.integers(0, 40, n)), rng.normal(size=(n + 1, 3))
        rows[-1] = 0
        want = np.zeros((40, 3))
        np.add.at(want, keys, rows[:-1])
        found, sums = R._summed(keys, rows)
        assert found.tolist() == sorted(set(keys.tolist()))
        assert np.allclose(sums, want[found])


def test_places_of_hashes():
    rng = np.random.default_rng(0)
    listed = rng.permutation(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    hashes = rng.choice(np.append(listed, rng.integers(0, 1 << 63, 3000, dtype=np.uint64)), 9000)
    place = {h: k for k, h in enumerate(listed.tolist())}
    assert S.Places(listed).find(hashes).tolist() == [place.get(h, 3000) for h in hashes.tolist()]
    assert S.Places(listed[:1]).find(listed[:2]).tolist() == [0, 1]
