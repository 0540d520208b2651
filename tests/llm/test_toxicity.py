from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tapebook.llm import toxicity as tox

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType())])
BAD = ["idiot", "moron", "pathetic", "worthless"]
HIDDEN = {"1d10t": "idiot", "i d i o t": "idiot", "idiooooot": "idiot", "m0r0n": "moron", "p@thetic": "pathetic", "w.o.r.t.h.l.e.s.s": "worthless", "moooron": "moron"}


def corpus(n=700, seed=3):
    rng = random.Random(seed)
    plain = ["the", "and", "house", "garden", "water", "letter", "over", "under", "reader", "winter", "table", "small"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(3, 40))]
        toxic = rng.random() < 0.2
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), None))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return tox.learn(spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS))


def scores(spark, model, rows):
    scored = tox.score(spark.createDataFrame(rows, SCHEMA), model)
    assert scored.columns == ["doc_id", "text", "score", "score_"]
    return {r.doc_id: r.score_ for r in scored.collect()}


def test_hidden_words_are_restored(model):
    for hidden, word in HIDDEN.items():
        assert model.decoder.restore(hidden) == word


def test_viterbi_equals_the_best_of_all_paths(model):
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice("abt0143@. ") for _ in range(rng.randint(1, 7)))
        steps = [*model.decoder.lattice(text), [(" ", 0.0)]]
        best = -math.inf
        for path in itertools.product(*steps):
            a = b = 0
            total = 0.0
            for letters, channel in path:
                total += channel
                for c in letters:
                    symbol = ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27
                    if symbol or b:
                        total += model.decoder.logp[a, b, symbol]
                        a, b = b, symbol
                    else:
                        total += tox.EMPTY
            if total > best + 1e-9:
                best, word = total, " ".join("".join(p for p, _ in path).split())
        assert model.decoder._decode(text) == word


def test_toxic_hidden_and_clean_texts(spark, model):
    rows = [(0, "the garden and the table", "x"), (1, "the IDIOT reader", None), (2, None, None), (3, "", None)]
    rows += [(10 + k, f"under the {h} house", None) for k, h in enumerate(HIDDEN)]
    rows += [(90, "winter " * 30000 + " you 1d10t", None), (91, "water 2024 house 3 + 4 | 5 !! a b c", None), (None, "moron", None)]
    got = scores(spark, model, rows)
    assert all(got[i] < 0.5 for i in (0, 2, 3, 91))
    assert got[2] == got[3]
    assert all(got[i] >= 0.5 for i in [1, 90, None, *range(10, 10 + len(HIDDEN))])
    assert all(0 <= v <= 1 for v in got.values())


def test_held_out_accuracy(spark, model):
    rows, labels = corpus(400, seed=8)
    got = scores(spark, model, rows)
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, y in labels]) > 0.98


def test_counts_are_those_of_a_plain_loop(spark):
    texts = ["ab  ba", None, "", "Äb, c3d", "a"]
    counts = tox.trigram_counts(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA).repartition(2))
    want: dict[tuple, int] = {}
    for t in texts:
        symbols, word = [0], []
        for c in (t or "") + " ":
            s = 27 if ord(c) > 127 else ord(c.lower()) - 96 if c.isalpha() else 0
            if s or symbols[-1]:
                symbols.append(s)
        for k in zip(symbols, symbols[1:], symbols[2:]):
            want[k] = want.get(k, 0) + 1
    inner = {k: v for k, v in want.items() if k[1] != 0}  # across a text's end the next one's words follow
    got = counts.reshape(28, 28, 28)
    assert {k: got[k] for k in inner} == inner


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    first, second = (tox.learn(docs, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert np.array_equal(first.weights, second.weights) and first.intercept == second.intercept


def test_clean_documents_and_predictions(spark):
    rows, labels = corpus(500)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = tox.clean_documents(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == SCHEMA.names
    ids = {r.doc_id for r in kept.collect()}
    assert np.mean([(i in ids) == (not y) for i, y in labels]) > 0.98


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert tox.clean_documents(docs, labels).collect() == []
    some = spark.createDataFrame([(1, "an idiot", None), (2, None, "x")], SCHEMA)
    got = [r.score_ for r in tox.score(some, tox.learn(some, labels)).collect()]
    assert len(got) == 2 and all(0 <= s <= 1 for s in got)
    assert tox.ToxicityModel(tox.Deobfuscator.from_counts(np.zeros(28**3)), tox.HashSet(np.zeros(0, np.uint64)), np.zeros(0), 0.0).scores(pa.array([], pa.string())).size == 0


def test_a_text_is_scored_alike_in_any_company(model):
    texts = ["le!!", "an 1d10t", "", "i d i", "o t", "abb", "bbc", "x1", "2y", "m0r0n"]
    alone = [model.scores(pa.array([t]))[0] for t in texts]
    assert np.allclose(alone, model.scores(pa.array(texts)))


MORE_HIDDEN = ["1 d 1 0 t", "i  d  i  o  t", "i--d--i--o--t", "i - d - i - o - t", "iddiot", "1d1000t", "idi00t!", "w0rthle55", "worthle$$", "m 0 r 0 n", "idio+", "1di0++"]


def test_more_forms_of_each_disguise_are_found_and_restored(spark, model):
    rows = [(k, f"under the {h} house", None) for k, h in enumerate(MORE_HIDDEN) if h != "iddiot"]
    got = scores(spark, model, rows)
    assert {MORE_HIDDEN[k]: v for k, v in got.items() if v < 0.5} == {}
    assert model.decoder.restore("iddiot") == "idiot"
    assert model.decoder.restore("small!") == "small" and model.decoder.restore("letter+") == "letter"


def test_tokens_that_end_in_look_alikes_are_stretches():
    for text in ("ki11", "a55", "a$$", "shi+", "$ h 1 t", "a   b   c"):
        block = next(tox.word_blocks(pa.array(["x", text, "y"]), tox.LETTERS))
        assert [block.data[s:e].tobytes().decode() for s, e in tox.hidden_stretches(block)] == [text]
    block = next(tox.word_blocks(pa.array(["a", "b", "c", "1 2 3 4 5"]), tox.LETTERS))
    assert tox.hidden_stretches(block) == []
