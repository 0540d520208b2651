from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tapebook.llm import quality as Q

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType())])


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abdeinorst") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(5, 60))]
        good = rng.random() > 0.25
        if not good:
            kind = rng.randrange(4)
            if kind == 0:
                words = [w + rng.choice(["$$$", "###", "&&&"]) for w in words]
            elif kind == 1:
                words = [w.upper() + "!!" for w in words]
            elif kind == 2:
                words = [w for w in words for _ in range(6)]
            else:
                words = [x for w in words for x in (w, "|")]
        rows.append((i, " ".join(words) + ".", None))
        labels.append((i, int(good)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return Q.learn(spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS))


def test_held_out_accuracy(spark, model):
    rows, labels = corpus(400, seed=5)
    got = {r.doc_id: r.predicted for r in Q.predictions(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert np.mean([got[i] == y for i, y in labels]) > 0.97


def test_edge_cases(spark, model):
    rows = [(1, None, "x"), (2, "", None), (3, "word " * 100000, None), (3, "word " * 100000, None), (None, "plain words here.", "x"), (4, "日本 \x00", None)]
    out = Q.score(spark.createDataFrame(rows, SCHEMA), model)
    assert out.columns == ["doc_id", "text", "score", "score_"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score_ <= 1 for r in got)
    by_id = {r.doc_id: r.score_ for r in got}
    assert by_id[1] == by_id[2] and by_id[3] < Q.GOOD


def test_measures_are_those_of_a_plain_count():
    text = "Ab ab ab! x|y 12\n#$ Ab ab ab!"
    m = dict(zip(Q.FEATURES, Q._column_measures(pa.array(["other", text, ""]))[1]))
    words = text.lower().split()
    assert m["symbols"] == pytest.approx(2 / len(text)) and m["bars"] == pytest.approx(1 / len(text))
    assert m["exclamation"] == pytest.approx(2 / len(text)) and m["upper"] == pytest.approx(2 / len(text))
    assert m["repeated_words"] == pytest.approx(1 - len(set(words)) / len(words))
    assert m["repeated_neighbours"] == pytest.approx(sum(a == b for a, b in zip(words, words[1:])) / len(words))
    triples = list(zip(words, words[1:], words[2:]))
    assert m["repeated_runs"] == pytest.approx(1 - len(set(triples)) / len(triples))


def test_better_texts_win_most_pairs():
    rng = np.random.default_rng(0)
    label = rng.integers(0, 2, 300)
    measured = rng.normal(size=(300, 3)) + label[:, None] * [2.0, 0.0, -1.0]
    model = Q.fit(measured, label, (150, 150), pairs=5000)
    raw = model.raw(measured)
    assert (raw[label == 1][:, None] > raw[label == 0][None]).mean() > 0.93


def measured_texts(n=1000, seed=3):
    """Two measures that tell classes apart a little (separable classes have no inner optimum), and one that doesn't."""
    rng = np.random.default_rng(seed)
    label = (rng.random(n) < 0.6).astype(int)
    measured = np.stack([rng.normal(0.7 * label, 1.0), rng.normal(-0.5 * label, 1.0), rng.normal(0, 1, n)], 1)
    return np.round(measured, 2), label


def plain_score(model, row):
    return sum(w[sum(x >= step for step in steps)] for steps, w, x in zip(model.steps, model.worth, row))


def test_fit_equals_newton_steps_on_feature_differences():
    measured, label = measured_texts()
    pairs = 6000
    model = Q.fit(measured, label, (400, 600), pairs)
    rng = np.random.default_rng(7)
    better, worse = rng.choice(np.flatnonzero(label == 1), pairs), rng.choice(np.flatnonzero(label == 0), pairs)
    sizes = [len(w) for w in model.worth]
    features = np.zeros((len(label), sum(sizes)))
    for i, row in enumerate(measured):
        first = 0
        for steps, size, x in zip(model.steps, sizes, row):
            features[i, first + sum(x >= step for step in steps)] = 1
            first += size
    difference = features[better] - features[worse]

    def loss(worth):
        return np.log1p(np.exp(-difference @ worth)).mean() + 0.5e-4 * worth @ worth

    best = np.zeros(sum(sizes))
    for _ in range(30):
        wrong = 1 / (1 + np.exp(difference @ best))
        slope = -(difference.T @ wrong) / pairs + 1e-4 * best
        bend = (difference * (wrong * (1 - wrong))[:, None]).T @ difference / pairs + 1e-4 * np.eye(len(best))
        best -= np.linalg.solve(bend, slope)
    found = np.concatenate(model.worth)
    assert loss(best) <= loss(found) < loss(best) * 1.01 < np.log(2)
    assert np.corrcoef(features @ found, features @ best)[0, 1] > 0.99
    assert np.allclose([plain_score(model, row) for row in measured], model.raw(measured))


@pytest.mark.parametrize("shares", [(96, 144), (900, 100), (1, 1)])
def test_threshold_is_the_best_of_all_cuts(shares):
    measured, label = measured_texts(seed=4)
    model = Q.fit(measured, label, shares, 500)
    scores = [plain_score(model, row) for row in measured]
    many = [sum(label == 0), sum(label == 1)]

    def mistakes(cut):
        return sum(shares[y] / many[y] for s, y in zip(scores, label) if (s >= cut) != (y == 1))

    ranked = sorted(set(np.round(scores, 9)))
    cuts = [ranked[0] - 1, *[(a + b) / 2 for a, b in zip(ranked, ranked[1:])], ranked[-1] + 1]
    assert mistakes(model.threshold) == pytest.approx(min(map(mistakes, cuts)))


def test_the_held_out_fold_is_not_read(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    first, second = (Q.learn(docs, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert first.threshold == second.threshold and all(np.array_equal(a, b) for a, b in zip(first.worth, second.worth))


def test_empty_tables_and_one_class(spark):
    none = Q.learn(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS))
    assert Q.score(spark.createDataFrame([], SCHEMA), none).collect() == []
    rows, labels = corpus(40)
    docs = spark.createDataFrame(rows, SCHEMA)
    one = Q.learn(docs, spark.createDataFrame([(i, 1) for i, _ in labels], LABELS))
    assert {r.predicted for r in Q.predictions(docs, one).collect()} == {1}


def test_every_labelled_text_counts(spark):
    """More texts than any sample of before: steps and threshold are those of all of them, in any order."""
    n = 9000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat(repeat('plain ', cast(id % 50 AS int)), if(id % 9 < 2, '$$ ## $$', 'words.')) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "cast(id % 9 > 1 AS int) AS quality")
    measured = Q.measured_labels(docs, labels, "text", "doc_id")
    assert measured.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n)) > 7000
    first, second = Q.learn(docs, labels), Q.learn(docs.repartition(7), labels.repartition(3))
    assert first.threshold == second.threshold and all(np.array_equal(a, b) for a, b in zip(first.worth, second.worth))
    label = np.arange(700) % 7 > 1
    better, worse = Q._pairs(label.astype(np.uint8), 3)
    assert set(better) == set(np.flatnonzero(label)) and set(worse) == set(np.flatnonzero(~label))
    got = {r.doc_id: r.predicted for r in Q.predictions(docs, first).collect()}
    assert np.mean([got[i] == int(i % 9 > 1) for i in range(n)]) > 0.99
