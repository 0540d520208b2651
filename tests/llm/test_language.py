from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tapebook.llm import language as L

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])
PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = {
    "en": "the house water reading letter thing over under winter with".split(),
    "de": "der das und straße über wasser lesen nicht schön mit".split(),
    "fr": "le la et maison être été où lettre hiver avec".split(),
}


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOCABULARY))
        rows.append((i, " ".join(rng.choice(VOCABULARY[lang]) for _ in range(rng.randint(2, 30))), lang, None))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return L.learn(spark.createDataFrame(corpus(), SCHEMA).repartition(3))


def brute(book, place, probabilities, word):
    """Sum over all segmentations, by recursion."""
    text = b" " + word

    def total(at):
        if at == len(text):
            return 1.0
        sums = probabilities[book.size + text[at]] * total(at + 1)
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in place:
                sums += probabilities[place[text[at:end]]] * total(end)
        return sums

    return math.log(total(0))


def test_forward_sums_all_segmentations(model):
    book = L.pieces(PATH)
    words = [b"a", "straße".encode(), b"water", b"qzx", b"under", b"lettering"]
    candidates = {(b" " + w)[i:j] for w in words for i in range(len(w) + 1) for j in range(i + 1, len(w) + 2)}
    ordered = sorted(candidates)
    ends = np.cumsum([len(c) for c in ordered])
    hashes = L._plain_block(np.frombuffer(b"".join(ordered), np.uint8)).stretch(ends - [len(c) for c in ordered], ends)
    index, at = book.set.find(hashes)
    place = {ordered[i]: p for i, p in zip(index, at)}
    assert " water".encode() in place or b"water" in place
    ends = np.cumsum([len(w) for w in words])
    laid = L.Words(book, np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)
    got = laid.log_likelihoods(model.model)
    for i, w in enumerate(words):
        for k in range(len(model.languages)):
            assert got[i, k] == pytest.approx(brute(book, place, model.model[:, k], w), rel=1e-9)


def test_expectation_maximisation_never_lowers_the_likelihood():
    words = [("x", w.encode(), 3) for w in VOCABULARY["en"]]
    book = L.pieces(PATH)
    data = b"".join(w for _, w, _ in words)
    ends = np.cumsum([len(w) for _, w, _ in words])
    laid = L.Words(book, np.frombuffer(data, np.uint8), ends - [len(w) for _, w, _ in words], ends)
    model = np.full((book.size + 256, 1), 1 / (book.size + 256))
    last = -np.inf
    for _ in range(6):
        now = laid.log_likelihoods(model).sum()
        assert now >= last - 1e-9
        last = now
        counts = np.zeros(model.shape)
        laid.expected(model, np.zeros(len(words), int), np.ones(len(words)), counts)
        model = counts / counts.sum(0)


def test_held_out_accuracy_and_edge_cases(spark, model):
    rows = corpus(200, seed=9)
    rows += [(1000, None, "en", None), (1001, "", None, None), (1002, "123 !? …", "de", "x"), (1003, "the water " * 40000, None, "x")]
    rows += [(1004, "und die " + "x" * 5000, None, None), (1005, "日本語", None, None), (None, "le la été", None, None), (None, "le la été", None, None)]
    out = L.predict(spark.createDataFrame(rows, SCHEMA), model)
    assert out.columns == ["doc_id", "text", "lang", "score", "lang_pred", "score_"]
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score_ == 0 for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == "en" and by_id[None].lang_pred == "fr"
    assert by_id[1005].lang_pred in model.languages
    assert np.mean([by_id[i].lang_pred == lang for i, _, lang, _ in rows[:200]]) > 0.97
    assert all(0 <= r.score_ <= 1 for r in got)


def test_the_held_out_fold_is_not_read(spark):
    rows = corpus(120)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows]
    first, second = (L.learn(spark.createDataFrame(x, SCHEMA)) for x in (rows, changed))
    assert first.languages == second.languages and np.array_equal(first.model, second.model)


def test_empty_tables(spark):
    nothing = L.learn(spark.createDataFrame([], SCHEMA))
    got = L.predict(spark.createDataFrame([(1, "some text", None, None)], SCHEMA), nothing).collect()
    assert [(r.lang_pred, r.score_) for r in got] == [("und", 0.0)]
    assert L.predict(spark.createDataFrame([], SCHEMA), nothing).collect() == []


def test_a_rare_language_is_learned_beside_a_common_one(spark):
    rows = [(i, "the house water reading", "en", None) for i in range(4000)] + [(9000 + i, "straße über wasser", "de", None) for i in range(4)]
    assert any(zlib.crc32(str(9000 + i).encode()) % 3 != 1 for i in range(4))
    model = L.learn(spark.createDataFrame(rows, SCHEMA).repartition(3), sample=50)
    assert model.languages == ["de", "en"]
    assert model.predict(pa.array(["über wasser"]))[0] == ["de"]


def forward(book, model, word):
    """The plain recursion from the left, in logarithms."""
    text = b" " + word
    flat = np.frombuffer(text, np.uint8)
    block = L._plain_block(flat)
    sums = np.full((len(text) + 1, model.shape[1]), -np.inf)
    sums[0] = 0
    for end in range(1, len(text) + 1):
        ways = [sums[end - 1] + np.log(model[book.size + text[end - 1]])]
        for size in range(1, min(end, book.longest) + 1):
            found, place = book.set.find(block.stretch(np.array([end - size]), np.array([end])))
            ways += [sums[end - size] + np.log(model[p]) for p in place]
        sums[end] = np.logaddexp.reduce(ways)
    return sums[-1]


@pytest.mark.parametrize("word", ["ภาษาไทยไม่มีช่องว่าง" * 9, "straßeüberwasser" * 32, "x" * 500, "a" * 45, "語" * 200])
def test_long_words_are_summed_whole(model, word):
    word = word.encode()
    assert len(word) > 40
    book = L.pieces(PATH)
    want = forward(book, model.model, word)
    assert L.LongWord(book, word).log_likelihood(model.model) == pytest.approx(want, rel=1e-9)
    if len(word) <= L.plain_bytes(model.model):
        data = np.frombuffer(word, np.uint8)
        assert L.Words(book, data, np.array([0]), np.array([len(word)])).log_likelihoods(model.model)[0] == pytest.approx(want, rel=1e-9)
    names, scores = model.predict(pa.array([word.decode()]))
    assert names == [model.languages[int(want.argmax())]]
    assert scores[0] == pytest.approx(1 / np.exp(want - want.max()).sum(), rel=1e-6)


def test_long_and_short_words_expect_the_same(model):
    book = L.pieces(PATH)
    words = [w.encode() for w in ("straße", "water", "lettering", "été")]
    language, weight = np.array([0, 1, 1, 2]), np.array([3.0, 1.0, 2.0, 5.0])
    short, long = np.zeros_like(model.model), np.zeros_like(model.model)
    L.expected_counts(book, model.model, words, language, weight, short)
    for w, k, n in zip(words, language, weight):
        L.LongWord(book, w).expected(model.model, int(k), float(n), long)
    assert np.allclose(short, long, rtol=1e-9, atol=1e-12)
    whole = np.zeros_like(model.model)
    L.expected_counts(book, model.model, ["語".encode() * 300], np.array([0]), np.array([1.0]), whole)
    assert whole.sum() > 100 and np.isfinite(whole).all()


def test_rounds_in_spark_equal_one_loop(spark):
    words = [(lang, w.encode(), n + 1) for lang, ws in VOCABULARY.items() for n, w in enumerate(ws)]
    frame = spark.createDataFrame(words, "lang string, word binary, n long").repartition(5)
    got = L.fit(frame, PATH)
    book, languages = L.pieces(PATH), sorted(VOCABULARY)
    model = np.full((book.size + 256, 3), 1 / (book.size + 256))
    for _ in range(L.ROUNDS):
        counts = np.full(model.shape, L.SMOOTHING)
        L.expected_counts(book, model, [w for _, w, _ in words], np.array([languages.index(x) for x, _, _ in words]), np.array([float(n) for *_, n in words]), counts)
        model = counts / counts.sum(0)
    assert got.languages == languages and np.allclose(got.model, model, rtol=1e-3, atol=1e-9)


def test_many_languages_fit(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"{chr(97 + lang % 26)}{chr(97 + lang // 26)}{rng.choice('aeiou')}" for _ in range(20)), f"l{lang}", None) for i, lang in enumerate(list(range(200)) * 4)]
    model = L.learn(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert len(model.languages) > 190
    names, _ = model.predict(pa.array([rows[k][1] for k in range(0, 800, 10)]))
    assert np.mean([n == rows[k][2] for n, k in zip(names, range(0, 800, 10))]) > 0.9


@pytest.mark.parametrize("cells", [1, 50, 1 << 22])
def test_passes_hold_every_word_once(cells, monkeypatch):
    monkeypatch.setattr(L, "PASS_CELLS", cells)
    lengths = np.random.default_rng(1).integers(1, 30, 200)
    parts = list(L.passes(lengths, 2))
    assert sorted(np.concatenate(parts).tolist()) == list(range(200))
    assert all(len(p) == 1 or len(p) * (lengths[p].max() + 2) * 2 <= cells for p in parts)
