"""Toxicity of texts after noisy-channel deobfuscation.

Writers hide words by look-alike symbols (``1d10t``), spacing (``i d i o t``) and repetition
(``idiooot``). Each such stretch becomes a lattice of the letters it may stand for; the most likely
path under a character language model of the whole corpus is decoded (Viterbi), and the restored
words are scored with the others by a model of toxic words and word beginnings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .labelled import class_counts, fold, labelled_sample
from .shared import free_name, small_batches
from .words import LETTERS, Block, HashSet, mix, word_blocks

#: Letters that a symbol may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "+": "t", "|": "il",
}
#: Signs that may be put between the letters of a word.
BETWEEN = " .-_*"
#: Log-probabilities of the channel: a symbol stands for a letter or ends the word, a sign was put in
#: or ends the word, a letter was repeated from one or from two, a pair is a pair or one doubled.
STANDS, ENDS, PUT_IN, KEPT_APART, REPEATED = map(math.log, (0.99, 0.01, 0.9, 0.1, 0.5))
PAIR, DOUBLED = map(math.log, (0.9, 0.1))

#: And of a word without letters.
EMPTY = math.log(0.001)

#: Symbols of the language model: word end, a to z, any other letter.
SYMBOLS = 28
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:192] = 255
_SYMBOL[192:] = 27

_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LOOKS_LIKE]] = True
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[ord(c) for c in BETWEEN]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Lengths of word beginnings that are features besides the whole word.
BEGINNINGS = (3, 4, 5)
#: Likelihood-ratio statistic that a feature needs.
LEAST_G2 = 25.0
#: Bound of the labelled sample, for each class.
SAMPLE = 2000


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of three symbols in a row over all words of the corpus."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for block in word_blocks(batch.column(0), LETTERS):
                symbols = np.insert(_SYMBOL[block.data], block.offsets, 0)
                symbols = symbols[symbols != 255].astype(np.int64)
                symbols = symbols[_not_repeated_end(symbols)]
                triples = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
                total += np.bincount(triples, minlength=SYMBOLS**3)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], ["place", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, "place long, n long")
    counts = np.zeros(SYMBOLS**3, np.int64)
    for r in rows.groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r.place] = r.n
    return counts


def _not_repeated_end(symbols: np.ndarray) -> np.ndarray:
    """Marks all but the word ends that follow another."""
    kept = np.ones(len(symbols), bool)
    kept[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    return kept


@dataclass
class Deobfuscator:
    """Viterbi decoding of a character lattice; ``logp[a, b, c]`` is the language model."""

    logp: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Deobfuscator:
        """Trigrams that lean on bigrams, those on single symbols, those on the uniform distribution."""
        third = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        second, first = third.sum(0), third.sum((0, 1))
        p = (first + 1) / (first.sum() + SYMBOLS)
        p = (second + 5 * p) / (second.sum(1, keepdims=True) + 5)
        p = (third + 5 * p) / (third.sum(2, keepdims=True) + 5)
        return cls(np.log(p))

    @staticmethod
    def lattice(text: str) -> list[list[tuple[str, float]]]:
        """For each step, what it may stand for and the channel's log-probability; a blank ends a word."""
        steps: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(text):
            char, run = text[i], 1
            while i + run < len(text) and text[i + run] == char:
                run += 1
            once, more = (DOUBLED, PAIR) if run == 2 else (REPEATED, REPEATED)
            if char in LOOKS_LIKE:
                letters = LOOKS_LIKE[char]
                options = [(c, STANDS - math.log(len(letters))) for c in letters] + [(" ", ENDS)]
                steps.append(options)
                steps += [[*((c, p + more) for c, p in options), ("", once)]] * (run - 1)
            elif char.isalpha():
                steps.append([(char, once), (char * 2, more)] if run > 1 else [(char, 0.0)])
            elif char in BETWEEN:
                while i + run < len(text) and text[i + run] in BETWEEN:
                    run += 1
                steps.append([("", PUT_IN), (" ", KEPT_APART)])
            else:
                steps.append([(" ", 0.0)])
            i += run
        return steps

    def restore(self, text: str) -> str:
        """The most likely words behind a stretch, divided by blanks."""
        if text not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[text] = self._decode(text)
        return self.known[text]

    def _decode(self, text: str) -> str:
        # state: the last two symbols; its best score and the way there (text so far as a linked list)
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in [*self.lattice(text), [(" ", 0.0)]]:
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, way) in states.items():
                for letters, channel in options:
                    x, y, total = a, b, score + channel
                    for c in letters:
                        symbol = ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27
                        if symbol or y:
                            total += self.logp[x, y, symbol]
                            x, y = y, symbol
                        else:
                            total += EMPTY
                    if (x, y) not in following or total > following[x, y][0]:
                        following[x, y] = (total, (way, letters))
            states = following
        way = max(states.values(), key=lambda s: s[0])[1]
        parts: list[str] = []
        while way:
            way, letters = way
            parts.append(letters)
        return " ".join("".join(reversed(parts)).split())


def _edges(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked places."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def hidden_stretches(block: Block) -> list[tuple[int, int]]:
    """Byte ranges of a block, in order and apart, that may hide a word: white-space-bounded tokens of
    letters and look-alikes or with a letter three times in a row, and three or more single letters or
    look-alikes (a letter among them), whatever separators lie between."""
    data = np.insert(block.data, block.offsets[1:], 32)  # rows must not touch
    if len(data) < 3:
        return []
    letter, leet = LETTERS[data], _LEET[data]
    repeated = np.zeros(len(data), bool)
    repeated[:-2] = (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & letter[:-2] & (data[:-2] < 128)

    def within(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many marked places each range has."""
        sums = np.concatenate([[0], np.cumsum(marks)])
        return sums[ends] - sums[starts]

    row_start = block.offsets + np.arange(block.rows + 1)

    def row_of(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(row_start, places, side="right") - 1

    found: list[tuple[int, int]] = []

    def add(starts: np.ndarray, ends: np.ndarray) -> None:
        row = row_of(starts)
        found.extend(zip((starts - row).tolist(), (ends - row).tolist()))

    starts, ends = _edges(~_SPACE[data])
    hit = (within(letter, starts, ends) > 0) & (within(leet, starts, ends) > 0) | (within(repeated, starts, ends) > 0)
    add(starts[hit], ends[hit])

    starts, ends = _edges(letter | leet)
    if len(starts) > 2:
        one = ends - starts == 1
        other = within(~_BETWEEN[data], ends[:-1], starts[1:])
        follows = np.concatenate([[False], one[1:] & one[:-1] & ((starts[1:] - ends[:-1] <= 3) | (other == 0))])
        at = np.flatnonzero(follows)
        follows[at] = row_of(starts[at]) == row_of(starts[at - 1])
        first, last = _edges(follows)
        first, last = starts[first[last - first >= 2] - 1], ends[last[last - first >= 2] - 1]
        worded = within(letter, first, last) > 0
        add(first[worded], last[worded])

    single = (block.ends - block.starts == 1) if len(block.starts) else np.zeros(0, bool)
    joined = np.zeros(len(single), bool)
    if len(single) > 1:
        row = block.row_of_word()
        joined[1:] = single[1:] & single[:-1] & (block.starts[1:] - block.ends[:-1] <= 3) & (row[1:] == row[:-1])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
    for first, last_ in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if last_ - first >= 2:  # three single letters or more
            found.append((int(block.starts[first - 1]), int(block.ends[last_ - 1])))
    found.sort()
    apart: list[tuple[int, int]] = []
    for start, end in found:
        if apart and start < apart[-1][1]:
            apart[-1] = (apart[-1][0], max(end, apart[-1][1]))
        else:
            apart.append((start, end))
    return apart


def _features(block: Block, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and word beginnings, and the row of each."""
    row = block.row_of_word()[taken]
    starts, ends = block.starts[taken], block.ends[taken]
    hashes, rows = [block.stretch(starts, ends)], [row]
    for k in BEGINNINGS:
        long = ends - starts > k
        hashes.append(mix(block.stretch(starts[long], starts[long] + k) + np.uint64(k)))
        rows.append(row[long])
    return np.concatenate(hashes), np.concatenate(rows)


def text_features(column: pa.Array, decoder: Deobfuscator) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """For each block of a text column its features and their rows, with hidden words restored."""
    for block in word_blocks(column, LETTERS):
        stretches = hidden_stretches(block)
        taken = np.ones(len(block.starts), bool)
        if not stretches:
            yield block, *_features(block, taken)
            continue
        begin, end = map(np.array, zip(*stretches))
        at = np.searchsorted(begin, block.starts, side="right") - 1
        taken = (at < 0) | (block.starts >= end[at])
        restored = [decoder.restore(block.data[s:e].tobytes().decode("utf-8", "replace")) for s, e in stretches]
        owner = np.searchsorted(block.offsets, begin, side="right") - 1
        hashes, rows = _features(block, taken)
        for extra in word_blocks(pa.array(restored, pa.string()), LETTERS):
            more, of = _features(extra, np.ones(len(extra.starts), bool))
            hashes = np.concatenate([hashes, more])
            rows = np.concatenate([rows, owner[extra.first + of]])
        yield block, hashes, rows


@dataclass
class ToxicityModel:
    decoder: Deobfuscator
    features: HashSet
    weights: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Scores from 0 to 1 of a text column."""
        out = []
        for block, hashes, rows in text_features(column, self.decoder):
            index, place = self.features.find(hashes)
            pairs = np.unique(np.stack([rows[index], place], 1), axis=0) if len(index) else np.zeros((0, 2), np.int64)
            logit = self.intercept + np.bincount(pairs[:, 0], self.weights[pairs[:, 1]], minlength=block.rows)
            out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fit_weights(feature: np.ndarray, row: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Features that speak for label 1, their weights and the intercept: a likelihood-ratio test picks
    features, logistic regression with a small ridge weighs them."""
    n, positive = len(label), int(label.sum())
    values, inverse = np.unique(feature, return_inverse=True)
    seen = np.bincount(inverse, minlength=len(values))
    hits = np.bincount(inverse, label[row], minlength=len(values))
    share = positive / max(1, n)

    def term(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-12) / np.maximum(expected, 1e-12)), 0)

    misses = seen - hits
    g2 = 2 * (
        term(hits, seen * share) + term(misses, seen * (1 - share))
        + term(positive - hits, (n - seen) * share) + term(n - positive - misses, (n - seen) * (1 - share))
    )
    chosen = np.flatnonzero((g2 > LEAST_G2) & (hits > seen * share))
    number = np.full(len(values), -1)
    number[chosen] = np.arange(len(chosen))
    column = number[inverse]
    row, column = row[column >= 0], column[column >= 0]
    weights, bias = np.zeros(len(chosen)), math.log((positive + 0.5) / (n - positive + 0.5))
    step_w, step_b = np.zeros(len(chosen)), 0.0
    for _ in range(400 if len(chosen) else 0):
        logit = bias + np.bincount(row, weights[column], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
        slope = np.bincount(column, error[row], minlength=len(chosen)) + 0.05 * weights
        step_w += slope**2
        step_b += error.sum() ** 2
        weights -= 0.5 * slope / np.sqrt(step_w + 1e-9)
        bias -= 0.5 * error.sum() / math.sqrt(step_b + 1e-9)
    return values[chosen], weights, bias


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", per_class: int = SAMPLE) -> ToxicityModel:
    """A model from labels (``doc_id``, ``toxic``) outside fold 0.

    The language model counts all texts. Weights come from at most ``per_class`` labelled documents
    of each class; the intercept then stands for the classes' real shares.
    """
    decoder = Deobfuscator.from_counts(trigram_counts(docs, text))
    sent = docs.sparkSession.sparkContext.broadcast(decoder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for block, hashes, rows in text_features(batch.column(0), sent.value):
                order = np.argsort(rows, kind="stable")
                parts = np.split(hashes[order], np.cumsum(np.bincount(rows, minlength=block.rows))[:-1])
                packed += [np.unique(p).tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(packed, pa.binary())], ["label", "features"])

    sample = labelled_sample(docs, labels, "toxic", text, doc_id, per_class=per_class)
    rows = sample.mapInArrow(run, "label int, features binary").collect()
    label = np.array([r.label for r in rows], float)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r.features) // 8 for r in rows])
    feature = np.frombuffer(b"".join(r.features for r in rows), np.uint64)
    del rows
    values, weights, bias = fit_weights(feature, row, label)
    clean, toxic = class_counts(labels, "toxic", doc_id)
    drawn = math.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5))
    real = math.log((toxic + 0.5) / (clean + 0.5))
    return ToxicityModel(decoder, HashSet(values), weights, bias - drawn + real)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows with one more column ``score`` (0 to 1, higher: more likely toxic).

    Null and empty texts get the score of a text without any toxic word. An existing column
    ``score`` keeps its place and the new one takes the next free name. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    name = free_name(docs, "score")
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(sent.value.scores(batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], schema.names)

    return docs.mapInArrow(run, schema)


def predictions(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from 0.5 on) of every document."""
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that aren't toxic, with their columns."""
    scored = score(docs, learn(docs, labels, text, doc_id), text)
    return scored.filter(F.col(scored.columns[-1]) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
