"""Language of texts by segmentation-marginalised unigram models.

Every language gives each piece of a fixed public vocabulary (and each single byte) a probability. A
word's probability is the sum over all its segmentations into pieces, found by a forward pass over
the whole word, however long; the models are fitted by expectation maximisation over the same segmentations,
in rounds of Spark tasks. A text's score is the
product over its words, so each different word is segmented once for many texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from .labelled import fold
from .shared import free_name, small_batches, written
from .words import LETTERS, Block, HashSet, mix, word_blocks

#: Bytes of text whose different words are segmented together, and (word, end, language) cells of one forward pass.
SHARD_BYTES, PASS_CELLS = 8 << 20, 1 << 22
#: Expected counts are summed over tasks as whole numbers of this fraction, in any order alike.
GRAIN = 1 << 20
#: Documents of each language that the models are fitted on (about), rounds, and added counts.
SAMPLE, ROUNDS, SMOOTHING = 3000, 4, 0.05
#: Predicted for texts without any letter.
UNDETERMINED = "und"


class Pieces:
    """Pieces of a sentencepiece vocabulary as hashes of their bytes; the word mark is a blank.

    The last 256 places of a model stand for single bytes.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = set()
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                texts.add(model.id_to_piece(i).replace("▁", " ").lower().encode())
        ordered = sorted(t for t in texts if t)
        ends = np.cumsum([len(t) for t in ordered])
        starts = ends - np.array([len(t) for t in ordered])
        hashes = _plain_block(np.frombuffer(b"".join(ordered), np.uint8)).stretch(starts, ends)
        self.set = HashSet(hashes)
        self.size = len(self.set.values)
        self.longest = max(len(t) for t in ordered)


def _plain_block(data: np.ndarray) -> Block:
    none = np.zeros(0, np.int64)
    return Block(0, 1, data, data, np.array([0, len(data)]), none, none, none, none)


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Words:
    """Different words laid out for forward passes, longest first: a blank and the word's bytes.

    ``steps`` lists, by end and then length of a piece, the words that have a piece there and its place.
    """

    def __init__(self, book: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.length = ends - starts + 1
        self.order = np.argsort(-self.length, kind="stable")
        length = self.length[self.order]
        base = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else np.zeros(0, np.int64)
        size = int(length.sum())
        flat = np.full(size, 32, np.uint8)
        index = np.arange(size) - np.repeat(base, length)
        body = index > 0
        flat[body] = data[(np.repeat(starts[self.order] - 1, length) + index)[body]]
        block = _plain_block(flat)
        most = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(most + 1), side="right")
        self.count, self.sorted_length, self.most, self.active = len(length), length, most, active
        self.steps: list[tuple[int, list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]] = []
        for end in range(1, most + 1):
            here = base[: active[end]]
            found = []
            for size in range(1, min(end, book.longest) + 1):
                words, places = book.set.find(block.stretch(here + end - size, here + end))
                if len(words):
                    found.append((end - size, words, places))
            self.steps.append((end, found, flat[here + end - 1].astype(np.int64) + book.size))

    def forward(self, model: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of each word's beginnings: [word, end, language]."""
        alpha = np.zeros((self.count, self.most + 1, model.shape[1]))
        alpha[:, 0] = 1
        for end, found, byte in self.steps:
            n = self.active[end]
            alpha[:n, end] = alpha[:n, end - 1] * model[byte]
            for start, words, places in found:
                alpha[words, end] += alpha[words, start] * model[places]
        return alpha

    def totals(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[np.arange(self.count), self.sorted_length]

    def log_likelihoods(self, model: np.ndarray) -> np.ndarray:
        """Of each word in the order given, for each language."""
        out = np.empty((self.count, model.shape[1]))
        out[self.order] = np.log(self.totals(self.forward(model)))
        return out

    def expected(self, model: np.ndarray, language: np.ndarray, weight: np.ndarray, counts: np.ndarray) -> None:
        """Add to ``counts`` how often each piece is expected in the words, ``weight`` times each, where
        every word is of one language."""
        language, weight = language[self.order], weight[self.order]
        alpha = np.zeros((self.count, self.most + 1))
        alpha[:, 0] = 1
        for end, found, byte in self.steps:
            n = self.active[end]
            alpha[:n, end] = alpha[:n, end - 1] * model[byte, language[:n]]
            for start, words, places in found:
                alpha[words, end] += alpha[words, start] * model[places, language[words]]
        beta = np.zeros_like(alpha)
        beta[np.arange(self.count), self.sorted_length] = weight / self.totals(alpha)
        for end, found, byte in reversed(self.steps):
            n = self.active[end]
            through = beta[:n, end] * model[byte, language[:n]]
            np.add.at(counts, (byte, language[:n]), alpha[:n, end - 1] * through)
            beta[:n, end - 1] += through
            for start, words, places in found:
                through = beta[words, end] * model[places, language[words]]
                np.add.at(counts, (places, language[words]), alpha[words, start] * through)
                beta[words, start] += through


class LongWord:
    """One word that is too long for plain doubles: all pieces in it, by their ends."""

    def __init__(self, book: Pieces, word: bytes):
        flat = np.frombuffer(b" " + word, np.uint8)
        block, self.length = _plain_block(flat), len(flat)
        starts, ends, places = [np.arange(self.length)], [np.arange(1, self.length + 1)], [flat.astype(np.int64) + book.size]
        for size in range(1, min(self.length, book.longest) + 1):
            at, place = book.set.find(block.stretch(np.arange(self.length - size + 1), np.arange(size, self.length + 1)))
            starts.append(at)
            ends.append(at + size)
            places.append(place)
        order = np.argsort(np.concatenate(ends), kind="stable")
        self.starts, self.ends, self.places = (np.concatenate(x)[order] for x in (starts, ends, places))
        self.bounds = np.searchsorted(self.ends, np.arange(self.length + 2))

    def log_likelihood(self, model: np.ndarray) -> np.ndarray:
        """For each language. Sums are kept as fractions and exponents for the last ends a piece can reach back to."""
        ring = int((self.ends - self.starts).max()) + 1
        value, power = np.zeros((ring, model.shape[1])), np.zeros((ring, model.shape[1]), np.int64)
        value[0] = 1
        for end in range(1, self.length + 1):
            found = slice(self.bounds[end], self.bounds[end + 1])
            at = self.starts[found] % ring
            top = power[at].max(0)
            total = np.ldexp(value[at] * model[self.places[found]], power[at] - top).sum(0)
            value[end % ring], more = np.frexp(total)
            power[end % ring] = top + more
        last = self.length % ring
        return np.log(value[last]) + power[last] * math.log(2)

    def expected(self, model: np.ndarray, language: int, weight: float, counts: np.ndarray) -> None:
        """Add to ``counts`` how often each piece is expected in the word, ``weight`` times."""
        log = np.log(model[self.places, language])
        before, after = np.full(self.length + 1, -np.inf), np.full(self.length + 1, -np.inf)
        before[0] = after[self.length] = 0
        for end in range(1, self.length + 1):
            found = slice(self.bounds[end], self.bounds[end + 1])
            before[end] = np.logaddexp.reduce(before[self.starts[found]] + log[found])
        for end in range(self.length, 0, -1):
            found = slice(self.bounds[end], self.bounds[end + 1])
            at = self.starts[found]  # each start once, since pieces of one end differ in size
            np.logaddexp.at(after, at, after[end] + log[found])
        share = np.exp(before[self.starts] + log + after[self.ends] - before[self.length])
        np.add.at(counts, (self.places, np.full(len(self.places), language)), weight * share)


def plain_bytes(model: np.ndarray) -> int:
    """Words of so many bytes and a blank have probabilities well within doubles, byte by byte at worst."""
    return max(1, int(280 / -math.log10(min(0.1, float(model.min())))) - 1)


def passes(lengths: np.ndarray, languages: int) -> Iterator[np.ndarray]:
    """Words of similar length, a bounded number of cells at a time."""
    order = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(order):
        # all cells are as long as the last word, so grow while they fit
        last = first + 1
        step = 1
        while last < len(order) and (last - first + step) * (lengths[order[min(last + step, len(order)) - 1]] + 2) * languages <= PASS_CELLS:
            last = min(last + step, len(order))
            step *= 2
        yield order[first:last]
        first = last


@dataclass
class LanguageModel:
    languages: list[str]
    model: np.ndarray
    path: str

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability (all languages alike before) of each text."""
        if not self.languages:
            return [UNDETERMINED] * len(column), np.zeros(len(column))
        book, names, scores = pieces(self.path), [], []
        short = plain_bytes(self.model)
        for block in word_blocks(column, LETTERS, SHARD_BYTES):
            starts, ends, row = block.starts, block.ends, block.row_of_word()
            _, first, inverse = np.unique(block.stretch(starts, ends), return_index=True, return_inverse=True)
            likelihood = np.empty((len(first), len(self.languages)))
            length = ends[first] - starts[first]
            plain = np.flatnonzero(length <= short)
            for part in passes(length[plain], len(self.languages)):
                part = plain[part]
                words = Words(book, block.data, starts[first[part]], ends[first[part]])
                likelihood[part] = words.log_likelihoods(self.model)
            for k in np.flatnonzero(length > short):
                likelihood[k] = LongWord(book, block.word(first[k])).log_likelihood(self.model)
            total = np.stack([np.bincount(row, likelihood[inverse, k], minlength=block.rows) for k in range(len(self.languages))], 1)
            best = total.argmax(1)
            names += [self.languages[k] for k in best]
            scores.append(1 / np.exp(total - total.max(1, keepdims=True)).sum(1))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def expected_counts(book: Pieces, model: np.ndarray, words: list[bytes], language: np.ndarray, weight: np.ndarray, counts: np.ndarray) -> None:
    """Add to ``counts`` how often each piece is expected in counted words, each of one language."""
    length = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(length)
    starts, data = ends - length, np.frombuffer(b"".join(words), np.uint8)
    short = plain_bytes(model)
    plain = np.flatnonzero(length <= short)
    for part in passes(length[plain], 1):
        part = plain[part]
        Words(book, data, starts[part], ends[part]).expected(model, language[part], weight[part], counts)
    for k in np.flatnonzero(length > short):
        LongWord(book, words[k]).expected(model, int(language[k]), float(weight[k]), counts)


def fit(counted: DataFrame, path: str, rounds: int = ROUNDS) -> LanguageModel:
    """Models of counted words (``lang``, ``word``, ``n``; a written table) by expectation maximisation in
    Spark: each round sends the models to the tasks, which add up the pieces that they expect in their
    own words; only these sums, one per piece and language, come to the driver."""
    spark = counted.sparkSession
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    size = pieces(path).size + 256
    model = np.full((size, len(languages)), 1 / size)
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((model, languages))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            model, languages = sent.value
            book, counts, number = pieces(path), np.zeros_like(model), {x: k for k, x in enumerate(languages)}
            for batch in batches:
                language = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
                expected_counts(book, model, batch.column(1).to_pylist(), language, np.asarray(batch.column(2)).astype(float), counts)
            grains = np.rint(counts * GRAIN).astype(np.int64)
            piece, language = np.nonzero(grains)
            columns = [pa.array(piece, pa.int64()), pa.array(language, pa.int64()), pa.array(grains[piece, language])]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "language", "grains"])

        found = counted.select("lang", "word", "n").mapInArrow(run, "piece long, language long, grains long")
        sums = found.groupBy("piece", "language").agg(F.sum("grains").alias("grains")).toArrow()
        counts = np.full(model.shape, SMOOTHING)
        counts[np.asarray(sums["piece"]), np.asarray(sums["language"])] += np.asarray(sums["grains"]) / GRAIN
        model = counts / counts.sum(0)
        sent.unpersist()
    return LanguageModel(languages, model, path)


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE, path: str | None = None
) -> LanguageModel:
    """Models of all languages from documents with a known language outside fold 1 of 3: all of a
    language that has at most ``sample``, else about so many, those whose id hash is below the
    language's limit. Broadcast are the languages with their numbers of documents, and models: a
    quarter of a megabyte per language. Words are counted and kept in a table; the driver holds models only."""
    small_batches(docs.sparkSession)
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    known = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("body"))
    known = known.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & (fold("id", 3) != 1))
    sizes = known.select("lang", "id").distinct().groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n_ids"))
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))  # from 0 to 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for block in word_blocks(batch.column(1), LETTERS):
                starts, ends, row = block.starts, block.ends, block.row_of_word()
                if len(starts):
                    key = mix(block.stretch(starts, ends) + mix(row.astype(np.uint64)))
                    _, first, many = np.unique(key, return_index=True, return_counts=True)
                    words = [block.data[s:e].tobytes() for s, e in zip(starts[first], ends[first])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(langs[block.first + row[first]].tolist(), pa.string()), pa.array(words, pa.binary()), pa.array(many)],
                        ["lang", "word", "n"],
                    )

    counted = (
        known.join(F.broadcast(sizes), F.col("lang") == F.col("of"))
        .filter(place * F.col("n_ids") < sample)
        .select("lang", "body")
        .mapInArrow(run, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    # in a fixed order, so that sums of doubles inside a task are the same at every run
    return fit(written(counted.sortWithinPartitions("word", "lang"), "language_words"), path)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows with columns ``lang_pred`` and ``score`` (the language's posterior probability).

    Texts that are null or have no letter get ``und`` and 0. Existing columns of these names keep
    their places; the new ones take the next free names. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    name, number = free_name(docs, "lang_pred"), free_name(docs, "score")
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StringType()), T.StructField(number, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = sent.value.predict(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    letters = F.coalesce(F.col(f"`{text}`").cast("string").rlike(r"\p{L}"), F.lit(False))
    predicted = docs.mapInArrow(run, schema)
    return predicted.withColumn(number, F.when(letters & (F.col(name) != UNDETERMINED), F.col(number)).otherwise(0.0)).withColumn(
        name, F.when(letters, F.col(name)).otherwise(UNDETERMINED)
    )


def predictions(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document."""
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )
