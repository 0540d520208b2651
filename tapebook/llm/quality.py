"""Quality of texts by Bradley-Terry ranking: a score learned from pairs of a better and a worse text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .labelled import class_counts, fold, known_labels
from .shared import free_name, small_batches, written
from .words import NOT_SPACE, Block, mix, word_blocks

#: Preference pairs of few texts; of many, partners that each text of the larger class has at least.
PAIRS, PARTNERS = 40_000, 4
#: Texts of a block, inside of which pairs are made, and texts of the smaller class that a block has about.
BLOCK_TEXTS, BLOCK_LEAST = 4096, 64
#: Bits by which sums are scaled to integers (their order then makes no difference), bits of a number's
#: place that quantiles are counted by, steps of the scores among which the threshold is sought.
SUM_BITS, PLACE_BITS, CUTS = 24, 22, 1024
#: Newton steps at most, slices in which their sums are added up, the weight of the ridge.
STEPS, SLICES, RIDGE = 25, 16, 1e-4
#: Steps of each measure's scale.
BINS = 32
#: A document counts as good from this score on.
GOOD = 0.3

FEATURES = (
    "symbols", "exclamation", "bars", "upper", "digits", "other_signs", "full_stops", "word_bytes", "longest_word",
    "words", "repeated_neighbours", "repeated_words", "repeated_runs", "lines", "beyond_ascii",
)


def _table(text: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in text]] = True
    return table


_SYMBOLS, _EXCLAIM, _BAR, _STOP, _LINE = map(_table, ("#$%&*", "!", "|", ".", "\n"))
_UPPER, _DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_SIGNS = _table("\"'()+,-/:;<=>?@[\\]^_`{}~")
_BEYOND = np.zeros(256, bool)
_BEYOND[128:] = True


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Different values of each row."""
    _, first = np.unique(mix(values + mix(row.astype(np.uint64))), return_index=True)
    return np.bincount(row[first], minlength=rows)


def measures(block: Block) -> np.ndarray:
    """One line of ``FEATURES`` per row; shares of nothing are 0."""
    ends = np.diff(block.offsets)
    size = np.maximum(ends, 1)
    words = np.maximum(block.counts, 1)

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[block.raw])])
        return np.diff(sums[block.offsets]) / size

    hashes, row = block.hashes(), block.row_of_word()
    length = block.ends - block.starts
    longest = np.zeros(block.rows)
    np.maximum.at(longest, row, length)
    same = np.zeros(len(row), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    runs = hashes[: max(0, len(hashes) - 2)]
    if len(runs):
        whole = row[2:] == row[:-2]
        triples = mix(mix(runs * np.uint64(3) + hashes[1:-1]) + hashes[2:])[whole]
        run_row = row[:-2][whole]
    else:
        triples, run_row = runs, row[:0]
    triple_count = np.bincount(run_row, minlength=block.rows)
    columns = [
        share(_SYMBOLS), share(_EXCLAIM), share(_BAR), share(_UPPER), share(_DIGIT), share(_SIGNS), share(_STOP),
        np.bincount(row, length, minlength=block.rows) / words,
        np.log1p(longest),
        np.log1p(block.counts),
        np.bincount(row, same, minlength=block.rows) / words,
        (block.counts - _distinct(hashes, row, block.rows)) / words,
        (triple_count - _distinct(triples, run_row, block.rows)) / np.maximum(triple_count, 1),
        share(_LINE), share(_BEYOND),
    ]
    return np.stack(columns, 1)


def _column_measures(column: pa.Array) -> np.ndarray:
    parts = [measures(block) for block in word_blocks(column, NOT_SPACE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class QualityModel:
    """Steps of each measure, the worth of each step, the raw score that divides good from bad."""

    steps: list[np.ndarray]
    worth: list[np.ndarray]
    threshold: float
    constant: float | None = None

    @staticmethod
    def _places(steps: list[np.ndarray], measured: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(s, measured[:, k], side="right") for k, s in enumerate(steps)], 1)

    def raw(self, measured: np.ndarray) -> np.ndarray:
        places = self._places(self.steps, measured)
        return sum((w[places[:, k]] for k, w in enumerate(self.worth)), np.zeros(len(measured)))

    def scores(self, column: pa.Array) -> np.ndarray:
        measured = _column_measures(column)
        if self.constant is not None:
            return np.full(len(measured), self.constant)
        logit = self.raw(measured) - self.threshold + math.log(GOOD / (1 - GOOD))
        # the threshold itself must not fall below GOOD by rounding
        return np.clip(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0, 1)


def fit(measured: np.ndarray, label: np.ndarray, shares: tuple[int, int], pairs: int = PAIRS) -> QualityModel:
    """The model of rows at hand, by sampled pairs; ``learn`` does the same over a table, with all its texts.

    Bradley-Terry: the chance that one text is preferred is a logistic function of the difference of
    their scores. A score adds up the worth of the step that each measure falls in. The threshold is
    the quantile of the scores that divides the labelled texts best, with classes weighed as in
    ``shares`` (labelled bad and good texts)."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        constant = (shares[1] + 1) / (sum(shares) + 2)
        return QualityModel([], [], 0.0, constant)
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    half = [np.concatenate([np.quantile(measured[good, k], quantiles), np.quantile(measured[bad, k], quantiles)]) for k in range(measured.shape[1])]
    steps = [np.unique(h) for h in half]
    places = QualityModel._places(steps, measured)
    base = np.concatenate([[0], np.cumsum([len(s) + 1 for s in steps])])
    places = places + base[:-1]
    rng = np.random.default_rng(7)
    better, worse = rng.choice(good, pairs), rng.choice(bad, pairs)
    worth, past = np.zeros(base[-1]), np.full(base[-1], 1e-9)
    for _ in range(300):
        score = worth[places].sum(1)
        wrong = 1 / (1 + np.exp(np.clip(score[better] - score[worse], -30, 30)))  # chance of the other preference
        pull = np.bincount(better, wrong, minlength=len(label)) - np.bincount(worse, wrong, minlength=len(label))
        slope = np.bincount(places.ravel(), np.repeat(pull, places.shape[1]), minlength=base[-1]) / pairs - 1e-4 * worth
        past += slope**2
        worth += 0.3 * slope / np.sqrt(past)
    score = worth[places].sum(1)
    weight = np.where(label == 1, shares[1] / len(good), shares[0] / len(bad))
    order = np.argsort(score, kind="stable")
    ranked, lost = score[order], np.cumsum(np.where(label[order] == 1, weight[order], -weight[order]))
    mistakes = np.concatenate([[0], lost])  # relative to calling all good: bad ones below the cut are right
    cuts = np.concatenate([[ranked[0] - 1], (ranked[1:] + ranked[:-1]) / 2, [ranked[-1] + 1]])
    usable = np.concatenate([[True], ranked[1:] > ranked[:-1], [True]])
    best = mistakes[usable].min()
    ties = cuts[usable][mistakes[usable] <= best + 1e-9]
    return QualityModel(steps, [worth[a:b] for a, b in zip(base[:-1], base[1:])], float(np.median(ties[[0, -1]])) if len(ties) > 1 else float(ties[0]))


def measured_labels(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(labelled_id, label, measured) of all labelled texts outside fold 0; measures move, texts don't."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("labelled_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.filter(F.col("labelled_id").isNotNull() & (fold("labelled_id", 5) != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            measured = pa.array([m.tobytes() for m in _column_measures(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), measured], ["labelled_id", "measured"])

    schema = T.StructType([rows.schema["labelled_id"], T.StructField("measured", T.BinaryType())])
    return written(rows.mapInArrow(run, schema).join(known_labels(labels, "quality", doc_id), "labelled_id"), "measured")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(-1, len(FEATURES))


def steps_of(measured: DataFrame) -> list[np.ndarray]:
    """Steps of each measure: quantiles of all good and of all bad texts, counted by a number's leading bits."""
    shift = 64 - PLACE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = (_matrix(batch.column(1)) + 0.0).view(np.uint64) >> np.uint64(shift)  # no measure is negative
            label, kinds = batch.column(0).to_numpy(), np.arange(len(FEATURES), dtype=np.uint64)
            key = (place << np.uint64(8)) + kinds * np.uint64(2) + label.astype(np.uint64)[:, None]
            keys, counts = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], ["key", "n"])

    counted = measured.select("label", "measured").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = np.array([(r.key, r.n) for r in counted.orderBy("key").collect()], np.int64).reshape(-1, 2)
    steps, wanted = [], np.linspace(0, 1, BINS + 1)[1:-1]
    for k in range(len(FEATURES)):
        parts = []
        for label in (0, 1):
            own = found[(found[:, 0] & 255) == 2 * k + label]
            sums = np.cumsum(own[:, 1])
            at = np.searchsorted(sums, wanted * sums[-1], side="right").clip(max=len(own) - 1)
            parts.append(((own[at, 0] >> 8).astype(np.uint64) << np.uint64(shift)).view(float))
        steps.append(np.unique(np.concatenate(parts)))
    return steps


def _pairs(label: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Better and worse texts of a block's pairs, in which all its texts take part."""
    rng = np.random.default_rng(7)
    good, bad = rng.permutation(np.flatnonzero(label == 1)), rng.permutation(np.flatnonzero(label == 0))
    more, fewer = (good, bad) if len(good) >= len(bad) else (bad, good)
    if not len(fewer):
        return good[:0], bad[:0]
    partners = min(len(fewer), max(PARTNERS, -(-PAIRS // (blocks * len(more)))))
    shifts = rng.permutation(len(fewer))[:partners]
    first = np.tile(more, partners)
    second = np.concatenate([fewer[(np.arange(len(more)) + s) % len(fewer)] for s in shifts])
    return (first, second) if more is good else (second, first)


def _blocks(measured: DataFrame, steps: list[np.ndarray], blocks: int) -> DataFrame:
    """The labels and places of all texts, one row per block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("label", "ascending"), ("measured", "ascending")]).combine_chunks()
        places = QualityModel._places(steps, _matrix(table["measured"])).astype(np.uint8)
        label = table["label"].to_numpy().astype(np.uint8)
        return pa.table({"label": pa.array([label.tobytes()], pa.binary()), "places": pa.array([places.tobytes()], pa.binary())})

    rows = measured.select(F.pmod(F.xxhash64("labelled_id"), F.lit(blocks)).alias("block"), F.xxhash64("labelled_id", F.lit(1)).alias("order"), "label", "measured")
    return written(rows.groupBy("block").applyInArrow(run, "label binary, places binary"), "places")


def _read_blocks(batch: pa.RecordBatch, base: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for label, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        yield np.frombuffer(label, np.uint8), np.frombuffer(places, np.uint8).reshape(-1, len(FEATURES)) + base


def _pair_sums(texts: DataFrame, base: np.ndarray, size: int, worth: np.ndarray, blocks: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss of all pairs, its gradient and second derivatives."""
    scale = float(1 << SUM_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + size + size * size, np.int64)
        for batch in batches:
            for label, places in _read_blocks(batch, base):
                score = worth[places].sum(1)
                better, worse = _pairs(label, blocks)
                for k in range(0, len(better), 4096):
                    b, w = better[k : k + 4096], worse[k : k + 4096]
                    gap = score[b] - score[w]
                    wrong = 1 / (1 + np.exp(np.clip(gap, -30, 30)))  # chance of the other preference
                    apart = np.zeros((len(b), size), np.float32)
                    row = np.arange(len(b))[:, None]
                    apart[row, places[b]] += 1
                    apart[row, places[w]] -= 1
                    bend = apart.T @ (apart * (wrong * (1 - wrong)).astype(np.float32)[:, None])
                    sums = np.concatenate([[len(b), np.logaddexp(0, -gap).sum()], -(wrong.astype(np.float32) @ apart), bend.ravel()])
                    total += np.rint(sums * scale).astype(np.int64)
        bodies = [x.tobytes() for x in np.array_split(total, SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(bodies, pa.binary())], ["slice", "body"])

    def add(table: pa.Table) -> pa.Table:
        body = sum(np.frombuffer(x.as_py(), np.int64) for x in table["body"])
        return pa.table({"slice": table["slice"][:1], "body": pa.array([body.tobytes()], pa.binary())})

    found = texts.mapInArrow(run, "slice int, body binary").groupBy("slice").applyInArrow(add, "slice int, body binary").collect()
    sums = np.concatenate([np.frombuffer(bytes(r["body"]), np.int64) for r in sorted(found, key=lambda r: r["slice"])]) / scale
    mean = sums[1:] / sums[0]
    return float(mean[0]), mean[1 : 1 + size], mean[1 + size :].reshape(size, size)


def _threshold(texts: DataFrame, base: np.ndarray, worth: np.ndarray, shares: tuple[int, int]) -> float:
    """The cut between steps of the scores of all texts that divides them best, with classes weighed as in ``shares``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, places in _read_blocks(batch, base):
                key = np.floor(worth[places].sum(1) * CUTS).astype(np.int64) * 2 + label
                keys, counts = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    counted = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()
    key, n = (np.array(x, np.int64) for x in zip(*counted))
    ranked, place = np.unique(key >> 1, return_inverse=True)
    many = [np.bincount(place, np.where(key % 2 == y, n, 0), minlength=len(ranked)) for y in (0, 1)]
    lost = np.cumsum(many[1] * shares[1] / many[1].sum() - many[0] * shares[0] / many[0].sum())
    mistakes = np.concatenate([[0], lost])  # relative to calling all good: bad ones below the cut are right
    cuts = np.concatenate([[ranked[0] - 1], (ranked[1:] + ranked[:-1] + 1) / 2, [ranked[-1] + 2]]) / CUTS
    ties = cuts[mistakes <= mistakes.min() + 1e-9]
    return float((ties[0] + ties[-1]) / 2)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> QualityModel:
    """A model from all labels (``doc_id``, ``quality``) outside fold 0. Steps, preference pairs and the
    threshold take in every labelled text; sums of tasks alone reach the driver. It is the same model
    however the rows are partitioned."""
    small_batches(docs.sparkSession)
    shares = class_counts(labels, "quality", doc_id)
    measured = measured_labels(docs, labels, text, doc_id)
    texts = {r.label: r.n for r in measured.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(texts) < 2:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, int), shares)
    steps = steps_of(measured)
    blocks = max(1, min(sum(texts.values()) // BLOCK_TEXTS, min(texts.values()) // BLOCK_LEAST))
    placed = _blocks(measured, steps, blocks)
    base = np.concatenate([[0], np.cumsum([len(s) + 1 for s in steps])])
    first, size = base[:-1], int(base[-1])
    best, lowest, worth = np.zeros(size), np.inf, np.zeros(size)
    for _ in range(STEPS):
        loss, slope, bend = _pair_sums(placed, first, size, worth, blocks)
        loss += RIDGE / 2 * float(worth @ worth)
        if loss > lowest:
            worth = (best + worth) / 2  # too far
            continue
        best, lowest = worth, loss
        slope = slope + RIDGE * best
        way = np.linalg.solve(bend + RIDGE * np.eye(size), slope)
        if slope @ way < 1e-6:
            break
        worth = best - way
    return QualityModel(steps, [best[a:b] for a, b in zip(base[:-1], base[1:])], _threshold(placed, first, best, shares))


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows with one more column ``score`` (0 to 1, higher: more likely good; from ``GOOD`` on a
    text counts as good). Null counts as empty; an existing ``score`` keeps its place and the new one
    takes the next free name. An empty table gives no rows."""
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


def predictions(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
