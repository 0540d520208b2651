"""Ranked lexical search that scores every distinct bag of words once.

Only terms of the searched items can add to a score, so each document is restricted to them: its bag is
its terms' counts. Its score for any item then follows from the bag and a length weight m, and all
documents with the same bag and m form a class. Classes are found by a hash of both and verified by
comparing both; each class is scored once, and the best classes are expanded to their members by
ascending id. A class sends at most ``top`` ids, since no item can list more of its members.

Whole texts are read, once. What moves is one packed bag per document and class candidates; the corpus
totals and one document frequency per item term reach the driver. Items come in blocks of bounded
text, one pass each, so the broadcast vocabulary is bounded whatever their number.

Terms are compared by 64-bit hashes of their bytes, and ``PRODUCTS`` bounds what a task holds at a time. Null texts have no terms; null ids rank behind other ids of the
same score; rows of equal ids are documents of their own. An item that is null, empty or without known terms
has no rows. Items of equal ids are searched each by themselves; a null item id stays null, or is '' among texts. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .contamination import item_blocks
from .shared import small_batches, written
from .words import ALNUM, HashSet, word_blocks

TOP = 10
#: Length normalisation: m is FLAT + (SLOPE * n * N) div L.
FLAT, SLOPE = 10, 90
#: (class, item) cells, and about so many (term of a class, item) products, of one pass.
CELLS, PRODUCTS = 1 << 22, 1 << 20


@dataclass
class Vocabulary:
    """Terms of some items, in order of their hashes, and the items that hold each."""

    items: list
    known: HashSet
    bounds: np.ndarray
    """index of each term's first holder, and the end"""
    holders: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[str, str]]) -> Vocabulary:
        column = pa.array([t for _, t in items], pa.string())
        hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for block in word_blocks(column, ALNUM):
            hashes.append(block.hashes())
            rows.append(block.first + block.row_of_word())
        known = HashSet(np.concatenate(hashes))
        place = np.searchsorted(known.values, np.concatenate(hashes))
        at, holder = np.divmod(np.unique(place * max(len(items), 1) + np.concatenate(rows)), max(len(items), 1))
        bounds = np.searchsorted(at, np.arange(len(known.values) + 1))
        return cls([i for i, _ in items], known, bounds, holder)


def bags(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats) and ``bag`` of every document with a term: the places of the
    item terms it holds, ascending, and their counts, as little-endian 64-bit integers (empty for none)."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(words)
    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("bag")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value.known
        for batch in batches:
            for block in word_blocks(batch.column(1), ALNUM):
                rows = np.flatnonzero(block.counts)
                if not rows.size:
                    continue
                at, place = known.find(block.hashes())
                key, count = np.unique(block.row_of_word()[at] * (len(known.values) + 1) + place, return_counts=True)
                owner, place = np.divmod(key, len(known.values) + 1)
                packed = np.stack([place, count], 1).astype("<i8").tobytes()
                bounds = np.searchsorted(owner, np.arange(block.rows + 1)) * 16
                found = [packed[bounds[r] : bounds[r + 1]] for r in rows]
                ids = batch.column(0).take(pa.array(block.first + rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(block.counts[rows], pa.int64()), pa.array(found, pa.binary())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Corpus:
    documents: int
    terms: int
    weights: np.ndarray
    """of each item term"""


def statistics(found: DataFrame, words: Vocabulary) -> Corpus:
    """Documents and terms in all, and each item term's weight floor(1000 * ln((2N + 2) / (2 df + 1)))."""
    size = len(words.known.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.zeros(size, np.int64)
        for batch in batches:
            # bags are few per batch and flat in memory; a place occurs once in a bag
            places = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")[::2]
            frequency += np.bincount(places, minlength=size)
        at = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(frequency[at])], ["place", "df"])

    totals = found.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    frequency = np.zeros(size, np.int64)
    for r in found.select("bag").mapInArrow(run, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).collect():
        frequency[r.place] = r.df
    weights = [math.floor(1000 * math.log((2 * totals.docs + 2) / (2 * int(df) + 1))) for df in frequency]
    return Corpus(totals.docs, totals.terms, np.array(weights, np.int64))


def classes(found: DataFrame, corpus: Corpus, top: int = TOP) -> DataFrame:
    """``bag``, ``m`` and the ``top`` smallest ids (ascending, nulls last) of each class with an item term.

    Rows meet by the hash of bag and m, and are one class if both are equal as well. Tasks keep
    ``top`` rows per class before anything moves, so a class of a third of all rows costs little more.
    """
    terms = max(corpus.terms, 1)
    m = F.lit(FLAT).cast("long") + F.expr(f"({SLOPE}L * n * {corpus.documents}L) div {terms}L")
    keyed = found.filter(F.length("bag") > 0).select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    same = W.partitionBy("hash", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    first = keyed.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= top)
    members = F.transform(F.array_sort(F.collect_list(F.struct("nth", "doc_id"))), lambda x: x["doc_id"])
    return first.groupBy("hash", "m", "bag").agg(members.alias("members")).select("bag", "m", "members")


class Best:
    """The best classes of each item so far: by score, then smallest id."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.members: list = []
        self.least = np.zeros(items, np.int64)
        """what a class must reach to be listed"""

    def add(self, item: np.ndarray, score: np.ndarray, first: np.ndarray, members: list) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        first, members = np.concatenate([self.first, first]), self.members + members
        order = np.lexsort((first, -score, item))
        heads = np.searchsorted(item[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - heads[item[order]]
        kept = order[rank < self.top]
        self.item, self.score, self.first = item[kept], score[kept], first[kept]
        self.members = [members[i] for i in kept]
        full = order[rank == self.top - 1]
        self.least[item[full]] = score[full]


def scores(bag: np.ndarray, owner: np.ndarray, m: np.ndarray, words: Vocabulary, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, item and score of all pairs that share a term; ``bag`` lists (place, count) class by class."""
    place, count = bag[:, 0], bag[:, 1]
    part = weights[place] * ((1_000_000_000 * count) // (1000 * count + 8 * m[owner]))
    holders = np.diff(words.bounds)[place]
    at = np.repeat(words.bounds[place] - (np.cumsum(holders) - holders), holders) + np.arange(holders.sum())
    pair = np.repeat(owner, holders) * len(words.items) + words.holders[at]
    total = np.zeros(len(m) * len(words.items), np.int64)
    np.add.at(total, pair, np.repeat(part, holders))
    hit = np.flatnonzero(total > 0)
    return hit // len(words.items), hit % len(words.items), total[hit]


def rank(found: DataFrame, words: Vocabulary, corpus: Corpus, top: int = TOP) -> DataFrame:
    """``item`` (its place among the items), ``rank``, ``doc_id`` and ``score`` of each item's best documents.

    Tasks score their classes and keep the ``top`` best ones per item: a document of a further class has
    that many documents before it, the first members of those classes.
    """
    spark = found.sparkSession
    sent = spark.sparkContext.broadcast((words, corpus.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = sent.value
        best = Best(len(words.items), top)
        holders = np.diff(words.bounds)
        most = max(1, CELLS // max(len(words.items), 1))
        for batch in batches:
            packed, members, m = batch.column(0).to_pylist(), batch.column(2).to_pylist(), np.asarray(batch.column(1))
            bag = np.frombuffer(b"".join(packed), "<i8").reshape(-1, 2)
            sizes = np.array([len(p) // 16 for p in packed], np.int64)
            owner = np.repeat(np.arange(len(packed)), sizes)
            work = np.cumsum(np.bincount(owner, holders[bag[:, 0]], minlength=len(packed)))
            ends = np.cumsum(sizes)
            k = 0
            while k < len(packed):
                done = work[k - 1] if k else 0
                end = min(k + most, max(k + 1, int(np.searchsorted(work, done + PRODUCTS, side="right"))), len(packed))
                at = slice(ends[k] - sizes[k], ends[end - 1])
                which, item, score = scores(bag[at], owner[at] - k, m[k:end], words, weights)
                good = np.flatnonzero(score >= best.least[item])
                which, item, score = which[good] + k, item[good], score[good]
                # a null id ranks behind all
                first = np.array([np.iinfo(np.int64).max if members[i][0] is None else members[i][0] for i in which], np.int64)
                best.add(item, score, first, [members[i] for i in which])
                k = end
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.score), pa.array(best.members, pa.list_(pa.int64()))], ["item", "score", "members"]
        )

    chosen = classes(found, corpus, top)
    listed = chosen.mapInArrow(run, "item long, score long, members array<long>")
    documents = listed.select("item", "score", F.explode("members").alias("doc_id"))
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = documents.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``top`` best documents of every item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(items):
        words = Vocabulary.of(block)
        found = written(bags(docs, words), "bags")
        ranked = rank(found, words, statistics(found, words), top)
        names = spark.createDataFrame(list(enumerate(words.items)), "item long, name string")
        part = ranked.join(F.broadcast(names), "item").withColumn("item_id", F.col("name").try_cast(kind))
        result = result.unionByName(part.select(*result.columns))
    return result
