"""Benchmark passages in training documents, found with suffix arrays of the training words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .shared import free_name, small_batches, written
from .words import ALNUM, HashSet, mix, string_column, word_blocks

#: A passage of so many words counts; a shorter item counts as a whole.
WINDOW = 13
#: Bytes of text of one shard, which has one suffix array.
SHARD_BYTES = 4 << 20
#: Benchmark text is searched in blocks of at most about so many bytes, which every task holds.
ITEM_BLOCK_BYTES = 16 << 20
#: Matches that grow at a time.
MATCHES = 1 << 18

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def _pairs(words: np.ndarray) -> np.ndarray:
    """A hash of each word and its follower."""
    return mix(words[:-1] * _PAIR + words[1:])


@dataclass
class TestItems:
    """All words of a block of benchmark items, one after the other."""

    ids: list[str]
    words: np.ndarray
    item: np.ndarray
    """item of each word"""
    left: np.ndarray
    """words from here to the item's end"""
    need: np.ndarray
    """words of a window of the item"""
    singles: HashSet
    pairs: HashSet
    """how the windows begin: a word that is a window, or two words"""

    @classmethod
    def build(cls, rows: list[tuple[str, str | None]]) -> TestItems:
        texts = string_column(pa.array([t for _, t in rows], pa.string()))
        words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for block in word_blocks(texts, ALNUM):
            words.append(block.hashes())
            counts.append(block.counts)
        words, counts = np.concatenate(words), np.concatenate(counts)
        item = np.repeat(np.arange(len(counts)), counts)
        left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
        need = np.repeat(np.minimum(counts, WINDOW), counts)
        begins = left >= need
        alone = begins & (need == 1)
        two = np.flatnonzero(begins & (need > 1))
        pairs = mix(words[two] * _PAIR + words[two + 1]) if two.size else words[:0]
        return cls([i for i, _ in rows], words, item, left, need, HashSet(words[alone]), HashSet(pairs))


class SuffixArray:
    """Word suffixes of a shard in the order of their first ``WINDOW`` words.

    Only suffixes are held that begin as some test window does; the others match no window. Words are
    compared by 64-bit hashes, and a text's end by 0.
    """

    def __init__(self, words: np.ndarray, row_end: np.ndarray, places: np.ndarray):
        self.words, self.row_end = words, row_end
        columns = np.zeros((WINDOW, len(places)), np.uint64)
        for depth in range(WINDOW):
            at = places + depth
            inside = at < row_end[places]
            columns[depth, inside] = words[at[inside]]
        # Suffixes that begin alike are ordered by the word before them, 0 for none.
        before = np.zeros(len(places), np.uint64)
        inner = np.flatnonzero(places > 0)
        inner = inner[row_end[places[inner] - 1] == row_end[places[inner]]]
        before[inner] = words[places[inner] - 1]
        order = np.lexsort([before, *columns[::-1]])
        self.places, self.columns, self.before = places[order], columns[:, order], before[order]

    def _bound(self, column: np.ndarray, low: np.ndarray, high: np.ndarray, word: np.ndarray, after: bool) -> np.ndarray:
        """For each range, in which ``column`` ascends, its first suffix whose word there is not below (or is above) ``word``."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            value = column[np.minimum(mid, len(column) - 1)]
            right = open_ & ((value <= word) if after else (value < word))
            high = np.where(open_ & ~right, mid, high)
            low = np.where(right, mid + 1, low)
        return low

    def search(self, tests: TestItems) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Test suffixes and the ranges of the array where their windows occur, but for places where a match
        could begin one word earlier: place in the test words, first and last suffix (behind).

        Each suffix's range is narrowed word by word until its window is used up. Within the range of a
        whole window, suffixes are ordered by the word before; those with the same word before as in the
        item are part of a longer match and left out as a range, however many they are.
        """
        query = np.flatnonzero(tests.left >= tests.need)
        low = np.zeros(len(query), np.int64)
        high = np.full(len(query), len(self.places), np.int64)
        found = []
        for depth in range(WINDOW):
            word, column = tests.words[query + depth], self.columns[depth]
            low, high = self._bound(column, low, high, word, False), self._bound(column, low, high, word, True)
            alive = low < high
            query, low, high = query[alive], low[alive], high[alive]
            done = tests.need[query] == depth + 1
            found.append((query[done], low[done], high[done]))
            query, low, high = query[~done], low[~done], high[~done]
            if not query.size:
                break
        query, low, high = map(np.concatenate, zip(*found))
        # Only whole items are shorter than a window, and they have no word before.
        inner = np.flatnonzero(query > 0)
        inner = inner[tests.item[query[inner] - 1] == tests.item[query[inner]]]
        word = tests.words[query[inner] - 1]
        same = self._bound(self.before, low[inner], high[inner], word, False)
        more = self._bound(self.before, low[inner], high[inner], word, True)
        rest = query[inner], more, high[inner].copy()
        high[inner] = same
        query, low, high = (np.concatenate(x) for x in zip((query, low, high), rest))
        some = low < high
        return query[some], low[some], high[some]

    def longest(self, tests: TestItems) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Longest verbatim matches, a bounded number at a time: place in the test words, place in the
        shard, words."""
        query, low, high = self.search(tests)
        total = np.cumsum(high - low)
        for first in range(0, int(total[-1]) if len(total) else 0, MATCHES):
            number = np.arange(first, min(first + MATCHES, int(total[-1])))
            which = np.searchsorted(total, number, side="right")
            yield self._grown(tests, query[which], self.places[high[which] - (total[which] - number)])

    def _grown(self, tests: TestItems, query: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = tests.need[query].copy()
        most = np.minimum(tests.left[query], self.row_end[place] - place)
        growing = np.flatnonzero(length < most)
        while growing.size:
            same = tests.words[query[growing] + length[growing]] == self.words[place[growing] + length[growing]]
            growing = growing[same]
            length[growing] += 1
            growing = growing[length[growing] < most[growing]]
        return query, place, length


MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
_MATCH_ARROW = pa.list_(
    pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
)


def _search_column(column: pa.Array, tests: TestItems) -> tuple[list[int], list[list[dict]]]:
    """Words and longest matches of each row of a text column."""
    counts: list[int] = []
    matches: list[list[dict]] = []
    test_start = np.arange(len(tests.words)) - np.searchsorted(tests.item, tests.item) if len(tests.words) else None
    for block in word_blocks(column, ALNUM, SHARD_BYTES):
        counts += block.counts.tolist()
        found: list[list[dict]] = [[] for _ in range(block.rows)]
        matches += found
        words = block.hashes()
        row = block.row_of_word()
        row_end = block.bounds[1:][row]
        begin = tests.singles.find(words)[0]
        if len(words) > 1:
            pair = tests.pairs.find(_pairs(words))[0]
            begin = np.union1d(begin, pair[pair + 1 < row_end[pair]])
        if not begin.size:
            continue
        for some in SuffixArray(words, row_end, begin).longest(tests):
            for query, place, length in zip(*some):
                r = row[place]
                found[r].append(
                    {
                        "item_id": tests.ids[tests.item[query]],
                        "item_start": int(test_start[query]),
                        "start": int(place - block.bounds[r]),
                        "length": int(length),
                    }
                )
    return counts, matches


def item_blocks(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of a checked size; items without words are left out, a null id is ''."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("body")
    ).filter(F.length("body") > 0)
    total = rows.agg(F.sum(F.octet_length("body")).alias("n")).first().n or 0
    blocks = max(1, math.ceil(total / ITEM_BLOCK_BYTES))
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "body"), F.lit(blocks)))
        sizes = dealt.groupBy("block").agg(F.sum(F.octet_length("body")).alias("n"), F.max(F.octet_length("body")).alias("one"))
        worst = sizes.filter((F.col("n") > 2 * ITEM_BLOCK_BYTES) & (F.col("n") > F.col("one"))).limit(1).collect()
        if not worst or blocks > 1 << 16:
            break
        blocks *= 2
    for block in range(blocks):
        yield [(r.id, r.body) for r in dealt.filter(F.col("block") == block).collect()]


def find_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None
) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, by default all) with ``n_words`` and ``matches``.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased.
    A match is a longest run of words common to the document and an item, of at least ``WINDOW``
    words or of a whole shorter item: its item, where it begins in the item and in the document (in
    words), and its length. Null and empty texts have no words; an empty benchmark matches nothing;
    repeated rows and items are answered each. Documents are searched where they are read, without a
    shuffle. A benchmark beyond one block takes one pass for each block.
    """
    spark = small_batches(docs.sparkSession)
    keep = tuple(docs.columns) if keep is None else keep
    count, hits = free_name(docs, "n_words"), free_name(docs, "matches")
    body = text if text in keep else free_name(docs, "_body")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        *[F.col(f"`{text}`").alias(body)] * (body not in keep),
        F.lit(0).cast("long").alias(count),
        F.array().cast(T.ArrayType(MATCH)).alias(hits),
    )
    schema = rows.schema
    at = rows.columns.index(body)

    def one_pass(rows: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(TestItems.build(items))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = sent.value
            for batch in batches:
                counts, matches = _search_column(batch.column(at), tests)
                earlier = batch.column(batch.num_columns - 1).to_pylist()
                joined = [a + b for a, b in zip(earlier, matches)]
                columns = [*batch.columns[:-2], pa.array(counts, pa.int64()), pa.array(joined, _MATCH_ARROW)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return rows.mapInArrow(search, schema)

    first = True
    for items in item_blocks(benchmark):
        rows = one_pass(rows if first else written(rows, "passages"), items)
        first = False
    return rows.select(*[F.col(f"`{c}`") for c in keep], count, hits)


def covered(matches: Column) -> Column:
    """Words of a document inside any of its matches."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["length"]).alias("e"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(
        spans,
        zero,
        lambda done, span: F.struct(
            F.greatest(done["end"], span["e"]).alias("end"),
            (done["sum"] + F.greatest(F.lit(0), span["e"] - F.greatest(done["end"], span["s"]))).alias("sum"),
        ),
        lambda done: done["sum"],
    )


def contaminated(hit: Column, words: Column) -> Column:
    """At least one word in twenty lies in a benchmark passage."""
    return (hit > 0) & (20 * hit >= words)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    marked = find_passages(docs, benchmark, text)
    words, matches = marked.columns[-2:]
    hit = F.when(F.size(matches) > 0, covered(F.col(matches))).otherwise(F.lit(0))
    return marked.filter(~contaminated(hit, F.col(words))).select(*[F.col(f"`{c}`") for c in docs.columns])
