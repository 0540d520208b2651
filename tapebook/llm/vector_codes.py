"""Product codes of vectors: each part of a vector is replaced by its nearest entry of a codebook.

Components become integers, so codebooks, codes and errors are exact and the same on any number of
machines. Each round broadcasts the codebooks (parts * entries short vectors, whatever the input),
finds nearest entries with one tree per part and adds up members inside the tasks; what moves is one
row per task, part, entry and position.

Vectors: null ones and those with a null or non-finite component are dropped. The length of the kept
vector of smallest id is the length; vectors of another length, or with a component beyond ``largest``
(errors would not fit a long), stay with a null code and a null error and shape no codebook. Lengths that the parts do not divide are filled up with zeros. Null ids come last, rows of
equal ids in the order of their components. With fewer vectors than entries there are fewer entries.
At most 256 entries, so that two hex digits hold a place. Other columns are left out, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tapebook.operators.skew import lookup_join

from .gnat import Gnat
from .shared import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors that a task codes at a time.
BLOCK = 4096


def largest(length: int) -> int:
    """Integer components stay below this, so that the squared distances of a whole vector add up to less than 2**63."""
    return math.isqrt(((1 << 63) - 1) // max(length, 1)) // 2


@dataclass
class Codebooks:
    length: int
    scale: int
    entries: np.ndarray
    """[part, entry, position]"""
    trees: list[Gnat] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.trees = [Gnat(part) for part in self.entries]

    @property
    def sha256(self) -> str:
        """Of the entries' decimal components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[vector, part]: place of the nearest entry, squared distance."""
        parts, _, width = self.entries.shape
        cut = vectors.reshape(len(vectors), parts, width)
        places, errors = np.zeros((2, len(vectors), parts), np.int64)
        for k, tree in enumerate(self.trees):
            places[:, k], errors[:, k], _ = tree.nearest(np.ascontiguousarray(cut[:, k]))
        return places, errors

    def decode(self, codes: list[str]) -> np.ndarray:
        """Vectors (in the scale of the input) that codes stand for."""
        parts = len(self.entries)
        places = np.array([[int(c[2 * k : 2 * k + 2], 16) for k in range(parts)] for c in codes], np.int64).reshape(-1, parts)
        out = self.entries[np.arange(parts), places].reshape(len(codes), -1)
        return out[:, : self.length] / self.scale


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat components of an array column as doubles (null as NaN), start of each row, length of each row (-1 for null)."""
    column = column.cast(pa.large_list(pa.float64()))
    starts = column.offsets.to_numpy()[:-1]
    lengths = np.diff(column.offsets.to_numpy())
    lengths[np.asarray(column.is_null())] = -1
    return column.values.to_numpy(zero_copy_only=False), starts, lengths


def _usable(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    body = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(body, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), body.alias("vector"), F.col(f"`{label}`").alias("label"))
    return named.filter(F.coalesce(finite, F.lit(False)))


def _integers(column: pa.Array, length: int, scale: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the length and no component too large, and their integer components, filled up with zeros."""
    flat, starts, lengths = _vectors(column)
    fits = np.flatnonzero(lengths == length)
    scaled = flat[starts[fits, None] + np.arange(length)] * scale if length else np.zeros((len(fits), 0))
    small = (np.abs(scaled) < largest(length)).all(1)
    out = np.zeros((int(small.sum()), -(-length // parts) * parts), np.int64)
    out[:, :length] = np.floor(scaled[small])
    return fits[small], out


def fit(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks:
    """Codebooks of all usable vectors.

    Entries start as the parts of the first vectors by id; each round gives every part to its nearest
    entry (of equally near ones the first) and moves entries to their members' mean, rounded down. All
    sums are of integers. Only the first ``entries`` vectors and sums per entry reach the driver.
    """
    kept = _usable(vectors, vec_id, vector, label)
    spark = kept.sparkSession
    in_order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*in_order).limit(1).collect()
    length = len(first[0].vector) if first else 0
    fitting = kept.filter((F.size("vector") == length) & F.forall("vector", lambda x: F.abs(x * scale) < largest(length)))
    seeds = pa.array([r.vector for r in fitting.orderBy(*in_order).limit(entries).collect()], pa.list_(pa.float64()))
    _, start = _integers(seeds, length, scale, parts)
    width = start.shape[1] // parts
    books = Codebooks(length, scale, start.reshape(len(start), parts, width).transpose(1, 0, 2).copy())
    for _ in range(rounds if len(start) else 0):
        sent = spark.sparkContext.broadcast(books)

        def add_up(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            books = sent.value
            count, many, width = books.entries.shape
            members, sums = np.zeros((count, many), np.int64), np.zeros((count, many, width), np.int64)
            for batch in batches:
                for k in range(0, len(batch), BLOCK):
                    _, rows = _integers(batch.column(0).slice(k, BLOCK), books.length, books.scale, count)
                    places, _ = books.assign(rows)
                    for part in range(count):
                        np.add.at(sums[part], places[:, part], rows[:, part * width : (part + 1) * width])
                        members[part] += np.bincount(places[:, part], minlength=many)
            part, entry = np.nonzero(members)
            columns = [part, entry, members[part, entry], pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "n", "sums"])

        found = fitting.select("vector").mapInArrow(add_up, "part long, entry long, n long, sums array<long>")
        total = found.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[k]) for k in range(width)]).alias("sums")
        )
        moved = books.entries.copy()
        for r in total.collect():
            moved[r.part, r.entry] = [s // r.n for s in r.sums]
        books = Codebooks(length, scale, moved)
        sent.unpersist()
    return books


def encode(vectors: DataFrame, books: Codebooks, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` (squared distances summed over parts) of every kept vector."""
    kept = _usable(vectors, vec_id, vector, label)
    sent = kept.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([*kept.select("vec_id", "label").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    digits = np.array([f"{k:02x}" for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        count = len(books.entries)
        for batch in batches:
            codes, errors = np.full(len(batch), None, object), np.full(len(batch), -1, np.int64)
            for k in range(0, len(batch) if books.entries.shape[1] else 0, BLOCK):
                at, rows = _integers(batch.column(1).slice(k, BLOCK), books.length, books.scale, count)
                places, off = books.assign(rows)
                text = digits[places]
                codes[k + at] = ["".join(t) for t in text]
                errors[k + at] = off.sum(1)
            coded = [pa.array(codes, pa.string()), pa.array(errors, pa.int64(), mask=errors < 0)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *coded], schema.names)

    return kept.mapInArrow(run, schema)


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", **sizes: int
) -> DataFrame:
    """Codes and errors of all kept vectors, with the error summed over equal labels (nulls together)
    and the digest of the codebooks.

    Codes are written once; errors are added up per label inside tasks, and a hot label is dealt out.
    """
    books = fit(vectors, vec_id, vector, label, **sizes)
    coded = written(encode(vectors, books, vec_id, vector, label), "vector_codes")
    by_label = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    summed = lookup_join(coded, by_label, ["label"], spread_by=["vec_id"], hot_rows=100_000)
    return summed.withColumn("codebooks_sha256", F.lit(books.sha256))
