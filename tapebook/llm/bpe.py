"""Byte-level BPE over whole texts, with tree concatenation for long unsplit text."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import free_name, partitions, small_batches

#: Longer texts are dealt out over tasks in pieces.
LONG_CHARS = 1 << 16
#: A piece, and a leaf of unsplit text, has at most so many characters.
LEAF_CHARS = 1 << 14
#: Tokens on each side of a join that are encoded again at first; doubled until both sides agree.
WINDOW = 8


class Codec:
    """A byte-level BPE vocabulary: ranks in the order of merging, and special tokens by their text."""

    def __init__(self, ranks_path: str, json_path: str):
        with open(ranks_path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        with open(json_path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        self.special = {t["content"]: t["id"] for t in added}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.find_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.engine = tiktoken.Encoding(
            "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens=self.special
        )
        table = {i: t for t, i in self.ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.token_bytes = [table.get(i, b"") for i in range(max(table) + 1)]
        self.lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def encode(self, text: str) -> list[int]:
        if self.find_special.search(text):
            return self.engine.encode(text, allowed_special="all")
        return self.engine.encode_ordinary(text)

    def decode(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        index = np.repeat(self.places[ids] - (ends - lengths), lengths) + np.arange(total)
        return self.flat[index].tobytes().decode("utf-8", "replace")

    def merge_bytes(self, body: bytes) -> list[int]:
        """BPE of a short run of bytes that the pattern doesn't split."""
        parts = [body[i : i + 1] for i in range(len(body))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranked)), key=ranked.__getitem__)
            if ranked[at] == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts of unsplit text from their own encodings.

        A sequence of tokens is what BPE gives exactly if every two neighbours are what BPE gives
        for their bytes. So a window around the join is encoded again; once its first token is the
        left side's and its last token the right side's, all neighbours are known to be right.
        """
        size = WINDOW
        while left and right:
            k, m = min(size, len(left)), min(size, len(right))
            window = self.merge_bytes(b"".join(self.token_bytes[i] for i in left[-k:] + right[:m]))
            agree_left = k == len(left) or window[0] == left[-k]
            agree_right = m == len(right) or window[-1] == right[m - 1]
            if agree_left and agree_right:
                return left[:-k] + window + right[m:]
            size *= 2
        return left + right

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """Join neighbours in rounds, as in a binary tree."""
        while len(parts) > 1:
            paired = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = paired + parts[len(paired) * 2 :]
        return parts[0] if parts else []

    def pieces(self, text: str, leaf: int = LEAF_CHARS) -> Iterator[tuple[str, bool]]:
        """Parts of a text, and whether each continues unsplit text of the one before.

        Before white space that follows something else the pattern always splits, whatever stands
        around; so a cut there changes nothing. Only text without such a place is split by the
        pattern itself, and what the pattern keeps whole is cut into leaves.
        """
        start = 0
        for found in self.find_special.finditer(text):
            yield from self._plain_pieces(text[start : found.start()], leaf)
            yield found.group(), False
            start = found.end()
        yield from self._plain_pieces(text[start:], leaf)

    def _plain_pieces(self, text: str, leaf: int) -> Iterator[tuple[str, bool]]:
        def safe(i: int) -> bool:
            return text[i] in " \n\t\r" and not text[i - 1].isspace()

        start = 0
        while len(text) - start > leaf:
            cut = next((i for i in range(start + leaf, start, -1) if safe(i)), None)
            if cut is not None:
                yield text[start:cut], False
                start = cut
                continue
            cut = next((i for i in range(start + leaf + 1, len(text)) if safe(i)), len(text))
            for match in self.pattern.finditer(text[start:cut]):
                run = match.group()
                for i in range(0, len(run), leaf):
                    yield run[i : i + leaf], i > 0
            start = cut
        if start < len(text):
            yield text[start:], False


@lru_cache(maxsize=2)
def codec(ranks_path: str, json_path: str) -> Codec:
    return Codec(ranks_path, json_path)


def vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Paths of a public vocabulary's ranks and of its full description."""
    return public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.path(f"{name}.json")


def _added(with_text: bool) -> list[T.StructField]:
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return fields + [T.StructField("decoded", T.StringType())] * with_text


def _answers(book: Codec, encoded: list[np.ndarray], with_text: bool) -> list[pa.Array]:
    columns = [
        pa.array([len(ids) for ids in encoded], pa.int64()),
        pa.array([ids.tobytes() for ids in encoded], pa.binary()),
    ]
    return columns + [pa.array([book.decode(ids) for ids in encoded], pa.string())] * with_text


def encode(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    with_text: bool = False,
    paths: tuple[str, str] | None = None,
    long_chars: int = LONG_CHARS,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n_tokens``, ``ids`` (token ids as little-endian
    unsigned 32-bit integers) and, with ``with_text``, ``decoded`` (the text made from the ids).

    Null counts as empty; an empty text has no ids. Rows and ids may repeat. Texts of more than
    ``long_chars`` characters are cut into pieces that tasks encode apart and one task per document
    puts together again; the others are encoded where they are read, without a shuffle.
    """
    paths = paths or vocabulary()
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*keep).alias("kept"), body.alias("body"))
    kept_field = rows.schema["kept"]
    is_long = F.length("body") > long_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codec(*paths)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            encoded = [np.array(book.encode(t), "<u4") for t in texts]
            answers = _answers(book, encoded, with_text)
            yield pa.RecordBatch.from_arrays([batch.column(0), *answers], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codec(*paths)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = list(book.pieces(batch.column(1)[i].as_py(), leaf_chars))
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([batch.column(0).slice(i, 1)] * n),
                        pa.concat_arrays([batch.column(2).slice(i, 1)] * n),
                        pa.array(range(n), pa.int32()),
                        pa.array([p for p, _ in parts], pa.string()),
                        pa.array([glued for _, glued in parts], pa.bool_()),
                    ],
                    ["kept", "row", "seq", "piece", "glued"],
                )

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codec(*paths)
        for batch in batches:
            made = [np.array(book.encode(t), "<u4").tobytes() for t in batch.column(3).to_pylist()]
            columns = [batch.column(k) for k in (0, 1, 2, 4)] + [pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["kept", "row", "seq", "glued", "ids"])

    def together(table: pa.Table) -> pa.Table:
        book = codec(*paths)
        table = table.sort_by("seq").combine_chunks()
        runs: list[list[list[int]]] = []
        for glued, ids in zip(table["glued"].to_pylist(), table["ids"].to_pylist()):
            part = np.frombuffer(ids, "<u4").tolist()
            runs[-1].append(part) if glued else runs.append([part])
        ids = np.array([i for run in runs for i in book.join_all(run)], "<u4")
        answers = _answers(book, [ids], with_text)
        return pa.Table.from_arrays([table["kept"].chunk(0).slice(0, 1), *answers], names=names)

    names = ["kept", *(f.name for f in _added(with_text))]
    schema = T.StructType([kept_field, *_added(with_text)])
    short = rows.filter(~is_long).mapInArrow(whole, schema)

    row = T.StructField("row", T.LongType())
    seq = T.StructField("seq", T.IntegerType())
    glued = T.StructField("glued", T.BooleanType())
    piece = T.StructField("piece", T.StringType())
    part = T.StructField("ids", T.BinaryType())
    apart = (
        rows.filter(is_long)
        .withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(cut, T.StructType([kept_field, row, seq, piece, glued]))
        .repartition(partitions(docs.sparkSession), "row", "seq")
        .mapInArrow(encode_pieces, T.StructType([kept_field, row, seq, glued, part]))
    )
    long = apart.groupBy("row").applyInArrow(together, schema)
    return short.unionByName(long).select("kept.*", *names[1:])


def decode(encoded: DataFrame, ids: str = "ids", paths: tuple[str, str] | None = None) -> DataFrame:
    """The rows with one more column, ``decoded``: the text of the packed ids (null ids: null).

    An existing column of that name keeps its place; the new one takes a free name after it.
    """
    paths = paths or vocabulary()
    name = free_name(encoded, "decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])
    at = encoded.columns.index(ids)
    names = schema.names

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codec(*paths)
        for batch in batches:
            packed = batch.column(at).to_pylist()
            made = [None if p is None else book.decode(np.frombuffer(p, "<u4")) for p in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names)

    return encoded.mapInArrow(texts, schema)
