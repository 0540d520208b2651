"""Log-likelihoods of whole documents under corpus counts and a recurrent model."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .labelled import fold
from .recurrent import RATE, ROUNDS, TRAIN_LANES, Adam, Recurrent
from .shared import partitions, small_batches, written
from .words import NOT_SPACE, HashSet, word_blocks

#: Words that the recurrent model tells apart (a text's end is one).
VOCABULARY = 2048
#: Training: tokens of a block, parts of the texts after each of which weights are averaged, tokens of a
#: part that a task learns from by itself, and slices in which weights are summed.
BLOCK_TOKENS, PARTS, TASK_TOKENS, SLICES = 1 << 17, 6, 1 << 20, 64
#: Powers of two that counts are told apart by when the commonest words are looked for.
LEVELS = 48
#: Tokens that share one list of different words.
CHUNK_TOKENS = 4 << 20
#: Tokens of a chunk that are sorted at once.
BATCH_TOKENS = 1 << 18
#: Bytes of texts that are cut into words at once.
TEXT_BYTES = 1 << 17

#: The hash of a text's end.
END = np.uint64(0x045D9F3B3335B369)


class Chunk:
    """Texts as numbers of their different words. Each batch is sorted by itself, and batches meet in
    their different words only, so that a token takes four bytes here."""

    def __init__(self) -> None:
        self.words, self.trained, self.numbers, self.lengths, self.kept, self.size = [], [], [], [], [], 0

    def add(self, texts: list[np.ndarray], flags: list[bool], kept: pa.Array) -> None:
        lengths = np.array([len(t) for t in texts])
        words, inverse = np.unique(np.concatenate(texts), return_inverse=True)
        in_training = np.repeat(np.array(flags), lengths)
        self.words.append(words)
        self.trained.append(np.bincount(inverse[in_training], minlength=len(words)).astype(np.uint32))
        self.numbers.append(inverse.astype(np.uint32))
        self.lengths.append(lengths)
        self.kept.append(kept)
        self.size += len(inverse)

    def merged(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All different words by bucket, then hash, their buckets, and how often training texts have
        them; afterwards ``numbers`` are places in this order."""
        words, inverse = np.unique(np.concatenate(self.words), return_inverse=True)
        trained = np.bincount(inverse, np.concatenate(self.trained), minlength=len(words)).astype(np.uint32)
        bucket = (words % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((words, bucket))
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        first = 0
        for k, own in enumerate(self.words):
            self.numbers[k] = place[inverse[first : first + len(own)]][self.numbers[k]]
            first += len(own)
        return words[order], bucket[order], trained[order]


def _token_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of each text's words and its end."""
    for block in word_blocks(column, NOT_SPACE, TEXT_BYTES):
        hashes = block.hashes()
        for first, last in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist()):
            yield np.append(hashes[first:last], END)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unpacked(body: bytes, kind: type, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(body, size, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _schema(kept: T.StructField) -> T.StructType:
    """Rows of documents (``bucket`` is null): tokens as places in their chunk's words. Rows of a
    chunk's words by bucket: sorted hashes in ``body`` and how often training texts have them in ``more``."""
    return T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("kept", T.StructType([T.StructField(f.name, f.dataType) for f in kept.dataType.fields])),
            T.StructField("n", T.LongType()),
            T.StructField("body", T.BinaryType()),
            T.StructField("more", T.BinaryType()),
        ]
    )


def token_chunks(docs: DataFrame, text: str, keep: tuple[str, ...], train: str) -> DataFrame:
    """Documents as numbers of the words of their chunk, and the words of each chunk (see ``_schema``)."""
    buckets = partitions(small_batches(docs.sparkSession))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{text}`").cast("string").alias("body"), F.col(train)
    )
    schema = _schema(rows.schema["kept"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        chunk = Chunk()

        def flush(number: int) -> Iterator[pa.RecordBatch]:
            words, bucket, trained = chunk.merged(buckets)
            for numbers, lengths, kept in zip(chunk.numbers, chunk.lengths, chunk.kept):
                n = len(lengths)
                bodies = pa.array([_packed(x) for x in np.split(numbers, np.cumsum(lengths)[:-1])], pa.binary())
                arrays = [pa.array([number] * n, pa.int64()), pa.nulls(n, pa.int32()), kept, pa.array(lengths), bodies, pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)
            edges = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
            full = [k for k in range(buckets) if edges[k] < edges[k + 1]]
            slices = [slice(edges[k], edges[k + 1]) for k in full]
            arrays = [
                pa.array([number] * len(full), pa.int64()),
                pa.array(full, pa.int32()),
                pa.nulls(len(full), chunk.kept[0].type),
                pa.array([s.stop - s.start for s in slices], pa.int64()),
                pa.array([words[s].tobytes() for s in slices], pa.binary()),
                pa.array([_packed(trained[s]) for s in slices], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            texts, first, size = [], 0, 0
            for position, tokens in enumerate(_token_hashes(batch.column(1)), 1):
                texts.append(tokens)
                size += len(tokens)
                full = chunk.size + size >= CHUNK_TOKENS
                if full or size >= BATCH_TOKENS or position == batch.num_rows:
                    rows = batch.slice(first, position - first)
                    chunk.add(texts, rows.column(2).to_pylist(), rows.column(0))
                    texts, first, size = [], position, 0
                if full:
                    yield from flush(number)
                    number, chunk = number + 1, Chunk()
        if chunk.size:
            yield from flush(number)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def counted_words(chunks: DataFrame) -> DataFrame:
    """For each row of words of ``chunks`` its chunk, bucket, number of words and, in ``body``, how
    often all training texts have each. One row per bucket more (chunk -1) has the bucket's commonest
    words (and the text's end) in ``body``, their counts in ``more``, its number of different training
    words in ``n``, of training tokens in ``total``, and in ``levels`` how many words have a count of at
    least 1, 2, 4, ..."""

    def run(table: pa.Table) -> pa.Table:
        lengths = table["n"].to_pylist()
        hashes = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["body"]])
        words, inverse = np.unique(hashes, return_inverse=True)
        inverse = inverse.astype(np.uint32)
        del hashes
        edges = np.cumsum([0, *lengths]).tolist()
        total = np.zeros(len(words), np.int64)
        for k, x in enumerate(table["more"]):  # a chunk's words differ
            total[inverse[edges[k] : edges[k + 1]]] += _unpacked(x.as_py(), np.uint32, lengths[k])
        bodies = [_packed(total[inverse[edges[k] : edges[k + 1]]]) for k in range(len(lengths))]
        known = np.flatnonzero(total)
        top = known[np.lexsort((words[known], -total[known]))][:VOCABULARY]
        top = np.union1d(top, known[words[known] == END])
        levels = np.array([(total >= 1 << k).sum() for k in range(LEVELS)], np.int64)
        bucket, none = table["bucket"][0].as_py(), [None] * len(lengths)
        return pa.table(
            {
                "chunk": pa.array(table["chunk"].to_pylist() + [-1], pa.int64()),
                "bucket": pa.array([bucket] * (len(lengths) + 1), pa.int32()),
                "n": pa.array(lengths + [len(known)], pa.int64()),
                "body": pa.array(bodies + [words[top].tobytes()], pa.binary()),
                "more": pa.array(none + [total[top].tobytes()], pa.binary()),
                "total": pa.array(none + [int(total.sum())], pa.int64()),
                "levels": pa.array(none + [levels.tobytes()], pa.binary()),
            }
        )

    words = chunks.filter("bucket IS NOT NULL").select("chunk", "bucket", "n", "body", "more")
    return words.groupBy("bucket").applyInArrow(run, "chunk long, bucket int, n long, body binary, more binary, total long, levels binary")


def vocabulary(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Hashes and counts of the commonest words, the text's end first; all training tokens; different ones."""
    stats = counted.filter("chunk = -1")
    total = stats.agg(F.sum("total").alias("tokens"), F.sum("n").alias("words")).first()
    levels = sum((np.frombuffer(bytes(r.levels), np.int64) for r in stats.select("levels").collect()), np.zeros(LEVELS, np.int64))
    enough = np.flatnonzero(levels >= VOCABULARY)
    least = 1 << int(enough[-1]) if len(enough) else 1  # words of so many occurrences fill the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes, counts = np.frombuffer(body, np.uint64), np.frombuffer(more, np.int64)
                kept = (counts >= least) | (hashes == END)
                columns = [pa.array(hashes[kept].view(np.int64)), pa.array(counts[kept])]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "count"])

    listed = stats.select("body", "more").mapInArrow(run, "hash long, count long")
    end = int(END)
    first = F.col("hash") == end
    top = listed.orderBy(F.desc(first), F.desc("count"), "hash").limit(VOCABULARY).collect()
    ends = [r for r in top if r["hash"] == end]
    top = [r for r in top if r["hash"] != end][: VOCABULARY - 1]
    hashes = np.array([end, *(r["hash"] for r in top)], np.int64).view(np.uint64)
    counts = np.array([ends[0]["count"] if ends else 0, *(r["count"] for r in top)], np.int64)
    return hashes, counts, total.tokens or 0, total.words or 0


class Places:
    """Places of hashes in a list of different ones, its length for others."""

    def __init__(self, listed: np.ndarray):
        self.known, self.order, self.size = HashSet(listed), np.argsort(listed), len(listed)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.size, np.uint16 if self.size < 1 << 16 else np.uint32)
        near, at = self.known.find(hashes)
        out[near] = self.order[at]
        return out


def training_blocks(known: DataFrame, listed: np.ndarray) -> DataFrame:
    """The word numbers of all texts (column ``body``), run together and cut into blocks, and a part for each."""
    sent = known.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId(), [], 0
        places = Places(sent.value)

        def blocks(stream: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for k in range(0, len(stream), BLOCK_TOKENS):
                cut = places.find(stream[k : k + BLOCK_TOKENS]).astype(np.uint16)
                columns = [pa.array([number % PARTS], pa.int32()), pa.array([len(cut)], pa.int64()), pa.array([_packed(cut)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "n", "body"])
                number += 1

        for batch in batches:
            for hashes in _token_hashes(batch.column(0)):
                held.append(hashes)
                size += len(hashes)
                if size >= BLOCK_TOKENS:
                    stream = np.concatenate(held)
                    whole = size - size % BLOCK_TOKENS
                    yield from blocks(stream[:whole])
                    held, size = [stream[whole:]], size - whole
        if size:
            yield from blocks(np.concatenate(held))

    return known.select("body").mapInArrow(run, "part int, n long, body binary")


def averaged(blocks: DataFrame, model: Recurrent, rate: float, lanes: int = TRAIN_LANES) -> Recurrent:
    """The mean, by tokens, of the models that tasks get from ``model`` by one pass over their blocks."""
    sent = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, pace = pickle.loads(pickle.dumps(sent.value)), 0, None
        for batch in batches:
            for n, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pace = pace or Adam(own)
                own.follow(np.append(0, _unpacked(body, np.uint16, n)).astype(np.int64), pace, rate, lanes)
                seen += n
        if seen:
            bodies = [x.tobytes() for x in np.array_split(own.flat(), SLICES)]
            columns = [pa.array(range(SLICES), pa.int32()), pa.array([seen] * SLICES, pa.int64()), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "n", "body"])

    def mean(table: pa.Table) -> pa.Table:
        rows = sorted((r["n"], r["body"]) for r in table.to_pylist())  # the same order whatever tasks end first
        total = sum(n for n, _ in rows)
        body = sum(np.frombuffer(x, np.float32).astype(np.float64) * (n / total) for n, x in rows)
        return pa.table({"slice": table["slice"][:1], "body": pa.array([body.tobytes()], pa.binary())})

    learnt = blocks.select("n", "body").mapInArrow(run, "slice int, n long, body binary")
    found = learnt.groupBy("slice").applyInArrow(mean, "slice int, body binary").collect()
    sent.unpersist()
    if found:
        model.set_flat(np.concatenate([np.frombuffer(r["body"], np.float64) for r in sorted(found, key=lambda r: r["slice"])]))
    return model


def learn(
    docs: DataFrame, text: str, doc_id: str, listed: np.ndarray, counts: np.ndarray, others: int, sample: int | None = None
) -> Recurrent:
    """A recurrent model that starts from the corpus's counts and is trained on all training documents
    (with ``sample``, on so many of the smallest id hashes). Tasks train on their own texts from the same
    weights, which are averaged after each part of the texts; only weights reach the driver."""
    model = Recurrent(len(listed))
    model.set_unigrams(counts, others)
    known = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body")).filter(fold("id", 5) != 1)
    if sample is not None:
        known = known.filter(F.col("id").isNotNull())
        chosen = known.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
        known = known.join(F.broadcast(chosen), "id")
    blocks = written(training_blocks(known, listed), "training")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-total // (PARTS * TASK_TOKENS)))
    lanes = min(TRAIN_LANES, max(32, total >> 15))  # few texts give more updates of fewer lanes
    if total:
        for k in range(ROUNDS * PARTS):
            part = blocks.filter(F.col("part") == k % PARTS).coalesce(tasks)
            model = averaged(part, model, RATE * (1 - 0.9 * k / (ROUNDS * PARTS)), lanes)
    return model


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (fold 1 of 5, from which nothing is learned),
    ``n_tokens`` (words and the text's end), ``n_known`` (tokens that training texts have),
    ``train_tokens``, ``base_score`` (log10 likelihood under the smoothed counts of all training
    texts) and ``score`` (that under the recurrent model, which tells the commonest words apart and
    gives the others their share of the counts, and is trained on all training texts unless ``sample``
    names a smaller number).

    Null counts as empty, which is an end alone. Rows and ids may repeat; without training texts all
    counts are 0. An empty table gives no rows.
    """
    train = fold(doc_id, 5) != 1
    marked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (~train).alias("held_out"), F.col(f"`{text}`").alias("body"), train.alias("train"))
    chunks = written(token_chunks(marked, "body", ("doc_id", "held_out"), "train"), "chunks")
    counted = written(counted_words(chunks), "counts")
    listed, counts, tokens, words = vocabulary(counted)
    others = max(0, tokens - int(counts.sum()))
    model = learn(docs, text, doc_id, listed, counts, others, sample)
    rest = others + 0.5 * (max(0, words - int((counts > 0).sum())) + 1)  # the other words' counts, one place for unseen ones
    base = tokens + 0.5 * (words + 1)
    sent = docs.sparkSession.sparkContext.broadcast((model, listed))

    def run(table: pa.Table) -> pa.Table:
        model, listed = sent.value
        is_text = pc.is_null(table["bucket"])
        texts = table.filter(is_text).combine_chunks()
        rows = table.filter(pc.invert(is_text)).select(["bucket", "n", "body", "counted"]).sort_by("bucket")
        del table
        first, second = (rows.filter(x) for x in (pc.invert(rows["counted"]), rows["counted"]))
        word = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in first["body"]])
        count = np.concatenate([_unpacked(x.as_py(), np.int64, n) for x, n in zip(second["body"], second["n"].to_pylist())])
        del rows, first, second
        number = Places(listed).find(word)
        del word
        base_log = np.log10((count + 0.5) / base)
        rest_log = np.where(number == len(listed), np.log10((count + 0.5) / rest), 0.0)
        known = count > 0
        documents, base_scores, known_tokens, rest_scores = [], [], [], []
        for body, n in zip(texts["body"], texts["n"].to_pylist()):
            at = _unpacked(body.as_py(), np.uint32, n)
            documents.append(number[at])
            base_scores.append(float(base_log[at].sum()))
            known_tokens.append(int(known[at].sum()))
            rest_scores.append(float(rest_log[at].sum()))
        scores = model.text_scores(documents) / math.log(10) + np.array(rest_scores)
        kept = texts["kept"].combine_chunks()
        return pa.table(
            {
                "doc_id": pc.struct_field(kept, "doc_id"),
                "held_out": pc.struct_field(kept, "held_out"),
                "n_tokens": texts["n"],
                "n_known": pa.array(known_tokens, pa.int64()),
                "train_tokens": pa.array([tokens] * len(documents), pa.int64()),
                "base_score": pa.array(base_scores, pa.float64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    first = chunks.select("chunk", "bucket", "kept", "n", "body", F.lit(False).alias("counted"))
    second = counted.filter("chunk >= 0").select(
        "chunk", "bucket", F.lit(None).cast(chunks.schema["kept"].dataType).alias("kept"), "n", "body", F.lit(True).alias("counted")
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", marked.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
            *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")],
        ]
    )
    return first.union(second).groupBy("chunk").applyInArrow(run, schema)
