"""Exact similarity join of documents on word shingles, and its groups.

Two documents link when their shingle sets have a Jaccard similarity of at least ``PERCENT``. The
join is exact up to equal 64-bit shingle hashes:

1. Each distinct set names the smallest hashes of its shingles, so many that two similar sets share
   several of them. Names that one set alone has are counted out; of the others the rarest are kept,
   again so many that similar sets share one. What is left are a few names of sets that have
   near copies.
2. Sets meet in size-banded tiles: a set meets those of its own size band and of the next one. The
   few sets of a rare name are joined by name. Sets that names of many sets connect are a family; its
   sets are dealt out over blocks of a bounded size, and every two blocks that sizes allow are a tile.
3. A bitmap of hashed shingles bounds the overlap of two sets from above by a bit count; sorted
   arrays are intersected only beyond it. Pairs that the bitmaps allow meet in tiles as well, one for
   the sets around a common smallest one. In a tile, sets that are already connected
   aren't compared again, so a large group of near copies gives links in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .bitmaps import FILTER_BITS, bitmap_levels, contains, filter_levels, filter_of, level_in
from .components import components
from .shared import discard, free_name, partitions, small_batches, written
from .words import NOT_SPACE, Block, mix, word_blocks

#: Words of a shingle, and the least similarity in percent.
WORDS, PERCENT = 5, 80
#: Longs of a set's bitmap.
SIGNATURE = 16
#: A size band ends at so many times its start; more than 100 / PERCENT, so similar sets are at most one band apart.
BAND = 1.26
#: Names are ranked by how many sets share them, in powers of 8.
LEVELS = 5
#: A name of more sets than this makes them a family; sets of a block; names that a task packs together.
RARE, BLOCK_SETS, PACKED = 48, 1024, 1 << 21
#: Pairs meet around a common smallest set if it has no more sets around it than this.
HUB_SETS = 256

SIGNATURE_COLUMNS = [f"s{k}" for k in range(SIGNATURE)]
PACKED_COLUMNS = ["bucket", "tags", "low", "several", "high", "more", "many"]

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(block: Block, words: int = WORDS) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes; a text of fewer words is one shingle."""
    hashes = block.hashes()
    places = max(0, len(hashes) - words + 1)
    whole = np.zeros(places, np.uint64)
    for k in range(words):
        whole = whole * _STEP + hashes[k : k + places]
    whole = mix(whole)
    for first, last in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist()):
        if last - first >= words:
            found = np.sort(whole[first : last - words + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif last > first:
            short = np.array([last - first], np.uint64)
            for k in range(first, last):
                short = mix(short * _STEP + hashes[k : k + 1])
            yield short
        else:
            yield np.zeros(0, np.uint64)


def _least(n: int | np.ndarray) -> int | np.ndarray:
    """The least overlap of a set of n with a similar one."""
    return -(-n * PERCENT // 100)


def _spare(n: int | np.ndarray) -> int | np.ndarray:
    """Names that two similar sets share at least, of those that each gives."""
    return 1 + n // 20


def set_keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """For each set 128 bits that tell it from others, none for an empty one; the sets of a block at a time."""
    sizes = np.array([len(x) for x in sets], np.int64)
    full = np.flatnonzero(sizes)
    keys: list[bytes | None] = [None] * len(sets)
    if len(full):
        flat, first = np.concatenate(sets), (np.cumsum(sizes) - sizes)[full]
        sums = [np.add.reduceat(mix(x), first, dtype=np.uint64) for x in (flat, flat * _STEP + np.uint64(1))]
        for k, key in zip(full.tolist(), mix(np.stack(sums, 1) + sizes[full].astype(np.uint64)[:, None])):
            keys[k] = key.tobytes()
    return keys


def _signature(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIGNATURE * 64, np.uint8)
    bits[(shingles % np.uint64(SIGNATURE * 64)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def named_sets(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """Per document: the ``keep`` columns (as ``kept``), ``n``, ``set_key`` (null without words), ``u``
    (64 bits of it), the bitmap ``s0`` ..., and ``names``, which are null where the same task has met
    the set before."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{text}`").cast("string").alias("body"))
    schema = T.StructType(
        [
            rows.schema["kept"],
            T.StructField("n", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("u", T.LongType()),
            T.StructField("names", T.ArrayType(T.LongType())),
            *[T.StructField(c, T.LongType()) for c in SIGNATURE_COLUMNS],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            sizes, keys, names, signatures = [], [], [], [np.zeros((0, SIGNATURE), np.int64)]
            for block in word_blocks(batch.column(1), NOT_SPACE):
                found = list(shingle_sets(block))
                for shingles, key in zip(found, set_keys(found)):
                    n = len(shingles)
                    sizes.append(n)
                    keys.append(key)
                    names.append(None if key is None or key in seen else shingles[: n - _least(n) + _spare(n)].view(np.int64))
                    signatures.append(_signature(shingles)[None])
                    seen.add(key)
            short = [None if k is None else int.from_bytes(k[:8], "little", signed=True) for k in keys]
            bits = np.concatenate(signatures)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(short, pa.int64()),
                    pa.array(names, pa.list_(pa.int64())),
                    *[pa.array(np.ascontiguousarray(bits[:, k])) for k in range(SIGNATURE)],
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)


def _tag(names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A name's bucket and its 32-bit tag there. Names that agree in both are taken for one, which
    can only make more sets meet."""
    names = names.view(np.uint64)
    return (names & np.uint64(buckets - 1)).astype(np.int64), (names >> np.uint64(24)).astype(np.uint32)


def _tag_value(bucket: np.ndarray, tag: np.ndarray) -> np.ndarray:
    return mix((tag.astype(np.uint64) << np.uint64(16)) | bucket.astype(np.uint64)).view(np.int64)


def _ends(order_by: np.ndarray, low: np.ndarray, high: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each different value of ``order_by``: itself, the least ``low``, the most ``high``, the sum of ``many``."""
    order = np.argsort(order_by, kind="stable")
    value = order_by[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    if not len(first):
        return value, low, high, many
    return (
        value[first],
        np.minimum.reduceat(low[order], first),
        np.maximum.reduceat(high[order], first),
        np.add.reduceat(many[order], first),
    )


def shared_names(sets: DataFrame, buckets: int) -> DataFrame:
    """``bucket``, ``level``, ``bits``: a filter of the names that different sets have (as ``_tag_value``)
    for each bucket and level.

    Tasks pack the names of each bucket into one row, every name once with the least and the most of
    its sets and their number, so a name that very many sets share stays small; buckets are then merged.
    """
    most = FILTER_BITS - (buckets - 1).bit_length()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            names, u = (np.concatenate(x) for x in zip(*held))
            bucket, tag = _tag(names, buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for k in range(buckets):
                at = order[edges[k] : edges[k + 1]]
                if len(at):
                    tags, low, high, many = _ends(tag[at], u[at], u[at], np.ones(len(at), np.uint32))
                    several = np.flatnonzero(low != high).astype(np.uint32)
                    more = np.flatnonzero(many > 1).astype(np.uint32)
                    rows.append((k, tags, low, several, high[several], more, many[more].astype(np.uint32)))
            columns = list(zip(*rows))
            packed = [pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *packed], PACKED_COLUMNS)

        for batch in batches:
            lists = batch.column(1)
            held.append((lists.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())))
            size += len(held[-1][0])
            if size >= PACKED:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def merge(table: pa.Table) -> pa.Table:
        parts = []
        for row in table.to_pylist():
            tags, low = np.frombuffer(row["tags"], np.uint32), np.frombuffer(row["low"], np.int64)
            high, many = low.copy(), np.ones(len(tags), np.int64)
            high[np.frombuffer(row["several"], np.uint32)] = np.frombuffer(row["high"], np.int64)
            many[np.frombuffer(row["more"], np.uint32)] = np.frombuffer(row["many"], np.uint32)
            parts.append((tags, low, high, many))
        tags, low, high, many = _ends(*(np.concatenate(x) for x in zip(*parts)))
        shared = low != high
        value = _tag_value(np.full(int(shared.sum()), table["bucket"][0].as_py()), tags[shared])
        level = np.minimum(LEVELS - 1, np.log2(many[shared]) // 3).astype(np.int32)
        levels = np.unique(level)
        filters = [filter_of(value[level == k], most).tobytes() for k in levels]
        bucket = pa.array([table["bucket"][0].as_py()] * len(levels), pa.int32())
        return pa.table({"bucket": bucket, "level": pa.array(levels, pa.int32()), "bits": pa.array(filters, pa.binary())})

    packed = sets.filter("names IS NOT NULL").select("u", "names").mapInArrow(
        pack, "bucket int, tags binary, low binary, several binary, high binary, more binary, many binary"
    )
    return packed.groupBy("bucket").applyInArrow(merge, "bucket int, level int, bits binary")


def rarest(names: np.ndarray, row: np.ndarray, level: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's names (a set of ``n[row]`` shingles) those to keep, in the order of level and name.

    Names of level -1 are in no other set. Two similar sets share at least ``_spare`` of the smaller
    one's size many names, and that one is at least ``_least`` of the other's size. So each may leave
    out its commonest ones up to one less than ``_spare(_least(n))``, and the rarest name that both
    have is still kept by both.
    """
    names, row, level = names[level >= 0], row[level >= 0], level[level >= 0]
    order = np.lexsort((names, level, row))
    names, row = names[order], row[order]
    shared = np.bincount(row, minlength=len(n))
    rank = np.arange(len(row)) - np.repeat(np.cumsum(shared) - shared, shared)
    taken = rank < (shared - _spare(_least(n)) + 1)[row]
    return names[taken], row[taken]


def rare_names(sets: DataFrame) -> DataFrame:
    """``name``, ``u``, ``n``: of each set's names those that others have too, the rarest of them. How often names
    occur comes back as filters of a bounded size, by powers of 8, so the names themselves needn't be shuffled for it."""
    spark = sets.sparkSession
    buckets = 1 << max(6, min(16, (partitions(spark) - 1).bit_length()))
    shared = written(shared_names(sets, buckets), "shared-names")
    maps = spark.sparkContext.broadcast(filter_levels(shared.collect(), buckets, LEVELS))
    discard(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            names = batch.column(2)
            flat = names.flatten().to_numpy()
            row = np.repeat(np.arange(len(u)), names.value_lengths().to_numpy())
            bucket, tag = _tag(flat, buckets)
            flat, row = rarest(flat, row, level_in(maps.value, bucket, _tag_value(bucket, tag)), n)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(u[row]), pa.array(n[row])], ["name", "u", "n"])

    rows = sets.filter("names IS NOT NULL").select("u", "n", "names")
    return rows.mapInArrow(run, "name long, u long, n long").distinct()


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / float(np.log(BAND)))


def tiles(names: DataFrame) -> DataFrame:
    """Each row in the tile of its name and size band and, as a guest, in that of the band before."""
    return names.select("*", F.explode(F.array(_band(F.col("n")), _band(F.col("n")) - 1)).alias("band"))


def full_sets(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``u`` and ``shingles`` (sorted 64-bit hashes) of at least the sets in ``wanted`` (column ``u``),
    each once. Texts are read again; a bitmap of a bounded size tells which, so the sets of other
    documents aren't moved."""
    marked = wanted.select("u", F.lit(0).alias("level"))
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_levels(marked, "u", "level", 1)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            u, bodies = [], []
            for block in word_blocks(batch.column(0), NOT_SPACE):
                found = list(shingle_sets(block))
                keys = set_keys(found)
                some = [k for k, key in enumerate(keys) if key]
                short = np.array([int.from_bytes(keys[k][:8], "little", signed=True) for k in some], np.int64)
                maybe = contains(bitmap.value, short) if len(some) else []
                for k, key, wanted_here in zip(some, short.tolist(), maybe):
                    if wanted_here and key not in seen:
                        seen.add(key)
                        u.append(key)
                        bodies.append(found[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(bodies, pa.binary())], ["u", "shingles"])

    read = docs.select(F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, "u long, shingles binary")
    return read.dropDuplicates(["u"])


def _may_link(a: str, b: str) -> Column:
    """Sizes fit, and the bit count allows enough overlap: it is at most half of what the sizes
    together have beyond the bits that differ."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(SIGNATURE)), F.lit(0))
    overlap = F.floor((n + m - differ) / 2)
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * overlap >= PERCENT * (n + m))


def possible(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The different pairs (``a``, ``b``) whose sizes and bitmaps allow a link."""
    left = signatures.withColumnRenamed("u", "a").alias("x")
    right = signatures.withColumnRenamed("u", "b").alias("y")
    return pairs.distinct().join(left, "a").join(right, "b").filter(_may_link("x", "y")).select("a", "b")


def _overlaps(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def pair_places(pairs: DataFrame) -> DataFrame:
    """``u``, ``tile`` and ``side`` of sets such that the two of each pair meet.

    Every set knows the smallest one that it or a pair of it names, its hub. Pairs of sets with one hub
    of up to ``HUB_SETS`` meet there, so each set of a group of near copies goes to one place, however many pairs
    it is in. Other pairs meet where their smaller set is, by about ``BLOCK_SETS`` in a tile.
    """
    ends = pairs.select(F.col("a").alias("u"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    hubs = ends.groupBy("u").agg(F.least("u", F.min("other")).alias("hub"), F.count(F.lit(1)).alias("pairs"))
    small = hubs.groupBy("hub").agg(F.count(F.lit(1)).alias("around")).filter(F.col("around") <= HUB_SETS).select("hub")
    small = small.withColumn("small", F.lit(True))
    hubs = written(hubs.join(small, "hub", "left"), "hubs")
    one = hubs.select(F.col("u").alias("a"), F.col("hub").alias("hub_a"), "small", "pairs")
    placed = pairs.join(one, "a").join(hubs.select(F.col("u").alias("b"), F.col("hub").alias("hub_b")), "b")
    shared = F.coalesce("small", F.lit(False)) & (F.col("hub_a") == F.col("hub_b"))
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / BLOCK_SETS))
    tile = F.when(shared, F.xxhash64(F.lit("hub"), "hub_a")).otherwise(F.xxhash64(F.lit("set"), "a", part))
    first, second = F.struct(F.col("a").alias("u"), F.lit(0).alias("side")), F.struct(F.col("b").alias("u"), F.when(shared, 0).otherwise(1).alias("side"))
    rows = placed.select(tile.alias("tile"), F.explode(F.array(first, second)).alias("row"))
    places = written(rows.select("row.u", "tile", "row.side").distinct(), "near")
    discard(hubs)
    return places


def tile_links(u: np.ndarray, sets: list[np.ndarray], first: int) -> list[tuple[int, int]]:
    """Links that connect the similar sets of a tile. The first ``first`` sets are one block, the others
    another one, which is compared with the first only; a tile of one block is compared with itself."""
    size = np.array([len(x) for x in sets])
    width = 1 << max(9, min(14, int(4 * size.max()).bit_length()))
    bits = np.zeros((len(sets), width // 64), np.uint64)
    for k, x in enumerate(sets):
        marks = np.zeros(width, np.uint8)
        marks[(x & np.uint64(width - 1)).astype(np.int64)] = 1
        bits[k] = np.packbits(marks, bitorder="little").view(np.uint64)
    group = np.arange(len(sets))
    links = []
    whole = first == len(sets)
    for k in range(first):
        others = np.arange(k + 1, len(sets)) if whole else np.arange(first, len(sets))
        fits = 100 * np.minimum(size[k], size[others]) >= PERCENT * np.maximum(size[k], size[others])
        others = others[fits & (group[others] != group[k])]
        differ = np.bitwise_count(bits[others] ^ bits[k]).sum(1, dtype=np.int64)
        both = size[k] + size[others]
        bound = (both - differ) // 2
        able = (100 + PERCENT) * bound >= PERCENT * both
        others = others[able][np.argsort(-bound[able], kind="stable")]
        for j in others.tolist():
            if group[j] != group[k] and _overlaps(sets[k], sets[j]):
                links.append((int(u[k]), int(u[j])))
                group[group == group[j]] = group[k]
    return links


def family_places(members: DataFrame) -> DataFrame:
    """``u``, ``tile`` and ``side`` of the sets of families (``family``, ``u``, ``n``; every set once).

    A family's sets of one size band are dealt out over blocks of about ``BLOCK_SETS`` sets by hash.
    A tile is a block with itself, with a later block of its band, or with one of the next band.
    """
    banded = members.withColumn("band", _band(F.col("n")))
    blocks = banded.groupBy("family", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("own"))
    beside = blocks.select("family", (F.col("band") - 1).alias("band"), F.col("own").alias("above")).unionByName(
        blocks.select("family", (F.col("band") + 1).alias("band"), F.col("own").alias("below")), allowMissingColumns=True
    )
    beside = beside.groupBy("family", "band").agg(F.max("above").alias("above"), F.max("below").alias("below"))
    known = blocks.join(beside, ["family", "band"], "left")
    block = F.pmod(F.xxhash64("u"), F.col("own")).cast("int")

    def places(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def tile(band: Column, i: Column, step: int, j: Column, side: Column | int) -> Column:
        side = F.lit(side) if isinstance(side, int) else side
        return F.struct(band.alias("band"), i.alias("i"), F.lit(step).alias("step"), j.alias("j"), side.alias("side"))

    here, b = F.col("band"), F.col("block")
    own = F.transform(places(F.col("own")), lambda j: tile(here, F.least(b, j), 0, F.greatest(b, j), F.when(b <= j, 0).otherwise(1)))
    up = F.transform(places(F.coalesce("above", F.lit(0))), lambda j: tile(here, b, 1, j, 0))
    down = F.transform(places(F.coalesce("below", F.lit(0))), lambda j: tile(here - 1, j, 1, b, 1))
    return (
        banded.join(known, ["family", "band"])
        .withColumn("block", block)
        .select("family", "u", F.explode(F.concat(own, up, down)).alias("t"))
        .select("u", F.xxhash64("family", "t.band", "t.i", "t.step", "t.j").alias("tile"), "t.side")
    )


def place_links(sets: DataFrame, places: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between the sets (``u``, ``shingles``) that meet (``u``, ``tile``, ``side``), tile by tile."""
    met = places.join(sets, "u").select("tile", "side", "u", "shingles").repartition("tile").sortWithinPartitions("tile", "side", "u")

    def found(held: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
        sides, u, shingles = zip(*held)
        return tile_links(np.array(u), list(shingles), sides.count(0)) if len(held) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def answer(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            links = []
            for t, side, u, body in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if t != tile:
                    links += found(held) if held else []
                    tile, held = t, []
                held.append((side, u, np.frombuffer(body, np.uint64)))
            yield answer(links)
        if held:
            yield answer(found(held))

    return met.mapInArrow(run, "a long, b long")


def links(docs: DataFrame, text: str, sets: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between sets that connect exactly the similar ones."""
    names = written(rare_names(sets), "names")
    common = names.groupBy("name").agg(F.count(F.lit(1)).alias("many"), F.min("u").alias("least")).filter("many > 1")
    met = written(names.join(common, "name"), "met")

    rare = met.filter(F.col("many") <= RARE).select("name", "u", "n")
    x = rare.withColumn("band", _band(F.col("n"))).alias("x")
    y = tiles(rare).alias("y")
    same_tile = (F.col("x.name") == F.col("y.name")) & (F.col("x.band") == F.col("y.band"))
    smaller_first = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.u") < F.col("y.u")))
    sizes_fit = 100 * F.col("x.n") >= PERCENT * F.col("y.n")
    pairs = x.join(y, same_tile & smaller_first & sizes_fit).select(
        F.least("x.u", "y.u").alias("a"), F.greatest("x.u", "y.u").alias("b")
    )
    light = sets.filter("names IS NOT NULL").select("u", "n", *SIGNATURE_COLUMNS)
    signatures = written(light.join(rare.select("u").distinct(), "u", "left_semi").dropDuplicates(["u"]), "signatures")
    pairs = written(possible(pairs, signatures), "pairs")

    family = components(met.filter(F.col("many") > RARE).select(F.col("u").alias("a"), F.col("least").alias("b")).distinct())
    members = met.filter(F.col("many") > RARE).select("u", "n").distinct()
    members = written(members.join(family.select(F.col("node").alias("u"), F.col("component").alias("family")), "u"), "families")

    near = pair_places(pairs)
    places = written(near.union(family_places(members)), "places")
    discard(names, met, signatures, pairs, members, near)
    found = written(place_links(full_sets(docs, text, places.select("u").distinct()), places), "links")
    discard(places)
    return found


def link_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable
    by links, its own included), ``component`` (a key of the group; null without words), and the
    ``keep`` columns.

    Null and empty texts have no shingles and link with nothing. Equal texts link; repeated rows are
    answered each. Null ids take part but never are the smallest id. An empty table gives no rows.
    """
    columns = (doc_id, *keep)
    sets = written(named_sets(docs, text, columns), "prefixes")
    group = components(links(docs, text, sets)).withColumnRenamed("node", "u")
    members = (
        sets.filter("set_key IS NOT NULL")
        .groupBy("set_key", "u")
        .agg(F.min(f"kept.`{doc_id}`").alias("least"))
        .join(group, "u", "left")
        .withColumn("component", F.coalesce(F.col("component").cast("string"), F.hex("set_key")))
    )
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = members.select("set_key", "component").join(smallest, "component")
    return sets.join(answers, "set_key", "left").select(
        F.col(f"kept.`{doc_id}`").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.when(F.col("set_key").isNull(), F.col(f"kept.`{doc_id}`"))).alias("component_id"),
        "component",
        *[F.col(f"kept.`{c}`") for c in keep],
    )


def distinct_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each group of linked ones, with its columns: that of the smallest id (a null id
    only if all are null), of equal ids that of the smallest text digest. Documents without words all stay.

    Most documents stay, so those that go are looked for: a bitmap of a bounded size lets through all
    that surely stay, and only the rest is compared by key.
    """
    mark, maybe, turn = (free_name(docs, n) for n in ("_mark", "_maybe", "_turn"))
    identity = F.col(f"`{doc_id}`")
    digest = F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"), 256)
    marked = docs.withColumn(mark, F.concat_ws(":", digest, F.coalesce(identity.cast("string"), F.lit("null"))))
    linked = written(link_documents(marked, text, doc_id, keep=(mark,)).filter("component IS NOT NULL"), "linked")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(mark))
    stays = linked.groupBy("component").agg(F.min(rank).alias("stays"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = linked.join(stays, "component").select(F.col(mark), (F.col(mark) == F.col(f"stays.{mark}")).alias("stays"))
    named = written(rows.distinct(), "marks")
    number = F.xxhash64(mark)
    bitmap = docs.sparkSession.sparkContext.broadcast(
        bitmap_levels(named.select(number.alias("value"), F.lit(0).alias("level")), "value", "level", 1)[0]
    )

    @F.pandas_udf("boolean")
    def in_bitmap(values: pd.Series) -> pd.Series:
        return pd.Series(contains(bitmap.value, values.to_numpy()))

    checked = marked.withColumn(maybe, in_bitmap(number))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sure = checked.filter(~F.col(maybe)).select(*columns)
    near = checked.filter(F.col(maybe)).join(named, mark, "left")
    once = F.row_number().over(Window.partitionBy(mark).orderBy(mark))
    near = near.withColumn(turn, once).filter(F.col("stays").isNull() | (F.col("stays") & (F.col(turn) == 1)))
    return sure.unionByName(near.select(*columns))
