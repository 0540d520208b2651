from __future__ import annotations

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import types as T

from tapebook.llm import bitmaps, components, jaccard

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.StringType())])


def shingles(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^ \t-\r]+", text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    out = []
    for i, (d, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((str(d), len(sets[i]), str(min(ids) if ids else None)))
    return sorted(out)


def found(spark, rows):
    linked = jaccard.link_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), keep=("n",))
    assert linked.columns == ["doc_id", "n_shingles", "component_id", "component", "n"]
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in linked.collect())


def near_copies(seed, groups=14, most=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 30, 90, 250]))]
        if g % 2:
            base += passage
        for _ in range(rng.randint(1, most)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 50, len(base) // 30])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words += [rng.choice(vocabulary) for _ in range(len(words) // rng.choice([4, 5, 6, 20]))]
            rows.append((rng.randrange(10**6), rng.choice([" ", "\n", " \t "]).join(words), "x"))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = near_copies(seed)
    assert found(spark, rows) == brute(rows)


def test_a_drifting_group(spark):
    """Neighbours are similar, the ends are not: links must carry through."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in range(i):
            words[k * 3] = f"x{k}"
        rows.append((1000 - i, " ".join(words), None))
    assert found(spark, rows) == brute(rows)


def test_families_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "RARE", 2)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    rows = near_copies(5)
    assert found(spark, rows) == brute(rows)


def test_tiles_connect_what_all_pairs_connect():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for _ in range(60):
        keep = base[rng.random(300) > rng.choice([0.02, 0.08, 0.15])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)])))

    def groups(pairs):
        label = list(range(60))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return {frozenset(i for i in range(60) if label[i] == x) for x in label}

    pairs = [(i, j) for i in range(60) for j in range(i) if jaccard._overlaps(sets[i], sets[j])]
    u = np.arange(60)
    assert groups(jaccard.tile_links(u, sets, 60)) == groups(pairs)
    across = [(i, j) for i, j in pairs if (i < 20) != (j < 20)]
    got = jaccard.tile_links(u, sets, 20)
    assert groups(got) == groups(across) and all((i < 20) != (j < 20) for i, j in got)


def test_similar_sets_keep_a_common_name():
    """Any sizes, any overlap from the least one on, any order of rarity."""
    rng = np.random.default_rng(6)
    for _ in range(4000):
        n = int(rng.integers(1, 260))
        m = int(rng.integers(jaccard._least(n), n + 1))
        both = next(o for o in range(1, m + 1) if 100 * o >= 80 * (n + m - o)) if 100 * m >= 80 * n else None
        both = int(rng.integers(both, m + 1))
        shingles = rng.choice(2**62, n + m - both, replace=False).astype(np.uint64)
        x, y = np.sort(shingles[:n]), np.sort(shingles[n - both :])
        prefixes = [s[: len(s) - jaccard._least(len(s)) + jaccard._spare(len(s))] for s in (x, y)]
        names, row = np.concatenate(prefixes), np.repeat([0, 1], [len(p) for p in prefixes])
        common = np.intersect1d(x, y)
        rare = rng.integers(0, 5)
        level = np.where(np.isin(names, common), (names % np.uint64(7) >= rare).astype(int), rng.integers(-1, 2, len(names)))
        level[~np.isin(names, common)] = np.where(names[~np.isin(names, common)] % np.uint64(3) == 0, -1, 0)
        kept, of = jaccard.rarest(names, row, level, np.array([len(x), len(y)]))
        assert len(np.intersect1d(kept[of == 0], kept[of == 1])), (n, m, both)


def test_nulls_empty_and_repeated_rows(spark):
    long = " ".join(f"v{i % 977}x{i % 31}" for i in range(30000))
    rows = [
        (1, None, None), (2, "", "x"), (3, "  \n ", "x"), (4, "a b c", None), (5, "A  B\nc", None), (5, "A  B\nc", None),
        (6, "a b c d", None), (None, "a b c", "y"), (None, "only null", "y"), (7, long, None), (8, long + " end", None),
        (9, "a", None), (10, "a a a a a a a", None), (11, "a a a a a", None),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {n: n for e in edges for n in e}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    want = {n: top(n) for e in edges if e[0] != e[1] for n in e}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = near_copies(7) + [(1, None, "x"), (2, "", "y"), (2, "", "y"), (5, "a b c", "p"), (5, "a b c", "p"), (None, "a  b c", "q")]
    kept = jaccard.distinct_documents(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert kept.columns == SCHEMA.names
    got = kept.collect()
    words = [r for r in got if shingles(r.text)]
    assert sorted(str(r.doc_id) for r in words) == sorted({c for _, n, c in brute(rows) if n})
    assert sorted(str(r.doc_id) for r in got if not shingles(r.text)) == ["1", "2", "2"]


def test_dead_tables_and_shuffle_files_go(spark):
    """What is on disk at the end is what the lazy result still reads."""
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "llm"
    blocks = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = {p.name for p in shared.glob("*")}, set(blocks.rglob("shuffle_*.data"))
    rows = spark.createDataFrame(near_copies(3, groups=60), SCHEMA).repartition(3)
    sets = jaccard.written(jaccard.named_sets(rows, "text", ("doc_id",)), "prefixes")
    links = jaccard.links(rows, "text", sets)
    assert {p.name[33:] for p in shared.glob("*") if p.name not in before[0]} - {"edges"} == {"prefixes", "links"}
    left = sum(f.stat().st_size for f in set(blocks.rglob("shuffle_*.data")) - before[1])
    assert left < 10_000 < rows.selectExpr("sum(length(text))").first()[0] / 8
    assert links.count() > 0


def test_filters_hold_all_and_few_others():
    """At half of the bits that a value is due, as when a corpus outgrows the bound."""
    rng = np.random.default_rng(4)
    values = rng.integers(0, 2**63, 60_000)
    bucket = values % 16
    rows = [{"bucket": k, "level": level, "bits": bitmaps.filter_of(values[(bucket == k) & (values // 16 % 2 == level)], 14).tobytes()} for k in range(15) for level in range(2)]
    maps = bitmaps.filter_levels(rows, 16, 3)
    assert [m[0] for m in maps] == [0, 1]  # a level without names costs nothing
    there = bucket < 15
    assert sum(m[1].nbytes for m in maps) <= 2 * 16 * 2**14 // 8
    assert (bitmaps.level_in(maps, bucket[there], values[there]) >= values[there] // 16 % 2).all()
    assert (bitmaps.level_in(maps, bucket[~there], values[~there]) == -1).all()
    others = rng.integers(0, 2**63, 60_000)
    assert (bitmaps.level_in(maps, others % 16, others) >= 0).mean() < 0.1


def test_a_set_of_a_group_moves_once(spark):
    """All pairs of 40 near copies meet at one place; pairs of a chain and of a large hub meet as well."""
    group = [(i, j) for i in range(40) for j in range(i + 1, 40)]
    chain = [(100 + i, 101 + i) for i in range(50)]
    star = [(1000, 1001 + i) for i in range(2 * jaccard.HUB_SETS)]
    places = jaccard.pair_places(spark.createDataFrame(group + chain + star, "a long, b long")).collect()
    assert len([p for p in places if p.u < 40]) == 40
    at = {}
    for p in places:
        at.setdefault(p.u, {})[p.tile] = p.side
    assert all(any(at[a][t] == 0 for t in at[a].keys() & at[b].keys()) for a, b in group + chain + star)
    assert len([p for p in places if p.u >= 1000]) <= 3 * len(star)


def test_keys_of_many_sets_are_those_of_each():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 3, 1, 0, 0, 700, 3, 0)]
    keys = jaccard.set_keys(sets)
    assert keys == [jaccard.set_keys([x])[0] for x in sets]
    assert [k is None for k in keys] == [len(x) == 0 for x in sets] and len(set(keys)) == 5
