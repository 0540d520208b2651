from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tapebook.llm import vector_codes
from tapebook.llm.gnat import Gnat, squared

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


@given(
    st.integers(1, 40), st.integers(1, 4), st.integers(0, 3), st.integers(2, 5), st.integers(1, 4),
    st.integers(0, 2**32 - 1),
)
@settings(max_examples=120, deadline=None)
def test_tree_equals_comparing_with_all(n, width, power, degree, leaf, seed):
    """Small ranges give many ties and equal points; large ones leave the doubles' exact range."""
    rng = np.random.default_rng(seed)
    most = (2, 5, 1000, 1 << 29)[power]
    points, queries = rng.integers(-most, most, (n, width)), rng.integers(-most, most, (50, width))
    queries[:n][: len(points)] = points[:50]
    place, best, work = Gnat(points, degree, leaf).nearest(queries)
    all_ = np.array([squared(p, queries) for p in points])
    assert place.tolist() == all_.argmin(0).tolist() and best.tolist() == all_.min(0).tolist()
    assert work <= n * len(queries)


def test_tree_leaves_out_far_points():
    rng = np.random.default_rng(1)
    centres = rng.integers(-1_000_000, 1_000_000, (8, 8))
    points = np.concatenate([c + rng.integers(-9, 9, (8, 8)) for c in centres])
    queries = np.repeat(points, 4, axis=0) + 1
    _, _, work = Gnat(points).nearest(queries)
    assert work < 0.5 * len(points) * len(queries)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Plain Python integers."""
    kept = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own: dict[int, list] = {}
            for c in cut:
                own.setdefault(nearest(p, c[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(own[k]) for col in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])]
    coded = {}
    for (i, _, lab), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        coded[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab)
    flat = ",".join(str(x) for b in books for e in b for x in e)
    total: dict = {}
    for _, error, lab in coded.values():
        total[lab] = total.get(lab, 0) + error
    sha = hashlib.sha256(flat.encode()).hexdigest()
    return {i: (code, error, total[lab], sha) for i, (code, error, lab) in coded.items()}


@pytest.mark.parametrize("n", [3, 16, 120])
def test_equals_plain_integers(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)], int(rng.integers(0, 3)) or None) for i in rng.permutation(n)]
    rows += [(n + i, rows[0][1], 1) for i in range(n)]  # a hot group of equal vectors
    rows += [(3 * n, None, 1), (3 * n + 1, [0.5] * 15 + [None], 1), (3 * n + 2, [0.5] * 15 + [float("nan")], 1),
             (3 * n + 3, [0.5] * 15 + [float("-inf")], 1)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(5)
    got = {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(frame).collect()}
    assert got == brute(rows)


def test_odd_vectors(spark):
    rows = [(1, [0.1, 0.2, 0.3], 1, "x"), (2, [0.4, 0.5, 0.6], 1, "x"), (3, [1.0], 1, "x"), (4, [1e30, 0.0, 0.0], None, "x"),
            (None, [0.1, 0.2, 0.3], None, "x"), (2, [0.4, 0.5, 0.6], 1, "x")]
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6  # three components are filled up to eight parts of one
    assert {(r.vec_id, r.code is None, r.error) for r in got} == {(1, False, 0), (2, False, 0), (3, True, None), (4, True, None), (None, False, 0)}
    assert {len(r.code) for r in got if r.code} == {16}


def test_empty(spark):
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1, "x")], SCHEMA)).collect() == []
    got = vector_codes.compress(spark.createDataFrame([(1, [], 1, "x")], SCHEMA)).collect()
    assert [(r.vec_id, r.code, r.error) for r in got] == [(1, "00" * 8, 0)]


def test_decoding_is_as_far_away_as_the_error_says(spark):
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([(i, [float(x) for x in rng.normal(0, 1, 16)], 0, "x") for i in range(60)], SCHEMA)
    books = vector_codes.fit(frame)
    coded = vector_codes.encode(frame.select("vec_id", "embedding", "label"), books).collect()
    whole = {r.vec_id: np.floor(np.array(r.embedding) * 4096) for r in frame.collect()}
    for r in coded:
        off = books.decode([r.code])[0] * 4096 - whole[r.vec_id]
        assert int((off**2).sum()) == r.error
