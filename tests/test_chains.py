from __future__ import annotations

import random
from datetime import date, timedelta
from pathlib import Path

import pytest

from fixtures import AS_OF, tx
from tapebook.operators import chains, versions
from tapebook.schemas import INSIDER_DATA
from tapebook.session import Scratch


@pytest.fixture
def scratch(spark, tmp_path):
    return Scratch(spark, str(tmp_path))


def brute(links):
    out = {}
    for start in links:
        path, here = [start], links[start]
        while here is not None and here not in path:
            path.append(here)
            here = links.get(here)
        if here is None:
            out[start] = (path[-1], len(path) - 1, None)
        else:
            out[start] = (None, None, min(path[path.index(here):]))
    return out


def follow(spark, scratch, links, **more):
    frame = spark.createDataFrame(list(links.items()), "id long, next long").repartition(4)
    got = chains.follow_links(frame, scratch, **more).collect()
    assert {r.id: r.next for r in got} == links and len(got) == len(links)
    return {r.id: (r.final_id, r.hops, r.cycle_id) for r in got}


@pytest.mark.parametrize("seed", range(3))
def test_random_links(spark, scratch, seed):
    rng = random.Random(seed)
    ids = list(range(rng.choice([3, 30, 120])))
    links = {i: rng.choice(ids + [None, 500 + i]) if rng.random() < 0.9 else None for i in ids}
    assert follow(spark, scratch, links) == brute(links)


def test_a_long_chain_takes_few_rounds(spark, scratch):
    links = {i: i + 1 for i in range(1001)}
    got = follow(spark, scratch, links)
    assert got == {i: (1001, 1001 - i, None) for i in links}
    assert max(int(p.name.split("-")[1]) for p in Path(scratch.root).glob("links-*")) <= 10


def test_a_hot_winner_is_dealt_out(spark, scratch):
    links = {i: 1 for i in range(2, 400)} | {1: 0, 0: None, 1000: 1001, 1001: 1002, 1002: 1000, 1003: 1000, 7000: 7000}
    assert follow(spark, scratch, links, hot_rows=20) == brute(links)


def test_no_rows(spark, scratch):
    assert follow(spark, scratch, {}) == {}
    assert follow(spark, scratch, {1: None}) == {1: (1, 0, None)}


def test_stored_versions(spark, scratch):
    rows = tx(spark, [
        {"transaction_id": "a", "superseded_by": "b", "is_active": 0}, {"transaction_id": "b", "superseded_by": "c", "is_active": 0},
        {"transaction_id": "c"}, {"transaction_id": "z"},
    ])
    got = {r.transaction_id: (r.final_id, r.hops) for r in chains.final_versions(rows, scratch).collect()}
    assert got == {"a": ("c", 2), "b": ("c", 1), "c": ("c", 0), "z": ("z", 0)}


def test_versions_of_several_batches(spark, scratch):
    """Each batch's amendment retires the one before, which retired the first row."""
    stored = INSIDER_DATA.empty(spark)
    for k, flags in enumerate(["D", "A", "A", "A"]):
        fresh = tx(spark, [{"transaction_id": f"v{k}", "x_flags": flags, "filing_date": date(2024, 1, 1 + k), "page_id": k}])
        stored = scratch.write(versions.supersede(stored, fresh, AS_OF + timedelta(days=k)), "stored")
    got = {r.transaction_id: (r.superseded_by, r.final_id, r.hops) for r in chains.final_versions(stored, scratch).collect()}
    assert got == {"v0": ("v1", "v3", 3), "v1": ("v2", "v3", 2), "v2": ("v3", "v3", 1), "v3": (None, "v3", 0)}
