from __future__ import annotations

from tapebook.sources import feeds


def test_values_of_any_kind(spark):
    rows = [
        ("A", '{"shortName": "a", "n": 5, "deep": {"x": [1, {"y": "z"}]}, "none": null}'), ("A", '{"shortName": "b"}'),
        ("B", "no json"), ("C", None), ("D", "[1, 2]"), ("E", '{"n": "text", "shortName": 7}'), ("F", "{}"),
    ]
    frame = spark.createDataFrame(rows, "ticker string, info string")
    paths = {"short_name": ("$.shortName", "string"), "n": ("$.n", "bigint"), "y": ("$.deep.x[1].y", "string"), "deep": ("$.deep", "string")}
    got = {r.ticker: tuple(r)[1:] for r in feeds.metadata_paths(frame, paths).collect()}
    none = (None,) * 4
    assert got == {"A": ("a", 5, "z", '{"x":[1,{"y":"z"}]}'), "B": none, "C": none, "D": none, "E": ("7", None, None, None), "F": none}
    keys = {(r["key"], r["kind"]): r.n_rows for r in feeds.unknown_keys(frame).collect()}
    assert keys[("n", "bigint")] == 1 and keys[("n", "string")] == 1 and keys[("deep", "object")] == 1
    assert not {k for k, _ in keys} & set(feeds.METADATA_KEYS)


def test_maps_and_no_rows(spark):
    frame = spark.createDataFrame([("A", {"shortName": "a", "k": "1"}), ("B", None)], "ticker string, info map<string,string>")
    assert [tuple(r) for r in feeds.unknown_keys(frame).collect()] == [("k", "string", 1)]
    assert feeds.unknown_keys(frame.limit(0)).collect() == []
