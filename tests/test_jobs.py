from __future__ import annotations

import csv
import glob
import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, LATER, cells, metadata_frame, page, pages_frame
from tapebook.operators import quality, runs
from tapebook.plans.disclosures import run_disclosures
from tapebook.plans.pricing import run_prices
from tapebook.session import Observed, Scratch
from tapebook.schemas import (
    BATCH_STATUS, DIVIDENDS, OHLCV_LONG, PRICING_DATA, REQUESTS, SPLITS, TABLES,
    TICKER_DATA, TICKER_EXCLUSIONS, TICKER_FAILURES,
)
from tapebook.sources import export, feeds
from tapebook.sources.store import SnapshotStore
from tapebook.streaming.incremental import price_batch, stream_disclosures, stream_prices


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def first_page():
    return page([
        cells(href="/1"),
        cells(href="/1"),                                   # same row again
        cells(href="/2", insider="Roe", traded="bad date"),  # no trade date
        cells(href="/3", filed="not a date"),                # breaks a constraint
        cells(href=None, insider="Poe"),                     # no link
        cells(href="/4", ticker="BBB", company="B Co", kind="S - Sale"),
    ])


def test_disclosure_job(spark, store):
    pages = pages_frame(spark, first_page())
    first = run_disclosures(store, pages, metadata_frame(spark), AS_OF)
    assert (first.inserted, first.skipped, first.quarantined) == (3, 1, 2)
    assert (first.tickers_inserted, first.indexes_inserted, first.deactivated, first.reconciled) == (2, 6, 0, 0)
    stored = store.read("insider_data")
    assert rows(stored, "ticker", "insider_name", "trade_date", "source", "is_active") == [
        ("AAA", "Doe Jane", date(2024, 1, 18), "openinsider", 1),
        ("AAA", "Roe", None, "openinsider", 1),
        ("BBB", "Doe Jane", date(2024, 1, 18), "openinsider", 1),
    ]
    assert rows(store.read("ticker_data"), "ticker", "short_name") == [("AAA", "Triple A"), ("BBB", None)]
    assert sorted(store.manifest()["insider_data"]) == ["2024-01", "none"]

    again = run_disclosures(store, pages, metadata_frame(spark), LATER)
    assert (again.inserted, again.skipped, again.tickers_inserted, again.indexes_inserted) == (0, 4, 0, 0)
    assert rows(store.read("insider_data"), *stored.columns) == rows(stored, *stored.columns)
    assert {r["last_seen_at"].day for r in store.read("ticker_data").collect()} == {26}

    # An amendment in another run retires the stored row; other months stay untouched.
    amended = pages_frame(spark, page([cells(x="A", href="/9", price="$13.00")]), first_id=7)
    third = run_disclosures(store, amended, metadata_frame(spark), LATER + timedelta(days=1))
    assert (third.inserted, third.deactivated, third.reconciled) == (1, 1, 0)
    by_flag = {r["x_flags"]: r for r in store.read("insider_data").filter("ticker = 'AAA' and insider_name = 'Doe Jane'").collect()}
    assert by_flag["A"]["is_active"] == 1
    assert by_flag[""]["is_active"] == 0 and by_flag[""]["superseded_by"] == by_flag["A"]["transaction_id"]
    assert store.manifest()["insider_data"]["none"] < store.manifest()["insider_data"]["2024-01"]

    log = store.read("runs")
    assert rows(log, "run_id", "status", "rows_inserted", "rows_updated") == [
        (1, "SUCCESS", 11, 0), (2, "SUCCESS", 0, 0), (3, "SUCCESS", 1, 1)]


def test_page_order_decides_between_amendments(spark, store):
    page_ = page([cells(x="A", href="/n", filed="2024-01-20"), cells(x="A", href="/o", filed="2024-01-10")])
    result = run_disclosures(store, pages_frame(spark, page_), metadata_frame(spark), AS_OF, reconcile_all=True)
    assert (result.deactivated, result.reconciled) == (1, 0)
    active = store.read("insider_data").filter("is_active = 1").collect()
    assert [r["filing_date"] for r in active] == [date(2024, 1, 10)]


def test_failed_run_is_logged(spark, store):
    with pytest.raises(Exception, match="no table.tinytable"):
        run_disclosures(store, pages_frame(spark, "<p/>"), metadata_frame(spark), AS_OF)
    log = store.read("runs").collect()
    assert [r["status"] for r in log] == ["FAILED"] and "tinytable" in log[0]["error_message"]
    assert store.read("insider_data").count() == 0


def test_rejected_rows_are_kept_with_their_reasons(spark, store):
    run_disclosures(store, pages_frame(spark, first_page()), metadata_frame(spark), AS_OF)
    kept = store.read("rejected_rows").collect()
    assert sum(r["n_rows"] for r in kept) == 2 and {r["table_name"] for r in kept} == {"insider_data"}
    assert {r["violations"] for r in kept} == {"filing_date is required", "source_url is required"}
    assert any(json.loads(r["row_data"])["insider_name"] == "Poe" for r in kept)
    # scanned = accepted + copies + rejected
    assert 6 == store.read("insider_data").count() + 1 + 2
    run_disclosures(store, pages_frame(spark, first_page()), metadata_frame(spark), AS_OF)
    assert store.read("rejected_rows").count() == len(kept)  # the same run again adds nothing


def test_a_page_without_the_table_can_be_recorded(spark, store):
    pages = pages_frame(spark, "<p/>", page([cells(href="/1")]))
    result = run_disclosures(store, pages, metadata_frame(spark), AS_OF, record_pages_without_table=True)
    assert (result.inserted, result.quarantined) == (1, 1)
    (lost,) = store.read("rejected_rows").collect()
    assert lost["table_name"] == "pages" and json.loads(lost["row_data"])["page_id"] == 1


def test_rows_after_a_nested_table_stay(spark, store):
    inner = "A<table><tr><td>x </td><th>y</th></tr><tr><td><table><tr><td>z</td></tr></table></td></tr></table>B"
    html = page([cells(href="/1", company=inner), cells(href="/2", ticker="BBB")])
    run_disclosures(store, pages_frame(spark, html), metadata_frame(spark), AS_OF)
    assert rows(store.read("insider_data"), "ticker", "insider_name", "qty") == [("AAA", "Doe Jane", 1000), ("BBB", "Doe Jane", 1000)]
    assert rows(store.read("ticker_data"), "ticker", "company_name") == [("AAA", "AxyzB"), ("BBB", "A Co")]
    assert store.read("rejected_rows").count() == 0


def test_interleaved_jobs_lose_no_update(spark, store):
    seed_symbols(spark, store, {"A": None, "B": None})
    base = store.manifest()
    mine = store.read("ticker_data").withColumn("status", F.lit("MINE"))
    entry, _ = store.stage("ticker_data", mine)
    other = store.read("ticker_data").withColumn("status", F.lit("OTHER"))
    other_entry, _ = store.stage("ticker_data", other)
    assert entry != other_entry  # each stage has a folder of its own
    store.publish({"ticker_data": other_entry}, base)
    with pytest.raises(RuntimeError, match="ticker_data changed"):
        store.publish({"ticker_data": entry}, base)
    assert {r["status"] for r in store.read("ticker_data").collect()} == {"OTHER"}


def test_a_commit_that_is_overtaken_goes_on_top(spark, store, monkeypatch):
    """Another writer publishes between this one's look at the newest commit and its own commit."""
    entry, _ = store.stage("index_data", spark.createDataFrame([("^A", "a")], "ticker string, index_name string"))
    publish, others = SnapshotStore._publish, []

    def overtaken(self, version, manifest):
        if not others:
            others.append(True)
            seed_symbols(spark, SnapshotStore(spark, store.root), {"A": None})
        return publish(self, version, manifest)

    monkeypatch.setattr(SnapshotStore, "_publish", overtaken)
    assert store.publish({"index_data": entry}, {}) == 2
    assert rows(store.read("index_data"), "ticker") == [("^A",)] and rows(store.read("ticker_data"), "ticker") == [("A",)]


def test_runs_that_start_together_get_ids_of_their_own(spark, store, monkeypatch):
    record, ids = runs.run_record, []

    def interrupted(log, run_id, job, *args, **more):
        if not ids:
            ids.append(None)
            ids[0] = runs.start_run(SnapshotStore(spark, store.root), "other", AS_OF)
        return record(log, run_id, job, *args, **more)

    monkeypatch.setattr(runs, "run_record", interrupted)
    mine = runs.start_run(store, "mine", AS_OF)
    assert sorted([ids[0], mine]) == [1, 2]
    assert rows(store.read("runs"), "run_id", "job_name") == [(1, "other"), (2, "mine")]


def test_references_are_checked(spark, store):
    bars = spark.createDataFrame([("A",), ("Z",), (None,), ("Z",)], "ticker string")
    known = spark.createDataFrame([("A",), ("B",)], "ticker string")
    good, orphans = quality.split_references(bars, PRICING_DATA, {"ticker_data": known})
    assert rows(good, "ticker") == [("A",), (None,)] and good.columns == ["ticker"]
    assert rows(orphans, "ticker", "violations") == [("Z", ["ticker has no row in ticker_data"])] * 2
    unchecked, none = quality.split_references(bars, PRICING_DATA, {})
    assert unchecked.count() == 4 and none.count() == 0

    seed_symbols(spark, store, {"A": None})
    splits = spark.createDataFrame([("A", AS_OF, 2.0), ("Q", AS_OF, 2.0)], SPLITS)
    result = run_prices(store, feed_frame(spark, [bar("A", 25, 4.0), bar("Z", 25, 4.0)]), AS_OF, splits=splits)
    assert (result.price_rows, result.quarantined) == (1, 2)
    assert rows(store.read("rejected_rows"), "table_name", "violations") == [
        ("corporate_actions", "ticker has no row in ticker_data"), ("pricing_data", "ticker has no row in ticker_data"),
    ]


def test_sorted_export(spark, tmp_path):
    data = [(k * 7919 % 1000, f'v "{k}"' if k % 3 else None) for k in range(1000)]
    frame = spark.createDataFrame(data, "k int, v string").repartition(7)
    listed = export.write_sorted_csv(frame, str(tmp_path / "out"), ["k"], rows_per_part=100).orderBy("position").collect()
    assert len(listed) > 5 and sum(r.n_lines for r in listed) == 1000 and {r["columns"] for r in listed} == {"k,v"}
    joined = "".join((tmp_path / "out" / "parts" / r.part).read_text() for r in listed)
    want = sorted(data)
    assert [(int(a), b or None) for a, b in csv.reader(joined.splitlines())] == want
    lines = sorted(tuple(r) for r in export.read_sorted_lines(spark, str(tmp_path / "out")).collect())
    assert lines == [(i, line) for i, line in enumerate(joined.splitlines(), 1)]


def test_a_replayed_price_batch_changes_nothing(spark, store):
    seed_symbols(spark, store, {"A": None, "B": None})
    feed = feed_frame(spark, [bar("A", 25, 4.0)])
    for _ in range(3):
        price_batch(store, feed, 0, "stream", AS_OF)
    failures = store.read("ticker_failures").collect()
    assert [(r["ticker"], r["fail_count"]) for r in failures] == [("B", 1)]
    assert store.read("ticker_exclusions").count() == 0 and store.last_batch("stream") == 0
    price_batch(store, feed, 1, "stream", LATER)
    assert [r["fail_count"] for r in store.read("ticker_failures").collect()] == [2]


def test_repeated_requests_and_states_keep_keys(spark, store):
    seed_symbols(spark, store, {"A": None, "B": None})
    requests = spark.createDataFrame([("x", "A", True), ("x", "A", True), ("y", "A", True), ("y", "B", True)], REQUESTS)
    status = spark.createDataFrame([("y", None, None), ("y", None, "m")], BATCH_STATUS)
    run_prices(store, feed_frame(spark, [bar("A", 25, 4.0, "x"), bar("B", 25, 5.0, "y")]), AS_OF, requests=requests, batch_status=status)
    assert rows(store.read("ticker_data"), "ticker") == [("A",), ("B",)]
    assert rows(store.read("pricing_data"), "ticker", "close") == [("A", 4.0), ("B", 5.0)]


def test_store_versions(spark, store):
    assert store.version() == 0 and store.read("runs").count() == 0
    bars = spark.createDataFrame([("A", date(2024, 1, 2)), ("A", date(2024, 2, 2))], "ticker string, date date")
    store.commit({"pricing_data": bars})
    february = spark.createDataFrame([("B", date(2024, 2, 3))], "ticker string, date date")
    assert store.months_in("pricing_data", february) == ["2024-02"]
    store.commit({"pricing_data": february})
    folders = store.manifest()["pricing_data"]
    assert {m: int(f.split("-")[0]) for m, f in folders.items()} == {"2024-01": 1, "2024-02": 2}
    assert rows(store.read("pricing_data"), "ticker", "date") == [("A", date(2024, 1, 2)), ("B", date(2024, 2, 3))]
    assert rows(store.read("pricing_data", ["2024-01"]), "ticker") == [("A",)]
    before = store.manifest()
    assert store._publish(2, {}) is False and store.manifest() == before and store._publish(3, before)
    assert store._names("commits") and not [n for n in store._names("commits") if n.endswith(".tmp")]


def test_create_tables(store):
    store.create_tables()
    store.create_tables()
    assert store.version() == 1 and set(store.manifest()) == set(TABLES)
    assert all(store.read(name).count() == 0 for name in TABLES)


def feed_frame(spark, data):
    return spark.createDataFrame(data, OHLCV_LONG)


def bar(ticker, day, close, batch="b0"):
    return (batch, ticker, date(2024, 1, day), close, close, close, close, close, 10.0 if close is not None else None)


def seed_symbols(spark, store, statuses):
    frame = spark.createDataFrame(
        [(t, s, AS_OF, AS_OF) for t, s in statuses.items()],
        "ticker string, status string, first_seen_at timestamp, last_seen_at timestamp")
    store.commit({"ticker_data": TICKER_DATA.conform(frame)})


def test_price_job(spark, store):
    seed_symbols(spark, store, {"GOOD": None, "WATCHED": "WATCH", "GONE": "", "NULLS": "ACTIVE", "OUT": None,
                                "EXPIRED": None, "LATEBAD": "ACTIVE", "^DJI": None})
    old = datetime(2020, 1, 1)
    store.commit({
        "index_data": feeds.index_seed(spark).limit(2),
        "ticker_exclusions": spark.createDataFrame(
            [("OUT", "MANUAL", "r", "s", old, None, 1), ("EXPIRED", "TEMP", "r", "s", old, datetime(2024, 1, 1), 1)],
            TICKER_EXCLUSIONS.schema),
        "ticker_failures": spark.createDataFrame(
            [("GONE", "price", date(2020, 1, 1), "r", "Old", "msg", old, old, 2),
             ("GOOD", "price", date(2020, 1, 1), "r", "Old", "msg", old, old, 2),
             ("LATEBAD", "price", date(2020, 1, 1), "r", "Old", "msg", old, old, 1)], TICKER_FAILURES.schema),
    })
    feed = feed_frame(spark, [
        bar("GOOD", 24, 10.0), bar("GOOD", 25, 11.0), bar("GOOD", 10, 5.0), bar("WATCHED", 24, 3.0),
        bar("NULLS", 24, None), bar("EXPIRED", 25, 2.0), bar("OUT", 25, 1.0), bar("STRANGER", 25, 1.0),
        bar("^DJI", 25, 7.0, "b1"),
    ])
    requests = spark.createDataFrame(
        [("b0", t, True) for t in ("GOOD", "WATCHED", "GONE", "NULLS", "OUT", "EXPIRED")]
        + [("b1", "^DJI", False), ("b1", "^GSPC", False), ("b2", "LATEBAD", True)], REQUESTS)
    status = spark.createDataFrame([("b2", "Timeout", "read timed out")], BATCH_STATUS)
    splits = spark.createDataFrame(
        [("GOOD", datetime(2024, 1, 24, 5), 2.0), ("GOOD", datetime(2024, 1, 23), 0.0), ("^DJI", datetime(2024, 1, 24), 3.0),
         ("WATCHED", datetime(2024, 1, 24), -1.0)], SPLITS)
    dividends = spark.createDataFrame([("GONE", datetime(2024, 1, 24), 0.5), ("LATEBAD", datetime(2024, 1, 24), 0.5)], DIVIDENDS)
    result = run_prices(store, feed, AS_OF, splits=splits, dividends=dividends, batch_status=status, requests=requests)
    assert (result.requested, result.priced, result.price_rows, result.quarantined) == (8, 4, 5, 2)  # one is the stranger's
    assert rows(store.read("pricing_data"), "ticker", "date", "close") == [
        ("EXPIRED", date(2024, 1, 25), 2.0), ("GOOD", date(2024, 1, 24), 10.0), ("GOOD", date(2024, 1, 25), 11.0),
        ("WATCHED", date(2024, 1, 24), 3.0), ("^DJI", date(2024, 1, 25), 7.0)]
    assert rows(store.read("corporate_actions"), "ticker", "action_type", "split_ratio", "dividend_cash") == [
        ("GONE", "DIVIDEND", None, 0.5), ("GOOD", "SPLIT", 2.0, None)]
    failures = {r["ticker"]: r for r in store.read("ticker_failures").collect()}
    assert {t: (f["error_class"], f["fail_count"]) for t, f in failures.items()} == {
        "GONE": ("YFMissingTicker", 3), "NULLS": ("YFNoRows", 1), "LATEBAD": ("Timeout", 2), "^GSPC": ("YFMissingTicker", 1)}
    assert failures["GONE"]["error_message"] == "msg" and failures["GONE"]["first_seen_at"] == old
    assert failures["LATEBAD"]["error_message"] == "read timed out"
    symbols = {r["ticker"]: r for r in store.read("ticker_data").collect()}
    assert {t: s["status"] for t, s in symbols.items()} == {
        "GOOD": "ACTIVE", "WATCHED": "WATCH", "GONE": "EXCLUDED", "NULLS": "ACTIVE", "OUT": None, "EXPIRED": "ACTIVE",
        "LATEBAD": "ACTIVE", "^DJI": "ACTIVE", "^GSPC": "WATCH"}
    assert symbols["GOOD"]["last_price_date"] == date(2024, 1, 25) and symbols["NULLS"]["last_price_date"] is None
    assert symbols["OUT"]["last_price_attempt_at"] is None and symbols["GONE"]["last_price_attempt_at"] is not None
    assert symbols["^GSPC"]["company_name"] == "S&P 500"
    exclusions = {r["ticker"]: (r["status"], r["is_active"]) for r in store.read("ticker_exclusions").collect()}
    assert exclusions == {"OUT": ("MANUAL", 1), "EXPIRED": ("TEMP", 1), "GONE": ("NO_DATA", 1)}

    before = rows(store.read("pricing_data"), "ticker", "date", "close")
    rerun = run_prices(store, feed, AS_OF, requests=requests, batch_status=status)
    assert rerun.requested == 7 and rows(store.read("pricing_data"), "ticker", "date", "close") == before


def test_outcomes_count_twice_when_nothing_is_usable(spark, store):
    seed_symbols(spark, store, {"A": None, "B": None, "C": None})
    feed = feed_frame(spark, [bar("A", 24, None, "x"), bar("B", 24, None, "x")])
    run_prices(store, feed, AS_OF, requests=spark.createDataFrame(
        [("x", "A", True), ("x", "B", True), ("y", "C", True)], REQUESTS))
    got = {r["ticker"]: (r["error_class"], r["fail_count"]) for r in store.read("ticker_failures").collect()}
    assert got == {"A": ("YFNoNormalizedRows", 2), "B": ("YFNoNormalizedRows", 2), "C": ("YFEmptyBatch", 1)}
    assert store.read("pricing_data").count() == 0 and store.read("pricing_data").columns == PRICING_DATA.columns


def test_export(spark, store, tmp_path):
    seed_symbols(spark, store, {'quo"te, comma': "", "B": None})
    written = export.export_csv(store, str(tmp_path / "csv"))
    assert len(written) == len(TABLES)
    parts = glob.glob(str(tmp_path / "csv" / "ticker_data" / "part-*.csv"))
    got = [r for p in parts for r in csv.DictReader(open(p, newline=""))]
    assert sorted(r["ticker"] for r in got) == ["B", 'quo"te, comma'] and {r["status"] for r in got} == {""}
    back = spark.read.schema(TICKER_DATA.schema).option("header", True).option("escape", '"').csv(written[0])
    assert back.count() == 2


def test_readers(spark, tmp_path):
    feed = feed_frame(spark, [bar("A", 24, 1.0), bar("A", 25, None)])
    for fmt in ("parquet", "json", "csv", "orc"):
        path = str(tmp_path / fmt)
        feed.write.format(fmt).option("header", True).save(path)
        got = feeds.read_prices(spark, path, ("2024-01-25", "2024-01-26"), fmt)
        assert rows(got, "ticker", "date", "close") == [("A", date(2024, 1, 25), None)]
    text_info = metadata_frame(spark).select("ticker", F.to_json("info").alias("info"))
    assert rows(feeds.metadata_columns(text_info), "ticker", "short_name") == [("AAA", "Triple A"), ("^GSPC", "SPX")]


def test_landed_actions_keep_bad_rows(spark, tmp_path):
    lines = ["ticker,action_date,ratio", "A,2024-01-24 05:00:00,2.0", "B,never,2.0", ",2024-01-24 05:00:00,x", "C,2024-01-24 05:00:00,"]
    (tmp_path / "splits.csv").write_text("\n".join(lines))
    good, bad = feeds.read_actions(spark, str(tmp_path / "splits.csv"), SPLITS)
    assert good.schema == SPLITS and rows(good, "ticker", "ratio") == [("A", 2.0), ("C", None)]
    assert sorted((r["ticker"], tuple(r["violations"])) for r in bad.collect() if r["ticker"]) == [("B", ("action_date is no timestamp",))]
    assert good.count() + bad.count() == 4


def test_streams_are_incremental_and_idempotent(spark, store, tmp_path):
    landing, check = str(tmp_path / "landing"), str(tmp_path / "check")
    clock = lambda: AS_OF

    def drain(checkpoint=check):
        query = stream_disclosures(store, landing, checkpoint, metadata_frame(spark), clock)
        query.awaitTermination()

    pages_frame(spark, page([cells(href="/1")])).write.mode("append").parquet(landing)
    drain()
    assert store.read("insider_data").count() == 1
    pages_frame(spark, page([cells(href="/2", x="A")]), first_id=2).write.mode("append").parquet(landing)
    drain()
    assert rows(store.read("insider_data"), "x_flags", "is_active") == [("", 0), ("A", 1)]
    drain(str(tmp_path / "other"))  # replay everything
    assert rows(store.read("insider_data"), "x_flags", "is_active") == [("", 0), ("A", 1)]
    prices = str(tmp_path / "prices")
    feed_frame(spark, [bar("AAA", 25, 4.0)]).write.parquet(prices)
    stream_prices(store, prices, str(tmp_path / "check2"), clock).awaitTermination()
    assert rows(store.read("pricing_data"), "ticker", "close") == [("AAA", 4.0)]


def test_scratch_uses_the_shared_folder_and_cleans_up(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    with Scratch(spark, str(tmp_path)) as scratch:
        assert scratch.root.startswith(f"{shared}/tapebook/")
        assert scratch.write(spark.range(3), "rows").count() == 3 and os.path.exists(scratch.root)
    assert not os.path.exists(scratch.root) and not list(tmp_path.iterdir())


def test_numbers_come_from_the_writes(spark, store, monkeypatch):
    """Only tables of the last commit are counted, never what the run has written."""
    run_disclosures(store, pages_frame(spark, first_page()), metadata_frame(spark), AS_OF)
    stored = {f for t in ("ticker_data", "index_data") for f in store.read(t).inputFiles()}
    count = type(spark.range(1)).count

    def watched(df):
        assert set(df.inputFiles()) <= stored
        return count(df)

    monkeypatch.setattr(type(spark.range(1)), "count", watched)
    pages = pages_frame(spark, page([cells(href="/1"), cells(href="/9", x="A"), cells(href="/5", filed="no")]), first_id=2)
    again = run_disclosures(store, pages, metadata_frame(spark), LATER)
    assert (again.inserted, again.skipped, again.quarantined, again.tickers_inserted) == (1, 1, 1, 0)
    stored |= set(store.read("ticker_data").inputFiles())
    priced = run_prices(store, feed_frame(spark, [bar("AAA", 25, 4.0), bar("ZZZ", 25, 1.0)]), LATER)
    assert (priced.priced, priced.price_rows, priced.quarantined) == (1, 1, 1)


def test_observed_numbers_of_empty_rows(spark, tmp_path):
    with Scratch(spark, str(tmp_path)) as scratch:
        for rows in (spark.range(0), spark.range(5).join(spark.range(9, 12), "id"), spark.range(5).limit(0)):
            seen = Observed(n=F.count(F.lit(1)), s=F.sum("id"))
            assert scratch.write(rows, "none", seen).count() == 0 and (seen["n"], seen["s"]) == (0, 0)
        seen = Observed(n=F.count(F.lit(1)), s=F.sum("id"))
        scratch.write(spark.range(5).repartition(3), "some", seen)
        assert (seen["n"], seen["s"]) == (5, 10)
