from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, LATER, metadata_frame, tx
from tapebook.functions import identity
from tapebook.operators import actions, health, keyed, paging, prices, quality, runs, symbols
from tapebook.schemas import CORPORATE_ACTIONS, INDEX_DATA, INSIDER_DATA, METADATA, OHLCV_LONG, PRICING_DATA, RUNS, TABLES, TICKER_DATA
from tapebook.sources import feeds


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    once = keyed.insert_if_absent(target, batch, ["k"], "v")
    assert rows(once, "k", "v") == [("a", 1), ("b", 2)]
    assert rows(keyed.insert_if_absent(once, batch, ["k"], "v"), "k", "v") == rows(once, "k", "v")


def test_upsert_update_delete(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 7), ("b", 8), ("c", 9)], "k string, v int")
    merged = keyed.upsert(target, batch, ["k"], F.col("v").desc())
    assert rows(merged, "k", "v") == [("a", 1), ("b", 8), ("c", 9)]
    hit = spark.createDataFrame([("a", 5)], "k string, v int")
    assert rows(keyed.update_keys(target, hit, ["k"], {"v": F.col("v") + F.col("new_v")}), "k", "v") == [("a", 6), ("b", 2)]
    assert rows(keyed.delete_keys(target, hit, ["k"]), "k", "v") == [("b", 2)]
    assert rows(keyed.present_keys(target, batch, ["k"]), "k", "v") == [("b", 2)]


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = keyed.first_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_defaults_and_constraints(spark):
    df = tx(spark, [
        {"transaction_id": "ok"}, {"transaction_id": "f", "filing_date": None}, {"transaction_id": "u", "source_url": None},
        {"transaction_id": "p", "price": -1.0}, {"transaction_id": "c", "classification": "X", "is_open_market": 2},
    ])
    good, bad = quality.split_valid(df, INSIDER_DATA)
    assert [r["transaction_id"] for r in good.collect()] == ["ok"]
    assert {r["transaction_id"]: r["violations"] for r in bad.collect()} == {
        "f": ["filing_date is required"], "u": ["source_url is required"], "p": ["price check"],
        "c": ["is_open_market check", "classification check"],
    }
    strict, _ = quality.split_valid(df, INSIDER_DATA, fail_fast=True)
    with pytest.raises(Exception, match="insider_data"):
        strict.collect()


@pytest.mark.parametrize("value", [1e100, 1e-100, 5e-324, 1.7976931348623157e308, 2.5e-10, -3.25e123, 1e16, 1e-5])
def test_texts_of_extreme_values(spark, value):
    got = spark.range(1).select(identity.float_text(F.lit(value)).alias("t")).first().t
    assert got == repr(value)


def test_action_constraints(spark):
    splits = spark.createDataFrame([("A", -1.0), ("B", 0.0), ("C", None), ("D", 2.0)], "ticker string, ratio double")
    divs = spark.createDataFrame([("A", -1.0), ("B", 0.0), ("C", None), ("D", 0.5)], "ticker string, cash double")
    day = F.lit("2024-01-02 05:00:00").cast("timestamp")
    batch = actions.action_rows(splits.withColumn("action_date", day), divs.withColumn("action_date", day), AS_OF)
    good, bad = quality.split_valid(batch, CORPORATE_ACTIONS)
    assert rows(good, "ticker", "action_type", "split_ratio", "dividend_cash") == [
        ("B", "DIVIDEND", None, 0.0), ("D", "DIVIDEND", None, 0.5), ("D", "SPLIT", 2.0, None)]
    assert rows(bad, "ticker", "violations") == [("A", ["dividend_cash check"]), ("A", ["split_ratio check"])]
    once = actions.upsert_actions(CORPORATE_ACTIONS.empty(spark), good)
    later = actions.upsert_actions(once, good.withColumn("fetched_at", F.lit("2030-01-01 00:00:00").cast("timestamp")))
    assert later.count() == 3 and {r["fetched_at"].year for r in later.collect()} == {2030}


def test_orphans(spark):
    child = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "ticker string, v int")
    parent = spark.createDataFrame([("a",)], "ticker string")
    assert rows(quality.orphan_keys(child, parent, "ticker", "ticker"), "key", "n_rows") == [("b", 2)]
    marked = quality.mark_orphans(child, parent, "ticker", "ticker")
    assert rows(marked, "v", "_orphan") == [(1, False), (2, True), (3, True), (4, False)]


def test_repeated_batch_keys_leave_one_row_per_key(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("a", 5), ("a", 7), ("c", 3), ("c", None)], "k string, v int")
    updated = keyed.update_keys(target, batch, ["k"], {"v": F.col("new_v")})
    assert rows(updated, "k", "v") == [("a", 7), ("b", 2)]
    merged = keyed.merge(target, batch, ["k"], matched={"v": F.col("new_v")}, inserted={"v": F.col("new_v")})
    assert rows(merged, "k", "v") == [("a", 7), ("b", 2), ("c", 3)]


def test_repeated_metadata_leaves_one_row_per_symbol(spark):
    metadata = spark.createDataFrame(
        [("AAA", {"shortName": "Z"}), ("AAA", {"shortName": "B", "sector": "S"}), ("^GSPC", {"shortName": "X"}), ("^GSPC", {})], METADATA)
    seen = tx(spark, [{"ticker": "AAA"}]).withColumn("company_name", F.lit("A Co"))
    got = symbols.ingest_tickers(TICKER_DATA.empty(spark), seen, metadata, AS_OF)
    assert rows(got, "ticker", "short_name", "sector") == [("AAA", "B", "S")]
    seeds = spark.createDataFrame([("^GSPC", "S&P 500")], "ticker string, index_name string")
    indexes = symbols.upsert_indexes(INDEX_DATA.empty(spark), seeds, metadata)
    assert rows(indexes, "ticker", "short_name") == [("^GSPC", "X")]


def test_feed_rows_count_for_their_own_batch(spark):
    requests = spark.createDataFrame([("x", "A"), ("x", "A"), ("y", "A"), ("y", "B")], "batch_id string, ticker string")
    feed = spark.createDataFrame(
        [("x", "A", 1.0), (None, "B", 2.0), ("z", "A", 3.0)], "batch_id string, ticker string, close double"
    ).withColumns({c: F.lit(None).cast("double") for c in ("open", "high", "low", "adj_close", "volume")})
    status = spark.createDataFrame([("x", None, None), ("x", None, "again")], "batch_id string, error_class string, error_message string")
    got = health.feed_outcomes(requests, health.feed_counts(feed), status)
    assert rows(got, "batch_id", "ticker", "n_usable", "succeeded") == [("x", "A", 1, True), ("y", "A", 0, False), ("y", "B", 1, True)]


def test_ticker_ingest(spark):
    batch = tx(spark, [{"ticker": "AAA", "pos": 2}, {"ticker": "AAA", "pos": 1}, {"ticker": "OLD"}]).withColumn(
        "company_name", F.concat("ticker", F.col("pos").cast("string")))
    known = quality.fill_defaults(spark.createDataFrame([("OLD", "Old Co")], "ticker string, company_name string"),
                                  TICKER_DATA, AS_OF)
    got = symbols.ingest_tickers(known, batch, metadata_frame(spark), LATER)
    assert rows(got, "ticker", "company_name", "short_name", "sector", "country") == [
        ("AAA", "AAA1", "Triple A", "Tech", None), ("OLD", "Old Co", None, None, None)]
    seen = {r["ticker"]: (r["first_seen_at"].day, r["last_seen_at"].day) for r in got.collect()}
    assert seen == {"AAA": (26, 26), "OLD": (25, 26)}


def test_indexes_and_placeholders(spark):
    seeds = feeds.index_seed(spark)
    once = symbols.upsert_indexes(INDEX_DATA.empty(spark), seeds, metadata_frame(spark))
    assert once.count() == 6 and once.filter("short_name = 'SPX'").count() == 1
    renamed = spark.createDataFrame([("^DJI", "Dow")], "ticker string, index_name string")
    assert symbols.upsert_indexes(once, renamed).filter("index_name = 'Dow'").count() == 0
    assert symbols.upsert_indexes(once, renamed, overwrite=True).filter("index_name = 'Dow'").count() == 1
    ensured = symbols.ensure_tickers(TICKER_DATA.empty(spark), seeds, AS_OF, "index_name")
    assert ensured.filter("company_name = short_name").count() == 6
    assert symbols.ensure_tickers(ensured, seeds, LATER).count() == 6


def test_prices(spark):
    nan = float("nan")
    feed = spark.createDataFrame([
        ("b", "A", date(2024, 1, 2), 1.0005, 2.0, 0.5, 1.5, 1.4, 100.9),
        ("b", "A", date(2024, 1, 3), nan, nan, nan, 1.6, None, nan),
        ("b", "A", date(2024, 1, 4), nan, None, nan, nan, None, nan),
    ], OHLCV_LONG)
    batch = prices.cast_prices(prices.drop_empty_days(feed), AS_OF)
    assert rows(batch, "date", "open", "close", "volume") == [
        (date(2024, 1, 2), 1.0005, 1.5, 100), (date(2024, 1, 3), None, 1.6, None)]
    stored = prices.upsert_prices(PRICING_DATA.empty(spark), batch)
    newer = prices.cast_prices(feed.limit(1).withColumn("close", F.lit(9.0)), LATER)
    merged = prices.upsert_prices(stored, newer)
    assert rows(merged, "date", "close") == [(date(2024, 1, 2), 9.0), (date(2024, 1, 3), 1.6)]
    legacy = prices.insert_prices_if_absent(merged, feed.withColumn("date", F.date_add("date", 1)), LATER)
    assert rows(legacy, "date", "open", "close") == [
        (date(2024, 1, 2), 1.0005, 9.0), (date(2024, 1, 3), None, 1.6), (date(2024, 1, 4), None, 1.6)]
    windowed = prices.insert_prices_if_absent(PRICING_DATA.empty(spark), feed, AS_OF.replace(day=3), term_days=1)
    assert rows(windowed, "date", "open", "close") == [(date(2024, 1, 2), 1.0, 1.5), (date(2024, 1, 3), None, 1.6)]
    trades = spark.createDataFrame([(1, "A", date(2024, 1, 2)), (2, "A", date(2024, 1, 9)), (3, "B", date(2024, 1, 2))],
                                   "id int, ticker string, trade_date date")
    assert rows(prices.price_on_date(trades, merged, "trade_date"), "id", "close_on_date", "low_on_date") == [
        (1, 9.0, 0.5), (2, None, None), (3, None, None)]


def test_wide_and_long_agree(spark):
    wide = spark.createDataFrame(
        [(date(2024, 1, 2), 1.0, 10.0, None), (date(2024, 1, 3), None, None, 5.0)],
        "date date, `A|Close` double, `A|Volume` double, `B.X|Adj Close` double")
    got = prices.drop_empty_days(prices.wide_to_long(wide))
    assert rows(got, "ticker", "date", "close", "adj_close", "volume") == [
        ("A", date(2024, 1, 2), 1.0, None, 10.0), ("B.X", date(2024, 1, 3), None, 5.0, None)]
    single = wide.select("date", F.col("`A|Close`").alias("Close"))
    assert rows(prices.drop_empty_days(prices.wide_to_long(single, "Z")), "ticker", "close") == [("Z", 1.0)]


def test_price_stats_brute_force(spark):
    import random
    from datetime import timedelta

    rng = random.Random(5)
    data = []
    for t in ("A", "B"):
        day = date(2020, 1, 1)
        for _ in range(300):
            day += timedelta(days=rng.choice([1, 1, 1, 3, 40]))
            close = None if rng.random() < 0.05 else round(rng.uniform(1, 100), 2)
            data.append((t, day, close, None if close is None else close - 1, None if close is None else close + 1))
    df = spark.createDataFrame(data, "ticker string, date date, close double, low double, high double")
    got = {(r["ticker"], r["date"]): r for r in prices.price_stats(df).collect()}
    for t in ("A", "B"):
        mine = [r for r in data if r[0] == t]
        for i, r in enumerate(mine):
            span = [x for x in mine[: i + 1] if (r[1] - x[1]).days <= 364 and x[2] is not None]
            s = got[(t, r[1])]
            assert s["low_52w"] == (pytest.approx(min(x[3] for x in span), abs=6e-4) if span else None)
            assert s["high_52w"] == (pytest.approx(max(x[4] for x in span), abs=6e-4) if span else None)
            for n, c in ((50, "avg_50"), (200, "avg_200")):
                closes = [x[2] for x in mine[max(0, i + 1 - n): i + 1] if x[2] is not None]
                assert s[c] == (pytest.approx(sum(closes) / len(closes), abs=6e-4) if closes else None)
    for r in prices.latest_stats(df).collect():
        assert r == got[(r["ticker"], r["date"])] and r["date"] == max(x[1] for x in data if x[0] == r["ticker"])


def test_averages_of_extreme_closes(spark):
    closes = {"big": [1e19, 1.0], "small": [1e-3, 1e-12], "nan": [float("nan"), 4.0], "none": [None, None]}
    data = [(t, date(2024, 1, 1 + i), c, c, c) for t, cs in closes.items() for i, c in enumerate(cs)]
    df = spark.createDataFrame(data, "ticker string, date date, close double, low double, high double")
    got = {(r["ticker"], r["date"].day): (r["avg_50"], r["high_52w"]) for r in prices.price_stats(df).collect()}
    assert got[("big", 1)] == (1e19, 1e19) and got[("big", 2)] == (5e18, 1e19)
    assert got[("small", 2)] == (0.001, 0.001) and got[("nan", 1)] == (None, None) and got[("nan", 2)] == (4.0, 4.0)
    assert got[("none", 2)] == (None, None)
    last = {r["ticker"]: (r["avg_50"], r["high_52w"]) for r in prices.latest_stats(df).collect()}
    assert last == {t: got[(t, 2)] for t in closes}


def test_incremental_latest_date(spark):
    day = [date(2024, 1, d) for d in range(1, 6)]
    history = spark.createDataFrame([("A", d) for d in day], "ticker string, date date")
    tickers = spark.createDataFrame([("A", day[2]), ("B", day[0]), ("C", None)], "ticker string, last_price_date date")
    got = prices.write_back_latest(tickers, prices.latest_dates(history))
    assert rows(got, "ticker", "last_price_date") == [("A", day[4]), ("B", day[0]), ("C", None)]


def test_runs(spark):
    log = RUNS.empty(spark)
    assert runs.next_run_id(log) == 1
    log = runs.run_record(log, 1, "job", AS_OF)
    assert rows(log, "run_id", "status", "rows_inserted", "finished_at") == [(1, "RUNNING", 0, None)]
    log = runs.run_record(log, 1, "job", AS_OF, finished_at=LATER, status="FAILED", error_message="x")
    assert rows(log, "run_id", "status", "error_message") == [(1, "FAILED", "x")] and runs.next_run_id(log) == 2
    assert runs.scalar(log.filter("run_id = 9").select("status"), "none") == "none"
    assert rows(runs.table_counts({"runs": log, "empty": log.limit(0)}), "table_name", "n_rows") == [("empty", 0), ("runs", 1)]


def test_counters(spark):
    target = spark.createDataFrame([("a",)], "k string")
    batch = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    got = runs.ingest_counters(runs.label_ingest(batch, target, ["k"])).first()
    assert (got["inserted"], got["skipped"]) == (1, 2)


def test_batches_and_pages(spark):
    symbols_ = spark.range(120).select(F.col("id").cast("string").alias("ticker"))
    sizes = {r["batch_id"]: r["count"] for r in paging.assign_batches(symbols_, 50).groupBy("batch_id").count().collect()}
    assert sizes == {"0": 50, "1": 50, "2": 20}
    df = spark.range(10)
    assert [r["id"] for r in paging.page_of(df, [paging.By("id", descending=True)], 2, 4).collect()] == [5, 4, 3, 2]


def test_every_table_has_an_empty_frame(spark):
    for table in TABLES.values():
        assert table.empty(spark).columns == table.columns
        assert set(table.keys) <= set(table.columns)


def test_set_operations(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "t string")
    b = spark.createDataFrame([("y",), ("z",)], "t string")
    assert rows(keyed.difference(a, b), "t") == [("x",)] and rows(keyed.intersection(a, b), "t") == [("y",)]


def test_keep_keys(spark):
    from tapebook.operators.skew import keep_keys

    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("z", 4)], "t string, v int")
    wanted = spark.createDataFrame([("x",), ("z",)], "t string")
    for hot_rows in (1, 100):
        assert rows(keep_keys(df, wanted, ["t"], hot_rows), "v") == [(1,), (2,), (4,)]
