"""Inserts, upserts, touches, deletes, counters and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import actions, key_bits, keyed, runs, symbols
from ..schemas import CORPORATE_ACTIONS, INDEX_DATA, RUNS, TICKER_DATA
from ..session import Scratch, scratch_root
from ..sources import bucketed, feeds
from ..sources.store import month_of
from .registry import AS_OF, TX_SQL, bars, bars_sql, day_text, disclosures, query, shared_path, table


@query(
    "insert_if_absent",
    f"""WITH {TX_SQL}, s AS (SELECT transaction_id, min(filing_date) AS filing_date FROM tx GROUP BY ALL)
  SELECT *, CASE WHEN filing_date < '1999-01-01' THEN 'stored' ELSE 'new' END AS origin FROM s""",
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch overlaps the stored rows by one year; those are skipped."""
    rows = disclosures(spark, sf_dir).select("transaction_id", "filing_date")
    early = rows.filter("filing_date < date'1999-01-01'")
    stored = keyed.first_per_key(early, ["transaction_id"], "filing_date").withColumn("origin", F.lit("stored"))
    batch = rows.filter("filing_date >= date'1998-01-01'").withColumn("origin", F.lit("new"))
    merged = keyed.insert_if_absent(stored, batch, ["transaction_id"], "filing_date")
    return merged.withColumn("filing_date", day_text("filing_date"))


@query(
    "insert_by_bitmap",
    f"""WITH {TX_SQL} SELECT DISTINCT transaction_id, filing_date FROM tx
  WHERE filing_date >= '1998-06-01' AND (transaction_id, filing_date) NOT IN (
    SELECT (transaction_id, filing_date) FROM tx WHERE filing_date < '1999-01-01')""",
)
def insert_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch overlaps the stored rows by seven months; bitmaps of their keys tell which months to read."""
    rows = disclosures(spark, sf_dir).select("transaction_id", "filing_date", month_of("filing_date").alias("month")).distinct()
    keys = ["transaction_id", "filing_date"]
    stored, batch = rows.filter("filing_date < date'1999-01-01'"), rows.filter("filing_date >= date'1998-06-01'")
    scratch = Scratch(spark, scratch_root(spark))
    bits = scratch.write(key_bits.key_bits(stored, "month", keys), "bits")
    fresh = key_bits.absent_rows(batch, bits, "month", keys, lambda months: stored.filter(F.col("month").isin(months)), scratch)
    return fresh.select("transaction_id", day_text("filing_date").alias("filing_date"))


_LINES = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
_BY_KEY = bucketed.Buckets(("l_orderkey", "l_linenumber"), 16)


def _bucketed_lines(spark: SparkSession, sf_dir: str, change: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """What ``change`` makes of lines stored in buckets and the lines shipped later."""
    rows = table(spark, sf_dir, "lineitem").select(*_BY_KEY.keys, *_LINES)
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    name, path = f"lines_{uuid.uuid4().hex}", shared_path(spark, "lines")
    stored = bucketed.write_bucketed(keyed.first_per_key(rows.filter(early), _BY_KEY.keys, *_LINES), name, f"{path}/stored", _BY_KEY)
    changed = bucketed.write_bucketed(change(stored, rows.filter(~early)), f"{name}_new", f"{path}/new", _BY_KEY, in_place=True)
    columns = changed.columns
    for known in (name, f"{name}_new"):  # the files stay
        spark.sql(f"DROP TABLE {known}")
    return spark.read.parquet(f"{path}/new").select(*columns).withColumn("l_shipdate", day_text("l_shipdate"))


_SPLIT_SQL = """s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
    l_shipdate >= DATE '1998-01-01' AS is_new FROM lineitem),
  one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, is_new
    ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1)"""


@query(
    "bucketed_upsert",
    f"""WITH {_SPLIT_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM one
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY is_new DESC) = 1""",
)
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New lines replace stored ones in a bucketed table; the stored side isn't shuffled."""
    return _bucketed_lines(spark, sf_dir, lambda stored, new: bucketed.upsert(stored, new, _BY_KEY, *_LINES))


@query(
    "bucketed_insert",
    f"""WITH {_SPLIT_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM one a WHERE is_new AND NOT EXISTS (
    SELECT 1 FROM one b WHERE NOT b.is_new AND b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)""",
)
def bucketed_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that an insert adds to a bucketed table."""
    return _bucketed_lines(spark, sf_dir, lambda stored, new: bucketed.insert_if_absent(stored, new, _BY_KEY, *_LINES))


@query(
    "insert_first_wins",
    """WITH s AS (
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
      CASE WHEN l_shipdate < DATE '1998-01-01' THEN 0 ELSE 1 END AS is_new FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM s
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY is_new, l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def insert_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").select(*keys, *order)
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    stored = keyed.first_per_key(rows.filter(early), keys, *order)
    return keyed.insert_if_absent(stored, rows.filter(~early), keys, *order).drop("l_shipdate")


@query(
    "latest_wins_upsert",
    f"""WITH {bars_sql('stored', but='purchase')}, {bars_sql('batch', 'purchase')}
  SELECT ticker, strftime(date, '%Y-%m-%d') AS date, close, volume, 'batch' AS origin FROM batch
  UNION ALL
  SELECT ticker, strftime(date, '%Y-%m-%d'), close, volume, 'stored' FROM stored s
  WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.ticker = s.ticker AND b.date = s.date)""",
)
def latest_wins_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase bars replace the other bars of the same symbol and day."""
    columns = ["ticker", "date", "close", "volume", "origin"]
    stored = bars(spark, sf_dir, but="purchase").withColumn("origin", F.lit("stored")).select(*columns)
    batch = bars(spark, sf_dir, "purchase").withColumn("origin", F.lit("batch")).select(*columns)
    merged = keyed.upsert(stored, batch, ["ticker", "date"], F.col("volume").desc())
    return merged.withColumn("date", day_text("date"))


@query(
    "split_dividend_rows",
    """SELECT CAST(l_orderkey AS VARCHAR) || '/' || l_partkey || '/' || l_suppkey || '/' || l_linenumber AS ticker,
    strftime(l_shipdate, '%Y-%m-%d') AS action_date, 'SPLIT' AS action_type, l_discount AS split_ratio,
    CAST(NULL AS DOUBLE) AS dividend_cash FROM lineitem WHERE l_discount <> 0
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR) || '/' || l_partkey || '/' || l_suppkey || '/' || l_linenumber,
    strftime(l_shipdate, '%Y-%m-%d'), 'DIVIDEND', NULL, nullif(l_tax, 0.05) FROM lineitem WHERE l_tax <> 0.05""",
)
def split_dividend_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("ticker"),
        F.col("l_shipdate").alias("action_date"),
        F.col("l_discount").alias("ratio"),
        F.nullif("l_tax", F.lit(0.05)).alias("cash"),
    )
    rows = actions.action_rows(lines, lines, AS_OF)
    return rows.select(
        "ticker", day_text("action_date").alias("action_date"), "action_type", "split_ratio", "dividend_cash"
    )


@query(
    "action_upsert",
    """WITH a AS (
    SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_shipdate AS action_date, l_discount AS ratio, l_tax AS cash
    FROM lineitem),
  s AS (SELECT ticker, action_date, 'SPLIT' AS action_type, max(ratio) AS split_ratio, CAST(NULL AS DOUBLE) AS dividend_cash
    FROM a WHERE ratio <> 0 GROUP BY ALL),
  d AS (SELECT ticker, action_date, 'DIVIDEND' AS action_type, CAST(NULL AS DOUBLE) AS split_ratio, max(cash) AS dividend_cash
    FROM a GROUP BY ALL)
  SELECT ticker, strftime(action_date, '%Y-%m-%d') AS action_date, action_type, split_ratio, dividend_cash
  FROM (SELECT * FROM s UNION ALL SELECT * FROM d)""",
)
def action_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (symbol, day, type) rows collapse to one."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_shipdate").alias("action_date"),
        F.col("l_discount").alias("ratio"),
        F.col("l_tax").alias("cash"),
    )
    merged = actions.upsert_actions(CORPORATE_ACTIONS.empty(spark), actions.action_rows(lines, lines, AS_OF))
    return merged.select(
        "ticker", day_text("action_date").alias("action_date"), "action_type", "split_ratio", "dividend_cash"
    )


RECENT = "2001-01-01"


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to a day, which are the stored rows, and those from it on, which are the batch."""
    orders = table(spark, sf_dir, "orders")
    recent = F.col("o_orderdate") >= F.lit(RECENT).cast("timestamp_ntz")
    return orders.filter(~recent), orders.filter(recent)


@query(
    "update_touch",
    f"""WITH old AS (SELECT o_custkey, min(o_orderpriority) AS mark FROM orders WHERE o_orderdate < DATE '{RECENT}' GROUP BY ALL),
  new AS (SELECT o_custkey, max(o_orderpriority) AS latest FROM orders WHERE o_orderdate >= DATE '{RECENT}' GROUP BY ALL)
  SELECT old.o_custkey, coalesce(latest, mark) AS mark FROM old LEFT JOIN new USING (o_custkey)""",
)
def update_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with older orders are stored; every recent order is a batch row, so keys repeat."""
    old, new = _orders(spark, sf_dir)
    stored = old.groupBy("o_custkey").agg(F.min("o_orderpriority").alias("mark"))
    return keyed.update_keys(stored, new.select("o_custkey", "o_orderpriority"), ["o_custkey"], {"mark": F.col("new_o_orderpriority")})


@query(
    "keyed_delete",
    f"""SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderdate < DATE '{RECENT}' AND NOT EXISTS (
    SELECT 1 FROM orders n WHERE n.o_custkey = o.o_custkey AND n.o_orderdate >= DATE '{RECENT}')""",
)
def keyed_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older orders go whose customer has a recent one."""
    old, new = _orders(spark, sf_dir)
    return keyed.delete_keys(old.select("o_orderkey", "o_custkey"), new.select("o_custkey"), ["o_custkey"])


@query(
    "ticker_ingest",
    f"""WITH known AS (SELECT * FROM customer WHERE c_custkey IN (
    SELECT o_custkey FROM orders WHERE o_orderdate < DATE '{RECENT}')),
  seen AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= DATE '{RECENT}'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
  SELECT CAST(coalesce(k.c_custkey, s.o_custkey) AS VARCHAR) AS ticker,
    CASE WHEN k.c_custkey IS NOT NULL THEN k.c_name ELSE s.o_orderpriority END AS company_name,
    CASE WHEN k.c_custkey IS NOT NULL THEN k.c_mktsegment ELSE m.c_mktsegment END AS sector,
    CASE WHEN k.c_custkey IS NULL THEN m.c_name END AS short_name,
    s.o_custkey IS NOT NULL AS touched, k.c_custkey IS NULL AS added
  FROM known k FULL JOIN seen s ON k.c_custkey = s.o_custkey
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) m ON m.c_custkey = s.o_custkey""",
)
def ticker_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: customers with older orders. Seen: customers with recent ones. All metadata lands twice,
    once under another name."""
    customers = table(spark, sf_dir, "customer").withColumn("ticker", F.col("c_custkey").cast("string"))
    old, new = _orders(spark, sf_dir)
    long_ago = F.lit("1990-01-01 00:00:00").cast("timestamp")
    known = TICKER_DATA.conform(
        customers.join(old.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi").select(
            "ticker",
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("sector"),
            long_ago.alias("first_seen_at"),
            long_ago.alias("last_seen_at"),
        )
    )
    info = F.to_json(F.struct(F.col("c_mktsegment").alias("sector"), F.col("c_name").alias("shortName")))
    again = F.to_json(F.struct(F.lit("none").alias("sector"), F.concat("c_name", F.lit(" again")).alias("shortName")))
    metadata = customers.filter(F.col("c_acctbal") > 0).select("ticker", F.explode(F.array(again, info)).alias("info"))
    batch = new.select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.col("o_orderpriority").alias("company_name"),
        F.unix_date(F.to_date("o_orderdate")).alias("page_id"),
        F.col("o_orderkey").alias("pos"),
    )
    result = symbols.ingest_tickers(known, batch, metadata, AS_OF)
    return result.select(
        "ticker", "company_name", "sector", "short_name",
        (F.col("last_seen_at") > long_ago).alias("touched"),
        (F.col("first_seen_at") > long_ago).alias("added"),
    )


@query(
    "seed_table_upsert",
    """WITH seeds(ticker, index_name) AS (VALUES ('^GSPC', 'S&P 500'), ('^DJI', 'Dow Jones Industrial Average'),
    ('^IXIC', 'NASDAQ'), ('^VIX', 'CBOE Volatility Index'), ('^RUT', 'Russell 2000'), ('^FTW5000', 'Wilshire 5000')),
  incoming AS (SELECT * FROM seeds UNION ALL
    SELECT c_name, 'renamed ' || c_nationkey FROM customer WHERE c_mktsegment = 'FURNITURE')
  SELECT coalesce(i.ticker, c.c_name) AS ticker, coalesce(i.index_name, c.c_mktsegment) AS index_name
  FROM customer c FULL JOIN incoming i ON i.ticker = c.c_name""",
)
def seed_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed rows and renamed customers go into an index table made of all customers."""
    customers = table(spark, sf_dir, "customer")
    stored = INDEX_DATA.conform(
        customers.select(F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("index_name"))
    )
    renamed = customers.filter(F.col("c_mktsegment") == "FURNITURE").select(
        F.col("c_name").alias("ticker"), F.concat(F.lit("renamed "), "c_nationkey").alias("index_name")
    )
    incoming = feeds.index_seed(spark).unionByName(renamed)
    return symbols.upsert_indexes(stored, incoming, overwrite=True).select("ticker", "index_name")


@query(
    "ensure_symbols",
    """SELECT c_name AS ticker, c_mktsegment AS company_name FROM customer WHERE c_acctbal > 0
  UNION ALL
  SELECT 'Customer#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 'placeholder' FROM customer WHERE c_acctbal <= 0""",
)
def ensure_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    stored = TICKER_DATA.conform(
        customers.filter(F.col("c_acctbal") > 0).select(
            F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("company_name")
        )
    )
    wanted = customers.select(
        F.concat(F.lit(" "), "c_name").alias("ticker"), F.lit("placeholder").alias("label")
    )
    return symbols.ensure_tickers(stored, wanted, AS_OF, "label").select("ticker", "company_name")


@query(
    "ingest_counters",
    f"""WITH {TX_SQL}, k AS (SELECT transaction_id, count(*) AS n, bool_or(filing_date < '1999-01-01') AS known
    FROM tx WHERE filing_date < '1999-01-01' OR filing_date >= '1998-01-01' GROUP BY ALL),
  b AS (SELECT transaction_id, count(*) AS n FROM tx WHERE filing_date >= '1998-01-01' GROUP BY ALL)
  SELECT CAST(sum(CASE WHEN known THEN 0 ELSE 1 END) AS BIGINT) AS inserted,
    CAST(sum(b.n - CASE WHEN known THEN 0 ELSE 1 END) AS BIGINT) AS skipped
  FROM b JOIN k USING (transaction_id)""",
)
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = disclosures(spark, sf_dir).select("transaction_id", "filing_date")
    stored = rows.filter("filing_date < date'1999-01-01'").select("transaction_id").distinct()
    batch = rows.filter("filing_date >= date'1998-01-01'")
    return runs.ingest_counters(runs.label_ingest(batch, stored, ["transaction_id"]))


_COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COUNTED),
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.table_counts({t: table(spark, sf_dir, t) for t in _COUNTED})


@query(
    "run_log",
    """WITH s AS (SELECT o_custkey, max((o_orderdate, o_orderkey, o_orderstatus)) AS m FROM orders GROUP BY ALL)
  SELECT o_custkey AS run_id, m[3] AS status, m[2] AS last_entry, CAST(NULL AS VARCHAR) AS error_message FROM s
  UNION ALL SELECT max(o_custkey) + 1, 'FAILED', 7, 'x' FROM orders""",
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as log entries of the run of their customer: the current state of each run, and one more run."""
    entries = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("rows_inserted"), F.col("o_orderdate").cast("timestamp").alias("started_at"),
    )
    last = runs.latest_records(entries, "run_id", F.col("started_at").desc(), F.col("rows_inserted").desc())
    log = RUNS.conform(last)
    added = runs.run_record(log, runs.next_run_id(log), "price", AS_OF, status="FAILED", rows_inserted=7, error_message="x")
    return added.select("run_id", "status", F.col("rows_inserted").alias("last_entry"), "error_message")


@query(
    "scalar_default",
    """SELECT coalesce(max(CASE WHEN o_totalprice < 0 THEN o_orderkey END), -1) AS none_found,
    coalesce(max(o_orderkey), -1) AS last_order FROM orders""",
)
def scalar_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first cell of a frame without rows gives the default, one with rows its value."""
    orders = table(spark, sf_dir, "orders")
    none_found = runs.scalar(orders.filter("o_totalprice < 0").select("o_orderkey"), -1)
    last_order = runs.scalar(orders.select("o_orderkey").orderBy(F.desc("o_orderkey")), -1)
    return orders.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(none_found).cast("bigint").alias("none_found"), F.lit(last_order).cast("bigint").alias("last_order")
    )


@query(
    "legacy_price_insert",
    f"""WITH {bars_sql('stored', 'view')}, {bars_sql('batch')}
  SELECT coalesce(s.ticker, b.ticker) AS ticker, strftime(coalesce(s.date, b.date), '%Y-%m-%d') AS date,
    CASE WHEN s.ticker IS NULL THEN round_even(b.open * 1000, 0) / 1000 ELSE s.open END AS open,
    CASE WHEN s.ticker IS NULL THEN round_even(b.close * 1000, 0) / 1000 ELSE s.close END AS close
  FROM stored s FULL JOIN batch b ON s.ticker = b.ticker AND s.date = b.date""",
)
def legacy_price_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days already stored keep their values; the others get rounded open and close."""
    from ..operators import prices

    stored = prices.PRICING_DATA.conform(bars(spark, sf_dir, "view"))
    feed = bars(spark, sf_dir).withColumn("adj_close", F.col("close"))
    merged = prices.insert_prices_if_absent(stored, feed, AS_OF)
    return merged.select("ticker", day_text("date").alias("date"), "open", "close")


@query(
    "coalesce_merge",
    """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS kept,
    coalesce(CASE WHEN c_acctbal > 0 THEN c_name END, c_mktsegment) AS replaced FROM customer""",
)
def coalesce_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-else-old and old-else-new, as used by the keyed merges."""
    customers = text.require_columns(table(spark, sf_dir, "customer"), "c_custkey")
    old = customers.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("kept"),
                           F.col("c_mktsegment").alias("replaced"))
    new = customers.select("c_custkey", F.col("c_name").alias("kept"),
                           F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("replaced"))
    return keyed.merge(
        old, new, ["c_custkey"],
        matched={"kept": F.coalesce("kept", "new_kept"), "replaced": F.coalesce("new_replaced", "replaced")},
        inserted={},
    )
