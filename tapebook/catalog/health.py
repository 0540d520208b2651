"""Feed outcomes, failure ledger, exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import health
from ..schemas import TICKER_DATA, TICKER_EXCLUSIONS, TICKER_FAILURES
from .registry import AS_OF, query, table

SINCE = "2001-06-15"

# Customers are asked for, twice, in one batch per nation; orders are the feed, with a price if they are
# delivered, large and not from before a day; nations of one region fail as a whole, told twice.
OUTCOME_SQL = f"""asked AS (
    SELECT CAST(c_nationkey AS VARCHAR) AS batch_id, CAST(c_custkey AS VARCHAR) AS ticker, n_regionkey = 2 AS broken,
      coalesce(f.n, 0) AS n, coalesce(f.u, 0) AS u
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n,
        count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 50000 AND o_orderdate >= DATE '{SINCE}') AS u
      FROM orders GROUP BY ALL) f ON o_custkey = c_custkey),
  b AS (SELECT *, sum(n) OVER (PARTITION BY batch_id) AS bn, sum(u) OVER (PARTITION BY batch_id) AS bu,
      count(*) OVER (PARTITION BY batch_id) AS bc FROM asked),
  outcome AS (SELECT batch_id, ticker, NOT broken AND u > 0 AS succeeded,
    CASE WHEN broken THEN ['Timeout'] WHEN bn = 0 THEN ['YFEmptyBatch'] ELSE [x FOR x IN [
      CASE WHEN n = 0 THEN 'YFMissingTicker' END,
      CASE WHEN n > 0 AND u = 0 AND bc > 1 THEN 'YFNoRows' END,
      CASE WHEN n > 0 AND bu = 0 THEN 'YFNoNormalizedRows' END] IF x IS NOT NULL] END AS classes FROM b)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("batch_id"), F.col("c_custkey").cast("string").alias("ticker")
    )
    recent = F.col("o_orderdate") >= F.lit(SINCE).cast("timestamp_ntz")
    good = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 50000) & recent
    batch = requests.withColumnRenamed("ticker", "symbol")
    orders = table(spark, sf_dir, "orders").join(batch, F.col("o_custkey").cast("string") == F.col("symbol"))
    feed = (
        orders.select(
            "batch_id",
            F.col("o_custkey").cast("string").alias("ticker"),
            F.when(good, F.col("o_totalprice")).alias("close"),
            *[F.lit(None).cast("double").alias(c) for c in ("open", "high", "low", "adj_close", "volume")],
        )
    )
    status = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 2).select(
        F.col("n_nationkey").cast("string").alias("batch_id"),
        F.lit("Timeout").alias("error_class"),
        F.lit("read timed out").alias("error_message"),
    )
    later = status.withColumns({"error_class": F.lit("Unknown"), "error_message": F.lit(None).cast("string")})
    return health.feed_outcomes(requests.union(requests), health.feed_counts(feed), status.unionByName(later))


@query(
    "feed_outcomes",
    f"""WITH {OUTCOME_SQL} SELECT batch_id, ticker, array_to_string(classes, ',') AS classes, succeeded FROM outcome""",
)
def feed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = F.array_join(F.transform("labels", lambda l: l["error_class"]), ",")
    return _outcomes(spark, sf_dir).select("batch_id", "ticker", classes.alias("classes"), "succeeded")


@query(
    "success_counts",
    f"""WITH {OUTCOME_SQL} SELECT batch_id, count(*) AS n_symbols, count(*) FILTER (succeeded) AS n_priced,
    CAST(sum(len(classes)) AS BIGINT) AS n_failures FROM outcome GROUP BY ALL""",
)
def success_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_symbols"),
        F.count(F.when(F.col("succeeded"), 1)).alias("n_priced"),
        F.sum(F.size("labels").cast("bigint")).alias("n_failures"),
    )


# The stored ledger: failed orders before the feed's first day, counted per customer.
LEDGER_SQL = f"""ledger AS (
    SELECT CAST(o_custkey AS VARCHAR) AS ticker, count(*) AS fail_count,
      CASE WHEN o_custkey % 2 = 0 THEN 'OldClass' END AS error_class
    FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < DATE '{SINCE}' GROUP BY o_custkey),
  failed AS (SELECT ticker, len(classes) AS n, classes[-1] AS error_class,
      CASE WHEN classes[1] = 'Timeout' THEN 'read timed out' END AS error_message FROM outcome WHERE len(classes) > 0),
  upserted AS (SELECT coalesce(l.ticker, f.ticker) AS ticker, coalesce(l.fail_count, 0) + coalesce(f.n, 0) AS fail_count,
      coalesce(f.error_class, l.error_class) AS error_class,
      coalesce(f.error_message, CASE WHEN l.ticker IS NOT NULL THEN 'old message' END) AS error_message
    FROM ledger l FULL JOIN failed f ON l.ticker = f.ticker)"""


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit(SINCE).cast("timestamp_ntz"))
    )
    counted = old.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("fail_count"))
    return TICKER_FAILURES.conform(
        counted.select(
            F.col("o_custkey").cast("string").alias("ticker"),
            F.lit("price").alias("job_name"),
            F.when(F.col("o_custkey") % 2 == 0, "OldClass").alias("error_class"),
            F.lit("old message").alias("error_message"),
            "fail_count",
        )
    )


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = health.failure_batch(_outcomes(spark, sf_dir))
    return health.upsert_failures(_ledger(spark, sf_dir), batch, "price", AS_OF)


@query(
    "failure_upsert",
    f"""WITH {OUTCOME_SQL}, {LEDGER_SQL} SELECT ticker, fail_count, error_class, error_message FROM upserted""",
)
def failure_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir).select("ticker", "fail_count", "error_class", "error_message")


@query(
    "failure_clear",
    f"""WITH {OUTCOME_SQL}, {LEDGER_SQL} SELECT ticker, fail_count FROM ledger
  WHERE ticker NOT IN (SELECT ticker FROM outcome WHERE succeeded)""",
)
def failure_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _outcomes(spark, sf_dir).filter("succeeded")
    return health.clear_failures(_ledger(spark, sf_dir), done, "price").select("ticker", "fail_count")


SYMBOL_SQL = """symbols AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, CASE c_mktsegment WHEN 'MACHINERY' THEN NULL
    WHEN 'BUILDING' THEN '' WHEN 'AUTOMOBILE' THEN 'EXCLUDED' WHEN 'HOUSEHOLD' THEN 'DELISTED' ELSE 'ACTIVE' END AS status,
    'old reason' AS status_reason, c_acctbal > 8000 AS priced FROM customer WHERE c_acctbal > -500)"""


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    status = (
        F.when(segment == "BUILDING", "").when(segment == "AUTOMOBILE", "EXCLUDED")
        .when(segment == "HOUSEHOLD", "DELISTED").when(segment != "MACHINERY", "ACTIVE")
    )
    return TICKER_DATA.conform(
        table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > -500).select(
            F.col("c_custkey").cast("string").alias("ticker"),
            status.alias("status"),
            F.lit("old reason").alias("status_reason"),
            F.when(F.col("c_acctbal") > 8000, F.lit("2000-01-03").cast("date")).alias("last_price_date"),
        )
    )


@query(
    "status_rollup",
    f"""WITH {OUTCOME_SQL}, {SYMBOL_SQL}, f AS (SELECT ticker FROM outcome WHERE len(classes) > 0)
  SELECT coalesce(s.ticker, f.ticker) AS ticker, CASE WHEN s.ticker IS NULL THEN 'WATCH' WHEN f.ticker IS NULL THEN s.status
    WHEN coalesce(s.status, '') = '' THEN 'WATCH' ELSE s.status END AS status,
    f.ticker IS NOT NULL AS attempted, s.ticker IS NULL AS added
  FROM symbols s FULL JOIN f ON s.ticker = f.ticker""",
)
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = health.failure_batch(_outcomes(spark, sf_dir))
    rolled = health.roll_up_failures(_symbols(spark, sf_dir), batch, AS_OF)
    return rolled.select(
        "ticker", "status",
        F.col("last_price_attempt_at").isNotNull().alias("attempted"),
        F.col("first_seen_at").isNotNull().alias("added"),
    )


@query(
    "success_touch",
    f"""WITH {OUTCOME_SQL}, {SYMBOL_SQL}, d AS (SELECT ticker FROM outcome WHERE succeeded)
  SELECT s.ticker, CASE WHEN d.ticker IS NULL THEN s.status ELSE coalesce(s.status, 'ACTIVE') END AS status,
    CASE WHEN d.ticker IS NULL THEN s.status_reason END AS status_reason
  FROM symbols s LEFT JOIN d ON s.ticker = d.ticker""",
)
def success_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _outcomes(spark, sf_dir).filter("succeeded").select("ticker")
    touched, _ = health.record_success(
        _symbols(spark, sf_dir), TICKER_FAILURES.empty(spark), done, "price", AS_OF
    )
    return touched.select("ticker", "status", "status_reason")


@query(
    "failures_over_threshold",
    f"""WITH {OUTCOME_SQL}, {LEDGER_SQL}, {SYMBOL_SQL} SELECT ticker, l.fail_count FROM ledger l
  JOIN symbols s USING (ticker) WHERE l.fail_count >= 3 AND NOT s.priced""",
)
def failures_over_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.never_priced_failures(_ledger(spark, sf_dir), _symbols(spark, sf_dir), "price", 3)


DOOMED_SQL = """doomed AS (SELECT ticker FROM ledger l JOIN symbols s USING (ticker) WHERE l.fail_count >= 3 AND NOT s.priced),
  excluded AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_mktsegment = 'FURNITURE')"""


def _evaluated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stored = TICKER_EXCLUSIONS.conform(
        table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "FURNITURE").select(
            F.col("c_custkey").cast("string").alias("ticker"), F.lit("MANUAL").alias("status"),
            F.lit("by hand").alias("reason"), F.lit("user").alias("source"), F.lit(0).alias("is_active"),
        )
    )
    return health.evaluate_health(
        _ledger(spark, sf_dir), _symbols(spark, sf_dir), stored, "price", AS_OF
    )


@query(
    "health_exclusions",
    f"""WITH {OUTCOME_SQL}, {LEDGER_SQL}, {SYMBOL_SQL}, {DOOMED_SQL}
  SELECT coalesce(e.ticker, d.ticker) AS ticker, CASE WHEN d.ticker IS NULL THEN 'MANUAL' ELSE 'NO_DATA' END AS status,
    CASE WHEN e.ticker IS NULL THEN 'AUTO: >=3 failures with no price history' ELSE 'by hand' END AS reason,
    CASE WHEN e.ticker IS NULL THEN 'system' ELSE 'user' END AS source,
    CASE WHEN d.ticker IS NULL THEN 0 ELSE 1 END AS is_active
  FROM excluded e FULL JOIN doomed d ON e.ticker = d.ticker""",
)
def health_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    exclusions, _ = _evaluated(spark, sf_dir)
    return exclusions.select("ticker", "status", "reason", "source", "is_active")


@query(
    "health_status",
    f"""WITH {OUTCOME_SQL}, {LEDGER_SQL}, {SYMBOL_SQL}, {DOOMED_SQL}
  SELECT s.ticker, CASE WHEN d.ticker IS NULL THEN s.status ELSE 'EXCLUDED' END AS status,
    CASE WHEN d.ticker IS NULL THEN s.status_reason ELSE 'AUTO: NO_DATA (>=3 failures)' END AS status_reason
  FROM symbols s LEFT JOIN doomed d ON s.ticker = d.ticker""",
)
def health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tickers = _evaluated(spark, sf_dir)
    return tickers.select("ticker", "status", "status_reason")
