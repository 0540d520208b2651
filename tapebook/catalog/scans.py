"""Scans, text cleaning, projections and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock, identity, rules, text
from ..operators import paging, quality
from ..schemas import INSIDER_DATA, SPLITS, TICKER_EXCLUSIONS, TICKER_FAILURES
from ..sources import feeds, html
from .registry import AS_OF, HASHED_TX_SQL, LABEL_SQL, TX_SQL, day_text, disclosures, labels, query, table


@query(
    "html_list_scan",
    """SELECT page_id, CAST(unnest(range(len(items))) AS INTEGER) AS pos,
  trim(regexp_replace(unnest(items), '<[^>]*>', '', 'g')) AS item_text
  FROM (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM pages)""",
)
def html_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(html.elements(F.col("html"), "li", "ul|nav")).alias("pos", "item")
    )
    return items.select("page_id", "pos", text.markup_text(F.col("item")).alias("item_text"))


@query(
    "html_cell_text",
    """SELECT page_id, trim(replace(replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1),
    '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS heading
  FROM pages""",
)
def html_cell_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.try_element_at(html.elements(F.col("html"), "h1"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", text.markup_text(heading).alias("heading"))


@query(
    "html_link_extract",
    """SELECT page_id, CAST(unnest(range(len(links))) AS INTEGER) AS pos, unnest(links) AS href,
  'https://openinsider.com' || unnest(links) AS link
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)""",
)
def html_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", F.posexplode(text.hrefs(F.col("html"))).alias("pos", "href"))
        .withColumn("link", text.resolve_link(F.col("href")))
    )


@query(
    "page_url_normalize",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/]+/(.*)$', 1) AS path FROM pages)
  SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN 'https://www.sec.gov/' || path
    ELSE 'https://openinsider.com/' || path END AS link FROM p""",
)
def page_url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_extract("url", "^https?://[^/]+/(.*)$", 1)
    insecure = F.concat(F.lit(text.FILING_HOST_HTTP), path)
    href = F.when(F.startswith("url", F.lit("http://")), insecure).otherwise(F.concat(F.lit("/"), path))
    return table(spark, sf_dir, "pages").select("page_id", text.resolve_link(href).alias("link"))


@query(
    "projected_scan",
    "SELECT c_name AS ticker, c_mktsegment AS sector FROM customer WHERE c_acctbal > 0",
)
def projected_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select(F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("sector"))
    )


@query(
    "header_normalize",
    """SELECT p_partkey, lower(replace(p_name, ' ', '_')) || '_deltaown_' || lower(p_type) AS header FROM part""",
)
def header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("  "), "p_name", F.lit(f"{text.NBSP}ΔOwn "), "p_type", F.lit(f"{text.NBSP} "))
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_label(raw).alias("header"))


@query("tolerant_prune", "SELECT p_partkey, p_brand, p_size FROM part")
def tolerant_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = text.require_columns(table(spark, sf_dir, "part"), "p_partkey")
    return text.keep_columns(part, ["p_partkey", "p_absent", "p_brand", "p_size"])


@query(
    "date_coerce",
    """SELECT o_orderkey, strftime(CAST(try_cast(CASE
    WHEN o_orderpriority = '5-LOW' THEN NULL
    WHEN o_orderstatus = 'P' THEN 'not a date ' || o_orderkey
    WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, ' %Y-%m-%d')
    ELSE strftime(o_orderdate, '%Y-%m-%d 16:30:05') END AS TIMESTAMP) AS DATE), '%Y-%m-%d') AS filing_date
  FROM orders""",
)
def date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = day_text("o_orderdate")
    raw = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("not a date "), "o_orderkey"))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), day))
        .otherwise(F.concat(day, F.lit(" 16:30:05")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", day_text(text.date_of(raw)).alias("filing_date"))


@query(
    "int_clean",
    """SELECT c_custkey, try_cast(regexp_replace('+' || c_acctbal || ' shares, ' || c_mktsegment, '[^0-9]', '', 'g')
    AS BIGINT) AS qty, try_cast(regexp_replace(c_mktsegment, '[^0-9]', '', 'g') AS BIGINT) AS no_digits
  FROM customer""",
)
def int_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("+"), F.col("c_acctbal").cast("string"), F.lit(" shares, "), "c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.int_of(raw).alias("qty"), text.int_of(F.col("c_mktsegment")).alias("no_digits")
    )


@query(
    "decimal_clean",
    """SELECT c_custkey, try_cast(regexp_replace('$' || c_acctbal || ' USD', '[^0-9.]', '', 'g') AS DOUBLE) AS price,
    try_cast(regexp_replace('1.' || c_nationkey || '.' || c_custkey, '[^0-9.]', '', 'g') AS DOUBLE) AS two_dots
  FROM customer""",
)
def decimal_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("$"), F.col("c_acctbal").cast("string"), F.lit(" USD"))
    dotted = F.concat_ws(".", F.lit("1"), "c_nationkey", "c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.decimal_of(raw).alias("price"), text.decimal_of(dotted).alias("two_dots")
    )


@query(
    "code_prefix",
    """SELECT o_orderkey, split_part(replace(o_orderpriority, '-', ' - '), ' - ', 1) AS code,
    split_part(nullif(o_orderstatus, 'P'), ' - ', 1) AS bare FROM orders""",
)
def code_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.replace("o_orderpriority", F.lit("-"), F.lit(" - "))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.code_of(label).alias("code"),
        text.code_of(F.nullif("o_orderstatus", F.lit("P"))).alias("bare"),
    )


@query(
    "na_fold_cast",
    """SELECT c_custkey, nullif(c_acctbal, 0) AS price, CAST(trunc(nullif(c_acctbal, 0)) AS BIGINT) AS qty,
    try_cast(c_name AS DOUBLE) AS bad FROM customer""",
)
def na_fold_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan = F.when(F.col("c_acctbal") == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.to_double(nan).alias("price"),
        text.to_long(nan).alias("qty"),
        text.to_double(F.col("c_name")).alias("bad"),
    )


@query(
    "derived_value",
    f"""WITH {TX_SQL} SELECT transaction_id, price * nullif(qty, 1) AS value FROM tx""",
)
def derived_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = rules.trade_value(F.col("price"), F.nullif("qty", F.lit(1)))
    return disclosures(spark, sf_dir).select("transaction_id", value.alias("value"))


@query(
    "classify_label",
    f"""WITH l AS (SELECT {LABEL_SQL} AS trade_type FROM lineitem)
  SELECT trade_type,
    CASE WHEN trade_type IN ('P - Purchase', 'S - Sale') THEN 1
         WHEN trade_type IN ('S - Sale+OE', 'F - Tax') THEN 0 END AS is_open_market,
    CASE WHEN trade_type IS NULL THEN 'UNKNOWN' WHEN trade_type IN ('P - Purchase', 'S - Sale') THEN 'OPEN_MARKET'
         WHEN trade_type = 'S - Sale+OE' THEN 'OPTION_EXERCISE' ELSE 'OTHER' END AS classification,
    count(*) AS n_rows
  FROM l GROUP BY ALL""",
)
def classify_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("trade_type")
    return (
        table(spark, sf_dir, "lineitem")
        .select(labels().alias("trade_type"))
        .groupBy(
            "trade_type",
            rules.open_market_flag(label).alias("is_open_market"),
            rules.classification(label).alias("classification"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query("transaction_id", f"WITH {HASHED_TX_SQL} SELECT transaction_id, source_url, x_flags FROM tx")
def transaction_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosures(spark, sf_dir, hashed=True).select("transaction_id", "source_url", "x_flags")


@query("float_text", "SELECT DISTINCT l_extendedprice AS price, CAST(l_extendedprice AS VARCHAR) AS price_text FROM lineitem")
def float_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price")).distinct()
    return prices.withColumn("price_text", identity.float_text(F.col("price")))


@query(
    "symbol_clean_distinct",
    """SELECT DISTINCT trim(s) AS ticker FROM (
    SELECT CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '   '
      ELSE '  C' || o_custkey || ' ' END AS s FROM orders)
  WHERE length(trim(s)) > 0""",
)
def symbol_clean_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "F", "   ").when(
        F.col("o_orderstatus") == "O", F.concat(F.lit("  C"), "o_custkey", F.lit(text.NBSP))
    )
    return text.clean_symbols(table(spark, sf_dir, "orders").select(raw.alias("ticker")))


@query(
    "distinct_pairs",
    """SELECT DISTINCT nullif(o_orderstatus, 'P') AS ticker, o_custkey AS company FROM orders
  WHERE nullif(o_orderstatus, 'P') IS NOT NULL""",
)
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("ticker"), F.col("o_custkey").alias("company")
    )
    return pairs.dropna(subset=["ticker"]).dropDuplicates()


@query(
    "market_cutoff_window",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
  WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""",
)
def market_cutoff_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 21:05 UTC is 16:05 in New York, five minutes before today's bar counts.
    window = clock.price_window(AS_OF.replace(year=2024, month=1, day=20, hour=21, minute=5), 5)
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return events.filter(clock.in_window(F.col("ts"), window)).select("event_id", day_text("ts").alias("day"))


@query(
    "active_exclusions",
    """SELECT o_orderkey AS ticker FROM orders WHERE o_orderstatus <> 'P' AND
  (o_orderpriority = '5-LOW' OR o_orderdate + INTERVAL 30 DAY > TIMESTAMP '1999-06-01 12:00:00')""",
)
def active_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticker"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("is_active"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("expires_at"),
    )
    now = F.lit("1999-06-01 12:00:00").cast("timestamp_ntz")
    return orders.filter(rules.exclusion_in_force(now)).select("ticker")


@query(
    "amendment_flag",
    """WITH f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN lower(l_returnflag)
    ELSE 'D' || nullif(l_returnflag, 'R') END AS x_flags FROM lineitem)
  SELECT x_flags, coalesce(contains(x_flags, 'A'), false) AS at_insert,
    coalesce(x_flags ILIKE '%A%', false) AS at_reconcile, count(*) AS n_rows FROM f GROUP BY ALL""",
)
def amendment_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.when(F.col("l_linestatus") == "O", F.lower("l_returnflag")).otherwise(
        F.concat(F.lit("D"), F.nullif("l_returnflag", F.lit("R")))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select(flags.alias("x_flags"))
        .groupBy(
            "x_flags",
            rules.marks_amendment(F.col("x_flags")).alias("at_insert"),
            rules.counts_as_amendment(F.col("x_flags")).alias("at_reconcile"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "constraint_violations",
    f"""WITH {TX_SQL}, broken AS (
    SELECT transaction_id, [x FOR x IN [
      CASE WHEN x_flags = 'R' AND sec_tx_code = '1' THEN 'filing_date is required' END,
      CASE WHEN qty < 3 THEN 'source_url is required' END,
      CASE WHEN trade_type = 'Z - Other' AND qty > 40 THEN 'classification check' END,
      CASE WHEN price < 2000 THEN 'price check' END] IF x IS NOT NULL] AS v FROM tx)
  SELECT transaction_id, array_to_string(v, '; ') AS violations FROM broken WHERE len(v) > 0""",
)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    flawed = disclosures(spark, sf_dir).withColumns(
        {
            "filing_date": F.when(
                ~((F.col("x_flags") == "R") & (F.col("sec_tx_code") == "1")), F.col("filing_date")
            ),
            "source_url": F.when(F.col("qty") >= 3, F.col("source_url")),
            "classification": F.when(
                (F.col("trade_type") == "Z - Other") & (F.col("qty") > 40), "NO_SUCH_CLASS"
            ).otherwise(F.col("classification")),
            "price": F.col("price") - 2000,
        }
    )
    _, bad = quality.split_valid(flawed, INSIDER_DATA)
    return bad.select("transaction_id", F.array_join("violations", "; ").alias("violations"))


@query(
    "default_fill",
    """SELECT c_name AS ticker, coalesce(nullif(c_mktsegment, 'MACHINERY'), 'EXCLUDED') AS status,
    CASE WHEN c_acctbal > 0 THEN 'user' ELSE 'system' END AS source,
    '2001-06-01 12:00:00' AS excluded_at, 1 AS is_active FROM customer""",
)
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("ticker"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("status"),
        F.when(F.col("c_acctbal") > 0, "user").alias("source"),
    )
    filled = quality.fill_defaults(partial, TICKER_EXCLUSIONS, AS_OF)
    # The clock is a timestamp in UTC; show it independently of the session's time zone.
    utc = F.to_utc_timestamp("excluded_at", F.current_timezone())
    return filled.select(
        "ticker", "status", "source", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("excluded_at"), "is_active"
    )


@query(
    "status_case",
    """WITH s AS (SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN ''
    WHEN 'AUTOMOBILE' THEN 'EXCLUDED' WHEN 'HOUSEHOLD' THEN 'DELISTED' ELSE 'ACTIVE' END AS status FROM customer)
  SELECT c_custkey, CASE WHEN coalesce(status, '') = '' THEN 'WATCH' ELSE status END AS after_failure,
    coalesce(status, 'ACTIVE') AS after_success FROM s""",
)
def status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    status = (
        F.when(segment == "MACHINERY", F.lit(None).cast("string"))
        .when(segment == "BUILDING", "").when(segment == "AUTOMOBILE", "EXCLUDED")
        .when(segment == "HOUSEHOLD", "DELISTED").otherwise("ACTIVE")
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        rules.status_after_failure(status).alias("after_failure"),
        rules.status_after_success(status).alias("after_success"),
    )


@query(
    "screen_page",
    """SELECT o_orderkey AS transaction_id, strftime(o_orderdate, '%Y-%m-%d') AS filing_date, o_orderstatus AS sec_tx_code
  FROM orders WHERE o_orderstatus IN ('P', 'O') AND o_orderdate >= DATE '2001-06-01' - 730
  ORDER BY o_orderdate DESC, o_orderkey LIMIT 500 OFFSET 500""",
)
def screen_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.to_date("o_orderdate").alias("filing_date"),
        F.col("o_orderstatus").alias("sec_tx_code"),
    )
    found = paging.screen(orders, AS_OF.date(), codes=("P", "O"), page=2)
    return found.withColumn("filing_date", day_text("filing_date"))


@query(
    "batch_assign",
    """SELECT CAST((row_number() OVER (ORDER BY sha256(c_name)) - 1) // 50 AS VARCHAR) AS batch_id,
    c_name AS ticker FROM customer""",
)
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.assign_batches(table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker")), 50)


@query(
    "failure_defaults",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ticker, 'price' AS job_name, '2001-06-01' AS failure_date,
    1 AS fail_count FROM orders""",
)
def failure_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("ticker")).distinct()
    rows = quality.fill_defaults(keys.withColumn("job_name", F.lit("price")), TICKER_FAILURES, AS_OF)
    return rows.select("ticker", "job_name", day_text("failure_date").alias("failure_date"), "fail_count")


@query(
    "table_page_scan",
    """SELECT o_custkey AS page_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS pos,
    strftime(o_orderdate, '%Y-%m-%d') AS filing_date, 'C' || o_custkey AS ticker,
    CASE WHEN o_orderkey % 2 = 1 THEN 'Axyz' ELSE 'A & z' END AS company_name, o_orderpriority AS title,
    'https://openinsider.com/o/' || o_orderkey AS source_url FROM orders""",
)
def table_page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer with a table of its orders; every other row holds a table of its own."""
    nested = F.lit("A<table><tr><td> x</td><td>y </td></tr></table>z")
    company = F.when(F.col("o_orderkey") % 2 == 1, nested).otherwise("A &amp; z")
    return scanned_orders(order_pages(spark, sf_dir, company))


def order_pages(spark: SparkSession, sf_dir: str, company: Column) -> DataFrame:
    """(page_id, html): one page per customer with a table of its orders."""
    link = F.concat(F.lit('<a href="/o/'), "o_orderkey", F.lit('">'), day_text("o_orderdate"), F.lit("</a>"))
    cells = {
        "Filing Date": link,
        "Ticker": F.concat(F.lit("<b>C"), "o_custkey", F.lit("</b>")),
        "Company Name": company,
        "Title": F.col("o_orderpriority"),
    }
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), cells.get(h, F.lit("-")), F.lit("</td>")) for h in html.KEPT_HEADERS], F.lit("</tr>"))
    head = "".join(f"<th>{h}</th>" for h in html.KEPT_HEADERS)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", row.alias("row"))
    return orders.groupBy(F.col("o_custkey").alias("page_id")).agg(
        F.concat(
            F.lit(f'<p>before</p><table class="tinytable wide"><tr>{head}</tr>'),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "row"))), lambda r: r["row"]), "\n"),
            F.lit("</table><table><tr><td>after</td></tr></table>"),
        ).alias("html")
    )


def scanned_orders(pages: DataFrame) -> DataFrame:
    return html.extract_disclosures(html.require_table(pages)).select(
        "page_id", "pos", "filing_date", "ticker", "company_name", "title", "source_url"
    )


@query(
    "typed_landing",
    """SELECT l_orderkey * 10 + l_linenumber AS line, CASE WHEN l_linenumber <> 3 THEN l_discount END AS ratio,
    CASE WHEN l_returnflag <> 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS action_date,
    (CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) + (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_violations
  FROM lineitem""",
)
def typed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits that land as text, some with a ratio or a day that is none; every row stays."""
    landed = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("ticker"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate").cast("string")).alias("action_date"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount").cast("string")).otherwise("n/a").alias("ratio"),
    )
    rows = feeds.typed_rows(landed, SPLITS, ("ticker", "action_date"))
    return rows.select(
        F.col("ticker").cast("bigint").alias("line"), "ratio", day_text("action_date").alias("action_date"),
        F.size("violations").alias("n_violations"),
    )
