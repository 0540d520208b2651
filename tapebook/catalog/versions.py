"""Amendment versions: reconciliation, sequential supersession, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import identity, rules
from ..operators import versions
from ..operators.keyed import first_per_key
from ..operators.chains import follow_links
from ..operators.paging import By, page_of
from ..operators.skew import next_marked
from ..schemas import INSIDER_DATA, NATURAL_KEY
from ..session import Scratch, scratch_root
from .registry import AS_OF, HASHED_TX_SQL, TX_SQL, day_text, disclosures, query, table

KEY_SQL = "ticker, insider_name, sec_tx_code"
SAME_KEY = " AND ".join(f"tx.{c} IS NOT DISTINCT FROM top.{c}" for c in KEY_SQL.split(", "))
# The latest amendment of each key, and every row next to it.
JUDGED_SQL = f"""top AS (
  SELECT {KEY_SQL}, max((filing_date, transaction_id)) AS latest FROM tx WHERE contains(upper(x_flags), 'A') GROUP BY ALL),
judged AS (
  SELECT tx.*, top.latest[2] AS chosen FROM tx LEFT JOIN top ON {SAME_KEY})"""


@query(
    "reconcile_versions",
    f"""WITH {TX_SQL}, {JUDGED_SQL}
  SELECT transaction_id, CASE WHEN chosen <> transaction_id THEN 0 ELSE 1 END AS is_active,
    nullif(chosen, transaction_id) AS superseded_by FROM judged""",
)
def reconcile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = versions.reconcile_amendments(disclosures(spark, sf_dir), AS_OF)
    return rows.select("transaction_id", "is_active", "superseded_by")


@query(
    "active_after_reconcile",
    f"""WITH {HASHED_TX_SQL.replace("tx AS (", "landed AS (")},
  tx AS (SELECT DISTINCT * FROM (SELECT * FROM landed UNION ALL SELECT * FROM landed WHERE sec_tx_code IN ('1', '3'))),
  {JUDGED_SQL}
  SELECT x_flags, count(*) AS n_rows, count(*) FILTER (chosen IS NULL OR chosen = transaction_id) AS n_active
  FROM judged GROUP BY ALL""",
)
def active_after_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: content ids, one row per id, reconciliation, count what stays active.

    Two lines of every order land twice, so there are copies to drop. Ids move as bytes.
    """
    landed = disclosures(spark, sf_dir, hashed=True)
    landed = landed.withColumns({c: identity.packed_id(c) for c in ("transaction_id", "superseded_by")})
    landed = landed.unionByName(landed.filter(F.col("sec_tx_code").isin("1", "3")))
    needed = [*NATURAL_KEY, "transaction_id", "filing_date", "scraped_at", "x_flags", "is_active", "superseded_by", "superseded_at"]
    once = first_per_key(landed, ["transaction_id"], "source_url").select(*needed)
    once = Scratch(spark, scratch_root(spark)).write(once, "once")
    rows = versions.reconcile_amendments(once, AS_OF)
    return rows.groupBy("x_flags").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("is_active").cast("bigint")).alias("n_active")
    )


@query(
    "losers_in_subquery",
    f"""WITH {TX_SQL}, {JUDGED_SQL} SELECT transaction_id FROM judged WHERE chosen <> transaction_id""",
)
def losers_in_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = versions.find_losers(disclosures(spark, sf_dir))
    return judged.filter(F.col("winner_id") != F.col("transaction_id")).select("transaction_id")


@query(
    "winner_lookup",
    f"""WITH {TX_SQL}, {JUDGED_SQL} SELECT transaction_id, chosen AS winner_id FROM judged""",
)
def winner_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.find_losers(disclosures(spark, sf_dir)).select("transaction_id", "winner_id")


@query(
    "best_version",
    f"""WITH {TX_SQL}, b AS (
    SELECT {KEY_SQL}, max((contains(upper(x_flags), 'A'), filing_date, transaction_id)) AS best FROM tx GROUP BY ALL)
  SELECT {KEY_SQL}, best[3] AS transaction_id, best[2] AS filing_date FROM b""",
)
def best_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-1 per natural key, whether or not the key has an amendment."""
    order = [
        F.when(rules.counts_as_amendment(F.col("x_flags")), 1).otherwise(0).desc(),
        F.col("filing_date").desc(),
        F.col("scraped_at").desc(),
        F.col("transaction_id").desc(),
    ]
    best = first_per_key(disclosures(spark, sf_dir), NATURAL_KEY, *order)
    return best.select(
        "ticker", "insider_name", "sec_tx_code", "transaction_id", day_text("filing_date").alias("filing_date")
    )


def _in_version_order(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[By]]:
    amended = F.when(rules.counts_as_amendment(F.col("x_flags")), 1).otherwise(0)
    order = [By(c, descending=True) for c in ("amended", "filing_date", "scraped_at", "transaction_id")]
    return disclosures(spark, sf_dir).withColumn("amended", amended), order


@query(
    "sorted_page",
    f"""WITH {TX_SQL} SELECT transaction_id, filing_date FROM tx
  ORDER BY CASE WHEN x_flags ILIKE '%A%' THEN 1 ELSE 0 END DESC, filing_date DESC, transaction_id DESC LIMIT 500""",
)
def sorted_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page in version order: sort by a computed key and three columns, all descending."""
    rows, order = _in_version_order(spark, sf_dir)
    top = page_of(rows, order, 1, 500, tie=())
    return top.select("transaction_id", day_text("filing_date").alias("filing_date"))


@query(
    "deep_page",
    f"""WITH {TX_SQL}, placed AS (
    SELECT transaction_id, filing_date, row_number() OVER (
      ORDER BY CASE WHEN x_flags ILIKE '%A%' THEN 1 ELSE 0 END DESC, filing_date DESC, transaction_id DESC) - 1 AS place
    FROM tx)
  SELECT transaction_id, filing_date FROM placed
  WHERE place // 100 = (SELECT count(*) // 200 FROM tx)""",
)
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of 100 rows in the middle of all rows in version order, found by counting."""
    rows, order = _in_version_order(spark, sf_dir)
    page = rows.count() // 200 + 1
    found = page_of(rows, order, page, 100, tie=(), direct_rows=1000)
    return found.select("transaction_id", day_text("filing_date").alias("filing_date"))


@query(
    "large_page",
    """WITH placed AS (
    SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) - 1 AS place FROM orders)
  SELECT o_orderkey, o_totalprice FROM placed
  WHERE place // (SELECT count(*) // 3 FROM orders) = 1""",
)
def large_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a third of all orders, by a column of few values, then by price."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    order = [By("o_orderpriority", descending=True), By("o_totalprice"), By("o_orderkey")]
    found = page_of(orders, order, 2, orders.count() // 3, tie=(), direct_rows=100)
    return found.select("o_orderkey", "o_totalprice")


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as freshly landed rows, in order of ship day and digest.

    A landed page holds few rows, so a day is cut into 2**20 pages by the leading digits of the
    digest: a key with any share of the rows still spreads over many pages.
    """
    rows = disclosures(spark, sf_dir).withColumn("pos", F.sha2("transaction_id", 256))
    sheet = F.conv(F.substring("pos", 1, 5), 16, 10).cast("bigint")
    return rows.withColumn("page_id", F.unix_date("filing_date").cast("bigint") * (1 << 20) + sheet)


@query(
    "sequential_supersede",
    f"""WITH {TX_SQL}
  SELECT transaction_id, first_value(CASE WHEN x_flags LIKE '%A%' THEN transaction_id END IGNORE NULLS) OVER (
    PARTITION BY {KEY_SQL} ORDER BY filing_date, sha256(transaction_id) ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
    AS superseded_by FROM tx""",
)
def sequential_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows land in order: each is retired by the next amendment of its key."""
    marked = rules.marks_amendment(F.col("x_flags"))
    found = next_marked(
        _landed(spark, sf_dir), NATURAL_KEY, "page_id", ["pos"], marked, F.col("transaction_id"), "next_id"
    )
    return found.select("transaction_id", F.col("next_id").alias("superseded_by"))


@query(
    "final_winner",
    """WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN event_id END AS mark FROM events)
  SELECT event_id, first_value(mark IGNORE NULLS) OVER later AS superseded_by,
    coalesce(last_value(mark IGNORE NULLS) OVER later, event_id) AS final_id, count(mark) OVER later AS hops
  FROM e WINDOW later AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
)
def final_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tick is superseded by its user's next purchase, and that one by the next: which one stands at last?"""
    ticks = table(spark, sf_dir, "events").withColumn("day", F.unix_date(F.to_date("ts")))
    bought = F.col("event_type") == "purchase"
    links = next_marked(ticks, ["user_id"], "day", ["ts", "event_id"], bought, F.col("event_id"), "superseded_by", 4)
    ends = follow_links(links, Scratch(spark, scratch_root(spark)), "event_id", "superseded_by")
    return ends.drop("cycle_id")


_PART_LINKS_SQL = """lines AS (
    SELECT l_orderkey, l_linenumber, l_partkey,
      coalesce(lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey), -1) AS next FROM lineitem),
  links AS (
    SELECT l_partkey AS id, nullif(min((l_orderkey, l_linenumber, next))[3], -1) AS next FROM lines GROUP BY l_partkey)"""


@query(
    "supersede_cycles",
    f"""WITH RECURSIVE {_PART_LINKS_SQL},
  reach(id, met_id) AS (
    SELECT id, next FROM links WHERE next IS NOT NULL
    UNION SELECT r.id, l.next FROM reach r JOIN links l ON l.id = r.met_id WHERE l.next IS NOT NULL),
  loops AS (SELECT id FROM reach WHERE id = met_id),
  met AS (
    SELECT r.id, min(r.met_id) FILTER (r.met_id IN (SELECT id FROM loops)) AS cycle_id, count(*) AS hops,
      min(r.met_id) FILTER (r.met_id NOT IN (SELECT id FROM links WHERE next IS NOT NULL)) AS last
    FROM reach r GROUP BY r.id)
  SELECT l.id, l.next, CASE WHEN cycle_id IS NULL THEN coalesce(last, l.id) END AS final_id,
    CASE WHEN cycle_id IS NULL THEN coalesce(hops, 0) END AS hops, cycle_id
  FROM links l LEFT JOIN met USING (id)""",
)
def supersede_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part points to the part behind it in the first order that holds it: ends of chains, and cycles."""
    in_order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.coalesce(F.lead("l_partkey").over(in_order), F.lit(-1)).alias("next")
    )
    first = lines.groupBy(F.col("l_partkey").alias("id")).agg(F.min(F.struct("l_orderkey", "l_linenumber", "next")).alias("first"))
    links = first.select("id", F.nullif(F.col("first.next"), F.lit(-1)).alias("next"))
    return follow_links(links, Scratch(spark, scratch_root(spark)))


SPLIT_DAY = "1999-01-01"

INSERTED_SQL = f"""{TX_SQL}, placed AS (
    SELECT *, CASE WHEN filing_date >= '{SPLIT_DAY}' THEN 1 ELSE 0 END AS is_new FROM tx),
  merged AS (
    SELECT *, first_value(CASE WHEN is_new = 1 AND x_flags LIKE '%A%' THEN transaction_id END IGNORE NULLS) OVER (
      PARTITION BY {KEY_SQL} ORDER BY is_new, filing_date, sha256(transaction_id)
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS superseded_by FROM placed)"""


def _insert(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _landed(spark, sf_dir)
    new = F.col("filing_date") >= F.lit(SPLIT_DAY).cast("date")
    stored = rows.filter(~new).select(*INSIDER_DATA.columns)
    scratch = Scratch(spark, scratch_root(spark))
    fresh = scratch.write(rows.filter(new), "fresh")
    first_new = scratch.write(versions.first_amendments(fresh), "first_new")
    return fresh, versions.supersede(stored, fresh, AS_OF, first_new=first_new)


@query(
    "insert_supersede",
    f"""WITH {INSERTED_SQL}
  SELECT transaction_id, CASE WHEN superseded_by IS NULL THEN 1 ELSE 0 END AS is_active, superseded_by FROM merged""",
)
def insert_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from the split day on land after the earlier ones are stored."""
    _, merged = _insert(spark, sf_dir)
    return merged.select("transaction_id", "is_active", "superseded_by")


@query(
    "amendment_audit",
    f"""WITH {INSERTED_SQL}, n AS (
    SELECT superseded_by AS transaction_id, count(*) AS n FROM merged WHERE superseded_by IS NOT NULL GROUP BY ALL)
  SELECT p.transaction_id, p.ticker, p.insider_name, p.sec_tx_code, coalesce(n.n, 0) AS n_retired
  FROM placed p LEFT JOIN n USING (transaction_id)
  WHERE p.is_new = 1 AND p.x_flags LIKE '%A%' AND coalesce(n.n, 0) <> 1""",
)
def amendment_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh, merged = _insert(spark, sf_dir)
    return versions.amendment_audit(fresh, merged).drop("trade_date")
