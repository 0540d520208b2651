"""Pages landed as bytes, each in a charset of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, scratch_root
from ..sources import feeds
from .registry import query
from .scans import order_pages, scanned_orders

COMPANY = "Ærø € “A”"


def _latin(page: Column) -> Column:
    """Bytes of a page in windows-1252, which has no capital delta."""
    named = F.replace(page, F.lit("Δ"), F.lit("&Delta;"))
    return F.encode(F.translate(named, "€“”", "\x80\x93\x94"), "ISO-8859-1")


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of pages in four charsets, told by a mark, a meta tag or the server; one in ten is not what it declares."""
    page, kind = F.col("html"), F.col("page_id") % 4
    tagged = F.concat(F.lit('<!-- <meta charset="utf-8"> --><meta http-equiv="Content-Type" content="text/html; charset=ISO-8859-1">'), page)
    body = (
        F.when(F.col("page_id") % 10 == 7, _latin(page))
        .when(kind == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(page, "UTF-8")))
        .when(kind == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode(page, "UTF-16LE")))
        .when(kind == 2, _latin(tagged))
        .otherwise(F.encode(page, "UTF-16BE"))
    )
    charset = F.when(F.col("page_id") % 10 == 7, "UTF8").when(kind == 3, "UTF-16BE")
    pages = order_pages(spark, sf_dir, F.lit(COMPANY)).select(
        "page_id", F.concat(F.lit("https://openinsider.com/c/"), "page_id").alias("url"), body.alias("body"), charset.alias("charset")
    )
    return Scratch(spark, scratch_root(spark)).write(pages, "landed")


@query(
    "landed_bytes_scan",
    f"""SELECT o_custkey AS page_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS pos,
    strftime(o_orderdate, '%Y-%m-%d') AS filing_date, 'C' || o_custkey AS ticker, '{COMPANY}' AS company_name,
    o_orderpriority AS title, 'https://openinsider.com/o/' || o_orderkey AS source_url FROM orders WHERE o_custkey % 10 <> 7""",
)
def landed_bytes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned_orders(feeds.decode_pages(_landed(spark, sf_dir))[0])


@query(
    "landed_bytes_refused",
    """SELECT o_custkey AS page_id, 'https://openinsider.com/c/' || o_custkey AS url, 'bytes are not utf-8' AS violations
  FROM orders WHERE o_custkey % 10 = 7 GROUP BY o_custkey""",
)
def landed_bytes_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = feeds.decode_pages(_landed(spark, sf_dir))[1]
    return lost.select("page_id", "url", F.array_join("violations", ", ").alias("violations"))
