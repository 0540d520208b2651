"""Small landed inputs."""

from __future__ import annotations

from datetime import date, datetime

AS_OF = datetime(2024, 1, 25, 23, 0)
LATER = datetime(2024, 1, 26, 23, 0)

HEADERS = ["X", "Filing&nbsp;Date", "Trade Date", "Ticker", "Company&nbsp;Name", "Insider Name", "Title",
           "Trade Type", "Price", "Qty", "Owned", "&Delta;Own", "Value"]


def cells(x="", filed="2024-01-20 16:30:05", traded="2024-01-18", ticker="AAA", company="A Co", insider="Doe Jane",
          title="CEO", kind="P - Purchase", price="$12.34", qty="+1,000", href="http://www.sec.gov/f/1"):
    link = f'<a href="{href}">{filed}</a>' if href else filed
    return [x, f"<div>{link}</div>", traded, f"<b> <a href='/{ticker}'>{ticker}</a></b>", company, insider, title,
            kind, price, qty, "5,000", "+20%", "+$12,340"]


def page(rows: list[list[str]], css='class="tinytable"', headers=HEADERS) -> str:
    head = "".join(f"<th><h3>{h}</h3></th>" for h in headers)
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>\n" for row in rows)
    return (
        "<html><body><!-- <table class='tinytable'><tr><td>no</td></tr></table> -->"
        "<table class='other'><tr><td>skip</td></tr></table>"
        f"<table {css} width=100><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table></body></html>"
    )


def pages_frame(spark, *htmls: str, first_id: int = 1):
    from tapebook.schemas import PAGES

    return spark.createDataFrame([(first_id + i, f"http://x/{i}", h) for i, h in enumerate(htmls)], PAGES)


def metadata_frame(spark):
    from tapebook.schemas import METADATA

    return spark.createDataFrame(
        [("AAA", {"shortName": "Triple A", "sector": "Tech"}), ("^GSPC", {"shortName": "SPX"})], METADATA
    )


def tx(spark, rows: list[dict]):
    """insider_data rows with defaults, plus page_id and pos."""
    from tapebook.schemas import INSIDER_DATA
    from pyspark.sql import types as T

    schema = T.StructType(INSIDER_DATA.schema.fields + [T.StructField("page_id", T.LongType()), T.StructField("pos", T.IntegerType())])
    base = dict.fromkeys(schema.fieldNames())
    base |= {"source": "s", "scraped_at": datetime(2024, 1, 1), "filing_date": date(2024, 1, 1), "ticker": "T",
             "is_active": 1, "source_url": "u", "page_id": 1, "pos": 1}
    return spark.createDataFrame([tuple((base | r)[c] for c in schema.fieldNames()) for r in rows], schema)
