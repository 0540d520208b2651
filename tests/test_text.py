from __future__ import annotations

import hashlib
import html as html_lib
import random

import pytest
from pyspark.sql import functions as F

from fixtures import cells, page, pages_frame
from tapebook.functions import clock, identity, rules, text
from tapebook.sources import html
from datetime import date, datetime


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_int_of(spark):
    assert one(spark, ["+1,000", "-1,000", "1,000.5", "", None], text.int_of) == [1000, 1000, 10005, None, None]


def test_decimal_of(spark):
    got = one(spark, ["$12.34", "1.2.3", "-5.00", ".", None], text.decimal_of)
    assert got == [12.34, None, 5.0, None, None]


def test_date_of(spark):
    got = one(spark, ["2024-01-02 16:30:05", "2024-01-02", "bad", None], text.date_of)
    assert got == [date(2024, 1, 2), date(2024, 1, 2), None, None]


def test_code_of(spark):
    got = one(spark, ["S - Sale+OE", "P", "A - B - C", "", None], text.code_of)
    assert got == ["S", "P", "A", "", None]


def test_labels(spark):
    labels = ["P - Purchase", "S - Sale", "S - Sale+OE", "F - Tax", "Z - Other", None]
    assert one(spark, labels, rules.open_market_flag) == [1, 1, 0, 0, None, None]
    assert one(spark, labels, rules.classification) == [
        "OPEN_MARKET", "OPEN_MARKET", "OPTION_EXERCISE", "OTHER", "OTHER", "UNKNOWN",
    ]


def test_amendment_flags(spark):
    flags = ["A", "DM", "DA", "a", "", None]
    assert one(spark, flags, rules.marks_amendment) == [True, False, True, False, False, False]
    assert one(spark, flags, rules.counts_as_amendment) == [True, False, True, True, False, False]


def test_status_rules(spark):
    status = [None, "", "ACTIVE", "EXCLUDED", "DELISTED", "WATCH"]
    assert one(spark, status, rules.status_after_failure) == [
        "WATCH", "WATCH", "ACTIVE", "EXCLUDED", "DELISTED", "WATCH",
    ]
    assert one(spark, status, rules.status_after_success) == [
        "ACTIVE", "", "ACTIVE", "EXCLUDED", "DELISTED", "WATCH",
    ]


def test_round3(spark):
    assert one(spark, [1.0005, 1.2345, 2.0005, None], text.round3, "double") == [1.0, 1.234, 2.001, None]


def test_na_folding(spark):
    values = [float("nan"), 2.9, -2.9, None, 1e300]
    assert one(spark, values, text.to_long, "double") == [None, 2, -2, None, None]
    assert one(spark, values, text.to_double, "double") == [None, 2.9, -2.9, None, 1e300]


def test_float_text_matches_python(spark):
    rng = random.Random(7)
    values = [10000000.0, 0.0001, 12.0, 0.0, 1e16, 5e-05, 1.5e-7, 123456789.125, 0.001, 9999999.5, 1e22]
    values += [round(rng.uniform(0, 10 ** rng.randint(-3, 12)), rng.randint(0, 4)) for _ in range(2000)]
    assert one(spark, values, identity.float_text, "double") == [repr(v) for v in values]


def test_float_text_keeps_all_digits(spark):
    values = [0.00012345678901234567, 0.0009876543210987653, -0.00012345678901234567, -123456789.5, 12345678.0, 9007199254740991.0]
    rng = random.Random(11)
    values += [v for v in (rng.uniform(1e-4, 1e-3) for _ in range(500)) if len(repr(v)) > 20]
    shown = one(spark, values, identity.float_text, "double")
    assert [float(t) for t in shown] == values and shown[:6] == [repr(v) for v in values[:6]]
    assert all("E" not in t and "e" not in t for t in shown)


def test_long_character_references(spark):
    values = ["&#00000000065;", "&#x000000000000041;", "&#99999999;", "&" + "a" * 40 + ";", "&amp;"]
    assert one(spark, values, text.unescape, "string") == ["A", "A", "&#99999999;", "&" + "a" * 40 + ";", "&"]


def test_content_id(spark):
    parts = ["u", None, "é", "1.0"]
    df = spark.createDataFrame([tuple(parts)], "a string, b string, c string, d string")
    got = df.select(identity.content_id(*[F.col(c) for c in "abcd"])).first()[0]
    assert got == hashlib.sha256("u||é|1.0".encode()).hexdigest()


def test_headers():
    assert text.normalize_header(" Trade Date ") == "trade_date"
    assert text.normalize_header("ΔOwn") == "deltaown"


def test_unescape_and_cell_text(spark):
    raw = ["a &amp; b", "&lt;x&gt; &#233;&#xE9;", "&nosuch; &", "&amp;quot;", "&Delta;&nbsp;", "plain", "&apos;&quot;", None]
    assert one(spark, raw, text.unescape) == [None if r is None else html_lib.unescape(r) for r in raw]
    fragments = [" a <b> b </b>", "x<!-- c > -->y", " z&nbsp;", ""]
    assert one(spark, fragments, text.markup_text) == ["ab", "xy", "z", ""]


def test_links(spark):
    fragments = ['<a href="http://www.sec.gov/x?a=1&amp;b=2">t</a>', "<b><a class=k href='/y'>t</a></b>",
                 "<a href=z>t</a><a href=q>t</a>", "<a name=n>t</a>", "none", '<a href="//h/p">', '<a href="">t</a>']
    got = one(spark, fragments, lambda c: text.resolve_link(text.first_href(c)))
    base = text.LINK_BASE
    assert got == ["https://www.sec.gov/x?a=1&b=2", f"{base}y", f"{base}z", None, None, "https://h/p", base]


def test_clean_symbols(spark):
    df = spark.createDataFrame([(" A ",), ("A",), (None,), ("  ",), ("b ",)], "ticker string")
    assert sorted(r[0] for r in text.clean_symbols(df).collect()) == ["A", "b"]
    with pytest.raises(ValueError):
        text.clean_symbols(df, "symbol")


def test_price_window():
    before = datetime(2024, 1, 20, 21, 9)
    assert clock.price_window(before, 5) == ("2024-01-15", "2024-01-20")
    assert clock.price_window(before.replace(minute=10), 5) == ("2024-01-15", "2024-01-21")
    assert clock.price_window(datetime(2024, 7, 20, 20, 10), 1) == ("2024-07-19", "2024-07-21")
    # Past midnight UTC it is still the day before in New York.
    assert clock.price_window(datetime(2024, 1, 21, 3, 0), 1) == ("2024-01-19", "2024-01-21")


def test_scan_page(spark):
    short = cells()[:2]
    long = [*cells(ticker="BBB", href="/y"), "extra", "more"]
    no_link = cells(ticker="CCC &amp; D", href=None)
    body = page([cells(), short, long, no_link]).replace("</td>", "", 3)
    rows = html.extract_disclosures(pages_frame(spark, body, "<html><table class='x'></table></html>")).orderBy("pos").collect()
    assert [r["ticker"] for r in rows] == ["AAA", None, "BBB", "CCC & D"]
    assert [r["pos"] for r in rows] == [1, 2, 3, 4]
    assert rows[0]["filing_date"] == "2024-01-20 16:30:05"
    assert rows[0]["trade_date"] == "2024-01-18" and rows[0]["deltaown"] == "+20%"
    assert [r["source_url"] for r in rows] == [
        "https://www.sec.gov/f/1", "https://www.sec.gov/f/1", f"{text.LINK_BASE}y", None,
    ]


def test_scan_tolerates_markup_variants(spark):
    body = page([cells()])
    variants = [
        body.replace('class="tinytable"', "class='a tinytable b'"),
        body.replace('class="tinytable"', "id=t class=tinytable"),
        body.replace("<td>", "<TD align=right>").replace("</td>", "</TD>").replace("<tr>", "<TR >"),
        body.replace("</td>", "").replace("</tr>", ""),
    ]
    rows = html.extract_disclosures(pages_frame(spark, *variants)).collect()
    assert len(rows) == 4 and {r["ticker"] for r in rows} == {"AAA"}
    assert {r["value"] for r in rows} == {"+$12,340"}


def test_pages_without_table(spark):
    pages = pages_frame(spark, page([cells()]), "<p>none</p>", '<table class="tinytables"></table>')
    assert sorted(r[0] for r in html.pages_without_table(pages).select("page_id").collect()) == [2, 3]
    with pytest.raises(Exception, match="no table.tinytable on page"):
        html.extract_disclosures(html.require_table(pages)).collect()


def test_normalize(spark):
    raw = html.extract_disclosures(pages_frame(spark, page([cells(x="D", price="1.2.3"), cells()])))
    bad, good = html.normalize_disclosures(raw).orderBy("pos").collect()
    assert bad["price"] is None and bad["value"] is None and bad["x_flags"] == "D"
    assert good["value"] == 12340.0 and good["sec_tx_code"] == "P" and good["filing_date"] == date(2024, 1, 20)
    parts = ["https://www.sec.gov/f/1", "2024-01-20", "2024-01-18", "AAA", "Doe Jane", "CEO", "P - Purchase", "12.34", "1000", ""]
    assert good["transaction_id"] == hashlib.sha256("|".join(parts).encode()).hexdigest()
    with pytest.raises(ValueError):
        html.normalize_disclosures(raw.drop("ticker"))
    # A page without an optional column still normalises.
    assert html.normalize_disclosures(raw.drop("x", "trade_type")).first()["classification"] == "UNKNOWN"
