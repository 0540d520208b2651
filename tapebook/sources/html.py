"""Disclosure tables inside landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identity, rules, text

# Class of the wanted table, the column that carries the link, the kept headers.
TABLE_CLASS = "tinytable"
LINK_HEADER = "Filing Date"
KEPT_HEADERS = (
    "X", "Filing Date", "Trade Date", "Ticker", "Company Name", "Insider Name", "Title",
    "Trade Type", "Price", "Qty", "Owned", "ΔOwn", "Value",
)


def elements(markup: Column, tag: str, stops: str = "") -> Column:
    """Inner markup of every ``<tag>`` in a text; a missing end tag ends at the next element.

    ``stops`` names further tags, as a pattern, whose end also closes the element.
    """
    start = rf"(?i)<{tag}(?=[\s>/])[^>]*>"
    closing = f"{tag}|{stops}" if stops else tag
    pieces = F.split(markup, start)
    tail = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(tail, lambda p: F.regexp_replace(p, rf"(?is)</(?:{closing})\s*>.*$", ""))


def _own_markup(rest: Column) -> Column:
    """What stands before the end of the table that ``rest`` begins in. Tables inside of its cells lose
    their row and cell tags, so their text stays in the cell that holds them."""
    pieces = F.split(rest, r"(?i)(?=</?table[\s>])")
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))
    loose = r"(?i)</?(?:table|caption|colgroup|col|thead|tbody|tfoot|tr|th|td)(?=[\s>/])[^>]*>"

    def add(state: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"^(?i)<table[\s>]"), piece.rlike(r"^(?i)</table[\s>]")
        depth = state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        own = F.when(depth > 1, F.regexp_replace(piece, loose, "<i>")).otherwise(
            F.regexp_replace(piece, r"^(?i)</table(?=[\s>])[^>]*>", "<i>")
        )
        ended = (state["depth"] == 0) | (depth == 0)
        return F.struct(
            F.when(ended, 0).otherwise(depth).alias("depth"),
            F.when(ended, state["text"]).otherwise(F.concat(state["text"], own)).alias("text"),
        )

    return F.aggregate(pieces, start, add, lambda state: state["text"])


def _around_opening(html: Column, css_class: str) -> Column:
    """What stands before and after the opening tag of the first table of a class; one text if there is none."""
    name = css_class
    attribute = (
        rf"class\s*=\s*(?:\"(?:[^\"]*\s)?{name}(?:\s[^\"]*)?\"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))"
    )
    visible = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.split(visible, rf"(?i)<table\s(?:[^>]*\s)?{attribute}[^>]*>", 2)


def table_markup(html: Column, css_class: str = TABLE_CLASS) -> Column:
    """Inner markup of the first table of a class, NULL if the page has none."""
    opened = _around_opening(html, css_class)
    return F.when(F.size(opened) > 1, _own_markup(F.try_element_at(opened, F.lit(2))))


def _lacks_table(html: Column, css_class: str) -> Column:
    """Is ``table_markup`` NULL? Nothing after the opening tag is looked at."""
    return ~F.coalesce(F.size(_around_opening(html, css_class)) > 1, F.lit(False))


def scan_table(pages: DataFrame, css_class: str = TABLE_CLASS) -> DataFrame:
    """(page_id, pos, headers, cells): the data rows of the table on each page.

    The first table row is the header row; rows without data cells are left out.
    """
    headers = F.transform(
        elements(F.col("markup"), "th", "tr|thead"),
        lambda h: F.replace(text.markup_text(F.regexp_replace(h, r"(?is)<t[dr][\s>].*$", "")),
                            F.lit(text.NBSP), F.lit(" ")),
    )
    # Beside the generator headers would be read again for every row of the page.
    tables = pages.select("page_id", table_markup(F.col("html"), css_class).alias("markup")).withColumn("headers", headers)
    # A page without the table has NULL markup and explodes to nothing.
    rows = tables.select("page_id", "headers", F.posexplode(elements(F.col("markup"), "tr", "tbody")).alias("pos", "row"))
    has_cells = F.col("row").rlike(r"(?i)<td[\s>/]")
    return rows.filter((F.col("pos") > 0) & has_cells).select(
        "page_id", "pos", "headers", elements(F.col("row"), "td", "tr").alias("cells")
    )


def pages_without_table(pages: DataFrame, css_class: str = TABLE_CLASS) -> DataFrame:
    """Pages that cannot be scanned."""
    return pages.filter(_lacks_table(F.col("html"), css_class))


def require_table(pages: DataFrame, css_class: str = TABLE_CLASS) -> DataFrame:
    """Pass pages through, failing on the first one that has no table of the class."""
    message = F.concat(F.lit(f"no table.{css_class} on page "), F.col("page_id").cast("string"))
    lacks = _lacks_table(F.col("html"), css_class)
    return pages.withColumn("html", F.when(lacks, F.raise_error(message)).otherwise(F.col("html")))


def extract_disclosures(pages: DataFrame) -> DataFrame:
    """All-text disclosure rows, one column per kept header, plus link and row order."""
    rows = scan_table(pages)
    def cell(header: str) -> Column:
        hits = F.filter(F.col("_cells"), lambda z: (z["headers"] == header) & z["texts"].isNotNull())
        return F.try_element_at(hits, F.lit(-1))["texts"]

    at = F.array_position("headers", LINK_HEADER).cast("int")
    link_cell = F.when(at > 0, F.try_element_at("cells", at))
    # A column of its own each, so that no text is taken again wherever it is looked at.
    read = rows.withColumns({"texts": F.transform("cells", text.markup_text), "_href": text.first_href(link_cell)})
    return read.withColumn("_cells", F.arrays_zip("headers", "texts")).select(
        "page_id",
        "pos",
        *[cell(h).alias(text.normalize_header(h)) for h in KEPT_HEADERS],
        text.resolve_link(F.col("_href")).alias("source_url"),
    )


def normalize_disclosures(raw: DataFrame) -> DataFrame:
    """Typed disclosures with code, value, class and content id."""
    text.require_columns(raw, "ticker", "filing_date", "source_url")
    wanted = [text.normalize_header(h) for h in KEPT_HEADERS]
    absent = [c for c in wanted if c not in raw.columns]
    full = raw.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else raw
    typed = full.withColumns(
        {
            "filing_date": text.date_of(F.col("filing_date")),
            "trade_date": text.date_of(F.col("trade_date")),
            "price": text.decimal_of(F.col("price")),
            "qty": text.int_of(F.col("qty")),
            "x_flags": F.col("x"),
            "sec_tx_code": text.code_of(F.col("trade_type")),
        }
    )
    return typed.withColumns(
        {
            "value": rules.trade_value(F.col("price"), F.col("qty")),
            "is_open_market": rules.open_market_flag(F.col("trade_type")),
            "classification": rules.classification(F.col("trade_type")),
            "transaction_id": identity.transaction_id(),
        }
    )
