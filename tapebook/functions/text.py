"""Column expressions that clean landed text. All are Spark built-ins."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NBSP = "\u00a0"
_SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Trim every kind of white space, the no-break space included."""
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def normalize_header(name: str) -> str:
    """Column name for a page header (driver side, names only)."""
    return name.replace(NBSP, " ").strip().replace(" ", "_").replace("Δ", "delta").lower()


def normalize_label(c: Column) -> Column:
    """``normalize_header`` for header text that is held in a column."""
    spaced = strip(F.replace(c, F.lit(NBSP), F.lit(" ")))
    return F.lower(F.replace(F.replace(spaced, F.lit(" "), F.lit("_")), F.lit("Δ"), F.lit("delta")))


def keep_columns(df: DataFrame, keep: list[str] | tuple[str, ...]) -> DataFrame:
    """The listed columns that exist, in list order; absent ones are ignored."""
    return df.select(*[c for c in keep if c in df.columns])


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail while the plan is built if a column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df


def date_of(c: Column) -> Column:
    """ISO date or timestamp text -> date; anything else -> NULL."""
    return strip(c).try_cast("timestamp_ntz").cast("date")


def int_of(c: Column) -> Column:
    """Drop every character but digits, then cast; sign, comma and dot all go."""
    return F.regexp_replace(c, "[^0-9]", "").try_cast("bigint")


def decimal_of(c: Column) -> Column:
    """Drop every character but digits and dots, then cast; bad numbers -> NULL."""
    return F.regexp_replace(c, "[^0-9.]", "").try_cast("double")


def code_of(c: Column) -> Column:
    """The code before the first " - " of a label; the whole text if there is none."""
    return F.substring_index(c, " - ", 1)


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_double(c: Column) -> Column:
    return null_if_nan(c.try_cast("double"))


def to_long(c: Column) -> Column:
    """Truncate towards zero; NaN and out-of-range values -> NULL."""
    return null_if_nan(c.try_cast("double")).try_cast("bigint")


def round3(c: Column) -> Column:
    """Three places, halves to even, on the scaled binary value."""
    return F.rint(c * 1000) / 1000


def clean_symbols(df: DataFrame, column: str = "ticker") -> DataFrame:
    """Distinct non-blank symbols, trimmed."""
    require_columns(df, column)
    return (
        df.select(strip(F.col(column).cast("string")).alias("ticker"))
        .filter(F.length("ticker") > 0)
        .distinct()
    )


# --- text inside markup ---------------------------------------------------

_ENTITY_BOUNDARY = r"(?=&#?[0-9A-Za-z]+;)|(?<=;)"


def _entity(token: Column) -> Column:
    """One token that may be a character reference -> its character."""
    names = F.create_map(*[F.lit(v) for k, cp in sorted(name2codepoint.items()) for v in (k, chr(cp))])
    body = F.regexp_extract(token, "^&(#?[0-9A-Za-z]+);$", 1)
    # leading zeros say nothing; more digits than a code point has give none
    digits = F.regexp_extract(body, "^#0*([0-9]{1,7})$", 1)
    hexes = F.regexp_extract(body, "^#[xX]0*([0-9A-Fa-f]{1,6})$", 1)
    code = F.coalesce(
        F.when(digits != "", digits.try_cast("bigint")),
        F.when(hexes != "", F.conv(hexes, 16, 10).try_cast("bigint")),
    )
    named = F.when(body == "apos", F.lit("'")).otherwise(F.try_element_at(names, body))
    char = F.when(code.between(1, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.when(body != "", F.coalesce(char, named, token)).otherwise(token)


def unescape(c: Column) -> Column:
    """Replace named and numeric character references."""
    decoded = F.array_join(F.transform(F.split(c, _ENTITY_BOUNDARY), _entity), "")
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def markup_text(c: Column) -> Column:
    """Visible text of a fragment: each text node trimmed, then joined without a gap."""
    nodes = F.split(F.regexp_replace(c, "(?s)<!--.*?-->", "<!>"), "<[^>]*>")
    return F.array_join(F.transform(nodes, lambda n: strip(unescape(n))), "")


_HREF = r"(?is)<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"


def _href_value(anchor: Column) -> Column:
    return unescape(F.concat(*[F.regexp_extract(anchor, _HREF, i) for i in (1, 2, 3)]))


def hrefs(c: Column) -> Column:
    """``href`` of every anchor in a text, in order."""
    return F.transform(F.regexp_extract_all(c, F.lit(_HREF), F.lit(0)), _href_value)


def first_href(c: Column) -> Column:
    """``href`` of the first anchor in a fragment, NULL if there is none."""
    return F.try_element_at(hrefs(c), F.lit(1))


# The base that relative links resolve against, and the host whose links move to https.
LINK_BASE = "https://openinsider.com/"
FILING_HOST_HTTP = "http://www.sec.gov/"
FILING_HOST_HTTPS = "https://www.sec.gov/"


def resolve_link(href: Column, base: str = LINK_BASE) -> Column:
    """Absolute form of a link found on a page directly below the site root."""
    root = base.rstrip("/")
    scheme = base.split(":", 1)[0]
    path = F.regexp_replace(href, r"^(\./)+", "")
    absolute = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .when(href == "", F.lit(base))
        .when(href.isNotNull(), F.concat(F.lit(f"{root}/"), path))
    )
    return F.regexp_replace(absolute, f"^{re.escape(FILING_HOST_HTTP)}", FILING_HOST_HTTPS)
