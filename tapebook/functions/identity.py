"""Content-hash ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_text(c: Column) -> Column:
    """Shortest decimal text of a double: ``12.0``, ``10000000.0``, ``0.0001``, ``1e+16``, ``5e-05``.

    The engine's own text already has this form from 0.001 up to ten million; only values
    outside take the longer way.
    """
    size = F.abs(c)
    # The engine gives the least value one digit more than it takes.
    text = F.replace(c.cast("string"), F.lit("4.9E-324"), F.lit("5.0E-324"))
    sci = F.split(text, "E")
    exponent = F.try_element_at(sci, F.lit(2)).try_cast("int")
    # the shortest digits, set anew around the point
    sign = F.when(c < 0, "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(sci[0], r"\.0$", ""), r"[-.]", "")
    before = exponent + 1
    whole = F.concat(F.rpad(digits, before, "0"), F.lit(".0"))
    mixed = F.concat(F.substring(digits, F.lit(1), before), F.lit("."), F.substring(digits, before + 1, F.length(digits)))
    plain = F.concat(
        sign,
        F.when(exponent < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -before), digits))
        .when(F.length(digits) <= before, whole)
        .otherwise(mixed),
    )
    scientific = F.concat(
        F.regexp_replace(sci[0], r"\.0$", ""),
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(~F.contains(text, F.lit("E")) & ~text.rlike("[NI]"), text)
        .when((size >= 1e16) | (size < 1e-4), scientific)
        .otherwise(plain)
    )


def content_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ``|``; a NULL part counts as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def transaction_id() -> Column:
    """Stable id of a normalised disclosure row."""
    return content_id(
        F.col("source_url"),
        F.col("filing_date").cast("string"),
        F.col("trade_date").cast("string"),
        F.col("ticker"),
        F.col("insider_name"),
        F.col("title"),
        F.col("trade_type"),
        float_text(F.col("price")),
        F.col("qty").cast("string"),
        F.col("x_flags"),
    )


def packed_id(c: Column | str) -> Column:
    """The 32 bytes of a content id of 64 letters. They sort as the letters do and move as half as much."""
    return F.unhex(c)
