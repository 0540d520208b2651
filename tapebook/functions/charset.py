"""Text of landed bytes, by column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UTF8, UTF16LE, UTF16BE, WINDOWS = "utf-8", "utf-16le", "utf-16be", "windows-1252"

# Names under which pages declare a charset; the names of Latin-1 and ASCII mean windows-1252.
LABELS = {
    UTF8: ("utf-8", "utf8", "unicode-1-1-utf-8"),
    UTF16LE: ("utf-16", "utf-16le", "unicode"),
    UTF16BE: ("utf-16be",),
    WINDOWS: (
        "windows-1252", "cp1252", "x-cp1252", "iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "l1",
        "us-ascii", "ascii", "ansi_x3.4-1968",
    ),
}
#: Bytes 80-9F of windows-1252; five of them are control characters there as well.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
#: A tag that declares a charset counts among the first bytes only (fixed value).
META_BYTES = 1024


#: Bytes in which a tag can be read as ASCII are not UTF-16, whatever it says.
_INSIDE = {UTF16LE: UTF8, UTF16BE: UTF8}


def _known(label: Column, instead: dict[str, str] | None = None) -> Column:
    """The charset of a label, the label itself if it is none of ``LABELS``, NULL for an empty one."""
    pairs = [(name, (instead or {}).get(charset, charset)) for charset, names in LABELS.items() for name in names]
    table = F.create_map(*[F.lit(text) for pair in pairs for text in pair])
    name = F.nullif(F.lower(F.trim(label)), F.lit(""))
    return F.coalesce(F.try_element_at(table, name), name)


def _rest(body: Column, skip: int) -> Column:
    return F.substring(body, skip + 1, 2**31 - 1)


def _starts(body: Column, mark: str) -> Column:
    return F.hex(F.substring(body, 1, len(mark) // 2)) == mark


def _declared_inside(body: Column) -> Column:
    head = F.decode(F.substring(body, 1, META_BYTES), "ISO-8859-1")
    shown = F.regexp_replace(head, r"(?s)<!--.*?(?:-->|$)", "")
    label = F.regexp_extract(shown, r"""(?is)<(?:meta\s[^>]*?charset|\?xml\s[^>]*?encoding)\s*=\s*["']?\s*([a-z0-9_.:-]+)""", 1)
    return _known(label, _INSIDE)


def charset_of(body: Column, declared: Column | None = None) -> Column:
    """Charset of a page: its byte order mark, else what was ``declared`` with it, else its meta tag, else
    UTF-8 if the bytes are that, else windows-1252. A name that isn't supported is returned as it is."""
    mark = (
        F.when(_starts(body, "EFBBBF"), UTF8).when(_starts(body, "FFFE"), UTF16LE).when(_starts(body, "FEFF"), UTF16BE)
    )
    guess = F.when(F.is_valid_utf8(body.cast("string")), UTF8).otherwise(WINDOWS)
    told = [_known(declared)] if declared is not None else []
    return F.coalesce(mark, *told, _declared_inside(body), guess)


def _whole_utf16(body: Column, big: bool) -> Column:
    """Is every surrogate one of a pair? Units are looked at as blank-separated groups of four digits, but
    only if any byte could begin a surrogate."""
    units = F.regexp_replace(F.hex(body), "([0-9A-F]{4})", "$1 ")
    high, low = (r"\bD[89AB]..\b", r"\bD[C-F]..\b") if big else (r"\b..D[89AB]\b", r"\b..D[C-F]\b")
    lone = rf"{high}(?! {low[2:]})|(?<!{high} ){low}"
    suspect = F.decode(body, "ISO-8859-1").rlike("[\u00d8-\u00df]")
    return (F.length(body) % 2 == 0) & F.when(suspect, ~units.rlike(lone)).otherwise(F.lit(True))


def decoded(body: Column, charset: Column) -> Column:
    """The text of a page without its byte order mark; NULL if its bytes aren't of that charset."""
    utf8 = F.when(_starts(body, "EFBBBF"), _rest(body, 3)).otherwise(body).cast("string")
    out = F.when(charset == UTF8, F.when(F.is_valid_utf8(utf8), utf8))
    out = out.when(charset == WINDOWS, F.translate(F.decode(body, "ISO-8859-1"), _C1, _C1_WINDOWS))
    for name, mark, big in ((UTF16LE, "FFFE", False), (UTF16BE, "FEFF", True)):
        bare = F.when(_starts(body, mark), _rest(body, 2)).otherwise(body)
        out = out.when(charset == name, F.when(_whole_utf16(body, big), F.decode(bare, name.upper())))
    return out
