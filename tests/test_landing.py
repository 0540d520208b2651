from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, cells, metadata_frame, page
from tapebook.functions import charset
from tapebook.plans.disclosures import run_disclosures
from tapebook.sources import feeds
from tapebook.sources.store import SnapshotStore
from tapebook.streaming.incremental import stream_disclosures

TEXT = "<p>Ærø € 😀 ퟿</p>"
LATIN = "<p>Ærø €“”</p>"
META = '<html><head><!-- <meta charset="utf-8"> --><META  name=x CHARSET = "Latin1">'

CASES = [
    # body, declared, text
    (TEXT.encode(), None, TEXT),
    (TEXT.encode("utf-8-sig"), "latin1", TEXT),                      # the mark wins
    (b"\xff\xfe" + TEXT.encode("utf-16-le"), "utf-8", TEXT),
    (b"\xfe\xff" + TEXT.encode("utf-16-be"), None, TEXT),
    (TEXT.encode("utf-16-le"), " UTF-16 ", TEXT),
    (LATIN.encode("cp1252"), None, LATIN),                           # no valid UTF-8
    (LATIN.encode("cp1252"), "ISO-8859-1", LATIN),
    ((META + LATIN).encode("cp1252"), None, META + LATIN),
    (b'<?xml version="1.0" encoding="windows-1252"?>\xc3\xa9', None, '<?xml version="1.0" encoding="windows-1252"?>Ã©'),
    (b'<meta charset=utf-16>\xc3\xa9', None, "<meta charset=utf-16>é"),
    (b"\x81\x8d", "cp1252", "\x81\x8d"),
    (b"", None, ""),
    (b"", "utf-16be", ""),
    (b"\xe9", "", "é"),
    (b"x" * 1020 + b'<meta charset="no-such">\xc3\xa9', None, "x" * 1020 + '<meta charset="no-such">é'),  # too late to count
    # not decodable
    (b"\xe9", "utf-8", "bytes are not utf-8"),
    (b'<meta charset="utf-8">\xe9', None, "bytes are not utf-8"),
    (b"a\x00b", "utf-16le", "bytes are not utf-16le"),
    (b"\x3d\xd8\x41\x00", "utf-16le", "bytes are not utf-16le"),     # high surrogate alone
    (b"\x41\x00\x00\xde", "utf-16le", "bytes are not utf-16le"),     # low surrogate alone
    (b"\xd8\x3d", "utf-16be", "bytes are not utf-16be"),
    (b"\xde\x00\xd8\x3d", "utf-16be", "bytes are not utf-16be"),
    (b"a", "shift_jis", "unknown charset shift_jis"),
    (None, "utf-8", "page has no bytes"),
    (None, None, "page has no bytes"),
]
LANDED = "page_id long, url string, body binary, charset string"


def landed(spark, cases=CASES):
    return spark.createDataFrame([(i, "u", bytearray(b) if b is not None else None, c) for i, (b, c, _) in enumerate(cases)], LANDED)


def test_charsets(spark):
    pages, lost = feeds.decode_pages(landed(spark))
    got = {r.page_id: r.html for r in pages.collect()} | {r.page_id: r.violations[0] for r in lost.collect()}
    assert got == {i: text for i, (_, _, text) in enumerate(CASES)}
    assert pages.columns == ["page_id", "url", "html"] and lost.columns == ["page_id", "url", "body", "charset", "violations"]


def test_every_unit_of_utf16(spark):
    """All pairs of the borders of the surrogates, against the library's own decoder."""
    units = [0x0041, 0xD7FF, 0xD800, 0xDBFF, 0xDC00, 0xDFFF, 0xE000, 0xFFFF, 0x00D8, 0x41DC]
    for name in ("utf-16-le", "utf-16-be"):
        order = "little" if name.endswith("le") else "big"
        cases = []
        for a in units:
            for b in units:
                for c in (0x41, 0xDC00, 0xD800):
                    body = b"".join(u.to_bytes(2, order) for u in (a, b, c))
                    try:
                        text = body.decode(name)
                    except UnicodeDecodeError:
                        text = None
                    cases.append((body, None, text))
        df = landed(spark, cases).select("page_id", charset.decoded(F.col("body"), F.lit(name.replace("16-", "16"))).alias("t"))
        assert {r.page_id: r.t for r in df.collect()} == {i: t for i, (_, _, t) in enumerate(cases)}


def test_long_pages(spark):
    body = b"\xff\xfe" + ("é😀" * 300_000).encode("utf-16-le")
    pages, lost = feeds.decode_pages(landed(spark, [(body, None, None), (body + b"\x00\xdc", None, None)]))
    assert [len(r.html) for r in pages.collect()] == [600_000] and lost.count() == 1


def test_one_declared_charset_and_fail_fast(spark):
    bare = landed(spark, [(b"\xe9", None, None)]).drop("charset")
    assert feeds.decode_pages(bare, "latin1")[0].first().html == "é"
    with pytest.raises(Exception, match="page 0: bytes are not utf-8"):
        feeds.decode_pages(bare, "utf-8", fail_fast=True)[0].collect()
    good, lost = feeds.decode_pages(bare, fail_fast=True)
    assert (good.count(), lost.count()) == (1, 0)


def test_page_files_through_the_job_and_the_stream(spark, tmp_path):
    folder = tmp_path / "pages" / "day"
    folder.mkdir(parents=True)
    (folder / "0007.html").write_bytes(b"\xff\xfe" + page([cells(href="/1", company="Ærø €")]).encode("utf-16-le"))
    (folder / "0008.html").write_bytes(('<meta charset="iso-8859-1">' + page([cells(href="/2", insider="Rø")])).encode("cp1252"))
    (folder / "9-broken.html").write_bytes(b'<meta charset="utf-8">\xe9')
    (folder / "name.txt").write_bytes(b"x")
    files = feeds.read_page_files(spark, str(tmp_path / "pages"), "*.html")
    assert sorted(r.page_id for r in files.collect()) == [7, 8, 9]
    store = SnapshotStore(spark, str(tmp_path / "store"))
    result = run_disclosures(store, files, metadata_frame(spark), AS_OF)
    assert (result.inserted, result.quarantined) == (2, 1)
    assert sorted(r.insider_name for r in store.read("insider_data").collect()) == ["Doe Jane", "Rø"]
    refused = store.read("rejected_rows").first()
    assert (refused.table_name, refused.violations, refused.n_rows) == ("pages", "bytes are not utf-8", 1)
    assert '"page_id":9' in refused.row_data
    other = SnapshotStore(spark, str(tmp_path / "other"))
    (folder / "name.txt").unlink()
    stream_disclosures(
        other, str(folder), str(tmp_path / "check"), metadata_frame(spark), lambda: AS_OF, fmt="binaryFile"
    ).awaitTermination()
    assert (other.read("insider_data").count(), other.read("rejected_rows").count()) == (2, 1)


def test_a_page_is_decoded_once_and_its_headers_are_read_once(spark):
    """Not again for each row of its table, nor by filters that were moved before the decoding."""
    from tapebook.catalog import QUERIES

    plan = QUERIES["landed_bytes_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    explode = next(k for k, line in enumerate(lines) if "Generate posexplode" in line)
    assert not any("<th(?=" in line for line in lines[:explode]) and any("<th(?=" in line for line in lines[explode:])
    assert plan.count("([0-9A-F]{4})") == 2  # one for each byte order
