from __future__ import annotations

import base64
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from shopstar.llm import warc

SHAPE = "page_id bigint, url string, html string, path string, payload string, first int, same string"
PAGES = [
    (5, "http://a/\r\nx", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (9, "http://b", "<p>same</p>"),
    (1, "http://c", None),
    (2, "http://d", ""),
    (4, "http://é", "é\x00\U0001f600 \r\n\r\n WARC/1.1"),
    (6, "", "long " * 100_000),
    (7, "http://twice", "row"),
    (7, "http://twice", "row"),
    (None, "http://none", "<p>same</p>"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "p", "q", 1, "s") for r in rows], SHAPE)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    manifest = warc.write_archives(pages(spark), warc.archive_folder(spark))
    assert sum(r["records"] for r in manifest.collect()) == len(PAGES)
    rows = warc.read_archives(manifest, with_payload=True).collect()
    first = {"<p>same</p>": 3, "": 1, "row": 7}
    want = []
    for page_id, _, html in PAGES:
        lead = first.get(html or "", page_id)
        kind = ("response", None) if page_id == lead else ("revisit", lead)
        want.append((page_id, len((html or "").encode()), digest(html), *kind))
    assert sorted([tuple(r)[:1] + tuple(r)[2:6] for r in rows], key=repr) == sorted(want, key=repr)
    held = {r["page_id"]: r["payload"] for r in rows if r["record_type"] == "response"}
    assert held[4] == PAGES[5][2].encode() and held[6] == PAGES[6][2].encode() and held[1] == b""
    assert all(r["payload"] is None for r in rows if r["record_type"] == "revisit")


def test_small_payloads_and_small_archives(spark):
    manifest = warc.write_archives(pages(spark), warc.archive_folder(spark), least=10_000, archive_bytes=1)
    assert {r["records"] for r in manifest.collect()} == {1}
    assert {r["record_type"] for r in warc.read_archives(manifest).collect()} == {"response"}


def test_headers_of_any_length(spark):
    urls = ["http://" + c * size for c, size in (("u", 2 << 20), ("é", 1 << 20), ("\r\n", 1000))]
    rows = [(i, url, f"<p>{i}</p>" * i) for i, url in enumerate(urls, 1)]
    manifest = warc.write_archives(pages(spark, rows), warc.archive_folder(spark))
    found = {r["page_id"]: (r["url"], r["payload"]) for r in warc.read_archives(manifest, with_payload=True).collect()}
    escaped = lambda url: url.replace("\r", "%0D").replace("\n", "%0A")
    assert found == {i: (escaped(url), html.encode()) for i, url, html in rows}


def test_an_archive_is_one_task(spark):
    rows = [(i, "u", f"page {i}") for i in range(40)]
    manifest = warc.write_archives(pages(spark, rows).repartition(3), warc.archive_folder(spark), archive_bytes=1)
    spread = warc.read_archives(manifest).groupBy(F.spark_partition_id()).count().collect()
    assert manifest.count() == 40 and len(spread) >= 30 and max(r["count"] for r in spread) <= 3


def test_a_header_without_end():
    import zlib

    for plain in (b"WARC/1.1\r\nWARC-Type: response\r\n", b"WARC/1.1\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"):
        packer = zlib.compressobj(5, zlib.DEFLATED, 31)
        with pytest.raises(ValueError, match="does not end"):
            list(warc.records(io.BytesIO(packer.compress(plain) + packer.flush())))


def test_no_pages(spark):
    manifest = warc.write_archives(pages(spark, []), warc.archive_folder(spark))
    assert warc.read_archives(manifest).count() == 0


def test_damage_is_noticed():
    whole = b"".join(warc.member(1, "u", b"abc" * 50, None, False)) + b"".join(warc.member(2, "u", b"", 1, True))
    assert [r["page_id"] for r in warc.records(io.BytesIO(whole))] == [1, 2]
    assert list(warc.records(io.BytesIO(b""))) == []
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(whole[:-5])))
    import zlib

    plain = zlib.decompress(b"".join(warc.member(1, "u", b"abc", None, False)), 31)
    for broken in (plain.replace(b"abc", b"abd"), plain.replace(b"\r\nabc", b"\r\nab"), plain + b"x"):
        packer = zlib.compressobj(5, zlib.DEFLATED, 31)
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(packer.compress(broken) + packer.flush())))
