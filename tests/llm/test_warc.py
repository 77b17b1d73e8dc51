from __future__ import annotations

import base64
import hashlib

from loomcart.llm import warc


def expected(rows, floor):
    first: dict = {}
    for page, _, html in rows:
        body = (html or "").encode()
        key = (page is None, page)
        if len(body) >= floor and (body not in first or key < first[body]):
            first[body] = key
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        revisit = len(body) >= floor and first[body][1] != page
        out.append((str(page), len(body), digest, "revisit" if revisit else "response", first[body][1] if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows, folder, floor):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    listed = warc.write_archives(pages, folder, min_payload=floor)
    assert (listed.agg({"records": "sum"}).first()[0] or 0) == len(rows)
    got = warc.read_archives(spark, folder)
    return sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()), key=str)


ROWS = [
    (5, "http://a/\r\nX: 1", "<p>one</p>"), (3, None, "<p>one</p>"), (None, "u", "<p>one</p>"), (9, "", None), (8, "", ""),
    (7, "é", "é" * 100_000), (6, "v", "WARC/1.1\r\n\r\n"), (6, "v", "WARC/1.1\r\n\r\n"), (None, None, "only null"),
]


def test_round_trip(spark, tmp_path):
    assert round_trip(spark, ROWS, str(tmp_path / "a"), 0) == expected(ROWS, 0)
    assert round_trip(spark, ROWS, str(tmp_path / "b"), 5) == expected(ROWS, 5)


def test_archives_have_their_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"u{i}", f"<html><body>page number {i} of the same kind {i * i}</body></html>") for i in range(400)]
    folder = tmp_path / "c"
    assert round_trip(spark, rows, str(folder), 0) == expected(rows, 0)
    files = sorted(folder.glob("*.warc.zst"))
    assert len(files) > 1
    for file in files:
        assert file.read_bytes()[:4] == (0x184D2A5D).to_bytes(4, "little")
        assert all(r["headers"]["WARC-Record-ID"] for r in warc.read_records(file.read_bytes()))


def test_query(spark):
    from loomcart.llm.registry import queries

    folder = "/root/testdata/sf0.001"
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    got = queries()["op6_warc"](spark, folder).collect()
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == expected(rows, 0)


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_archives(pages, str(tmp_path / "d")).collect() == []
    assert warc.read_archives(spark, str(tmp_path / "d")).collect() == []


def test_stray_archives_are_not_read(spark, tmp_path):
    folder = tmp_path / "e"
    before = round_trip(spark, ROWS, str(folder), 0)
    [first, *_] = sorted(folder.glob("*.warc.zst"))
    (folder / "pages-000000-000000000000-00000.warc.zst").write_bytes(first.read_bytes())  # of an attempt that came second
    (folder / "pages-000009-000000000000-00000.warc.zst").write_bytes(b"broken off")
    got = warc.read_archives(spark, str(folder))
    assert sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()), key=str) == before
