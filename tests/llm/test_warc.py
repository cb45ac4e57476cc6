import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from feedweave.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, key int"


def archive(spark, pages, **options):
    folder = warc.archive_folder(spark)
    return warc.write(pages, folder), folder


def expected(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(i, first.get(data, i))
    found = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == i else refers
        found.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(found, key=str)


ROWS = [
    (3, "http://www.a.example.com/x?b=1#f", "é" * 60),
    (1, "https://user@A.example.com:8080/", "é" * 60),
    (2, "http://b.example.org", "é" * 60),
    (2, "http://b.example.org", "é" * 60),
    (4, "http://b.example.org/1", "short"),
    (5, "http://b.example.org/1", "short"),
    (6, None, None),
    (7, "not a url", ""),
    (8, "http://c.example.org/\r\nX-Page-ID: 99", "line\r\n\r\nbreaks" * 20),
    (None, "http://b.example.org/2", "é" * 60),
    (9, "http://d.example.org/big", "long text " * 50000),
]


@pytest.mark.parametrize("lines, part", [(1000, 16_000), (2, 10)])
def test_reads_back_every_row(spark, monkeypatch, lines, part):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc, "INDEX_LINES", part)
    rows = ROWS + [(100 + k, f"http://hot.example.net/{k % 7}", f"<p>{k % 5}</p>" * 30) for k in range(60)]
    pages = spark.createDataFrame([(*r, "old", 1) for r in rows], SCHEMA)
    directory, folder = archive(spark, pages)
    keys = pages.select(warc.surt(F.col("url")).alias("key"))
    found = warc.lookup(keys, directory, folder)
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    text = {i: (html or "").encode() for i, _, html in rows}
    for r in found.where("record_type = 'response' AND page_id IS NOT NULL").collect():
        assert bytes(r["payload"]) == text[r["page_id"]]


def test_lookup_of_some_keys(spark):
    pages = spark.createDataFrame([(*r, "old", 1) for r in ROWS], SCHEMA)
    directory, folder = archive(spark, pages)
    keys = spark.createDataFrame([("org,example,b)/1",), ("org,example,b)/1",), (None,), ("nowhere",), ("zzz",), ("",)], "key string")
    found = warc.lookup(keys, directory, folder, with_payload=False).collect()
    assert sorted(r["page_id"] for r in found) == [4, 5, 6]
    assert {r["payload"] for r in found} == {None}


def test_sort_keys(spark):
    urls = [("http://www.a.example.com/x?b=1#f", "com,example,a,www)/x?b=1#f"), ("https://user@A.example.com:8080/", "com,example,a)/"), ("http://b.org", "org,b)"), ("http://b.org?q", "org,b)?q"), ("mailto", "mailto"), ("", ""), (None, "")]
    df = spark.createDataFrame(urls, "url string, expected string")
    assert df.where(warc.surt(F.col("url")) != F.col("expected")).collect() == []


def test_files_are_standard_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "old", 1) for r in ROWS], SCHEMA)
    folder = str(tmp_path / "archive")
    directory = warc.write(pages, folder)
    files = list((tmp_path / "archive").glob("*.warc.gz"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)
    index = list((tmp_path / "archive").glob("*.cdx.gz"))
    assert {r["file"] for r in directory.collect()} == {f.name for f in index}
    lines = b"\n".join(gzip.decompress(f.read_bytes()) for f in index).split(b"\n")
    assert len(lines) == len(ROWS) and all(f.name.encode() in b"".join(lines) for f in files)


def test_empty(spark):
    pages = spark.createDataFrame([], SCHEMA)
    directory, folder = archive(spark, pages)
    assert directory.count() == 0
    assert warc.lookup(spark.createDataFrame([("a",)], "key string"), directory, folder).count() == 0
