import base64
import hashlib

import pytest

from mediabatch.llm import warc

SCHEMA = "page_id long, url string, html string"
FAKE = (
    "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 666\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"
)
ROWS = [
    (5, "https://a/5", "same"),
    (3, "https://a/3", "same"),
    (4, "https://a/4 \r\nX-Page-ID: 9", "same"),
    (7, None, None),
    (8, "https://a/8", ""),
    (9, "https://a/9", "é日本😀\r\n\r\n\n"),
    (10, "https://a/10", "before " + FAKE + "after"),
    (11, "https://a/11", FAKE),
    (12, "https://a/12", FAKE * 20 + "end" + "WARC/1.1\r\n"),
    (13, "https://a/13", "WARC/1.1\r\nWARC/1.1\r\nWARC/1.1\r\nContent-Length: 10000000\r\n\r\n"),
    (None, None, "no id"),
    (14, "https://a/14", "x" * 300_000),
    (15, "https://a/15", "same"),
    (15, "https://a/15", "same"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def brute(rows):
    groups = {}
    for i, _, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for text, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i or 0))
        seen = False
        for i in ids:
            response = i == first and not seen
            seen |= response
            out.append((i, len(text.encode()), digest(text), "response" if response else "revisit", None if response else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [None, "700"])
def test_round_trip(spark, rows_of, split):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "url AS digest", "url AS row", "url AS value").repartition(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        assert rows_of(warc.round_trip(table(spark, df))) == brute(ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def table(spark, df):
    from mediabatch.llm.common import stored

    return stored(df, "pages")


def test_payloads_come_back(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(table(spark, spark.createDataFrame(ROWS[5:12], SCHEMA)), path)
    records = warc.read_warc(spark, path).select("file", "start", "page_id")
    got = {r.page_id: bytes(r.payload).decode() for r in records.join(warc.read_payloads(spark, path), ["file", "start"]).collect()}
    assert got == {i: t for i, _, t in ROWS[5:12]}


def test_foreign_and_broken_files(spark, tmp_path):
    """Bytes that are no UTF-8, other field orders and cases, a torn last record, rubbish behind a broken chain."""
    whole = b"WARC/1.1\r\ncontent-length: 3\r\nwarc-type: warcinfo\r\n\r\n\xff\xfe\x00\r\n\r\n"
    torn = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 30\r\n\r\nshort\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(whole + whole + torn)
    (tmp_path / "b.warc").write_bytes(whole + b"rubbish" + whole)
    (tmp_path / "c.warc").write_bytes(b"rubbish" + whole)
    (tmp_path / "d.warc").write_bytes(b"")
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.file[-6:], r.start) for r in got) == [("a.warc", 0), ("a.warc", len(whole)), ("b.warc", 0)]
    assert {r.digest for r in got} == {base64.b32encode(hashlib.sha1(b"\xff\xfe\x00").digest()).decode()}


def test_empty_table(spark):
    assert warc.round_trip(table(spark, spark.createDataFrame([], SCHEMA))).count() == 0


def test_least_bytes(spark, rows_of):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = rows_of(warc.round_trip(table(spark, spark.createDataFrame(rows, SCHEMA)), 4), "page_id", "record_type")
    assert got == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
