"""Archives written and read back."""

import base64
import gzip
import hashlib

import pytest

from meshfold.llm import warc
from meshfold.llm.common import new_folder


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of (page_id, url, html) rows."""
    leaders = {}
    for i, _, html in rows:
        h, size = html or "", len((html or "").encode())
        if size >= least and i is not None:
            leaders[h] = min(leaders.get(h, i), i)
    out = []
    for i, _, html in rows:
        size, leader = len((html or "").encode()), leaders.get(html or "")
        revisit = size >= least and leader is not None and leader != i
        out.append((i, size, digest(html), "revisit" if revisit else "response", leader if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/b", "x\r\n\r\nWARC/1.1\r\n\r\n"), (3, "http://a/c?q=1#f", "x\r\n\r\nWARC/1.1\r\n\r\n"), (4, "http://a/c", "x\r\n\r\nWARC/1.1\r\n\r\n"), (None, None, None),
    (7, "u\r\nv", ""), (8, "é", "é\r\n"), (9, "q", "\r\n"), (10, "r", "a" * 300_000 + "\n" * 50), (11, "", "\n\n"), (12, "s", "Content-Length: 5\r\n\r\n"),
    (13, "t", "dup"), (13, "t", "dup"), (14, "t", "dup"),
]


@pytest.mark.parametrize("least", [0, 4, 1000])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, key string, n int").repartition(3)
    path = new_folder(spark, "warc-test")
    warc.write_warc(pages, path, least, files=2)
    captures = warc.assemble(warc.read_records(spark, path)).collect()
    got = []
    for c in captures:
        page = int(c.metadata["pageId"]) if "pageId" in c.metadata else None
        size = c.response.payload_bytes if c.response.payload_bytes is not None else int(c.metadata["payloadBytes"])
        refers = c.response.refers_to and int(c.response.refers_to.removeprefix("<urn:page:").removesuffix(">"))
        got.append((page, size, c.response.payload_digest, c.response.type, refers))
        assert c.request.startswith("GET /") and c.request.endswith("\r\n\r\n")
        if c.response.type == "response":
            assert digest(bytes(c.response.payload).decode()) == c.response.payload_digest
    assert sorted(got, key=repr) == expected(ROWS, least)
    kinds = {r.type: r["count"] for r in warc.read_records(spark, path).groupBy("type").count().collect()}
    assert kinds["request"] == kinds["metadata"] == len(ROWS) == kinds["response"] + kinds.get("revisit", 0)


def test_empty_table_and_broken_archives(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = new_folder(spark, "warc-test")
    warc.write_warc(pages.where("page_id = -1"), path)
    assert warc.assemble(warc.read_records(spark, path)).collect() == []
    record = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for name, data, good in (("whole", gzip.compress(record) + gzip.compress(record), True), ("cut", gzip.compress(record[:-6]), False), ("none", gzip.compress(b"hello\r\n\r\n"), False)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc.gz").write_bytes(data)
        found = warc.read_records(spark, f"file://{tmp_path}/{name}")
        if good:
            assert [(r.type, bytes(r.block)) for r in found.collect()] == [("warcinfo", b"abc")] * 2
            assert warc.assemble(found).collect() == []
        else:
            with pytest.raises(Exception, match="archive ends|no record"):
                found.collect()


def test_query(spark, sf_small):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()]
    got = sorted((tuple(r) for r in warc.op9_warc(spark, sf_small).collect()), key=repr)
    assert got == expected(rows, 0)
