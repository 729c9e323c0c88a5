import base64
import hashlib

from pyspark.sql import functions as F
from touchline.llm import warc
from touchline.llm.common import work_path


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string").repartition(3)


ROWS = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://b/\r\nx", ""), (5, "http://b", "WARC/1.1\r\n\r\nbody\r\n\r\n"), (6, "http://c", "x" * 100000), (7, "http://c", "x" * 100000), (7, "http://c", "x" * 100000), (None, "http://d", "<p>é</p>"), (None, "http://e", "alone"), (-8, "http://f", "minus")]


def brute(rows, least):
    top, count = {}, {}
    for i, _, h in rows:
        h = h or ""
        count[h] = count.get(h, 0) + 1
        top[h] = max((x for x in (i, top.get(h)) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = count[h or ""] > 1 and top[h or ""] is not None and i != top[h or ""] and len(raw) >= least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", top[h or ""] if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    for least in (0, 10):
        path = work_path(spark, "warc")
        warc.write_pages(pages(spark, ROWS), path, least)
        assert sorted(map(tuple, warc.page_records(spark, path).drop("target_uri").collect()), key=str) == brute(ROWS, least)
    payloads = {r.record_id: bytes(r.payload) for r in warc.read_warc(spark, path).where("record_type = 'response'").collect()}
    assert payloads["<urn:page:5>"] == ROWS[4][2].encode()
    empty = work_path(spark, "warc")
    warc.write_pages(pages(spark, []), empty)
    assert warc.page_records(spark, empty).count() == 0


def test_pushdown(spark):
    path = work_path(spark, "warc")
    warc.write_pages(pages(spark, ROWS), path)
    some = warc.read_warc(spark, path).where("record_type = 'revisit' and target_uri like 'http://a/%'")
    assert [r.record_id for r in some.collect()] == ["<urn:page:1>"]
    reader = warc.WarcReader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.StringStartsWith(("target_uri",), "http://a/"), warc.EqualTo(("http_length",), 5)]))
    assert len(left) == 1 and len(reader.filters) == 2
    assert [r[1] for p in reader.partitions() for f in p.paths for r in reader.records(f)] == ["<urn:page:1>"]
    bare = warc.read_warc(spark, path, payload="none", recordTypes="response")
    assert bare.where(F.col("payload").isNotNull()).count() == 0 and bare.count() == sum(r[3] == "response" for r in brute(ROWS, 0))


def test_plain_files_and_foreign_records(spark, tmp_path):
    data = warc.record("response", "<a>", "http://x", "2024-01-01T00:00:00Z", "D", None, b"<p>", 3)
    other = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <m>\r\nContent-Type: text/plain\r\n  ; charset=utf-8\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(data + other + data)
    got = [(r.record_type, bytes(r.payload)) for r in warc.read_warc(spark, str(tmp_path)).collect()]
    assert got == [("response", b"<p>"), ("metadata", b"abcd"), ("response", b"<p>")]
