import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from framewatch.llm import warc as W
from framewatch.llm.common import cut

SCHEMA = "page_id long, url string, html string"


@pytest.fixture
def pages(spark):
    rows = [(i, f"http://h{i % 3}.Example.com/p/{i % 40}?q={i}#f", f"<p>body {i % 25} é</p>" * (i % 7)) for i in range(200, 0, -1)]
    rows += [(500, None, None), (501, "http://[bad", ""), (-3, "https://x.example:81", "\r\n\r\nWARC/1.1\r\n"), (502, "a b\r\nc", "x"),
             (None, "http://n.example/", "x"), (503, "http://n.example/", "x"), (503, "http://n.example/", "x")]
    return spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = first.get(h or "")
        refers = None if i is None or refers == i else refers
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(pages):
    got = W.archive_round_trip(pages.withColumn("key", F.lit(1)), W.ArchiveFormat(block_lines=7, file_bytes=3000)).collect()
    rows = [tuple(r) for r in pages.collect()]
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=repr) == expected(rows)
    assert W.archive_round_trip(pages.limit(0)).count() == 0


def test_revisit_needs_its_size(pages):
    got = W.archive_round_trip(pages, W.ArchiveFormat(revisit_bytes=40)).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 40} == {"response"}
    assert "revisit" in {r["record_type"] for r in got}


def test_lookup_reads_single_captures(spark, pages):
    folder = W.archive_folder(spark)
    fmt = W.ArchiveFormat(block_lines=5)
    captures = W.write_archive(pages, folder, fmt)
    index = W.write_index(captures, folder, fmt)
    asked = [W.url_key("http://h1.example.com/p/1?q=1", 1), W.url_key("http://h1.example.com/p/0?q=40", 40), "aaa", "zzz"]
    found = W.look_up(spark.createDataFrame([(k,) for k in asked], "key string"), index, folder).collect()
    assert sorted(r["page_id"] for r in found) == [1, 40]
    doubled = W.look_up(spark.createDataFrame([(W.url_key("http://n.example/", 503),)], "key string"), index, folder)
    assert doubled.count() == 2


def test_keys_and_records():
    assert W.url_key("http://www.A.example.org/x/y?z=1#f", 0).startswith("org,example,a,www)/x/y?z=1 ")
    assert W.url_key("http://a.b", -1) < W.url_key("http://a.b", 0) < W.url_key("http://a.b", 10)
    made = W.record(5, "http://a.b/ü c", b"x\r\n\r\ny", None, "2024-01-01T00:00:00Z")
    text = gzip.decompress(made)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"x\r\n\r\ny\r\n\r\n")
    assert W.read_record(made)["payload_bytes"] == 6
    assert W.read_record(W.record(6, None, b"x\r\n\r\ny", 5, "2024-01-01T00:00:00Z"))["refers_to"] == 5
    with pytest.raises(ValueError):
        W.read_record(gzip.compress(text.replace(b"x\r\n\r\ny", b"z\r\n\r\ny")))


def test_cut_is_a_written_table(spark):
    df = cut(spark.range(5), "test")
    assert df.count() == 5 and "FileScan parquet" in df._jdf.queryExecution().toString()
