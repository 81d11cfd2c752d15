"""WARC: exact round trip, revisits, lookups through the two levels of the index."""

import base64
import hashlib
import random
import zlib

import pytest
from edge_cases import SF_DIR, tally

from brooklet.llm import warc
from brooklet.llm.queries import op3_warc
from brooklet.plans.inputs import scratch

SCHEMA = "page_id bigint, url string, html string, key string, file string"


def brute_force(rows, least=0):
    first = {}
    for page_id, html in rows:
        if page_id is not None and len(html.encode()) >= least:
            first[html] = min(page_id, first.get(html, page_id))
    out = []
    for page_id, html in rows:
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = page_id is not None and len(data) >= least and first[html] < page_id
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", first[html] if revisit else None))
    return sorted(out, key=repr)


def edge_pages():
    rng = random.Random(3)
    same = "<p>same</p>" * 30
    urls = [None, "", "http://a.example.com/x", "http://a.example.com/x", "http://b.a.example.com:8080/?q=1#top",
            "not a url", "http://[bad", "http://ä.example/ö\r\nInjected: 1", "ftp://user:pw@h.example/y"]
    rows = [(i, rng.choice(urls), rng.choice([None, "", same, f"<b>é{i}</b>", "z" * 3])) for i in range(60)]
    rows += [(2**60 + 1, "http://a.example.com/x", same), (7, "http://a.example.com/x", same), (7, None, same)]
    rows += [(None, None, None), (None, "http://c.example/", same), (100, "http://big.example/", "ab\r\n\r\nc" * 50_000)]
    return [(*row, "k", "f") for row in rows]


NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_of_edge_pages(spark, least):
    pages = spark.createDataFrame(edge_pages(), SCHEMA).repartition(4)
    archive = warc.Archive(spark, scratch(spark, "warc")).write(pages, least_bytes=least, block=3)
    read = archive.read_all(payloads=True).persist()
    assert tally(read.select(*NAMES)) == brute_force([(r[0], r[2] or "") for r in edge_pages()], least)
    wanted = {(r[0], r[2] or "") for r in edge_pages()}
    for r in read.filter("record_type = 'response'").collect():
        assert (r.page_id, bytes(r.payload).decode()) in wanted


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert tally(op3_warc(spark, SF_DIR).select(*NAMES)) == brute_force([(r.page_id, r.html or "") for r in pages.collect()])


def test_lookup(spark):
    pages = spark.createDataFrame(edge_pages(), SCHEMA)
    archive = warc.Archive(spark, scratch(spark, "warc")).write(pages, block=2)
    wanted = [(100, "http://big.example/"), (100, "http://big.example/"), (3, "http://nowhere.example/"), (None, None)]
    found = archive.lookup(spark.createDataFrame(wanted, "page_id bigint, url string")).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in found if r.page_id) == [(100, 350_000)]
    assert sum(r.page_id is None for r in found) == 1


def test_empty_table(spark):
    archive = warc.Archive(spark, scratch(spark, "warc")).write(spark.createDataFrame([], SCHEMA))
    assert archive.read_all().count() == 0


def test_every_record_is_a_gzip_member_that_says_what_it_is():
    payload = "<p>ü</p>".encode()
    digest = warc.base32(hashlib.sha1(payload).digest())
    data = warc.record(5, "http://x.example/a b", payload, digest, None)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: http://x.example/a%20b\r\n" in data
    member = warc._gzip(data)
    assert zlib.decompress(member, 31) == data
    assert warc.parse(member).payload == payload
    with pytest.raises(ValueError, match="differs"):
        warc.parse(warc._gzip(data.replace(b"<p>", b"<q>")))


def test_keys_sort_by_reversed_host():
    hosts = ["http://b.example.com/", "http://example.com/z", "http://a.example.com/", "http://example.org/"]
    assert [k.split(")")[0] for k in sorted(warc.capture_key(h, 1) for h in hosts)] == [
        "com,example", "com,example,a", "com,example,b", "org,example",
    ]
    assert warc.capture_key("http://x.example/", 9) < warc.capture_key("http://x.example/", 10)
    assert warc.capture_key("http://x.example/", -1) < warc.capture_key("http://x.example/", 0)
