"""Line dedup against dictionaries, and its index through insertions and deletions."""

import hashlib
import uuid

import numpy as np
import pytest
from edge_cases import SF_DIR, lower, tally, texts

from brooklet.llm.line_dedup import CuckooFilter, LineIndex, _hashes, digest
from brooklet.llm.queries import op1_line_dedup
from brooklet.plans.inputs import scratch
from pyspark.sql import functions as F


def key(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def brute_force(rows):
    holders = {}
    for doc_id, text in rows:
        for line in map(key, text.split("\n")):
            if doc_id is not None and len(line) >= 10:
                holders.setdefault(line, set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = text.split("\n")
        gone = [doc_id is not None and doc_id > min(holders.get(key(x), {doc_id})) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((doc_id, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def digests(rows):
    return tally(rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)))


def index(spark):
    return LineIndex(spark, scratch(spark, f"lines-{uuid.uuid4().hex}"))


def test_edge_rows(spark, edge):
    lines = index(spark)
    lines.insert(edge)
    kept = lines.kept(edge)
    assert digests(kept) == brute_force(texts(edge))
    assert kept.columns[: len(edge.columns)] == edge.columns


def test_documents(spark, documents):
    assert tally(op1_line_dedup(spark, SF_DIR)) == brute_force(texts(documents))


def test_empty_table(spark, empty):
    lines = index(spark)
    lines.insert(empty)
    assert lines.kept(empty).count() == 0


def test_batches_and_deletions_lead_to_the_decisions_of_the_documents_left(spark, documents):
    first, second = documents.filter("doc_id % 2 = 0"), documents.filter("doc_id % 2 = 1")
    lines = index(spark)
    lines.insert(second)
    lines.insert(first)
    assert digests(lines.kept(documents)) == brute_force(texts(documents))
    gone = documents.filter("doc_id % 3 = 0")
    lines.delete(gone)
    left = documents.filter("doc_id % 3 <> 0")
    reopened = LineIndex(spark, lines.path).open()
    assert digests(reopened.kept(left)) == brute_force(texts(left))
    reopened.insert(gone)
    assert digests(reopened.kept(documents)) == brute_force(texts(documents))


def test_filters_hold_just_the_keys_with_references(spark, documents):
    lines = index(spark)
    lines.insert(documents)
    lines.delete(documents.filter("doc_id >= 100"))
    counts = lines.counts()
    live = lines._lookup(counts.filter("refs > 0"))
    assert live.filter("NOT known").count() == 0
    dead = lines._lookup(counts.filter("refs = 0"))
    assert dead.filter("known").count() <= 0.01 * dead.count() + 2


def test_a_deletion_takes_out_no_other_key_of_the_same_fingerprint(spark):
    lines = index(spark)
    said = [f"line number {i} of many" for i in range(6000)]
    rows = spark.createDataFrame([(x, digest(x.encode())) for x in said], "line string, key binary")
    rows = lines._hashed(rows).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(8)))
    held = {}
    for row in rows.orderBy("line").collect():
        mark = int(_hashes(np.array([row.hash], np.int64))[1][0])
        held.setdefault((row.shard, mark), []).append(row.line)
    one, twin = next(x for x in held.values() if len(x) > 1)[:2]
    docs = [(1, one), (2, "\n".join(x for x in said if x not in (one, twin))), (3, twin), (4, one), (5, one)]
    frame = lambda *ids: spark.createDataFrame([docs[i - 1] for i in ids], "doc_id long, text string")
    lines.insert(frame(1))  # a filter of eight places, which the second batch outgrows
    lines.insert(frame(2, 3))
    lines.delete(frame(3))
    lines.insert(frame(4))
    assert lines._lookup(lines.counts().filter("refs > 0")).filter("NOT known").count() == 0
    assert lines._filters().groupBy("shard").count().filter("count > 1").count() == 0
    lines.delete(frame(1))
    lines.insert(frame(5))
    left = frame(2, 4, 5)
    assert digests(lines.kept(left)) == brute_force(texts(left))


def test_an_unfinished_batch_counts_for_nothing(spark, documents):
    lines = index(spark)
    lines.insert(documents.filter("doc_id < 100"))
    before = digests(lines.kept(documents.filter("doc_id < 100")))
    documents.selectExpr("doc_id", "0 AS shard", "CAST('x' AS binary) AS key").write.parquet(
        f"{lines.path}/postings/batch=1"
    )
    again = LineIndex(spark, lines.path).open()
    assert digests(again.kept(documents.filter("doc_id < 100"))) == before


@pytest.mark.parametrize("n", [0, 1, 7, 5000, 60_000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**62), 2**62, n))
    one = CuckooFilter.for_keys(len(keys))
    assert one.insert(keys)
    assert one.contains(keys).all()
    others = rng.integers(2**62, 2**63 - 1, 20_000)
    assert one.contains(others).mean() < 0.01
    again = CuckooFilter.from_bytes(one.to_bytes())
    for gone in keys[: n // 2][:500]:
        assert again.remove(int(gone))
    left = keys[min(n // 2, 500) :]
    assert again.contains(left).all()


def test_a_full_filter_is_left_as_it_was():
    small = CuckooFilter(np.zeros((2, 4), np.uint16))
    assert not small.insert(np.arange(100))
    assert not small.slots.any()
