"""The key index: exact against a plain set, whatever was merged, and flat in what it reads."""

import random

import pytest
from pyspark.sql import functions as F

from brooklet.operators.clean import clean
from brooklet.schema import KEY, SOURCE_DDL
from brooklet.sources import read_stored
from brooklet.sources.table import Manifest
from brooklet.streaming import TableSink, key_index
from brooklet.streaming.key_index import KeyIndex


def events(spark, ids):
    """Clean rows with these keys."""
    rows = [(str(i), 1, "s", "view", 1, "thing", "stuff", 9.99, 1, 9.99, "2024-01-01 00:00:00") for i in ids]
    return clean(spark.createDataFrame(rows, SOURCE_DDL))


def stored(spark, path):
    return sorted((r[KEY], r.batch_id) for r in read_stored(spark, path).collect())


@pytest.mark.parametrize(("looked_up", "bare"), [(2000, 2), (2000, -1), (3, 2)])
def test_first_batch_wins_through_all_levels(spark, tmp_path, monkeypatch, looked_up, bare):
    monkeypatch.setattr(key_index, "LOOKED_UP", looked_up)
    monkeypatch.setattr(key_index, "BARE_LEVELS", bare)
    monkeypatch.setattr("brooklet.operators.layout.FAN_IN", 3)
    path, rng, first = str(tmp_path / "table"), random.Random(looked_up), {}
    sink = TableSink(path, roll_up_every=2, writer="w")
    for batch in range(12):
        ids = [str(rng.randrange(60)) for _ in range(8)]
        sink(events(spark, ids), batch)
        for i in ids:
            first.setdefault(i, batch)
    assert stored(spark, path) == sorted(first.items())
    levels = dict(Manifest.of(spark, KeyIndex(path).path).segments).values()
    assert max(levels) >= 1


def test_replayed_and_other_streams(spark, tmp_path):
    path = str(tmp_path / "table")
    one, two = TableSink(path, writer="one"), TableSink(path, writer="two")
    one(events(spark, range(5)), 0)
    one(events(spark, range(3, 8)), 1)
    one(events(spark, range(3, 6)), 1)  # a replay with other rows replaces the batch and its run
    two(events(spark, range(4, 10)), 0)
    assert stored(spark, path) == sorted([(str(i), 0) for i in range(5)] + [("5", 1)] + [(str(i), 0) for i in (6, 7, 8, 9)])


def test_a_table_without_an_index(spark, tmp_path):
    path = str(tmp_path / "table")
    plain = TableSink(path, "batch", roll_up_every=2, writer="old")
    for batch in range(5):
        plain(events(spark, [batch]), batch)
    TableSink(path, writer="new")(events(spark, range(8)), 0)
    assert [i for i, b in stored(spark, path)] == [str(i) for i in range(8)]


def test_a_stream_that_ended_before_its_last_run_was_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    TableSink(path, writer="one")(events(spark, [1]), 0)
    with monkeypatch.context() as broken:
        broken.setattr(KeyIndex, "add", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            TableSink(path, writer="one")(events(spark, [2]), 1)
    TableSink(path, writer="two")(events(spark, [1, 2, 3]), 0)
    assert sorted(stored(spark, path)) == [("1", 0), ("2", 1), ("3", 0)]


def test_a_run_that_was_not_written_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    TableSink(path, writer="one")(events(spark, [1, 2]), 0)
    KeyIndex(path).add(events(spark, [1]), 0, "one")  # as if a task's file were missing
    TableSink(path, writer="two")(events(spark, [1, 2, 3]), 0)
    assert stored(spark, path) == [("1", 0), ("2", 0), ("3", 0)]


def bytes_read(spark):
    """Of files, by this JVM. Ranges read side by side are not counted, so they are off."""
    spark._jsc.hadoopConfiguration().setBoolean("parquet.hadoop.vectored.io.enabled", False)
    kinds = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(kinds.get(i).getBytesRead() for i in range(kinds.size()))


def test_a_lookup_reads_little_of_a_large_index(spark, tmp_path):
    path = str(tmp_path / "table")
    index = KeyIndex(path)
    keys = spark.range(0, 4_000_000).select(F.concat(F.lit("key-"), F.col("id").cast("string")).alias(KEY))
    index.add(keys.filter("hash(event_id) % 2 = 0"), 0, "w")
    index.add(keys.filter("hash(event_id) % 2 <> 0"), 1, "w")
    index.add(keys.limit(1), 2, "w")
    index.roll_up(spark)
    bytes_read(spark)
    wanted = keys.filter("event_id IN ('key-17', 'key-3999999')").unionByName(spark.createDataFrame([("none",)], f"{KEY} string"))
    before = bytes_read(spark)
    assert sorted(index.stored(wanted, 9, "w")) == ["key-17", "key-3999999"]
    looked_up = bytes_read(spark) - before
    before = bytes_read(spark)
    assert spark.read.parquet(f"{index.path}/_rolled/segment-*").select(F.max(KEY), F.max("hash")).first()
    assert looked_up < (bytes_read(spark) - before) / 10
