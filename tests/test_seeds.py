"""Keys in a stream's state, over several checkpoints, crashes and clocks."""

import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from brooklet.operators.contract import REASONS, check
from brooklet.operators.layout import roll_up
from brooklet.sources import read_events_stream, read_stored
from brooklet.streaming import Ingest, TableSink, stream_session
from brooklet.streaming.ingest import _first_seen
from brooklet.streaming.seeds import checkpoint_id, foreign_batches
from dirty import line, valid_lines, write_csv


class Streams:
    """Streams with checkpoints and landing folders of their own on one table."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.table = stream_session(spark, 3), folder, str(folder / "table")

    def land(self, stream, name, lines):
        write_csv(self.folder / f"in-{stream}" / f"{name}.csv", lines)
        time.sleep(0.02)

    def go(self, stream, sinks=None, **options):
        sinks = sinks or [TableSink(self.table, "none")]
        job = Ingest(sinks, quarantine=str(self.folder / "bad"), dedupe="state", **options)
        source = read_events_stream(self.spark, str(self.folder / f"in-{stream}"), max_files=1)
        job.start(source, self.checkpoint(stream), None).awaitTermination()
        return job

    def checkpoint(self, stream):
        return str(self.folder / f"ck-{stream}")

    def stored(self):
        """Key, stream and batch of every row."""
        names = {checkpoint_id(self.spark, self.checkpoint(s)): s for s in "ABC"}
        rows = read_stored(self.spark, self.table).collect()
        return sorted((r.event_id, names[r.stream], r.batch_id) for r in rows)


@pytest.fixture
def streams(spark, tmp_path):
    return Streams(spark, tmp_path)


def test_a_new_checkpoint_knows_the_stored_keys(streams):
    streams.land("A", "1", valid_lines(["a", "b"]))
    streams.land("A", "2", valid_lines(["b", "c"]))
    streams.go("A")
    streams.land("B", "1", valid_lines(["c", "a", "d"]))
    streams.go("B")
    streams.land("B", "2", valid_lines(["a", "d", "e"]))
    streams.go("B")
    assert streams.stored() == [("a", "A", 0), ("b", "A", 0), ("c", "A", 1), ("d", "B", 0), ("e", "B", 1)]


def test_an_old_checkpoint_learns_what_others_stored_since(streams):
    streams.land("A", "1", valid_lines(["a"]))
    streams.go("A")
    streams.land("B", "1", valid_lines(["a", "b"]))
    streams.go("B")
    streams.land("A", "2", valid_lines(["b", "c"]))
    streams.go("A")
    streams.land("B", "2", valid_lines(["c", "a", "d"]))
    streams.go("B")
    assert streams.stored() == [("a", "A", 0), ("b", "B", 0), ("c", "A", 1), ("d", "B", 1)]


def test_seeds_from_a_table_rolled_up(streams, spark):
    for name in "123":
        streams.land("A", name, valid_lines([name, "x"]))
    streams.go("A")
    roll_up(spark, streams.table)
    streams.land("B", "1", valid_lines(["1", "2", "3", "x", "y"]))
    streams.go("B")
    assert [key for key, *_ in streams.stored()] == ["1", "2", "3", "x", "y"]


class Lost:
    """Fails once, after or before its sink has written."""

    def __init__(self, sink, after):
        self.sink, self.after, self.failed = sink, after, False

    def __call__(self, rows, batch_id):
        if self.after or self.failed:
            self.sink(rows, batch_id)
        if not self.failed:
            self.failed = True
            raise RuntimeError("lost")


@pytest.mark.parametrize("after", [True, False])
def test_a_batch_replayed_after_another_stream_stored_its_keys(streams, after):
    streams.land("A", "0", valid_lines(["z"]))
    streams.go("A")
    streams.land("A", "1", valid_lines(["a", "b"]) + [line("c", {"price": "0"})])
    sink = Lost(TableSink(streams.table, "none"), after)
    with pytest.raises(StreamingQueryException):
        streams.go("A", [sink])
    streams.land("B", "1", valid_lines(["b", "d"]))
    streams.go("B")
    streams.go("A", [sink])
    streams.land("A", "2", valid_lines(["b", "d", "e"]))
    streams.go("A")
    keys = [key for key, *_ in streams.stored()]
    assert keys == sorted(set(keys)) == ["a", "b", "d", "e", "z"]


def test_without_seeds_a_table_of_others_is_refused(streams):
    streams.land("A", "1", valid_lines(["a"]))
    streams.go("A", seeded=False)
    streams.land("A", "2", valid_lines(["b"]))
    streams.go("A", seeded=False)  # its own batches are in its state
    streams.land("B", "1", valid_lines(["a"]))
    with pytest.raises(ValueError, match="other streams"):
        streams.go("B", seeded=False)
    assert len(streams.stored()) == 2


def test_marks_are_written_once_for_what_is_known(streams, spark):
    streams.land("A", "1", valid_lines(["a"]))
    streams.go("A")
    for name in "12":
        streams.land("B", name, valid_lines(["a", name]))
        streams.go("B")
    marks = spark.read.parquet(f"{streams.checkpoint('B')}/seeds/marks").collect()
    assert [(m.last_batch, m.start) for m in marks] == [(0, 0)]
    assert set(foreign_batches(spark, [streams.table], None).values()) == {0, 1}


@pytest.mark.parametrize("stamps", [("900", "500", "700"), ("500", "700", "900")])
def test_a_clock_set_back_brings_no_copy_again(spark, tmp_path, stamps):
    """Stamps of batches may come in any order; later copies with earlier event times do not count."""
    session = stream_session(spark, 2)
    seen = []
    for run, stamp in enumerate(stamps):
        moment = f"2024-01-01 00:00:0{9 - run}"
        write_csv(tmp_path / "in" / f"{run}.csv", [line(k, {"timestamp": moment}) for k in ("a", "b", f"new{run}")])
        source = read_events_stream(session, str(tmp_path / "in"))
        good = check(source).filter(F.col(REASONS) == "")
        query = (
            _first_seen(good, None, F.lit(stamp))
            .writeStream.outputMode("update")
            .foreachBatch(lambda rows, _, run=run: seen.extend((r.event_id, run) for r in rows.collect()))
            .option("checkpointLocation", str(tmp_path / "ck"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    assert sorted(seen) == [("a", 0), ("b", 0), ("new0", 0), ("new1", 1), ("new2", 2)]
