"""Unreadable lines: kept whole, repaired, and in again once."""

import pytest
from pyspark.sql import functions as F

from brooklet.operators.contract import accepted, check
from brooklet.sources import read_events_csv, read_events_stream, read_events_table
from brooklet.sources.landing import BLOCK, FILE, RAW
from brooklet.streaming import Ingest, TableSink, stream_session
from brooklet.streaming.repair import ROW_ID, cells, open_rows, quarantined, release
from dirty import EXTRA, SHORT, dirty_lines, line, valid_lines, write_csv

ODD = line("odd", {"price": "n/a"})


def test_lines_that_do_not_fit_are_kept_whole(spark, tmp_path):
    path = write_csv(tmp_path / "in" / "a.csv", [ODD, SHORT[1], EXTRA[1], *valid_lines(["fine"])])
    rows = {r.event_id: r for r in read_events_csv(spark, path, raw=True).collect()}
    assert {i: r[RAW] for i, r in rows.items()} == {"odd": ODD, SHORT[0]: SHORT[1], EXTRA[0]: EXTRA[1], "fine": None}
    assert all(r[FILE].endswith("a.csv") and r[BLOCK] == 0 for r in rows.values())


def test_the_same_rows_are_accepted_with_and_without_lines(spark, tmp_path):
    path = write_csv(tmp_path / "in" / "a.csv", dirty_lines())
    now = F.lit("2024-01-02").cast("timestamp")
    plain, whole = (accepted(check(read_events_csv(spark, path, raw=raw), now)) for raw in (False, True))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, whole.collect()))


class Job:
    def __init__(self, spark, folder, dedupe="sink"):
        self.spark, self.folder, self.dedupe = spark, folder, dedupe
        self.landing, self.table, self.bad, self.ledger = (str(folder / n) for n in ("in", "table", "bad", "ledger"))

    def go(self):
        unique = "none" if self.dedupe == "state" else "table"
        source = read_events_stream(self.spark, self.landing, raw=True)
        job = Ingest([TableSink(self.table, unique)], quarantine=self.bad, dedupe=self.dedupe)
        job.start(source, str(self.folder / "ck"), None).awaitTermination()

    def release(self, fix):
        return release(self.spark, self.bad, self.ledger, self.landing, fix)

    def stored(self):
        return {r.event_id: float(r.price) for r in read_events_table(self.spark, self.table).collect()}

    def open(self):
        return sorted(r.event_id for r in open_rows(self.spark, self.bad, self.ledger).collect())


def with_price(rows):
    """Prices that came as text are 5."""
    return rows.filter(cells()["price"] == "n/a").withColumn("price", F.lit(5.0))


@pytest.mark.parametrize("dedupe", ["sink", "state"])
def test_repaired_rows_go_in_again_once(spark, tmp_path, dedupe):
    job = Job(stream_session(spark), tmp_path, dedupe)
    write_csv(tmp_path / "in" / "a.csv", [ODD, ODD, SHORT[1], line("free", {"price": "0"}), *valid_lines(["fine"])])
    job.go()
    assert job.open() == sorted([SHORT[0], "free", "odd"])
    assert quarantined(spark, job.bad).filter("event_id = 'odd'").first()[RAW] == ODD
    assert job.release(with_price) == 1
    job.go()
    assert job.stored() == {"fine": 9.99, "odd": 5.0}
    assert job.release(with_price) == 0  # nothing is open that it could repair
    job.go()
    assert job.stored() == {"fine": 9.99, "odd": 5.0}
    assert job.open() == sorted([SHORT[0], "free"])


def test_a_release_that_died_before_its_ledger(spark, tmp_path):
    job = Job(spark, tmp_path)
    write_csv(tmp_path / "in" / "a.csv", [ODD])
    job.go()
    job.release(with_price)
    job.ledger = str(tmp_path / "empty")  # as if it had not been written
    assert job.release(with_price) == 1
    job.go()
    assert read_events_table(spark, job.table).count() == 1


def test_a_repair_that_repairs_nothing_changes_nothing(spark, tmp_path):
    job = Job(spark, tmp_path)
    write_csv(tmp_path / "in" / "a.csv", [line("free", {"price": "0"})])
    job.go()
    assert job.release(lambda rows: rows) == 0
    assert job.open() == ["free"]
    assert len({r[ROW_ID] for r in quarantined(spark, job.bad).collect()}) == 1
