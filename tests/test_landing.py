from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brooklet.operators.analytics import file_type_counts
from brooklet.plans.inputs import damaged_events, user_events
from brooklet.sources import landing_files, read_events_csv, read_events_stream, write_landing
from dirty import HEADER, VALID, valid_lines, write_csv

SF = "/root/testdata/sf0.001"


def data_files(folder):
    return sorted(p for p in Path(folder).rglob("*.csv") if not p.name.startswith(("_", ".")))


def test_files_hold_one_session_each(spark, tmp_path):
    write_landing(user_events(spark, SF), str(tmp_path / "landing"), by_session=True)
    files = data_files(tmp_path)
    assert len(files) == 50
    for file in files:
        header, *rows = file.read_text().splitlines()
        assert header == HEADER
        assert len(rows) == 20
        assert len({row.split(",")[2] for row in rows}) == 1


def test_round_trip_keeps_every_cell(spark, tmp_path):
    events = damaged_events(spark, SF)
    write_landing(events, str(tmp_path / "landing"), 300)
    back = read_events_csv(spark, str(tmp_path / "landing"))
    def shown(rows):
        return sorted(map(repr, rows.collect()))
    assert shown(back) == shown(events)


def test_columns_bind_by_position(spark, tmp_path):
    names = HEADER.split(",")
    swapped = [names[1], names[0], *names[2:]]
    row = {**VALID, "event_id": "e1", "user_id": "7"}
    folder = write_csv(tmp_path / "in" / "a.csv", [",".join(row[n] for n in swapped)], ",".join(swapped))
    bound = read_events_csv(spark, folder).first()
    assert bound.event_id == "7" and bound.user_id is None
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_events_csv(spark, folder, strict_header=True).collect()


def test_counts_per_file(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", valid_lines(["a1", "a2"]))
    folder = write_csv(tmp_path / "in" / "b.csv", valid_lines(["b1"], event_type="purchase"))
    counts = file_type_counts(landing_files(read_events_csv(spark, folder)))
    assert {tuple(r) for r in counts.collect()} == {("a.csv", 2, 0), ("b.csv", 0, 1)}


def drain(source, checkpoint, seen):
    def note(batch, batch_id):
        seen.append((batch_id, batch.select(F.input_file_name()).distinct().count(), batch.count()))
    query = (
        source.writeStream.foreachBatch(note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def test_admission_limit(spark, tmp_path):
    for i in range(12):
        folder = write_csv(tmp_path / "in" / f"f{i}.csv", valid_lines([f"e{i}"]))
    seen = []
    drain(read_events_stream(spark, folder), str(tmp_path / "ck"), seen)
    assert [files for _, files, _ in seen] == [5, 5, 2]


def test_byte_limit(spark, tmp_path):
    for i in range(4):
        folder = write_csv(tmp_path / "in" / f"f{i}.csv", valid_lines([f"e{i}"]))
    size = (tmp_path / "in" / "f0.csv").stat().st_size
    seen = []
    drain(read_events_stream(spark, folder, max_bytes=2 * size), str(tmp_path / "ck"), seen)
    assert [files for _, files, _ in seen] == [2, 2]


def test_consumed_files_are_archived(spark, tmp_path):
    archive = tmp_path / "archive"
    archive.mkdir()
    for i in range(3):
        folder = write_csv(tmp_path / "in" / f"f{i}.csv", valid_lines([f"e{i}"]))
    seen = []
    for extra in ("g0", "g1"):
        drain(
            read_events_stream(spark, folder, max_files=1, archive_dir=str(archive)),
            str(tmp_path / "ck"),
            seen,
        )
        write_csv(tmp_path / "in" / f"{extra}.csv", valid_lines([extra]))
    assert sum(rows for *_, rows in seen) == 4  # each file once, archived or not
    assert data_files(archive)  # archiving lags, so only some are there yet
