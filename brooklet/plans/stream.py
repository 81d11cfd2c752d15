"""Streaming queries by name, run over landing files until none is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.operators.clean import clean
from brooklet.plans.batch import LANDING_ROWS, Query
from brooklet.plans.inputs import damaged_events, scratch, user_events
from brooklet.schema import KEY, MONEY_COLUMNS, SOURCE_COLUMNS
from brooklet.sources import read_events_stream, read_events_table, read_stored, write_landing
from brooklet.sources.landing import RAW
from brooklet.streaming import (
    Ingest,
    TableSink,
    dedupe_stream,
    latest_result,
    live_events_per_minute,
    overwrite_sink,
    read_metrics,
    stream_session,
)
from brooklet.streaming.commits import read_committed
from brooklet.streaming.late import MARK_DDL, LateGate, closed_windows
from brooklet.streaming.repair import cells, open_rows, release
from brooklet.streaming.seeds import checkpoint_id

BATCH_BYTES = 64 << 30


def _landing(spark: SparkSession, *batches: DataFrame) -> str:
    path = scratch(spark, "landing")
    for batch in batches:
        write_landing(batch, path, LANDING_ROWS)
    return path


def _source(spark: SparkSession, path: str) -> DataFrame:
    return read_events_stream(spark, path, max_bytes=BATCH_BYTES)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged landing files through the ingest stream into the event table."""
    session = stream_session(spark)
    source = _source(session, _landing(spark, damaged_events(spark, sf_dir)))
    path = scratch(spark, "table")
    ingest = Ingest([TableSink(path)], quarantine=scratch(spark, "quarantine"))
    ingest.start(source, scratch(spark, "checkpoint"), None).awaitTermination()
    amounts = {name: F.col(name).cast("double") for name in MONEY_COLUMNS}
    return read_events_table(spark, path).withColumns(amounts).drop("ingested_at")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the ingest stream set aside, one per reason."""
    session = stream_session(spark)
    source = _source(session, _landing(spark, damaged_events(spark, sf_dir)))
    path = scratch(spark, "quarantine")
    ingest = Ingest([TableSink(scratch(spark, "table"), unique="batch")], quarantine=path)
    ingest.start(source, scratch(spark, "checkpoint"), None).awaitTermination()
    return spark.read.parquet(path).select(KEY, F.explode("reasons").alias("reason"))


def stream_events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = stream_session(spark)
    source = _source(session, _landing(spark, user_events(spark, sf_dir)))
    path = scratch(spark, "minutes")
    (
        live_events_per_minute(clean(source))
        .writeStream.outputMode("complete")
        .foreachBatch(overwrite_sink(path))
        .option("checkpointLocation", scratch(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return latest_result(spark.read.parquet(path))


LATENESS = "10 minutes"


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The events, and the condition of being in the earlier half of their time."""
    events = user_events(spark, sf_dir)
    moment = F.unix_seconds(F.to_timestamp("timestamp"))
    middle = events.agg(F.floor((F.min(moment) + F.max(moment)) / 2)).first()[0] or 0
    return events, f"unix_seconds(to_timestamp(`timestamp`)) < {middle}"


def _run(stream: DataFrame, checkpoint: str, path: str) -> None:
    (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
        .awaitTermination()
    )


def _in_turn(spark: SparkSession, slices: list[DataFrame], plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``plan`` appends when the slices land one after the other, a run for each."""
    session, landing = stream_session(spark), scratch(spark, "landing")
    checkpoint, path = scratch(spark, "checkpoint"), scratch(spark, "kept")
    for rows in slices:
        write_landing(rows, landing, LANDING_ROWS)
        _run(plan(_source(session, landing)), checkpoint, path)
    return spark.read.parquet(path)


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of their time, then all of them once more; state of ten minutes.

    Copies older than that are late, the others meet their key in the state.
    """
    events, early = _halves(spark, sf_dir)
    slices = [events.filter(early), events.filter(f"NOT ({early})"), events]
    return _in_turn(
        spark, slices, lambda source: dedupe_stream(clean(source), LATENESS).select(KEY, "event_timestamp")
    )


def stream_minutes_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed minutes; of the earlier half every fiftieth event arrives last, and is too late."""
    events, early = _halves(spark, sf_dir)
    late = f"({early}) AND CAST(event_id AS bigint) % 50 = 0"
    slices = [events.filter(f"({early}) AND NOT ({late})"), events.filter(f"NOT ({early})"), events.filter(late)]
    return _in_turn(spark, slices, lambda source: live_events_per_minute(clean(source), LATENESS))


RUNS = 4


class _LostOnce:
    """A sink that fails once after it has written batch 2, as a crash before the commit would."""

    def __init__(self, sink: TableSink) -> None:
        self.sink, self.failed = sink, False

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        self.sink(rows, batch_id)
        if batch_id == 2 and not self.failed:
            self.failed = True
            raise RuntimeError("lost after the write")


def _runs(spark: SparkSession, sf_dir: str, unique: str = "table") -> dict[str, str]:
    """Four runs on one checkpoint over landing files that arrive in between.

    Each brings a fourth of the damaged events and those of the run before again. The
    third fails after its write and is replayed. Folders of two tables, quarantine, metrics.
    """
    session = stream_session(spark)
    landing, checkpoint = scratch(spark, "landing"), scratch(spark, "checkpoint")
    folders = {name: scratch(spark, name) for name in ("table", "second", "quarantine", "metrics")}
    mode = {"state": "none"}.get(unique, unique)
    last = _LostOnce(TableSink(folders["second"], mode))
    job = Ingest(
        [TableSink(folders["table"], mode), last],
        quarantine=folders["quarantine"],
        metrics=folders["metrics"],
        dedupe="state" if unique == "state" else "sink",
    )
    for run in range(RUNS):
        number = f"CAST(event_id AS bigint) % {RUNS}"
        write_landing(damaged_events(spark, sf_dir, f"{number} IN ({run}, {run - 1})"), landing, LANDING_ROWS)
        source = read_events_stream(session, landing, max_files=None)
        try:
            job.start(source, checkpoint, None).awaitTermination()
        except StreamingQueryException:
            job.start(source, checkpoint, None).awaitTermination()
    return folders


def _stored_by_runs(unique: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folders = _runs(spark, sf_dir, unique)
        tables = [read_stored(spark, folders[name]).withColumn("sink", F.lit(name)) for name in ("table", "second")]
        amounts = {name: F.col(name).cast("double") for name in MONEY_COLUMNS}
        rows = tables[0].unionByName(tables[1]).withColumns(amounts)
        return rows.drop("ingested_at", "stream", "event_date")

    return query


def stream_runs_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(_runs(spark, sf_dir)["quarantine"])
    return rows.select(KEY, F.explode("reasons").alias("reason"), F.col("batch_id").cast("bigint").alias("batch_id"))


def stream_runs_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_metrics(spark, _runs(spark, sf_dir)["metrics"])
    return rows.select("batch_id", "accepted", "rejected", "total")


# (checkpoint, remainders of the event number that land before its run)
TWO_CHECKPOINTS = (("A", (0,)), ("B", (0, 1)), ("A", (1, 2)))


def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with keys in their state take turns on one table; some events reach both."""
    session = stream_session(spark)
    folders = {name: {part: scratch(spark, part) for part in ("landing", "checkpoint")} for name in "AB"}
    table, quarantine = scratch(spark, "table"), scratch(spark, "quarantine")
    for name, wanted in TWO_CHECKPOINTS:
        rows = damaged_events(spark, sf_dir, f"CAST(event_id AS bigint) % 3 IN ({', '.join(map(str, wanted))})")
        write_landing(rows, folders[name]["landing"], LANDING_ROWS)
        job = Ingest([TableSink(table, "none")], quarantine=quarantine, dedupe="state")
        source = read_events_stream(session, folders[name]["landing"], max_files=None)
        job.start(source, folders[name]["checkpoint"], None).awaitTermination()
    stored = read_stored(spark, table)
    first = F.col("stream") == checkpoint_id(spark, folders["A"]["checkpoint"])
    amounts = {name: F.col(name).cast("double") for name in MONEY_COLUMNS}
    rows = stored.withColumn("checkpoint", F.when(first, "A").otherwise("B")).withColumns(amounts)
    return rows.drop("ingested_at", "stream", "event_date")


class _LostBefore:
    """A sink that is lost before it writes batch 2."""

    def __init__(self, sink: TableSink) -> None:
        self.sink = sink

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if batch_id == 2:
            raise RuntimeError("lost before the write")
        self.sink(rows, batch_id)


def stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs into two tables, the last of which dies between them; both as their readers see them."""
    session = stream_session(spark)
    landing, checkpoint = scratch(spark, "landing"), scratch(spark, "checkpoint")
    tables = {name: scratch(spark, name) for name in ("table", "second")}
    commits = scratch(spark, "commits")
    sinks = [TableSink(tables["table"]), _LostBefore(TableSink(tables["second"]))]
    job = Ingest(sinks, quarantine=scratch(spark, "quarantine"), commits=commits)
    for run in range(3):
        rows = damaged_events(spark, sf_dir, f"CAST(event_id AS bigint) % 3 = {run}")
        write_landing(rows, landing, LANDING_ROWS)
        query = job.start(read_events_stream(session, landing, max_files=None), checkpoint, None)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if run < 2:
                raise
    seen = read_committed(spark, tables, commits)
    rows = [seen[name].withColumn("sink", F.lit(name)) for name in ("table", "second")]
    return rows[0].unionByName(rows[1]).select(KEY, "batch_id", "sink")


def _late_runs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The slices of ``stream_minutes_append`` through a gate for late rows."""
    events, early = _halves(spark, sf_dir)
    late = f"({early}) AND CAST(event_id AS bigint) % 50 = 0"
    slices = [events.filter(f"({early}) AND NOT ({late})"), events.filter(f"NOT ({early})"), events.filter(late)]
    session, landing, checkpoint = stream_session(spark), scratch(spark, "landing"), scratch(spark, "checkpoint")
    folders = {name: scratch(spark, name) for name in ("table", "late", "marks")}
    gate = LateGate(TableSink(folders["table"]), folders["late"], folders["marks"], LATENESS)
    job = Ingest([gate], quarantine=scratch(spark, "quarantine"))
    for rows in slices:
        write_landing(rows, landing, LANDING_ROWS)
        source = read_events_stream(session, landing, max_files=None)
        job.start(source, checkpoint, None).awaitTermination()
    return folders


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event that arrived, in the table or set aside."""
    folders = _late_runs(spark, sf_dir)
    kept = read_events_table(spark, folders["table"]).select(KEY, "event_timestamp", F.lit(False).alias("late"))
    aside = spark.read.parquet(folders["late"]).select(KEY, "event_timestamp", F.lit(True).alias("late"))
    return kept.unionByName(aside)


def stream_minutes_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed minutes of the rows on time."""
    folders = _late_runs(spark, sf_dir)
    kept = read_events_table(spark, folders["table"])
    return closed_windows(kept, spark.read.schema(MARK_DDL).parquet(folders["marks"]), LATENESS)


def _write_lines(rows: DataFrame, landing: str, *columns: str) -> None:
    """Landing files of these columns, whatever the landing schema says."""
    rows.select(*columns).write.mode("append").option("header", True).csv(landing)


def stream_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable prices and short lines: into the quarantine, the former repaired and in again.

    Events whose number leaves 1 have no number for a price, those that leave 2 lack the
    last cell, those that leave 3 have a cell too many (modulo 7). The repair works the
    price out, and is run twice.
    """
    session = stream_session(spark)
    landing, checkpoint = scratch(spark, "landing"), scratch(spark, "checkpoint")
    table, quarantine, ledger = (scratch(spark, name) for name in ("table", "quarantine", "ledger"))
    rows = user_events(spark, sf_dir).withColumns(
        {"kind": F.col(KEY).cast("bigint") % 7, "surplus": F.lit("x")}
    )
    price = F.when(F.col("kind") == 1, "n/a").otherwise(F.col("price").cast("string"))
    whole = rows.withColumn("price", price)
    _write_lines(whole.filter("kind NOT IN (2, 3)"), landing, *SOURCE_COLUMNS)
    _write_lines(whole.filter("kind = 2"), landing, *SOURCE_COLUMNS[:-1])
    _write_lines(whole.filter("kind = 3"), landing, *SOURCE_COLUMNS, "surplus")
    job = Ingest([TableSink(table)], quarantine=quarantine)

    def go() -> None:
        source = read_events_stream(session, landing, max_files=None, raw=True)
        job.start(source, checkpoint, None).awaitTermination()

    def fix(rows: DataFrame) -> DataFrame:
        unread = rows.filter(F.col(RAW).isNotNull() & (cells()["price"] == "n/a"))
        return unread.withColumn("price", F.round(F.col("total_amount") / F.col("quantity"), 2))

    go()
    for _ in range(2):
        release(spark, quarantine, ledger, landing, fix)
        go()
    stored = read_events_table(spark, table).select(KEY, F.col("price").cast("double").alias("price"), F.lit("stored").alias("place"))
    left = open_rows(spark, quarantine, ledger).select(KEY, "price", F.lit("open").alias("place"))
    return stored.unionByName(left)


QUERIES: dict[str, Query] = {
    "stream_ingest": stream_ingest,
    "stream_quarantine": stream_quarantine,
    "stream_events_per_minute": stream_events_per_minute,
    "stream_minutes_append": stream_minutes_append,
    "stream_dedupe": stream_dedupe,
    "stream_runs": _stored_by_runs("table"),
    "stream_runs_day": _stored_by_runs("day"),
    "stream_runs_state": _stored_by_runs("state"),
    "stream_runs_quarantine": stream_runs_quarantine,
    "stream_runs_metrics": stream_runs_metrics,
    "stream_two_checkpoints": stream_two_checkpoints,
    "stream_committed": stream_committed,
    "stream_late_rows": stream_late_rows,
    "stream_minutes_gated": stream_minutes_gated,
    "stream_repaired": stream_repaired,
}
