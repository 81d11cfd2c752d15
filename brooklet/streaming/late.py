"""Rows that come too late are set aside, not lost.

Spark's own watermark drops late rows and only counts them. Here each batch records its
newest event time; the watermark of a batch is the newest of those before it, less the
lateness allowed, which is what Spark would use. Rows behind it go to a folder of their
own with the watermark they missed, the others to the sink. The records are those of the
batches, so a replay comes to the same decision, and a restart goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions import total_money
from brooklet.operators.layout import delete_folders
from brooklet.sources.table import read_folder
from brooklet.streaming.batches import stream_id, write_batch

MARK_DDL = "newest timestamp, stream string, batch_id bigint"
#: Records that are kept; each carries the newest time so far.
KEPT = 64
LATE = "late"


@dataclass(frozen=True)
class LateGate:
    """A sink in front of ``sink`` that keeps late rows out of it.

    ``late``: folder for late rows, with ``reasons`` and the ``watermark``, as a quarantine
    has them. ``marks``: folder for the records. ``lateness``: an interval, such as
    ``10 minutes``. Rows without an event time are never late.
    """

    sink: Callable[[DataFrame, int], None]
    late: str
    marks: str
    lateness: str = "10 minutes"
    writer: str | None = None

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = newest_before(spark, self.marks, stream_id(spark, self.writer), batch_id)
        newest = rows.agg(F.max("event_timestamp")).first()[0]
        on_time = rows
        if before is not None:
            watermark = F.lit(before) - F.expr(f"INTERVAL {self.lateness}")
            behind = F.coalesce(F.col("event_timestamp") < watermark, F.lit(False))
            aside = rows.filter(behind).withColumns({"reasons": F.array(F.lit(LATE)), "watermark": watermark})
            write_batch(aside.hint("rebalance"), self.late, batch_id, writer=self.writer)
            on_time = rows.filter(~behind)
        # A late row cannot be the newest one, so the marks only rise.
        mark = max((t for t in (before, newest) if t is not None), default=None)
        record = spark.createDataFrame([(mark,)], "newest timestamp")
        self.sink(on_time, batch_id)
        write_batch(record, self.marks, batch_id, writer=self.writer)
        if batch_id % KEPT == KEPT - 1:
            old = lambda name: name.startswith("batch_id=") and int(name[9:]) <= batch_id - KEPT
            delete_folders(spark, f"{self.marks}/stream={stream_id(spark, self.writer)}", old)


def newest_before(spark: SparkSession, marks: str, stream: str, batch_id: int) -> datetime | None:
    """The newest event time of a stream's batches before this one."""
    records = read_folder(spark, marks, MARK_DDL)
    if records is None:
        return None
    own = (F.col("stream") == stream) & (F.col("batch_id") < batch_id)
    return records.filter(own).agg(F.max("newest")).first()[0]


def closed_windows(kept: DataFrame, marks: DataFrame, lateness: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Events and purchase revenue of the windows that no row on time can change any more.

    ``kept``: the rows a ``LateGate`` let through; ``marks``: its records.
    """
    revenue = total_money(kept, "total_amount", F.col("event_type") == "purchase")
    windows = kept.groupBy(F.window("event_timestamp", width)).agg(F.count("*").alias("n"), revenue.alias("revenue"))
    watermark = marks.agg(F.max("newest") - F.expr(f"INTERVAL {lateness}")).scalar()
    closed = windows.filter(F.col("window.end") <= watermark)
    return closed.select(F.col("window.start").alias("event_minute"), "n", "revenue")
