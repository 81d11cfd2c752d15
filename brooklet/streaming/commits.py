"""One commit for all sinks of a stream.

The sinks of a batch are written one after the other. A record of the batch, written after
the last of them, says that it is in all of them; readers that go by the records see the
batch in every sink or in none. A stream finishes a batch before the next one begins, so
the last record of a stream stands for all before it, and older ones are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.operators.layout import delete_folders
from brooklet.sources.table import read_folder, read_stored
from brooklet.streaming.batches import stream_id, write_batch

COMMIT_DDL = "committed_at timestamp, stream string, batch_id bigint"
#: Records of a stream that are kept, for readers that have listed them.
KEPT = 64


def commit(spark: SparkSession, path: str, batch_id: int, writer: str | None = None) -> None:
    write_batch(spark.range(1).select(F.current_timestamp().alias("committed_at")), path, batch_id, writer=writer)
    if batch_id % KEPT == 0:
        old = lambda name: name.startswith("batch_id=") and int(name[9:]) <= batch_id - KEPT
        delete_folders(spark, f"{path}/stream={stream_id(spark, writer)}", old)


def last_committed(spark: SparkSession, path: str) -> dict[str, int]:
    """The last committed batch of each stream."""
    records = read_folder(spark, path, COMMIT_DDL)
    if records is None:
        return {}
    return dict(records.groupBy("stream").agg(F.max("batch_id")).collect())


def is_committed(last: dict[str, int]) -> Column:
    """Whether a stored row's batch is; over partition columns, so that other folders are skipped."""
    known = F.lit(False)
    for stream, batch in sorted(last.items()):
        known = known | ((F.col("stream") == stream) & (F.col("batch_id") <= batch))
    return known


def read_committed(spark: SparkSession, tables: dict[str, str], commits: str) -> dict[str, DataFrame]:
    """Rows of several tables, by name, as of one moment: the batches that all of them hold.

    The records are read first and once, so the tables agree whatever is written meanwhile.
    """
    last = last_committed(spark, commits)
    found = {name: read_stored(spark, path) for name, path in tables.items()}
    return {name: rows.filter(is_committed(last)) for name, rows in found.items() if rows is not None}
