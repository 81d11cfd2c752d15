"""Read-optimised copy of the ingest table, and its batches rolled up in place."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.schema import STORED_DDL, TARGET_COLUMNS
from brooklet.sources.table import Manifest, write_settings

# Rows of a day are ordered so that row-group statistics serve the usual filters.
SORT = ("event_date", "event_type", "category", "user_id")


def compact(
    stored: DataFrame, path: str, since_batch: int | None = None, stream: str | None = None
) -> None:
    """Rewrite the days of ``stored`` (ingest table rows) as partitions of ``path``.

    Only days that got rows in batch ``since_batch`` or later (of ``stream``, or
    of any) are rewritten when it is given; their partitions are replaced whole, so a repeated run changes
    nothing. The rebalance hint merges the small files of a quiet day and splits
    a day that holds a large share of the rows, at
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` a piece.
    Assumes one compaction at a time per target.
    """
    rows = stored
    if since_batch is not None:
        # The calendar bounds the distinct days; broadcast, they prune the scan.
        new = stored.filter(F.col("batch_id") >= since_batch)
        if stream is not None:
            new = new.filter(F.col("stream") == stream)
        days = new.select("event_date").distinct()
        rows = stored.join(F.broadcast(days), "event_date", "left_semi")
    packed = rows.select(*TARGET_COLUMNS, "event_date").hint("rebalance", F.col("event_date"))
    with write_settings(stored.sparkSession):
        (
            packed.sortWithinPartitions(*SORT)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date")
            .parquet(path)
        )


#: Segments of a level that are merged into one of the next.
FAN_IN = 8
#: Versions of a manifest that are kept.
VERSIONS = 16


@dataclass(frozen=True)
class Layer:
    """How the rows of a folder of batches are laid out in its segments.

    ``arrange``: rows and the level of their segment to rows dealt and sorted for writing.
    """

    ddl: str
    partition: tuple[str, ...]
    arrange: Callable[[DataFrame, int], DataFrame]
    options: Mapping[str, str] = field(default_factory=dict)


def _by_day(rows: DataFrame, level: int) -> DataFrame:
    return rows.hint("rebalance", F.col("event_date")).sortWithinPartitions(*SORT)


EVENTS = Layer(STORED_DDL, ("event_date",), _by_day)


def roll_up(spark: SparkSession, path: str, layer: Layer = EVENTS) -> None:
    """Merge the closed batches of an ingest table, or of another such folder, in place.

    A batch is closed when its stream has a later one: only the last is ever written
    again. The new segment counts from the moment its manifest is written; before that
    readers see the batches, after it the segment, and never both. Folders that an earlier
    version made needless are deleted, those of this one stay for readers that have
    listed them already, until the next roll-up. ``FAN_IN`` segments of a level become
    one of the next, so a row is rewritten as often as the table's size has levels.

    One writer per folder, which is also the one to roll up.
    """
    before = Manifest.of(spark, path)
    for stream, batch in before.upto:
        done = lambda name, last=batch: name.startswith("batch_id=") and int(name[9:]) <= last
        delete_folders(spark, f"{path}/stream={stream}", done)
    kept = {name for name, _ in before.segments}
    delete_folders(spark, f"{path}/_rolled", lambda name: name.startswith("segment-") and name not in kept)
    old = {f"version={before.version - n}" for n in range(VERSIONS)}
    delete_folders(spark, f"{path}/_rolled/manifest", lambda name: name.startswith("version=") and name not in old)
    stored = spark.read.schema(layer.ddl).parquet(path)
    last = {r[0]: r[1] for r in stored.groupBy("stream").agg(F.max("batch_id")).collect()}
    upto = dict(before.upto) | {s: b - 1 for s, b in last.items() if b - 1 > dict(before.upto).get(s, -1)}
    after = Manifest(before.version + 1, before.segments, tuple(sorted(upto.items())))
    closed = stored.filter(before.open() & ~after.open())
    if closed.isEmpty():
        return
    segments, level, name = list(before.segments), 0, f"segment-{uuid.uuid4().hex}"
    parts, merged = [closed], [s for s in segments if s[1] == 0]
    while len(merged) + 1 >= FAN_IN:
        parts += [spark.read.schema(layer.ddl).parquet(f"{path}/_rolled/{s}").select(*stored.columns) for s, _ in merged]
        segments = [s for s in segments if s not in merged]
        level += 1
        merged = [s for s in segments if s[1] == level]
    rows = layer.arrange(reduce(DataFrame.unionByName, parts), level)
    with write_settings(spark):
        rows.write.options(**layer.options).partitionBy(*layer.partition).parquet(f"{path}/_rolled/{name}")
    segments.append((name, level))
    Manifest(after.version, tuple(sorted(segments)), after.upto).write(spark, path)


def delete_folders(spark: SparkSession, path: str, wanted: Callable[[str], bool]) -> None:
    """Delete the folders right below ``path`` whose name is ``wanted``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in store.listStatus(folder) if store.exists(folder) else ():
        if wanted(found.getPath().getName()):
            store.delete(found.getPath(), True)
