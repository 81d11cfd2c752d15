"""The stored event table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.schema import STORED_DDL, TARGET_COLUMNS, TARGET_DDL


# Timestamps as 64-bit microseconds: the default, INT96, carries no statistics, so no
# filter on a time could skip row groups. Partitions are merged as far as every core still
# gets one, but not below some MB: every join and rank before a write runs on all cores, and
# a small batch still leaves few files on a large cluster. Merged up to the advisory size,
# a batch of less than that would go through each of its steps in a single task.
WRITE_SETTINGS = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4MB",
}


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """The session with ``WRITE_SETTINGS`` for the time of a write."""
    before = {name: spark.conf.get(name) for name in WRITE_SETTINGS}
    for name, value in WRITE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


MANIFEST_DDL = "kind string, name string, number bigint, version bigint"


def read_folder(spark: SparkSession, path: str, ddl: str, kind: str = "parquet") -> DataFrame | None:
    """A folder of files; None where there is none."""
    try:
        return spark.read.schema(ddl).format(kind).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Manifest:
    """What of an ingest table has been rolled up, see ``operators.layout.roll_up``.

    ``segments``: folders of rolled-up batches with their level; ``upto``: the last batch
    of each stream that is in them. A version is one file, so readers see it whole or not.
    """

    version: int = 0
    segments: tuple[tuple[str, int], ...] = ()
    upto: tuple[tuple[str, int], ...] = ()

    @staticmethod
    def of(spark: SparkSession, path: str) -> Manifest:
        rows = read_folder(spark, f"{path}/_rolled/manifest", MANIFEST_DDL)
        if rows is None or (latest := rows.agg(F.max("version")).first()[0]) is None:
            return Manifest()
        # A line per segment and stream: some dozen.
        lines = rows.filter(F.col("version") == latest).collect()
        segments = sorted((r.name, r.number) for r in lines if r.kind == "segment")
        upto = sorted((r.name, r.number) for r in lines if r.kind == "upto")
        return Manifest(latest, tuple(segments), tuple(upto))

    def write(self, spark: SparkSession, path: str) -> None:
        lines = [("segment", *s) for s in self.segments] + [("upto", *u) for u in self.upto]
        rows = spark.createDataFrame(lines, "kind string, name string, number bigint").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{path}/_rolled/manifest/version={self.version}")

    def open(self) -> Column:
        """Whether a stored row is of a batch that is not rolled up."""
        closed = F.lit(False)
        for stream, batch in self.upto:
            closed = closed | ((F.col("stream") == stream) & (F.col("batch_id") <= batch))
        return ~closed


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """Ingest table rows with ``batch_id`` and ``event_date``; None before the first batch."""
    return read_layered(spark, path, STORED_DDL)


def read_layered(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """A folder of batches, some of them rolled up; None before the first one.

    Batches not rolled up come from their own folders, the others from the segments.
    """
    batches = read_folder(spark, path, ddl)
    if batches is None:
        return None
    rolled = Manifest.of(spark, path)
    if not rolled.segments:
        return batches
    columns = batches.columns
    parts = [spark.read.schema(ddl).parquet(f"{path}/_rolled/{name}") for name, _ in rolled.segments]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts], batches.filter(rolled.open()))


def read_events_table(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    until: datetime | None = None,
    with_day: bool = False,
) -> DataFrame:
    """Target columns of an ingest or compacted table; ``event_date`` too ``with_day``.

    ``since`` (inclusive) and ``until`` (exclusive) bound the event time. They
    also prune the day partitions, a day wider on either side in case the writer
    cut its days in another time zone.
    """
    stored = read_stored(spark, path) if Manifest.of(spark, path).segments else None
    if stored is None:
        rows = spark.read.schema(f"{TARGET_DDL}, `event_date` date").parquet(path)
    else:
        rows = stored.select(*TARGET_COLUMNS, "event_date")
    day = timedelta(days=1)
    if since is not None:
        rows = rows.filter(F.col("event_date") >= F.lit((since - day).date()))
        rows = rows.filter(F.col("event_timestamp") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("event_date") <= F.lit((until + day).date()))
        rows = rows.filter(F.col("event_timestamp") < F.lit(until))
    return rows if with_day else rows.select(*TARGET_COLUMNS)


def read_events_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    since: datetime,
    until: datetime,
    readers: int = 8,
    **options: str,
) -> DataFrame:
    """A database table, read by ``readers`` tasks that split the event-time range."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", "event_timestamp")
        .option("lowerBound", str(since))
        .option("upperBound", str(until))
        .option("numPartitions", readers)
        .load()
    )


def register_events(events: DataFrame, name: str = "user_events") -> None:
    """Name the event table for ``spark.sql``."""
    events.createOrReplaceTempView(name)
