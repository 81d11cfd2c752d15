"""A copy of the event table for lookups by user, by category and by time alike.

Rows are ordered along a Z-curve: the places of day, user and category among the values
the table has, a few bits each, are interleaved, so a file and a row group hold a small
box of all three. Bounds then rule out most row groups for a filter on any of them, and
Bloom filters of users and categories rule out most of the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.schema import TARGET_COLUMNS, TARGET_DDL
from brooklet.sources.table import write_settings

CURVE = ("event_date", "user_id", "category")
#: Bits of each dimension's place.
BITS = 6
#: Row groups small enough to skip one by one.
GROUP_BYTES = 8 << 20
CLUSTERED_DDL = f"{TARGET_DDL}, event_date date"


def bounds(rows: DataFrame, name: str, parts: int = 1 << BITS) -> list:
    """Values that cut the distinct values of a column into about equal parts; ``parts`` of them at most.

    Spark samples the values to deal them into ranges, and the driver gets the last of each.
    """
    ranges = rows.select(name).distinct().repartitionByRange(parts, name)
    lasts = ranges.groupBy(F.spark_partition_id().alias("part")).agg(F.max(name).alias("last"))
    return sorted(row.last for row in lasts.collect() if row.last is not None)


def place(name: str, cuts: Sequence) -> Column:
    """How many of ``cuts`` a value exceeds; 0 for NULL."""
    if not cuts:
        return F.lit(0)
    above = F.filter(F.array(*map(F.lit, cuts)), lambda cut: F.col(name) > cut)
    return F.coalesce(F.size(above), F.lit(0))


def z_value(places: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all places interleaved, the first place's in front."""
    value = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for at in places:
            one = F.shiftright(at.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            value = F.shiftleft(value, 1).bitwiseOR(one)
    return value


def bloom(*names: str, distinct: int) -> dict[str, str]:
    """Parquet options for a Bloom filter of each column in every row group."""
    on = {f"parquet.bloom.filter.enabled#{name}": "true" for name in names}
    return on | {f"parquet.bloom.filter.expected.ndv#{name}": str(distinct) for name in names}


def cluster(
    stored: DataFrame, path: str, by: Sequence[str] = CURVE, group_bytes: int = GROUP_BYTES, files: int | None = None
) -> None:
    """Write rows of an ingest table along the Z-curve of ``by``, replacing what ``path`` holds.

    The event time and key in the ranges let rows of one box, however many, spread over
    several files. ``files``: how many to write; by their advisory size unless given.
    """
    places = [place(name, bounds(stored, name)[:-1]) for name in by]
    order = ["_z", "event_timestamp", "event_id"]
    rows = stored.select(*TARGET_COLUMNS, "event_date", z_value(places).alias("_z"))
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    # Small rows take some 128 bytes; a filter for more values than a row group has is only larger.
    options = bloom("user_id", "category", distinct=group_bytes // 128) | {"parquet.block.size": str(group_bytes)}
    with write_settings(stored.sparkSession):
        dealt.sortWithinPartitions(*order).drop("_z").write.mode("overwrite").options(**options).parquet(path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """Target columns and ``event_date``; filters on users, categories and times skip row groups."""
    return spark.read.schema(CLUSTERED_DDL).parquet(path)


def events_of(clustered: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The events whose ``column`` is the one value of ``wanted``, looked up by that value.

    ``wanted`` has one row and column. Its value goes into the plan as it is, so that it
    reaches the files' bounds and Bloom filters, which a join's keys do not.
    """
    row = wanted.first()
    return clustered.filter(F.col(column) == F.lit(row[0])) if row else clustered.limit(0)
