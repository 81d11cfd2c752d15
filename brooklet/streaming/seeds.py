"""Keys that a table holds already, as the first rows of a stream that keeps keys in its state.

State belongs to a checkpoint. A stream that starts on a table which other streams wrote
to has to know their keys, so these are written below its checkpoint once, and the folder
is read as a second source of the stream: they enter the state the way rows do, split
over its partitions, in the first batch, and a restart does not read them again. What
other streams have added since is appended to the folder at every start, and comes in
with the next batch as any new file would.

Assumes that the streams of a table run one after the other.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.schema import KEY, STORED_DDL
from brooklet.sources.table import Manifest, read_folder, read_stored

MARKS_DDL = "table_path string, stream string, last_batch bigint, start bigint"
KEY_DDL = f"{KEY} string"


@dataclass(frozen=True)
class Seeds:
    """``known``: a streaming DataFrame of keys. ``added``: those that this start has found, None for none."""

    known: DataFrame
    added: DataFrame | None


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the stream a checkpoint belongs to; None for a new one."""
    lines = read_folder(spark, f"{checkpoint}/metadata", "value string", "text")
    found = lines.first() if lines is not None else None
    return found and json.loads(found.value)["id"]


def foreign_batches(spark: SparkSession, tables: Sequence[str], own: str | None) -> dict[tuple[str, str], int]:
    """The last batch of every other stream in each table.

    Of what is rolled up the manifest knows it; only the folders of open batches are looked at.
    """
    last: dict[tuple[str, str], int] = {}
    for table in tables:
        rolled, batches = Manifest.of(spark, table), read_folder(spark, table, STORED_DDL)
        if batches is None:
            continue
        newest = batches.filter(rolled.open()).groupBy("stream").agg(F.max("batch_id")).collect()
        last |= {(table, stream): batch for stream, batch in (*rolled.upto, *newest) if stream != own}
    return last


def seed(spark: SparkSession, checkpoint: str, tables: Sequence[str]) -> Seeds:
    """Append the keys not yet known to this checkpoint's folder, and read the folder as a stream.

    The marks that say up to which batch of which stream keys are known are written after
    the keys: a crash in between writes some keys twice, which state does not mind.
    """
    folder = f"{checkpoint}/seeds"
    marks = read_folder(spark, f"{folder}/marks", MARKS_DDL)
    lines = marks.collect() if marks is not None else []
    known = {}
    for line in lines:
        place = line.table_path, line.stream
        known[place] = max(known.get(place, -1), line.last_batch)
    found = foreign_batches(spark, tables, checkpoint_id(spark, checkpoint))
    new = {place: batch for place, batch in found.items() if batch > known.get(place, -1)}
    added = None
    if new or marks is None:
        parts = [_between(spark, table, stream, known.get((table, stream), -1)) for table, stream in new]
        empty = spark.createDataFrame([], KEY_DDL)
        start = max((line.start for line in lines), default=-1) + 1
        path = f"{folder}/keys/start={start}"
        reduce(DataFrame.unionByName, parts, empty).distinct().write.mode("overwrite").parquet(path)
        added = spark.read.schema(KEY_DDL).parquet(path) if new else None
        rows = [(*place, batch, start) for place, batch in new.items()] or [("", "", -1, start)]
        spark.createDataFrame(rows, MARKS_DDL).coalesce(1).write.mode("append").parquet(f"{folder}/marks")
    return Seeds(spark.readStream.schema(KEY_DDL).parquet(f"{folder}/keys/start=*").select(KEY), added)


def _between(spark: SparkSession, table: str, stream: str, after: int) -> DataFrame:
    stored = read_stored(spark, table)
    return stored.filter((F.col("stream") == stream) & (F.col("batch_id") > after)).select(KEY)
