"""First row per key, and rows whose key is not stored yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brooklet.schema import KEY

def first_per_key(rows: DataFrame, key: str = KEY, order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key by ``order``, then by all other columns.

    Ordering by every column makes the winner the same on any rerun. Spark turns
    the rank filter into a partial group limit before the shuffle, so each task
    sends at most one row of a key however many copies it read.
    """
    rest = [name for name in rows.columns if name != key and name not in order]
    window = Window.partitionBy(key).orderBy(*order, *rest)
    ranked = rows.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def not_stored(
    rows: DataFrame, stored: DataFrame, on: Sequence[str] = (KEY,), keys: DataFrame | None = None
) -> DataFrame:
    """Rows whose key is absent from ``stored``, a much larger set of keys.

    A direct anti join would shuffle every stored key. Instead the stored keys are first
    reduced to those that occur in ``keys`` (the key columns of ``rows`` when not
    given): below ``spark.sql.autoBroadcastJoinThreshold`` Spark broadcasts these and
    only scans the stored keys; beyond it both are shuffled by key. The anti join then
    runs against that remainder, which ``rows`` bounds.
    """
    on = list(on)
    wanted = (rows if keys is None else keys).select(*on).distinct()
    hits = stored.select(*on).join(wanted, on, "left_semi")
    return rows.join(hits, on, "left_anti")


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count as ``cnt``."""
    return rows.groupBy(*key).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)
