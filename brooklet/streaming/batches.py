"""Folders of micro-batches that a replay replaces whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from brooklet.sources.table import write_settings


def stream_id(spark: SparkSession, writer: str | None = None) -> str:
    """``writer``, or the id of the streaming query that is running this batch.

    That id belongs to the checkpoint: a restart keeps it, a new checkpoint, which
    counts its batches from 0 again, has another. Outside a stream there is none, and
    two callers without an id of their own would overwrite each other's batches.
    """
    found = writer or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("outside a stream a sink needs the id of its writer")
    return found


def write_batch(
    rows: DataFrame,
    path: str,
    batch_id: int,
    *partitions: str,
    writer: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the folder of one batch of one stream, so a replay is written once.

    The whole folder is overwritten: dynamic partition overwrite would keep the
    old rows of a replay that has none.
    """
    spark = rows.sparkSession
    folder = f"{path}/stream={stream_id(spark, writer)}/batch_id={batch_id}"
    with write_settings(spark):
        rows.write.mode("overwrite").options(**(options or {})).partitionBy(*partitions).parquet(folder)
