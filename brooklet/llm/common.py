"""Helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.plans.inputs import scratch

#: Characters of text worked on at once inside a Python task.
BATCH_CHARS = 4_000_000
#: Bytes handed to a Python task at once; a longer row goes alone.
BATCH_BYTES = 4 << 20
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: computed once, lineage cut."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands at most ``BATCH_BYTES`` to a Python task at once.

    By rows alone, a batch of texts takes 20 MB and more, and both ends hold several copies
    of it, and keep that memory. It stays set, for rows that are computed later; a lower
    limit is left as it is.
    """
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]?)[a-z]*\s*", spark.conf.get(BYTES_SETTING).lower()).groups()
    if not 0 < int(number) << 10 * "bkmgtp".find(unit or "b") <= BATCH_BYTES:
        spark.conf.set(BYTES_SETTING, f"{BATCH_BYTES}b")


def slices(batches: Iterable[pd.DataFrame], chars: int = BATCH_CHARS, column: str = "text") -> Iterator[pd.DataFrame]:
    """The batches cut so that each piece holds about ``chars`` characters (or bytes) of ``column``.

    A single text is never cut.
    """
    for batch in batches:
        if len(batch):
            at = batch[column].str.len().cumsum() // chars
            for _, piece in batch.groupby(at.to_numpy(), sort=True):
                yield piece.reset_index(drop=True)


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a null text as an empty one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def named_text(docs: DataFrame) -> DataFrame:
    """As ``id_text``, doc_id as text: pandas would round a long beside a null."""
    return id_text(docs).withColumn("doc_id", F.col("doc_id").cast("string"))


#: Rows of a few numbers that are broadcast at most, some 50 MB; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def bounded(rows: DataFrame) -> DataFrame:
    """``rows``, counted, with a broadcast hint if they are few enough. Cheap to read, please."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def columns(rows: DataFrame) -> list[Column]:
    """The columns of ``rows`` by name, whatever their names hold."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in rows.columns]


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``rows`` has."""
    taken = {column.lower() for column in rows.columns}
    while name in taken:
        name += "_"
    return name


def remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo ``divisor``; 0 for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor, F.lit(0))
