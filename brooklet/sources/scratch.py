"""Folders for tables that a job writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name for tables a query writes, in the folder the executors share.

    That is ``spark.checkpoint.dir``, or the warehouse folder where it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/brooklet/{name}-{uuid.uuid4().hex}"


def rewritten(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to such a folder and read back: computed once, whoever reads them."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
