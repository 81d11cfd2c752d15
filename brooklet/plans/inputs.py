"""Event rows in the landing schema, made from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions import batch_boundary
from brooklet.operators.clean import clean
from brooklet.operators.enrich import enrich
from brooklet.schema import EVENT_TIME_FORMAT, SOURCE_COLUMNS
from brooklet.sources.scratch import scratch

__all__ = ["cleaned", "damaged_events", "ingest_boundary", "products", "scratch", "slim_events", "table", "user_events"]

# Events per session, and so per landing file of the running reports.
SESSION_ROWS = 20


# Declared, so that planning a query opens no data file.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def slim_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table without product attributes; ``units`` is what a purchase buys."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS string) AS event_id",
        "CAST(user_id AS int) AS user_id",
        f"CAST(CAST(floor(event_id / {SESSION_ROWS}) AS bigint) AS string) AS session_id",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS bigint) AS product_id",
        "CAST(1 + event_id % 3 AS int) AS units",
        f"date_format(ts, '{EVENT_TIME_FORMAT}') AS timestamp",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "p_retailprice AS price",
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the 11-column landing schema."""
    return enrich(slim_events(spark, sf_dir), products(spark, sf_dir), units=F.col("units"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events; the ingest time is the next 10 s boundary after the event."""
    return clean(user_events(spark, sf_dir), ingested_at=ingest_boundary())


def ingest_boundary() -> Column:
    return batch_boundary(F.col("event_timestamp"))


# The given events are valid throughout. Here the events of products 1 to 28 come from
# faulty producers: each of these products has its own way of damaging one column.
# The texts are valid in Spark and ANSI SQL alike.
FAULTS = {
    "event_id": "CASE product WHEN 1 THEN NULL WHEN 2 THEN concat(event_id, repeat('x', 37)) ELSE event_id END",
    "user_id": "CASE product WHEN 3 THEN NULL ELSE user_id END",
    "session_id": "CASE product WHEN 4 THEN NULL WHEN 24 THEN repeat('s', 37) ELSE session_id END",
    "event_type": "CASE product WHEN 5 THEN NULL WHEN 6 THEN upper(event_type) "
    "WHEN 7 THEN concat(' ', event_type) WHEN 28 THEN repeat('t', 21) ELSE event_type END",
    "product_id": "CASE product WHEN 8 THEN NULL ELSE product_id END",
    "product_name": "CASE product WHEN 9 THEN repeat('n', 101) WHEN 25 THEN NULL ELSE product_name END",
    "category": "CASE product WHEN 10 THEN NULL WHEN 11 THEN repeat('c', 51) ELSE category END",
    "price": "CASE product WHEN 12 THEN 0e0 WHEN 13 THEN -1e0 WHEN 14 THEN NULL WHEN 15 THEN 4e-3 "
    "WHEN 16 THEN CAST('NaN' AS DOUBLE) WHEN 17 THEN CAST('Infinity' AS DOUBLE) "
    "WHEN 26 THEN 123456789e0 ELSE price END",
    "quantity": "CASE product WHEN 18 THEN NULL WHEN 19 THEN -1 ELSE quantity END",
    "total_amount": "CASE product WHEN 20 THEN 0e0 WHEN 21 THEN 123456789e0 "
    "WHEN 27 THEN CAST('NaN' AS DOUBLE) ELSE total_amount END",
    "timestamp": "CASE product WHEN 22 THEN 'not-a-ts' WHEN 23 THEN replace(\"timestamp\", ' ', 'T') "
    'ELSE "timestamp" END',
}


def damaged_events(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """All events, those of the faulty producers damaged in one column.

    ``only`` is a condition on the rows as they were before.
    """
    rows = user_events(spark, sf_dir).filter(only).withColumn("product", F.col("product_id"))
    damaged = (f"{FAULTS[name]} AS {name}".replace('"', "`") for name in SOURCE_COLUMNS)
    return rows.selectExpr(*damaged)
