"""Widen slim events with the product table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions import line_total
from brooklet.schema import SOURCE_FIELDS


def purchase_quantity(units: Column) -> Column:
    """A purchase buys ``units``; any other event counts as one."""
    return F.when(F.col("event_type") == "purchase", units).otherwise(F.lit(1))


def enrich(events: DataFrame, products: DataFrame, units: Column | None = None) -> DataFrame:
    """Events joined to (product_id, product_name, category, price).

    No broadcast hint: Spark broadcasts the products only when their size
    statistics are below ``spark.sql.autoBroadcastJoinThreshold``. A larger
    catalogue is joined by key, where adaptive execution splits the partition of
    a product that holds a large share of the events.
    Events without a product are returned by ``unmatched``.
    """
    slim = events.withColumn(
        "quantity", purchase_quantity(F.col("quantity") if units is None else units)
    )
    # The product's side of the key goes on, so that conditions on it meet the products.
    same = slim["product_id"] == products["product_id"]
    wide = slim.join(products, same, "inner").drop(slim["product_id"])
    wide = wide.withColumn("total_amount", line_total(F.col("price"), F.col("quantity")))
    return wide.selectExpr(*(f"CAST({name} AS {kind}) AS {name}" for name, kind in SOURCE_FIELDS.items()))


def enrich_all(events: DataFrame, products: DataFrame, units: Column | None = None) -> DataFrame:
    """``enrich``, keeping events whose product is unknown or missing.

    These have no product name, category and amounts, so the contract rejects them, by
    name, into the quarantine.
    """
    slim = events.withColumn("quantity", purchase_quantity(F.col("quantity") if units is None else units))
    known = products.withColumnRenamed("product_id", "_known")
    wide = slim.join(known, F.col("product_id") == F.col("_known"), "left")
    wide = wide.withColumn("total_amount", line_total(F.col("price"), F.col("quantity")))
    return wide.selectExpr(*(f"CAST({name} AS {kind}) AS {name}" for name, kind in SOURCE_FIELDS.items()))


def unmatched(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events whose product is unknown, or missing, for the quarantine."""
    return events.join(products.select("product_id"), "product_id", "left_anti")
