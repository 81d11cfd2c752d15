"""Data quality, latency and KPI reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions import exact_sum, latency_micros
from brooklet.operators.clean import conform
from brooklet.operators.contract import all_rules, violates
from brooklet.schema import KEY, TARGET


def quality_summary(events: DataFrame) -> DataFrame:
    """Rows that break each rule, as (rule, n), in one pass over landing rows."""
    rules = all_rules()
    counted = (f"count_if({broken}) AS {name}" for name, broken in rules.items())
    counts = conform(events).selectExpr(*counted)
    return counts.unpivot([], list(rules), "rule", "n")


def duplicate_rows(events: DataFrame, key: str = KEY) -> DataFrame:
    """How many rows repeat a key that another row already has."""
    copies = events.groupBy(key).agg(F.count("*").alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def _seconds(micros: Column) -> Column:
    return micros.cast("double") / F.lit(1e6)


def _latency() -> Column:
    return latency_micros(F.col("event_timestamp"), F.col("ingested_at"))


def latency_stats(events: DataFrame) -> DataFrame:
    """Average, smallest and largest delay between event and ingest, in seconds.

    Summed exactly in microseconds, so the average does not depend on row order.
    """
    return events.select(_latency().alias("_us")).agg(
        F.try_divide(_seconds(exact_sum(F.col("_us"))), F.count("_us")).alias("avg_s"),
        _seconds(F.min("_us")).alias("min_s"),
        _seconds(F.max("_us")).alias("max_s"),
    )


@dataclass(frozen=True)
class Kpi:
    """A measured value and the target it is held against."""

    name: str
    comparison: str
    target: float

    def passed(self, actual: Column) -> Column:
        bound = F.lit(self.target)
        return {">=": actual >= bound, "<=": actual <= bound, "=": actual == bound}[self.comparison]


# The published targets.
KPIS = (
    Kpi("throughput_per_s", ">=", 5.0),
    Kpi("avg_latency_s", "<=", 20.0),
    Kpi("max_latency_s", "<=", 30.0),
    Kpi("duplicate_pct", "=", 0.0),
    Kpi("clean_pct", "=", 100.0),
)


def kpi_report(events: DataFrame, kpis: tuple[Kpi, ...] = KPIS) -> DataFrame:
    """Each KPI with target, actual and verdict.

    Throughput spans the first event to the last ingest. All figures but the
    duplicates come from one aggregate that shuffles a row per task; only the
    keys themselves are shuffled to count the duplicates.
    """
    measured = events.select(
        "event_timestamp", "ingested_at", _latency().alias("_us"), violates().alias("_bad")
    )
    totals = measured.agg(
        F.count("*").alias("n"),
        F.count_if("_bad").alias("bad"),
        exact_sum(F.col("_us")).alias("us"),
        F.max("_us").alias("max_us"),
        F.min("event_timestamp").alias("first"),
        F.max("ingested_at").alias("last"),
    )
    return kpis_of(totals.withColumn("duplicates", duplicate_rows(events).scalar()), kpis)


def kpis_of(totals: DataFrame, kpis: tuple[Kpi, ...] = KPIS) -> DataFrame:
    """The report from one row of totals: n, bad, us, max_us, first, last, duplicates."""
    n = F.col("n").cast("double")
    span = _seconds(latency_micros(F.col("first"), F.col("last")))
    actuals = {
        "throughput_per_s": F.try_divide(n, span),
        "avg_latency_s": F.try_divide(_seconds(F.col("us")), n),
        "max_latency_s": _seconds(F.col("max_us")),
        "duplicate_pct": F.try_divide(100.0 * F.col("duplicates"), n),
        "clean_pct": F.try_divide(100.0 * (F.col("n") - F.col("bad")), n),
    }
    rows = []
    for kpi in kpis:
        actual = F.round(actuals[kpi.name], 4)
        rows.append(
            F.struct(
                F.lit(kpi.name).alias("kpi"),
                F.lit(kpi.target).alias("target"),
                actual.alias("actual"),
                kpi.passed(actual).alias("pass"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def schema_report(rows: DataFrame) -> DataFrame:
    """Every column of ``rows`` as it is: place, name, type, nullability, and its NULLs.

    Names, types and order are those of ``rows``. ``is_nullable`` is the target's rule,
    YES for a column the target does not have: file sources read every column as
    nullable whatever was declared, so that flag says nothing about the data.
    """
    strict = {c.name for c in TARGET}
    fields = rows.schema.fields
    seen = rows.select(*(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"c{i}") for i, f in enumerate(fields)))
    lines = [
        F.struct(
            F.lit(i + 1).alias("ordinal_position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("NO" if f.name in strict else "YES").alias("is_nullable"),
            F.col(f"c{i}").alias("nulls"),
        )
        for i, f in enumerate(fields)
    ]
    return seen.select(F.inline(F.array(*lines))).orderBy("ordinal_position")


def columns_of(spark: SparkSession, table: str) -> DataFrame:
    """(ordinal_position, column_name, data_type, is_nullable) of a table in the catalog, by its name."""
    columns = [
        (i, c.name, c.dataType, "YES" if c.nullable else "NO")
        for i, c in enumerate(spark.catalog.listColumns(table), start=1)
    ]
    shape = "ordinal_position int, column_name string, data_type string, is_nullable string"
    return spark.createDataFrame(columns, shape).orderBy("ordinal_position")


def table_columns(table: DataFrame) -> DataFrame:
    """(column_name, data_type, is_nullable) of any table, in column order."""
    fields = [
        (i, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for i, f in enumerate(table.schema.fields, start=1)
    ]
    shape = T.StructType(
        [
            T.StructField("ordinal_position", T.IntegerType()),
            T.StructField("column_name", T.StringType()),
            T.StructField("data_type", T.StringType()),
            T.StructField("is_nullable", T.StringType()),
        ]
    )
    return table.sparkSession.createDataFrame(fields, shape).orderBy("ordinal_position")
