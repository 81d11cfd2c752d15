"""Landing schema, target columns and the typed target table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The landing contract (column order matters, files bind by position).
SOURCE_FIELDS = {
    "event_id": "string",
    "user_id": "int",
    "session_id": "string",
    "event_type": "string",
    "product_id": "int",
    "product_name": "string",
    "category": "string",
    "price": "double",
    "quantity": "int",
    "total_amount": "double",
    "timestamp": "string",
}
SOURCE_COLUMNS = list(SOURCE_FIELDS)
SOURCE_DDL = ", ".join(f"`{name}` {kind}" for name, kind in SOURCE_FIELDS.items())

# The time format and event types of the landing files.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_TYPES = ("view", "purchase")


@dataclass(frozen=True)
class TargetColumn:
    """One NOT NULL column of the event table."""

    name: str
    kind: str
    max_chars: int | None = None
    default: str | None = None

    @property
    def ddl(self) -> str:
        kind = f"varchar({self.max_chars})" if self.max_chars else self.kind
        default = f" DEFAULT {self.default}" if self.default else ""
        return f"`{self.name}` {kind} NOT NULL{default}"


# The target contract, in ordinal order; event_id is the unique key.
TARGET = (
    TargetColumn("event_id", "string", 36),
    TargetColumn("user_id", "int"),
    TargetColumn("session_id", "string", 36),
    TargetColumn("event_type", "string", 20),
    TargetColumn("product_id", "int"),
    TargetColumn("product_name", "string", 100),
    TargetColumn("category", "string", 50),
    TargetColumn("price", "decimal(10,2)"),
    TargetColumn("quantity", "int", default="1"),
    TargetColumn("total_amount", "decimal(10,2)"),
    TargetColumn("event_timestamp", "timestamp"),
    TargetColumn("ingested_at", "timestamp", default="current_timestamp()"),
)
KEY = "event_id"
MONEY_COLUMNS = ("price", "total_amount")
TARGET_COLUMNS = [c.name for c in TARGET]
TARGET_DDL = ", ".join(f"`{c.name}` {c.kind}" for c in TARGET)

# The stored table adds three partition columns to the target.
STORED_DDL = f"{TARGET_DDL}, `stream` string, `batch_id` bigint, `event_date` date"


def to_target(rows: DataFrame) -> DataFrame:
    """Target columns in order, money narrowed to its stored type."""
    return rows.selectExpr(*(f"CAST({c.name} AS {c.kind}) AS {c.name}" for c in TARGET))


def create_event_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Declare the typed table in the catalog.

    Spark holds inserts to the text lengths and decimal range and fills defaults.
    File tables accept NULLs in spite of NOT NULL, and no key is unique by
    declaration: ``operators.contract`` and ``streaming.TableSink`` see to those.
    With a location the table is laid over a read-optimised folder written by
    ``operators.layout.compact``, so it is partitioned by ``event_date``.
    """
    columns = ", ".join(c.ddl for c in TARGET)
    if location is None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
        return
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, event_date date) USING parquet "
        f"PARTITIONED BY (event_date) LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(name)
