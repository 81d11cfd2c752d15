"""From the quarantine back to the landing folder: repaired rows go in again, once.

Every quarantined row has an id made of its file, place, line and cells. A release takes
the rows that no release has taken, lets ``fix`` repair them, and lands those that now
pass the contract; the stream takes the new files as any other. Their ids are written to
a ledger after the files, so a release that dies in between lands rows again, whose keys
the table then holds already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.operators.contract import REASONS, check
from brooklet.schema import SOURCE_COLUMNS, SOURCE_DDL
from brooklet.sources.landing import BLOCK, FILE, RAW, write_landing
from brooklet.sources.scratch import rewritten
from brooklet.sources.table import read_folder

ROW_ID = "row_id"
QUARANTINE_DDL = (
    f"{SOURCE_DDL}, ingested_at timestamp, {REASONS} array<string>, {RAW} string, {FILE} string, {BLOCK} bigint, "
    "stream string, batch_id bigint"
)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """All rows set aside with their ids; rows equal in all of line, place and cells are one."""
    rows = spark.read.schema(QUARANTINE_DDL).parquet(path)
    parts = F.to_json(F.struct(*SOURCE_COLUMNS, RAW, FILE, BLOCK))
    return rows.withColumn(ROW_ID, F.sha2(parts, 256)).dropDuplicates([ROW_ID])


def open_rows(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Quarantined rows that no release has taken."""
    rows, taken = quarantined(spark, path), read_folder(spark, ledger, f"{ROW_ID} string")
    return rows if taken is None else rows.join(taken, ROW_ID, "left_anti").select(*rows.columns)


def release(
    spark: SparkSession,
    path: str,
    ledger: str,
    landing: str,
    fix: Callable[[DataFrame], DataFrame],
    rows_per_file: int = 100_000,
) -> int:
    """Land the open rows of a quarantine that ``fix`` repairs; how many these are.

    ``fix`` returns rows in the landing columns with their ``row_id``; rows it leaves out,
    or that still break a rule, stay open.
    """
    fixed = fix(open_rows(spark, path, ledger)).select(*SOURCE_COLUMNS, ROW_ID)
    good = check(fixed).filter(F.col(REASONS) == "").select(*SOURCE_COLUMNS, ROW_ID)
    good = rewritten(good, "repaired")
    if count := good.count():
        write_landing(good, landing, rows_per_file)
        good.select(ROW_ID).write.mode("append").parquet(ledger)
    return count


def cells(line: str = RAW) -> dict[str, Column]:
    """The cells of a raw line as text, by landing column; NULL where the line has none.

    For lines whose cells hold no quoted separators; others need a parser of their own.
    """
    parts = F.split(F.col(line), ",")
    return {name: F.get(parts, F.lit(i)) for i, name in enumerate(SOURCE_COLUMNS)}
