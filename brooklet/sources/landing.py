"""The landing folder: CSV files with a header, bound by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions import render_event_time
from brooklet.schema import SOURCE_COLUMNS, SOURCE_DDL, SOURCE_FIELDS

# The published set-up of small files.
FILES_PER_BATCH = 5
ROWS_PER_FILE = 20


#: What ``raw`` adds: the line as it came where it does not fit the schema, its file, and the
#: place in the file of the block it was read in.
RAW, FILE, BLOCK = "raw_line", "landing_file", "landing_block"
RAW_COLUMNS = (RAW, FILE, BLOCK)


def _csv_options(strict_header: bool) -> dict[str, str]:
    # The name is that of a column only where the schema has it.
    return {"header": "true", "enforceSchema": str(not strict_header).lower(), "columnNameOfCorruptRecord": RAW}


def _schema(raw: bool) -> str:
    return f"{SOURCE_DDL}, `{RAW}` string" if raw else SOURCE_DDL


def _placed(rows: DataFrame, raw: bool) -> DataFrame:
    if not raw:
        return rows
    places = {FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start")}
    return rows.withColumns(places)


def read_events_csv(spark: SparkSession, path: str, strict_header: bool = False, raw: bool = False) -> DataFrame:
    """All landing files at once. Unreadable cells become NULL.

    Columns bind by position; ``strict_header`` fails the read when the header
    names differ from the schema. With ``raw`` the ``RAW_COLUMNS`` come too: the whole
    line where a cell is unreadable, or cells are missing or left over.
    """
    return _placed(spark.read.schema(_schema(raw)).options(**_csv_options(strict_header)).csv(path), raw)


def read_events_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = FILES_PER_BATCH,
    max_bytes: int | None = None,
    archive_dir: str | None = None,
    strict_header: bool = False,
    raw: bool = False,
) -> DataFrame:
    """Each new landing file once.

    A micro-batch takes at most ``max_files`` files, or ``max_bytes`` bytes of
    files: give the byte bound on a large cluster. With ``archive_dir`` consumed
    files are moved there after a later batch commits. ``raw`` as in ``read_events_csv``.
    """
    options = _csv_options(strict_header)
    if max_bytes is not None:
        options["maxBytesPerTrigger"] = str(max_bytes)
    elif max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    if archive_dir is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    return _placed(spark.readStream.schema(_schema(raw)).options(**options).csv(path), raw)


def landing_files(events: DataFrame, name: str = "file_id", folder: bool = False) -> DataFrame:
    """Landing rows with the name of the file each came from, or of the file's folder."""
    if folder:
        return events.withColumn(name, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return events.withColumn(name, F.col("_metadata.file_name"))


def as_landing(events: DataFrame) -> DataFrame:
    """Event table rows back in the landing schema, to replay them."""
    text = render_event_time(F.col("event_timestamp")).alias("timestamp")
    rows = events.select("*", text)
    return rows.selectExpr(*(f"CAST({name} AS {kind}) AS {name}" for name, kind in SOURCE_FIELDS.items()))


def write_landing(
    events: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, by_session: bool = False
) -> None:
    """Write events as landing files of at most ``rows_per_file`` rows.

    Spark writes to a hidden folder and renames on commit, so a stream watching
    ``path`` never lists a half-written file. ``by_session`` keeps the rows of a
    session together; the event id in the range key lets a session that holds a
    large share of the rows spread over several tasks.
    """
    rows = events.select(*SOURCE_COLUMNS)
    if by_session:
        order = ("session_id", "event_id")
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    (
        rows.write.mode("append")
        .option("header", True)
        .option("maxRecordsPerFile", rows_per_file)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
