"""Where a micro-batch of accepted rows goes. A sink is called with (rows, batch_id)."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.operators.dedupe import first_per_key, not_stored
from brooklet.operators.layout import roll_up
from brooklet.operators.partials import PARTIALS, partials, partials_path
from brooklet.schema import KEY, TARGET_COLUMNS, TARGET_DDL, to_target
from brooklet.sources.table import read_stored
from brooklet.streaming.batches import stream_id, write_batch
from brooklet.streaming.key_index import KeyIndex


@dataclass(frozen=True)
class TableSink:
    """Append to a Parquet table, first write of a key wins.

    ``unique`` says against what a key is checked:

    * ``"table"``: every earlier batch, and those of other streams, by the ``KeyIndex``
      beside the table. A batch of few keys looks them up; a large one scans the keys.
    * ``"day"``: earlier rows of the batch's event dates only. Right when copies
      of an event carry the same event time; the table scan is then pruned to
      those days.
    * ``"batch"``: this batch only.
    * ``"none"``: not at all; for streams that drop repeated keys themselves
      (``Ingest(dedupe="state")``). Such state is lost with the checkpoint: go on
      with ``"table"`` or ``"day"`` after that.

    Every ``roll_up_every`` batches the closed ones are merged in place, so that the
    folders to list and the files to read stay few; 0 for never. ``writer`` names the
    caller outside a stream. With ``partials`` each batch leaves its partial aggregates
    beside it, for ``operators.partials``. One writer per table. Rows come in as the 12
    target columns.
    """

    path: str
    unique: str = "table"
    roll_up_every: int = 0
    writer: str | None = None
    partials: bool = False
    _completed: set[str] = field(default_factory=set, init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.unique not in ("table", "day", "batch", "none"):
            raise ValueError(f"unique must be table, day, batch or none, not {self.unique!r}")

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows = to_target(rows).withColumn("event_date", F.to_date("event_timestamp"))
        # Copies go first: the ranking leaves the rows hashed and sorted by key,
        # as the anti join wants them.
        fresh = rows if self.unique == "none" else first_per_key(rows, KEY, ["event_timestamp"])
        if self.unique == "table":
            fresh = self._not_indexed(fresh, rows, batch_id)
        elif self.unique == "day":
            fresh = self._not_of_these_days(fresh, rows, batch_id)
        columns = [*TARGET_COLUMNS, "event_date"]
        spread = fresh.select(*columns).hint("rebalance", F.col("event_date"))
        write_batch(spread, self.path, batch_id, "event_date", writer=self.writer)
        index = KeyIndex(self.path)
        spark, aggregates = rows.sparkSession, partials_path(self.path)
        if self.unique == "table":
            index.add(self._written(spark, batch_id), batch_id, self.writer)
        if self.partials:
            found = partials(self._written(spark, batch_id))
            write_batch(found, aggregates, batch_id, writer=self.writer)
        if self.roll_up_every and batch_id % self.roll_up_every == self.roll_up_every - 1:
            roll_up(spark, self.path)
            if self.unique == "table":
                index.roll_up(spark)
            if self.partials:
                roll_up(spark, aggregates, PARTIALS)

    def _written(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What the table now holds of a batch."""
        folder = f"{self.path}/stream={stream_id(spark, self.writer)}/batch_id={batch_id}"
        return spark.read.schema(f"{TARGET_DDL}, event_date date").parquet(folder)

    def _not_indexed(self, fresh: DataFrame, rows: DataFrame, batch_id: int) -> DataFrame:
        index, stream = KeyIndex(self.path), stream_id(rows.sparkSession, self.writer)
        if stream not in self._completed:
            index.complete(rows.sparkSession, batch_id, self.writer)
            self._completed.add(stream)
        stored = index.stored(rows, batch_id, self.writer)
        if isinstance(stored, DataFrame):
            return not_stored(fresh, stored, [KEY], rows)
        return fresh.filter(~F.col(KEY).isin(stored)) if stored else fresh

    def _not_of_these_days(self, fresh: DataFrame, rows: DataFrame, batch_id: int) -> DataFrame:
        stored = read_stored(rows.sparkSession, self.path)
        if stored is None:
            return fresh
        other_stream = F.col("stream") != stream_id(rows.sparkSession, self.writer)
        earlier = stored.filter(other_stream | (F.col("batch_id") < batch_id))
        # The span prunes the scan of any plan; inside it the broadcast
        # keys prune to the very days, which takes a filter on their side.
        first, last = rows.agg(F.min("event_date"), F.max("event_date")).first()
        span = F.col("event_date").between(F.lit(first), F.lit(last))
        return not_stored(fresh, earlier.filter(span), ["event_date", KEY], rows.filter(span))


def tables_of(sink: object) -> list[str]:
    """The table that a sink, or the one it holds as ``sink``, writes to."""
    while not isinstance(sink, TableSink):
        sink = getattr(sink, "sink", None)
        if sink is None:
            return []
    return [sink.path]


@dataclass(frozen=True)
class JdbcSink:
    """Append to a database table over JDBC, first write of a key wins.

    ``merge=True`` writes a batch to a staging table of its stream, which it replaces, and
    then runs one transaction in the database: the staged rows whose key the table does not
    hold are inserted, whatever their event time, and the batch is marked. A batch whose
    mark is there was merged before, and is left alone. For databases that know
    ``INSERT ... ON CONFLICT DO NOTHING``; the marks are in a table beside the target. The
    database's driver has to be on the class path of Spark's driver, not only in its jars.

    Otherwise the keys that the table holds already are looked up first (``resume``):
    those of earlier batches, and those that a failed attempt at this one stored (the
    insert commits per writer task). The lookup is bounded by the batch's event times,
    which the target has an index on, and split over ``readers`` connections along them.
    A copy of an event carries its event time; one with a time outside the batch's span
    would not be seen, and collides with the primary key.
    """

    # Table name, batch size, writers, isolation and TLS of the published set-up.
    url: str
    table: str = "user_events"
    batch_size: int = 1000
    writers: int = 2
    isolation: str = "READ_COMMITTED"
    tls: bool = True
    resume: bool = True
    readers: int = 4
    options: dict[str, str] = field(default_factory=dict)
    merge: bool = False
    writer: str | None = None

    def connection(self) -> dict[str, str]:
        tls = {"ssl": "true", "sslmode": "require"} if self.tls else {}
        return {"url": self.url, "dbtable": self.table, **tls, **self.options}

    def write_options(self) -> dict[str, str]:
        return {
            **self.connection(),
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.writers),
            "isolationLevel": self.isolation,
        }

    def lookup_options(self, first: datetime, last: datetime) -> dict[str, str]:
        """Read options: ``readers`` connections, each for a part of the event times."""
        return {
            **self.connection(),
            "partitionColumn": "event_timestamp",
            "lowerBound": str(first),
            "upperBound": str(last + timedelta(seconds=1)),
            "numPartitions": str(self.readers),
        }

    def staging(self, stream: str) -> str:
        """The staging table of a stream; its name holds what an identifier may."""
        return f"{self.table}_staging_{re.sub('[^0-9A-Za-z]', '_', stream)}"

    def staging_options(self, stream: str) -> dict[str, str]:
        """The staging table is emptied, not dropped, so that its rights and types stay."""
        return {**self.write_options(), "dbtable": self.staging(stream), "truncate": "true"}

    def merge_statements(self, stream: str, batch_id: int) -> list[str]:
        """One transaction: merge what is staged unless the batch is marked, and mark it."""
        batch = f"'{stream.replace(chr(39), 2 * chr(39))}', {int(batch_id)}"
        marks, names = f"{self.table}_batches", ", ".join(TARGET_COLUMNS)
        return [
            f"CREATE TABLE IF NOT EXISTS {marks} "
            "(stream varchar(64) NOT NULL, batch_id bigint NOT NULL, PRIMARY KEY (stream, batch_id))",
            f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.staging(stream)} "
            f"WHERE NOT EXISTS (SELECT 1 FROM {marks} WHERE (stream, batch_id) = ({batch})) "
            f"ON CONFLICT ({KEY}) DO NOTHING",
            f"INSERT INTO {marks} (stream, batch_id) VALUES ({batch}) ON CONFLICT DO NOTHING",
        ]

    def stored(self, rows: DataFrame) -> DataFrame:
        """Keys stored with event times in the span of ``rows``; the database filters."""
        first, last = rows.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
        known = rows.sparkSession.read.format("jdbc").options(**self.lookup_options(first, last)).load()
        return known.filter(F.col("event_timestamp").between(F.lit(first), F.lit(last))).select(KEY)

    def write(self, rows: DataFrame) -> None:
        rows.write.format("jdbc").options(**self.write_options()).mode("append").save()

    def stage(self, rows: DataFrame, stream: str) -> None:
        rows.write.format("jdbc").options(**self.staging_options(stream)).mode("overwrite").save()

    def execute(self, spark: SparkSession, statements: list[str]) -> None:
        """Run the statements over one connection of the driver, as one transaction."""
        manager = spark.sparkContext._jvm.java.sql.DriverManager
        settings = spark.sparkContext._jvm.java.util.Properties()
        for name, value in self.connection().items():
            if name not in ("url", "dbtable"):
                settings.setProperty(name, value)
        connection = manager.getConnection(self.url, settings)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.execute(text)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows = first_per_key(to_target(rows), KEY, ["event_timestamp"]).select(*TARGET_COLUMNS)
        if self.merge:
            stream = stream_id(rows.sparkSession, self.writer)
            self.stage(rows, stream)
            self.execute(rows.sparkSession, self.merge_statements(stream, batch_id))
            return
        if self.resume:
            rows = rows.join(self.stored(rows), KEY, "left_anti").select(*TARGET_COLUMNS)
        self.write(rows)
