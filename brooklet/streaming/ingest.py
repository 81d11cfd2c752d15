"""The ingest stream: landing files in, event table and quarantine out."""

from __future__ import annotations

import logging
import signal
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from brooklet.operators.contract import REASONS, accepted, check, filter_rules, rejected, violates
from brooklet.schema import KEY
from brooklet.sources.landing import RAW_COLUMNS
from brooklet.sources.table import read_folder
from brooklet.streaming.batches import write_batch
from brooklet.streaming.commits import commit
from brooklet.streaming.seeds import Seeds, checkpoint_id, foreign_batches, seed
from brooklet.streaming.sinks import tables_of

logger = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]
#: Batches that a long run remembers.
KEPT_REPORTS = 10_000
METRICS_DDL = "accepted bigint, rejected bigint, seconds double, rows_per_s double"


class StopRequested(RuntimeError):
    """A batch was refused, with nothing written, because the stream is to stop."""


class ContractViolation(RuntimeError):
    """A strict stream met a row that the event table forbids."""


@dataclass(frozen=True)
class BatchReport:
    """What one micro-batch did."""

    batch_id: int
    accepted: int
    rejected: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return round(self.accepted / self.seconds, 1) if self.seconds > 0 else 0.0

    def row(self, spark: SparkSession) -> DataFrame:
        values = (self.accepted, self.rejected, self.seconds, self.rows_per_second)
        return spark.createDataFrame([values], METRICS_DDL)


@dataclass
class Ingest:
    """Writes accepted rows to every sink and the others to ``quarantine``.

    * ``quarantine``: folder for rejected rows with their reasons. To count and drop
      them instead has to be asked for by ``discard=True``.
    * ``strict``: fail on a row that passes the cleaning filters but breaks the
      table contract, as the table itself would, instead of setting it aside.
    * ``dedupe="state"``: keep the first row of each key in the stream's state store,
      so a batch costs a lookup per row and never reads the table. Copies are reduced
      to the earliest before they are shuffled. State grows with the keys: run it with
      the RocksDB provider. The table sink then needs ``unique="none"`` only. ``start``
      puts the keys that other streams have stored in the sinks' tables into the state
      first (see ``seeds``); with ``seeded=False`` it refuses tables that have any. The
      tables are those of the sinks, and of sinks that these hold as ``sink``; name others
      in ``tables``.
      ``dedupe="sink"`` leaves uniqueness to the sinks.
    * ``metrics``: folder for one report row per batch, see ``read_metrics``.
    * ``commits``: folder for one record per batch that all sinks hold, see ``commits``.

    ``reports`` are the newest batches of this run, ``KEPT_REPORTS`` at most; ``metrics``
    has them all. After ``request_stop`` the running batch ends as usual, and the next one
    is refused before it writes anything; see ``run``.
    """

    sinks: Sequence[Sink]
    quarantine: str | None = None
    strict: bool = False
    dedupe: str = "sink"
    time_zone: str | None = None
    metrics: str | None = None
    discard: bool = False
    seeded: bool = True
    tables: Sequence[str] = ()
    commits: str | None = None
    reports: deque[BatchReport] = field(default_factory=lambda: deque(maxlen=KEPT_REPORTS))

    def __post_init__(self) -> None:
        self._added: DataFrame | None = None
        self._stop = threading.Event()
        if not self.sinks:
            raise ValueError("without a sink accepted rows would be lost")
        if self.quarantine is None and not self.discard:
            raise ValueError("give a quarantine folder for rejected rows, or discard them explicitly")
        if self.dedupe not in ("sink", "state"):
            raise ValueError(f"dedupe must be sink or state, not {self.dedupe!r}")

    def plan(
        self, source: DataFrame, ingested_at: Column | None = None, seeds: DataFrame | None = None
    ) -> DataFrame:
        """The streaming DataFrame that reaches the batch callback.

        ``seeds``: keys, also as a stream, that count as seen before (``dedupe="state"``).
        """
        checked = check(source, ingested_at, self.time_zone).observe(
            "quality",
            F.count("*").alias("rows"),
            F.count_if(F.col(REASONS) == "").alias("accepted"),
            F.count_if(F.col(REASONS) != "").alias("rejected"),
        )
        if self.dedupe != "state":
            return checked
        good, bad = checked.filter(F.col(REASONS) == ""), checked.filter(F.col(REASONS) != "")
        lines = [name for name in RAW_COLUMNS if name in checked.columns]
        first = _first_seen(good.drop(*lines), seeds)  # the state need not hold where a good row came from
        return first.unionByName(bad, allowMissingColumns=True)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        if self._stop.is_set():
            raise StopRequested(f"batch {batch_id} is left to the next run")
        if self._added is not None:
            # A batch that the last run left undone comes again without the keys added since.
            good = batch.filter(F.col(REASONS) == "").join(self._added, KEY, "left_anti")
            batch = good.select(*batch.columns).unionByName(batch.filter(F.col(REASONS) != ""))
            self._added = None
        batch = batch.persist()
        try:
            tally = batch.agg(
                F.count_if(F.col(REASONS) == "").alias("good"),
                F.count_if(F.col(REASONS) != "").alias("bad"),
                F.count_if(_breaks_table_only()).alias("broken"),
            ).first()
            if self.strict and tally.broken:
                raise ContractViolation(f"batch {batch_id}: {tally.broken} rows break the table contract")
            if tally.bad and self.quarantine:
                spread = rejected(batch).hint("rebalance", F.col(KEY))
                write_batch(spread, self.quarantine, batch_id)
            if tally.good:
                for sink in self.sinks:
                    sink(accepted(batch), batch_id)
            else:
                logger.info("batch %s: nothing to store", batch_id)
            if self.commits:
                commit(batch.sparkSession, self.commits, batch_id)
        finally:
            batch.unpersist()
        report = BatchReport(batch_id, tally.good, tally.bad, time.monotonic() - started)
        self.reports.append(report)
        if self.metrics:
            write_batch(report.row(batch.sparkSession), self.metrics, batch_id)
        logger.info(
            "batch %s: %s accepted, %s set aside, %.2f s, %s rows/s",
            batch_id, report.accepted, report.rejected, report.seconds, report.rows_per_second,
        )

    def start(
        self,
        source: DataFrame,
        checkpoint: str,
        interval: str | None = "10 seconds",  # fixed value: the published trigger
        ingested_at: Column | None = None,
    ) -> StreamingQuery:
        """Start the stream; ``interval=None`` takes what is there and stops.

        Any error in the callback stops the query. A restart on the same
        checkpoint replays that batch under the same id and ingest time.
        """
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        seeds = self._seeds(source.sparkSession, checkpoint) if self.dedupe == "state" else None
        self._added = seeds and seeds.added
        return (
            self.plan(source, ingested_at, seeds and seeds.known)
            .writeStream.foreachBatch(self)
            .outputMode("update" if self.dedupe == "state" else "append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def request_stop(self) -> None:
        """Let the stream end after the batch that is running."""
        self._stop.set()

    def _seeds(self, spark: SparkSession, checkpoint: str) -> Seeds | None:
        tables = sorted({*self.tables, *(path for sink in self.sinks for path in tables_of(sink))})
        if self.seeded:
            return seed(spark, checkpoint, tables)
        if foreign_batches(spark, tables, checkpoint_id(spark, checkpoint)):
            raise ValueError("the table holds keys of other streams, which this stream's state does not know")
        return None


def _first_seen(rows: DataFrame, seeds: DataFrame | None = None, stamp: Column | None = None) -> DataFrame:
    """Of each key that is new to the state, the row with the earliest event time of the batch.

    ``stamp`` marks the rows of a batch: the run's own id and the instant of the batch. The
    state holds the least and the greatest stamp of a key besides its least row, and a key
    is new if both are this batch's. Stamps are compared for equality only, so the result
    does not hang on a clock that is set back between batches. A key of ``seeds`` has the
    empty stamp, which no batch has. Spark takes the least row per task before the shuffle.
    """
    order = ["event_timestamp", *(c for c in rows.columns if c not in (KEY, "event_timestamp"))]
    if stamp is None:
        stamp = F.concat_ws("/", F.lit(uuid.uuid4().hex), F.unix_millis(F.current_timestamp()).cast("string"))
    stamped = rows.select(KEY, F.struct(*order).alias("_row"), stamp.alias("_stamp"))
    if seeds is not None:
        kind = stamped.schema["_row"].dataType
        stamped = stamped.unionByName(
            seeds.select(KEY, F.lit(None).cast(kind).alias("_row"), F.lit("").alias("_stamp"))
        )
    first = stamped.groupBy(KEY).agg(
        F.min("_row").alias("_row"), F.min("_stamp").alias("_least"), F.max("_stamp").alias("_greatest")
    )
    new = first.filter((F.col("_least") == stamp) & (F.col("_greatest") == stamp))
    return new.select(KEY, "_row.*").select(*rows.columns)


def _breaks_table_only() -> Column:
    """Broke a column rule of the table while passing every cleaning filter."""
    return (F.col(REASONS) != "") & ~violates(filter_rules())


def run(
    query: StreamingQuery, job: Ingest | None = None, stop_file: str | None = None, poll_s: float = 1.0
) -> None:
    """Block until the stream ends, or is asked to stop.

    SIGINT and SIGTERM, and a file or folder at ``stop_file`` (in any store Spark reads),
    ask a ``job`` to stop between two batches: the one that is running is finished and
    committed, so a restart has nothing to write again. Without a job the query is
    stopped where it is. Signals are only heard in the main thread.
    """
    asked = threading.Event()
    before = {}
    if threading.current_thread() is threading.main_thread():
        for name in (signal.SIGINT, signal.SIGTERM):
            before[name] = signal.signal(name, lambda *_: asked.set())
    try:
        while not query.awaitTermination(poll_s):
            if stop_file and read_folder(SparkSession.active(), stop_file, "value string", "text") is not None:
                asked.set()
            if not asked.is_set():
                continue
            logger.info("stopping the stream")
            if job is not None:
                job.request_stop()
            if job is None or not query.status["isTriggerActive"]:
                query.stop()  # a batch that begins now is refused
                break
    except StreamingQueryException as ended:
        if StopRequested.__name__ not in str(ended):
            raise
    finally:
        for name, handler in before.items():
            signal.signal(name, handler)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch with the stream's running total of accepted rows.

    A row per batch is little even after years, so an ordered window will do.
    """
    rows = spark.read.schema(f"{METRICS_DDL}, stream string, batch_id bigint").parquet(path)
    so_far = Window.partitionBy("stream").orderBy("batch_id")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("total", F.sum("accepted").over(so_far))


PROGRESS_DDL = (
    "query string, batch_id bigint, rows bigint, seconds double, rows_per_s double, quality map<string, bigint>"
)


class ProgressRecorder(StreamingQueryListener):
    """Batch id, rows, seconds, rows per second and observed metrics of every batch.

    ``spark.streams.addListener(recorder)`` before the query starts; a query's own
    ``recentProgress`` keeps the last hundred only. Updates arrive shortly after a batch.
    ``rows`` are the newest ``kept``. With ``path`` all of them are appended there as
    PROGRESS_DDL, ``flush_every`` at a time and when a query ends.
    """

    def __init__(self, path: str | None = None, kept: int = KEPT_REPORTS, flush_every: int = 100) -> None:
        self.rows: deque[dict] = deque(maxlen=kept)
        self.ended: deque[str] = deque(maxlen=kept)
        self.path, self.flush_every = path, flush_every
        self.waiting: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seconds = progress.durationMs.get("triggerExecution", 0) / 1000
        quality = progress.observedMetrics.get("quality")
        count = quality["rows"] if quality else progress.numInputRows
        row = {
            "query": str(progress.id),
            "batch_id": progress.batchId,
            "rows": count,
            "seconds": seconds,
            "rows_per_s": round(count / seconds, 1) if seconds else 0.0,
            "quality": quality.asDict() if quality else {},
        }
        self.rows.append(row)
        if self.path:
            self.waiting.append(row)
            if len(self.waiting) >= self.flush_every:
                self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.waiting:
            self.flush()
        self.ended.append(str(event.id))

    def flush(self) -> None:
        """Append the rows that wait."""
        rows = SparkSession.active().createDataFrame(self.waiting, PROGRESS_DDL)
        rows.coalesce(1).write.mode("append").parquet(self.path)
        self.waiting = []

    def of(self, query: StreamingQuery, wait_s: float = 10.0) -> list[dict]:
        """Rows of an ended query, once its last update has arrived."""
        until = time.monotonic() + wait_s
        while str(query.id) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return [row for row in self.rows if row["query"] == str(query.id)]
