"""The keys of an ingest table, laid out so that a small batch finds its own without a scan.

Every batch leaves a run of its keys beside the table, in a folder of the batch's own, so
a replay replaces it. Runs of closed batches are merged as the table's rows are: into
segments of growing levels. The keys of a segment are sorted by their hash, bucketed by
its leading bits in levels that hold much, and their files carry a Bloom filter of the
hashes for every small row group.

A batch of at most ``LOOKED_UP`` keys asks for its hashes by value. Spark reads the buckets
they fall in, and of these the row groups whose bounds and Bloom filter admit one of them.
What is found is compared by the key itself, so the answer is exact. What a batch reads
follows its number of keys and the number of segments, some seven to a level, and not the
size of the table. A larger batch joins the whole index.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.operators.layout import Layer, roll_up
from brooklet.schema import KEY
from brooklet.sources.table import Manifest, read_folder, read_stored
from brooklet.streaming.batches import stream_id, write_batch

#: Keys looked up by value at most.
LOOKED_UP = 2_000
RUN_DDL = f"hash bigint, {KEY} string, bucket int, stream string, batch_id bigint"
#: Row groups of some ten thousand keys, each with a Bloom filter of the hashes.
FILES = {
    "parquet.block.size": "524288",
    "parquet.bloom.filter.enabled#hash": "true",
    "parquet.bloom.filter.expected.ndv#hash": "20000",
}
#: Leading bits of the hash that number a level's buckets: none up to level 2, then 3 more a level,
#: as a level holds ``FAN_IN`` times what the one below does.
BARE_LEVELS, LEVEL_BITS, MOST_BITS = 2, 3, 18
IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"


def bits(level: int) -> int:
    return min(MOST_BITS, LEVEL_BITS * max(0, level - BARE_LEVELS))


def bucket(hashed: Column, level: int) -> Column:
    """The leading ``bits`` of the hash; 0 where there are none."""
    return F.shiftrightunsigned(hashed, 64 - bits(level)).cast("int") if bits(level) else F.lit(0)


def _arrange(rows: DataFrame, level: int) -> DataFrame:
    """Ranges of hashes, sorted."""
    placed = rows.withColumn("bucket", bucket(F.col("hash"), level))
    return placed.repartitionByRange("bucket", "hash").sortWithinPartitions("bucket", "hash")


RUNS = Layer(RUN_DDL, ("bucket",), _arrange, FILES)


@contextmanager
def _in_lists(spark: SparkSession):
    before = spark.conf.get(IN_LIST)
    spark.conf.set(IN_LIST, str(LOOKED_UP))
    try:
        yield
    finally:
        spark.conf.set(IN_LIST, before)


@dataclass(frozen=True)
class KeyIndex:
    """Of the table in ``table``. One writer, which is the table's."""

    table: str

    @property
    def path(self) -> str:
        return f"{self.table}/_keys"

    def complete(self, spark: SparkSession, batch_id: int, writer: str | None = None) -> None:
        """Index the batches that the table holds and the index does not.

        Those written before there was an index, and the last one of a stream that ended
        between the two. Once per run will do.
        """
        stored = read_stored(spark, self.table)
        if stored is None:
            return
        # Runs are written in the order of their batches, so those rolled up lack none.
        rolled, batch = Manifest.of(spark, self.path), ["stream", "batch_id"]
        stored = self._before(stored, batch_id, writer).filter(rolled.open())
        runs = read_folder(spark, self.path, RUN_DDL)
        if runs is None:
            rows = stored.select(F.xxhash64(KEY).alias("hash"), KEY, F.lit(0).alias("bucket"), *batch)
            dealt = rows.hint("rebalance", *map(F.col, batch)).sortWithinPartitions(*batch, "hash")
            dealt.write.mode("append").options(**FILES).partitionBy(*batch).parquet(self.path)
            return
        # A run of fewer keys was left by a job that died.
        held = stored.groupBy(*batch).agg(F.count("*").alias("n"))
        known = runs.filter(rolled.open()).groupBy(*batch).agg(F.count("*").alias("n"))
        for stream, number, _ in held.join(known, [*batch, "n"], "left_anti").collect():  # open batches, so few
            rows = stored.filter((F.col("stream") == stream) & (F.col("batch_id") == number))
            self.add(rows, number, stream)

    def add(self, rows: DataFrame, batch_id: int, writer: str | None = None) -> None:
        """The run of a batch: the keys of the rows stored."""
        keys = rows.select(F.xxhash64(KEY).alias("hash"), KEY, F.lit(0).alias("bucket"))
        run = keys.repartitionByRange("hash").sortWithinPartitions("hash")
        write_batch(run, self.path, batch_id, writer=writer, options=FILES)

    def roll_up(self, spark: SparkSession) -> None:
        roll_up(spark, self.path, RUNS)

    def _parts(self, spark: SparkSession, hashes: Sequence[int] | None = None) -> list[DataFrame]:
        """The open runs and the segments; of the latter the buckets of ``hashes`` only."""
        runs = read_folder(spark, self.path, RUN_DDL)
        if runs is None:
            return []
        rolled = Manifest.of(spark, self.path)
        parts = [runs.filter(rolled.open())]
        for name, level in rolled.segments:
            part = spark.read.schema(RUN_DDL).parquet(f"{self.path}/_rolled/{name}")
            if hashes is not None and bits(level):
                at = {(h % (1 << 64)) >> (64 - bits(level)) for h in hashes}
                part = part.filter(F.col("bucket").isin(sorted(at)))
            parts.append(part)
        return parts

    def _before(self, part: DataFrame, batch_id: int, writer: str | None) -> DataFrame:
        """Keys of other streams, and of earlier batches of this one."""
        own = F.col("stream") == stream_id(part.sparkSession, writer)
        return part.filter(~own | (F.col("batch_id") < batch_id))

    def stored(self, rows: DataFrame, batch_id: int, writer: str | None = None) -> DataFrame | list[str]:
        """The keys of ``rows`` that are stored: a list for a small batch, else all stored keys.

        ``rows`` is read once more for its keys, so it should be persisted or cheap.
        """
        spark = rows.sparkSession
        wanted = rows.select(F.xxhash64(KEY).alias("hash"), KEY).distinct().limit(LOOKED_UP + 1).collect()
        if len(wanted) > LOOKED_UP:
            parts = [self._before(p, batch_id, writer).select(KEY) for p in self._parts(spark)]
            return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"{KEY} string")
        hashes, keys = sorted({w.hash for w in wanted}), [w[KEY] for w in wanted]
        parts = [
            self._before(part, batch_id, writer).filter(F.col("hash").isin(hashes) & F.col(KEY).isin(keys)).select(KEY)
            for part in self._parts(spark, hashes)
        ]
        if not parts or not wanted:
            return []
        with _in_lists(spark):
            return [r[KEY] for r in reduce(DataFrame.unionByName, parts).distinct().collect()]
