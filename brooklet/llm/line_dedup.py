"""Incremental, reversible line dedup.

``LineIndex`` is a folder of tables, split into shards by a hash of the line key:

* ``postings``: which document holds which line, one row per distinct line of a document;
* ``counts``: the exact reference counts. A row is (shard, key, refs, first, last): how
  many postings a key has, and the smallest and largest document among them. Rows are
  absolute; the one of the latest batch holds;
* ``filters``: one cuckoo filter per shard over the keys with at least one reference; one
  that gets full is built anew from the counts, at twice the size;
* ``removed``: documents taken out, with the batch that did it;
* ``log``: a row per finished batch. A batch is written under its number and counts only
  once it is in the log, so a job that died is simply run again.

An insertion asks the filters first: a key they deny is new, its count is written
without reading the table of counts; only keys they may hold are joined with it. A
deletion takes the references back, finds the next smallest document of the keys whose
first one went, and removes keys without references from the filters. Inserting and
deleting the same documents leads back to the same decisions.

Null and empty texts are one empty line, which is never dropped; a very long text is split
whole in its task. Repeated rows of a document hold its lines once. An empty table, first or
later, leaves an index that drops nothing more.

A line is dropped where its key has postings of two documents or more, in all of them but
the smallest. A third of all rows may share one line: its count is summed before the
shuffle, and the join that marks its postings is one whose large partitions Spark splits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import columns, fresh, id_text, slices

LEAST_CHARS = 10
WHITE = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 250_000
SLOTS, LOAD, KICKS = 4, 0.85, 200


# ---------------------------------------------------------------- cuckoo filters


def _hashes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket hash and fingerprint (1 to 65535) of 64-bit keys."""
    x = keys.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x >> np.uint64(16), (x & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1)


def _other(bucket: np.ndarray, mark: np.ndarray, size: int) -> np.ndarray:
    """The second bucket of a fingerprint; its own inverse."""
    spread = mark.astype(np.int64) * 0x5BD1E995
    return (bucket ^ spread) & (size - 1)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints, filled from the left, 0 where free.

    Insertion works on all keys at once: each round puts as many as fit into their
    bucket; of the rest one per bucket takes the place of a fingerprint there, which
    then tries its other bucket.
    """

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = slots

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        size = 1 << max(1, math.ceil(math.log2(max(n, 1) / (SLOTS * LOAD) + 1)))
        return cls(np.zeros((size, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashed, mark = _hashes(keys)
        bucket = (hashed & np.uint64(len(self.slots) - 1)).astype(np.int64)
        return bucket, _other(bucket, mark, len(self.slots)), mark

    def contains(self, keys: np.ndarray) -> np.ndarray:
        one, two, mark = self._places(keys)
        found = (self.slots[one] == mark[:, None]).any(axis=1)
        return found | (self.slots[two] == mark[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Put distinct keys in; False, and the filter as it was, where they don't fit."""
        before = self.slots.copy()
        bucket, _, mark = self._places(keys)
        for kick in range(KICKS):
            order = np.argsort(bucket, kind="stable")
            bucket, mark = bucket[order], mark[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            rank = np.arange(len(bucket)) - np.repeat(starts, np.diff(np.r_[starts, len(bucket)]))
            used = (self.slots[bucket] != 0).sum(axis=1)
            fits = used + rank < SLOTS
            self.slots[bucket[fits], (used + rank)[fits]] = mark[fits]
            bucket, mark, rank = bucket[~fits], mark[~fits], rank[~fits]
            if not len(bucket):
                return True
            if kick:
                # the first of each bucket's rest takes a place, turn by turn another slot
                one = np.r_[True, bucket[1:] != bucket[:-1]]
                slot = (kick + mark[one]) % SLOTS
                out = self.slots[bucket[one], slot].copy()
                self.slots[bucket[one], slot] = mark[one]
                mark[one] = out
            bucket = _other(bucket, mark, len(self.slots))
        self.slots = before
        return False

    def remove(self, key: int) -> bool:
        """Take out one fingerprint of a key that was put in."""
        one, two, mark = (int(x[0]) for x in self._places(np.array([key], np.int64)))
        for bucket in (one, two):
            row = self.slots[bucket]
            at = np.flatnonzero(row == mark)
            if len(at):
                last = np.count_nonzero(row) - 1
                row[at[0]], row[last] = row[last], 0
                return True
        return False


FILTER = "shard int, slots binary"


def _filters_of(rows: pd.DataFrame) -> list[CuckooFilter]:
    return [CuckooFilter.from_bytes(data) for data in rows["slots"]]


def _filled(keys: np.ndarray, n: int) -> CuckooFilter:
    """A filter with ``keys`` in it and room for ``n`` or more."""
    n = max(n, 1)
    while not (one := CuckooFilter.for_keys(n)).insert(keys):
        n *= 2
    return one


def _lookup(key: tuple, keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """``keys`` of one shard with ``known``: whether a filter may hold the key."""
    known = np.zeros(len(keys), bool)
    for one in _filters_of(filters):
        known |= one.contains(keys["hash"].to_numpy(np.int64))
    return keys.assign(known=known)


def _update(key: tuple, changes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after ``changes`` (hash, added); null where it has to be built anew.

    Keys of the same fingerprint and buckets share their places, so it does not matter
    whose is taken out. That holds within one filter only: a second one beside it would
    lose the fingerprint of another key. A shard of several, as older indexes have, is
    built anew as well.
    """
    new = changes.loc[changes["added"], "hash"].to_numpy(np.int64)
    slots = None
    if not len(filters):
        slots = _filled(new, len(new)).to_bytes()
    elif len(filters) == 1:
        (one,) = _filters_of(filters)
        for gone in changes.loc[~changes["added"], "hash"]:
            one.remove(int(gone))
        if one.insert(new):
            slots = one.to_bytes()
    return pd.DataFrame({"shard": [key[0]], "slots": [slots]})


def _rebuilt(key: tuple, live: pd.DataFrame) -> pd.DataFrame:
    """A filter over the keys of one shard (hash), with room for as many again."""
    hashes = live["hash"].to_numpy(np.int64)
    return pd.DataFrame({"shard": [key[0]], "slots": [_filled(hashes, 2 * len(hashes)).to_bytes()]})


# ---------------------------------------------------------------- lines


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()  # of bytes: A-Z only


def is_counted(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _keys(least: int):
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            ids, out = [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                held = {line_key(line) for line in text.encode().split(b"\n")}
                found = {digest(key) for key in held if is_counted(key, least)}
                ids += [doc_id] * len(found)
                out += sorted(found)
            if out:
                yield pd.DataFrame({"doc_id": ids, "key": out})

    return keys


def _drop_lines(least: int):
    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, n, dropped = [], [], []
            for text, gone in zip(batch["text"], batch["gone"], strict=True):
                lines = text.encode().split(b"\n")
                kept = lines
                if gone is not None and len(gone):
                    gone = set(map(bytes, gone))
                    kept = [
                        line for line in lines
                        if not (is_counted(key := line_key(line), least) and digest(key) in gone)
                    ]
                texts.append(b"\n".join(kept).decode())
                n.append(len(lines))
                dropped.append(len(lines) - len(kept))
            yield pd.DataFrame({"text": texts, "n_lines": n, "n_dropped": dropped})

    return drop


# ---------------------------------------------------------------- the index


class LineIndex:
    """A line index in folder ``path``, which all executors can reach.

    Rows without a doc_id are never in it: their lines neither repeat others nor are
    dropped. A null text is one empty line. Rows of the same doc_id are one document; a
    doc_id inserted again in a later batch adds to it, and its deletion takes out both.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, least: int = LEAST_CHARS) -> None:
        self.spark, self.path, self.least = spark, path, least
        self.batch, self.shards = -1, 0

    # -- tables

    def _write(self, rows: DataFrame, table: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={batch}")

    def _read(self, table: str, *more: int) -> DataFrame:
        """Rows of the finished batches and of ``more``, with ``batch``."""
        rows = self.spark.read.option("basePath", f"{self.path}/{table}")
        rows = rows.parquet(*(f"{self.path}/{table}/batch={b}" for b in [*self._batches(table), *more]))
        return rows

    def _batches(self, table: str) -> list[int]:
        """Numbers of the finished batches that wrote ``table``: one per call, so few."""
        if table == "filters":
            return [self.batch]
        kinds = {"postings": ["insert"], "counts": ["insert", "delete"], "removed": ["delete"]}[table]
        log = self.spark.read.schema("batch int, kind string, shards int").json(f"{self.path}/log")
        return sorted(r.batch for r in log.collect() if r.kind in kinds)

    def _finish(self, kind: str, batch: int) -> None:
        # Rows of literals need no Python worker, which an executor would keep.
        names = {"batch": F.lit(batch), "kind": F.lit(kind), "shards": F.lit(self.shards)}
        row = self.spark.range(1, numPartitions=1).select(*(value.alias(name) for name, value in names.items()))
        row.write.mode("append").json(f"{self.path}/log")
        self.batch = batch

    def open(self) -> LineIndex:
        """Go on with the finished batches in the folder."""
        log = self.spark.read.schema("batch int, kind string, shards int").json(f"{self.path}/log")
        self.batch, self.shards = log.agg(F.max("batch"), F.max("shards")).first()
        return self

    def counts(self, *more: int) -> DataFrame:
        """shard, key, refs, first, last, one row per key; batches ``more`` need not be finished."""
        rows = self._read("counts", *more)
        if len(self._batches("counts")) + len(more) == 1:
            return rows.select("shard", "key", "refs", "first", "last")
        latest = F.max_by(F.struct("refs", "first", "last"), "batch").alias("c")
        return rows.groupBy("shard", "key").agg(latest).select("shard", "key", "c.*")

    def postings(self) -> DataFrame:
        """doc_id, shard, key of the documents that are in."""
        rows = self._read("postings")
        if not self._batches("removed"):
            return rows.select("doc_id", "shard", "key")
        gone = self._read("removed").groupBy("doc_id").agg(F.max("batch").alias("until"))
        left = rows.join(gone, "doc_id", "left").filter("until IS NULL OR batch > until")
        return left.select("doc_id", "shard", "key")

    # -- changes

    def insert(self, docs: DataFrame) -> None:
        batch = self.batch + 1
        held = id_text(docs).filter("doc_id IS NOT NULL")
        keys = held.mapInPandas(_keys(self.least), "doc_id bigint, key binary")
        if not self.shards:
            self._write(keys, "unsharded", batch)
            keys = self.spark.read.parquet(f"{self.path}/unsharded/batch={batch}")
            distinct = keys.agg(F.approx_count_distinct("key")).first()[0]
            self.shards = max(8, math.ceil(distinct / SHARD_KEYS))
        shard = F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")
        self._write(keys.withColumn("shard", shard), "postings", batch)
        new = self.spark.read.parquet(f"{self.path}/postings/batch={batch}").groupBy("shard", "key")
        new = new.agg(
            F.count("*").alias("refs"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
        )
        if batch == 0:
            self._write(new, "counts", batch)
            added = self.spark.read.parquet(f"{self.path}/counts/batch={batch}")
            self._write_filters(added.withColumn("added", F.lit(True)), batch)
        else:
            asked = self._lookup(new)
            old = self.counts().select(
                "shard", "key", *(F.col(c).alias(f"old_{c}") for c in ("refs", "first", "last"))
            )
            met = asked.filter("known").join(old, ["shard", "key"], "left")
            met = met.select(
                "shard", "key",
                (F.col("refs") + F.coalesce("old_refs", F.lit(0))).alias("refs"),
                F.least("first", "old_first").alias("first"),
                F.greatest("last", "old_last").alias("last"),
                (F.coalesce("old_refs", F.lit(0)) == 0).alias("added"),
            )
            fresh = asked.filter("NOT known").select(
                "shard", "key", "refs", "first", "last", F.lit(True).alias("added")
            )
            self._write(met.unionByName(fresh), "counts", batch)
            rows = self.spark.read.parquet(f"{self.path}/counts/batch={batch}")
            self._write_filters(rows.filter("added"), batch)
        self._finish("insert", batch)

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents (column doc_id) out; ids that are not in it are ignored."""
        batch = self.batch + 1
        out = doc_ids.select("doc_id").filter("doc_id IS NOT NULL").distinct()
        self._write(out, "removed", batch)
        out = self.spark.read.parquet(f"{self.path}/removed/batch={batch}")
        live = self.postings()
        touched = live.join(out, "doc_id", "left_semi").groupBy("shard", "key").agg(F.count("*").alias("gone"))
        left = live.join(out, "doc_id", "left_anti").join(touched, ["shard", "key"], "left_semi")
        left = left.groupBy("shard", "key").agg(
            F.count("*").alias("refs"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
        )
        counts = touched.select("shard", "key").join(left, ["shard", "key"], "left")
        counts = counts.withColumn("refs", F.coalesce("refs", F.lit(0)))
        self._write(counts.withColumn("added", F.lit(False)), "counts", batch)
        rows = self.spark.read.parquet(f"{self.path}/counts/batch={batch}").filter("refs = 0")
        self._write_filters(rows, batch)
        self._finish("delete", batch)

    # -- filters

    def _hashed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("hash", F.xxhash64(F.lit(1), "key"))

    def _lookup(self, rows: DataFrame) -> DataFrame:
        rows = self._hashed(rows)
        schema = "shard int, key binary, refs long, first long, last long, hash long, known boolean"
        rows = rows.select("shard", "key", "refs", "first", "last", "hash").groupBy("shard")
        return rows.cogroup(self._filters().groupBy("shard")).applyInPandas(_lookup, schema)

    def _filters(self) -> DataFrame:
        return self._read("filters").filter("slots IS NOT NULL").select("shard", "slots")

    def _write_filters(self, changes: DataFrame, batch: int) -> None:
        changes = self._hashed(changes).select("shard", "hash", "added").groupBy("shard")
        if batch == 0:
            before = self.spark.range(0).selectExpr("CAST(id AS int) AS shard", "CAST(NULL AS binary) AS slots")
        else:
            before = self._filters()
        after = changes.cogroup(before.groupBy("shard")).applyInPandas(_update, FILTER)
        self._write(after, "filters", batch)
        if batch == 0:
            return  # made for their keys
        full = self.spark.read.schema(FILTER).parquet(f"{self.path}/filters/batch={batch}")
        full = full.filter("slots IS NULL").select("shard")
        if not full.isEmpty():
            live = self._hashed(self.counts(batch).filter("refs > 0"))
            live = live.join(F.broadcast(full), "shard", "left_semi").select("shard", "hash").groupBy("shard")
            rebuilt = live.applyInPandas(_rebuilt, FILTER)
            rebuilt.write.mode("append").parquet(f"{self.path}/filters/batch={batch}")

    # -- decisions

    def dropped(self) -> DataFrame:
        """doc_id, key of the lines that a smaller document holds too."""
        shared = self.counts().filter("first < last").select("key", "first")
        # Both sides come from files, so a key that many documents share can be split.
        marked = self.postings().select("doc_id", "key").join(shared, "key")
        return marked.filter("doc_id > first").select("doc_id", "key")

    def kept(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the lines that a smaller document of the index holds too.

        All columns of ``docs``, text without those lines, and n_lines (before) and
        n_dropped; columns of these names are replaced.
        """
        rows = docs.drop("n_lines", "n_dropped")
        gone, cleaned = fresh(rows, "gone"), fresh(rows, "cleaned")
        keys = self.dropped().groupBy("doc_id").agg(F.collect_set("key").alias(gone))
        joined = rows.join(keys, "doc_id", "left")
        joined = joined.withColumn(cleaned, _drop_udf(self.least)(F.coalesce("text", F.lit("")), F.col(gone)))
        kept = joined.withColumn("text", F.col(f"{cleaned}.text"))
        return kept.select(*columns(rows), f"{cleaned}.n_lines", f"{cleaned}.n_dropped")


def _drop_udf(least: int):
    inner = _drop_lines(least)

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def drop(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, gone in batches:
            yield from inner(iter([pd.DataFrame({"text": text, "gone": gone})]))

    return drop
