"""Packing of tokenised documents into sequences by best fit decreasing.

Every document becomes its token ids and one end id, is cut into full windows and a
remainder, and the pieces are placed, longest first, into the open sequence with the
least room that still takes them. A segment tree indexed by remaining capacity finds
that sequence in log2(capacity) steps.

Pieces are dealt evenly over tasks of ``GROUP`` pieces, each of which packs its own:
best fit leaves little room after some hundred pieces, so what a split costs is at most
one badly filled sequence in thousands. Memory of a task is bounded by ``GROUP``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brooklet.llm.byte_bpe import encoder
from brooklet.llm.common import columns, named_text, slices, written

CAPACITY = 1024
END_ID = 0
GROUP = 16_384


class OpenSequences:
    """Open sequences by their remaining capacity, in a segment tree of counts."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.tree[at] += n
            at >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The room and number of the tightest open sequence with ``length`` free."""
        tree, at = self.tree, length + self.leaves
        while not tree[at]:
            while at & 1:  # a right child: go on above it
                at >>= 1
                if not at:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces of equal length in given order."""
    lengths = np.asarray(lengths, dtype=np.int64)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, made = OpenSequences(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        room, number = rooms.take(length) or (capacity, made)
        made += number == made
        sequence[i], offset[i] = number, capacity - room
        if room > length:
            rooms.put(room - length, number)
    return sequence, offset


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([end_id], dtype="<u4")
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.concatenate([encoder(path).ids(text), end])
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pd.DataFrame(rows, columns=names[: 5 + with_ids])

    return cut


PIECE = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """The documents' tokens and end id in pieces of ``capacity`` and a remainder.

    With ``with_ids`` each row carries its token ids. A null text gives the end id only.
    """
    schema = PIECE + (", ids array<int>" if with_ids else "")
    pieces = named_text(docs).mapInPandas(_cut(tokenizer, capacity, end_id, with_ids), schema)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _pack(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(part.num_rows for part in parts):
            return
        rows = pa.Table.from_batches(parts)
        sequence, offset = best_fit_decreasing(rows["length"].to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 32
        rows = rows.drop_columns(["length"])
        rows = rows.append_column("sequence_id", pa.array(first + sequence))
        yield from rows.append_column("offset", pa.array(offset)).to_batches()

    return pack


def _packed_schema(pieces: DataFrame) -> StructType:
    fields = [StructField("piece", pieces.schema), StructField("sequence_id", LongType())]
    return StructType([*fields, StructField("offset", LongType())])


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (any columns, with ``length`` at most ``capacity``) with sequence_id and offset.

    The pieces of a sequence lie side by side from offset 0. ``pieces`` is counted and
    read again, so it should be cheap or written.
    """
    tasks = max(1, math.ceil(pieces.count() / group))
    names = columns(pieces)
    dealt = pieces.select(F.struct(*names).alias("piece"), "length").repartition(tasks)
    packed = dealt.mapInArrow(_pack(capacity), _packed_schema(pieces))
    return packed.select("piece.*", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, [ids], sequence_id, offset.

    Repeated rows, also of a null doc_id, are documents of their own. Other columns of
    ``docs`` are not looked at; an empty table gives no piece.
    """
    pieces = written(cut_pieces(docs, tokenizer, capacity, with_ids=with_ids), "pieces")
    return pack(pieces, capacity)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences, tokens and padding, a sequence whose length is a power of two needing none."""
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    power = F.bit_count("filled") == 1
    pad = F.when(power, 0).otherwise(capacity - F.col("filled"))
    return filled.agg(
        F.count("*").alias("sequences"), F.sum("filled").alias("tokens"), F.sum(pad).alias("padding")
    )
