"""Packing of tokenised documents into as few sequences as possible, by bin completion.

Every document becomes its token ids and one end id; only one longer than a sequence is
cut, into full sequences after a shorter first piece. The pieces are placed by branch
and bound over whole sequences: around the largest piece left, the fillings of the rest
of its sequence are enumerated, fullest first. A filling is dominated, and skipped, if
some pieces of it (or none) could be replaced by one piece left outside that is at least
as long and still fits. A branch ends when the room it has wasted, and what the pieces
left must waste at least, leave no packing with fewer sequences than the best one known.
That one is a best-fit-decreasing packing at first, and again one of the pieces left
wherever a branch ends; the search ends when it meets the lower bound.

The search takes ``NODES`` steps in a task at most and then keeps the best packing found;
finding the least number is NP-hard. Few tasks need any: see ``Search.solve``.

Pieces are dealt over tasks of ``GROUP`` pieces. Each task can waste most of one sequence,
so the emptiest sequences of all tasks are opened and packed again together, level by
level, each with at most an eighth of the pieces before, until one task holds them all.
A level that does not save sequences changes nothing.

Defined results: a null or empty text is its end id alone. Repeated rows, also of a null
doc_id, are documents of their own. A very long text is encoded whole and its pieces leave
the task one after another. Equal lengths keep their given order. Other columns are not
looked at; an empty table gives no piece.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brooklet.llm.byte_bpe import encoder
from brooklet.llm.common import columns, named_text, slices, written

CAPACITY = 2048
END_ID = 0
#: Pieces packed by one task.
GROUP = 16_384
#: Steps of a task's search.
NODES = 100_000
#: Sequences that a task opens for the next level, and the part of its pieces they may hold.
OPENED, OPENED_PART = 64, 8

Bin = list[int]


def best_fit_decreasing(counts: Sequence[int], capacity: int) -> list[Bin]:
    """Bins of lengths; ``counts[n]`` pieces have length n. The open rooms are bits of one integer."""
    bins: list[Bin] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for length in range(len(counts) - 1, 0, -1):
        for _ in range(counts[length]):
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                at = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, at = capacity, len(bins)
                bins.append([])
            bins[at].append(length)
            if room > length:
                by_room[room - length].append(at)
                rooms |= 1 << (room - length)
    return bins


def least_waste(counts: Sequence[int], capacity: int) -> int:
    """Room that any packing of these pieces wastes in sequences of its largest pieces.

    From the largest piece down: the room beside it can be filled by pieces no larger than
    that room only. Each shorter piece is granted once, to the largest piece that can use it,
    and what it does not use is handed on, so the bound holds for every packing.
    """
    waste = carried = 0
    low = 0
    for length in range(len(counts) - 1, 0, -1):
        room = capacity - length
        if room >= length:
            break
        n = counts[length]
        if not n:
            continue
        for size in range(low + 1, room + 1):
            carried += size * counts[size]
        low = max(low, room)
        wanted = n * room
        if carried < wanted:
            waste += wanted - carried
            carried = 0
        else:
            carried -= wanted
    return waste


def least_bins(counts: Sequence[int], capacity: int) -> int:
    total = sum(n * c for n, c in enumerate(counts))
    return math.ceil((total + least_waste(counts, capacity)) / capacity)


def _spread(bits: int, by: int) -> int:
    """Every bit of ``bits`` and the ``by`` places above it."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        bits |= bits << step
        done += step
    return bits


def is_dominated(filling: Sequence[int], slack: int, left: int) -> bool:
    """Whether one length of ``left`` (bits) can take the place of some, or none, of ``filling``.

    It has to be as long as what it replaces, or longer by ``slack`` at most, and not the
    same single length again. Such an exchange never makes a packing worse.
    """
    one, more = 0, 0  # sums of one piece, of several
    for n in filling:
        more |= (more | one) << n
        one |= 1 << n
    longer = _spread((one | 1) << 1, slack - 1) if slack else 0
    return bool((longer | _spread(more, slack)) & left)


class Search:
    """Branch and bound over completions of the largest piece's bin."""

    def __init__(self, lengths: Iterable[int], capacity: int, nodes: int = NODES) -> None:
        self.capacity, self.nodes = capacity, nodes
        self.counts = np.bincount(np.fromiter(lengths, np.int64), minlength=capacity + 1).tolist()
        #: Lengths that are left as bits, and mirrored: bit capacity - n for length n.
        self.left = self.mirrored = 0
        for n in range(1, capacity + 1):
            if self.counts[n]:
                self._mark(n)
        self.total = sum(n * c for n, c in enumerate(self.counts))

    def _mark(self, n: int) -> None:
        self.left |= 1 << n
        self.mirrored |= 1 << (self.capacity - n)

    def _take(self, n: int) -> None:
        self.counts[n] -= 1
        self.total -= n
        if not self.counts[n]:
            self.left &= ~(1 << n)
            self.mirrored &= ~(1 << (self.capacity - n))

    def _put(self, n: int) -> None:
        if not self.counts[n]:
            self._mark(n)
        self.counts[n] += 1
        self.total += n

    def _total_of(self, lengths: int) -> int:
        total = 0
        while lengths:
            n = lengths.bit_length() - 1
            lengths ^= 1 << n
            total += n * self.counts[n]
        return total

    def _sums(self, target: int, largest: int, steps: list[int]) -> Iterator[Bin]:
        """Lengths left, none above ``largest`` and not increasing, that add up to ``target``."""
        if target == 0:
            yield []
            return
        if target <= largest and self.left >> target & 1:
            yield [target]
        # Pairs at once: lengths n for which target - n is left too.
        below = min(largest, target - 1)
        pairs = self.left & (self.mirrored >> (self.capacity - target))
        pairs &= (1 << (below + 1)) - (1 << ((target + 1) // 2)) if below >= (target + 1) // 2 else 0
        while pairs:
            n = pairs.bit_length() - 1
            pairs ^= 1 << n
            if 2 * n != target or self.counts[n] > 1:
                yield [n, target - n]
        # Three and more: the largest first, the rest likewise.
        firsts = self.left & ((1 << (below + 1)) - 1)
        enough = self._total_of(firsts)
        while firsts and enough >= target and steps[0] > 0:
            n = firsts.bit_length() - 1
            firsts ^= 1 << n
            enough -= n * self.counts[n]
            steps[0] -= 1
            self._take(n)
            for rest in self._sums(target - n, min(n, target - n), steps):
                if len(rest) > 1:
                    self._put(n)
                    yield [n, *rest]
                    self._take(n)
            self._put(n)

    def fillings(self, room: int, waste: int, steps: list[int]) -> Iterator[Bin]:
        """Undominated fillings of ``room`` that leave ``waste`` free at most, fullest first."""
        if self.left >> room & 1:  # one piece that fills it dominates every other filling
            yield [room]
            return
        for slack in range(min(room, waste) + 1):
            for filling in self._sums(room - slack, room - slack, steps):
                for n in filling:
                    self._take(n)
                left = self.left
                for n in filling:
                    self._put(n)
                if not is_dominated(filling, slack, left):
                    yield filling
            if steps[0] <= 0:
                return

    def solve(self, known: list[Bin] | None = None) -> list[Bin]:
        """The packing with the fewest bins found; ``known`` is one to begin with.

        Best fit decreasing comes first, and mostly meets the lower bound already.
        """
        capacity = self.capacity
        best = best_fit_decreasing(self.counts, capacity)
        if known is not None and len(known) <= len(best):
            best = known
        bound = least_bins(self.counts, capacity)
        steps = [self.nodes]
        bins: list[Bin] = []
        branches: list[Iterator[Bin]] = []

        def down() -> None:
            """Branch on the largest piece left, or end this branch."""
            nonlocal best
            if not self.total:
                if len(bins) < len(best):
                    best = [list(b) for b in bins]
                branches.append(iter(()))
                return
            # Room that may be wasted if one bin is to be saved.
            spare = (len(best) - 1 - len(bins)) * capacity - self.total
            if spare < 0 or least_waste(self.counts, capacity) > spare:
                rest = best_fit_decreasing(self.counts, capacity)
                if len(bins) + len(rest) < len(best):
                    best = [list(b) for b in bins] + rest
                branches.append(iter(()))
                return
            largest = self.left.bit_length() - 1
            self._take(largest)
            bins.append([largest])
            branches.append(self.fillings(capacity - largest, spare, steps))

        if len(best) > bound:
            down()
        while branches and len(best) > bound and steps[0] > 0:
            steps[0] -= 1
            # The branch on top belongs to the last bin, which holds its largest piece and a filling.
            level = len(branches)
            if level <= len(bins):
                self._refill(bins[level - 1], [])
            filling = next(branches[-1], None) if level <= len(bins) else None
            if filling is None:
                branches.pop()
                if level <= len(bins):
                    self._put(bins.pop()[0])
                continue
            self._refill(bins[-1], filling)
            down()
        return best

    def _refill(self, held: Bin, filling: Bin) -> None:
        """Empty a bin down to its largest piece and fill it anew."""
        for n in held[1:]:
            self._put(n)
        for n in filling:
            self._take(n)
        held[1:] = filling


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "ids"]
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encoder(path).ids(text), np.uint32(end_id)).astype("<u4", copy=False)
                start, first = 0, len(ids) % capacity or capacity
                for piece in range(math.ceil(len(ids) / capacity)):
                    part = ids[start : first + piece * capacity]
                    row = (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    rows.append((*row, part.astype(np.int64)) if with_ids else row)
                    start += len(part)
            yield pd.DataFrame(rows, columns=names[: 6 + with_ids])

    return cut


PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """The documents' tokens and end id, the longer ones in full pieces after a first one that fills up.

    With ``with_ids`` each row carries its token ids.
    """
    schema = PIECE + (", ids array<long>" if with_ids else "")
    pieces = named_text(docs).mapInPandas(_cut(tokenizer, capacity, end_id, with_ids), schema)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _place(lengths: np.ndarray, bins: list[Bin]) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; pieces of one length are given out in their order."""
    in_bins = np.array([n for b in bins for n in b], np.int64)
    sizes = np.array([len(b) for b in bins], np.int64)
    number = np.repeat(np.arange(len(bins)), sizes)
    before = np.cumsum(in_bins) - in_bins
    offsets = before - np.repeat(before[np.cumsum(sizes) - sizes], sizes)
    place = np.empty(len(lengths), np.int64)
    place[np.argsort(lengths, kind="stable")] = np.argsort(in_bins, kind="stable")
    return number[place], offsets[place]


def _opened(filled: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The emptiest bins, not the full ones; their pieces are a small part of all."""
    order = np.argsort(filled, kind="stable")[:OPENED]
    order = order[filled[order] < capacity]
    return order[np.cumsum(sizes[order]) <= sizes.sum() // OPENED_PART]


def _pack(capacity: int, nodes: int, level: int):
    """One task's pieces: ``sequence_id``, ``offset``, and whether the next level ``open``s the sequence."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [part for part in batches if part.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        lengths = rows["length"].to_numpy()
        known, number = None, None
        if "sequence_id" in rows.column_names:
            _, number = np.unique(rows["sequence_id"].to_numpy(), return_inverse=True)
            order = np.argsort(number, kind="stable")
            known = [b.tolist() for b in np.split(lengths[order], np.cumsum(np.bincount(number))[:-1])]
        bins = Search(lengths, capacity, nodes).solve(known)
        at, offset = _place(lengths, bins)
        filled = np.bincount(at, lengths, len(bins)).astype(np.int64)
        reopened = np.zeros(len(bins), bool)
        reopened[_opened(filled, np.bincount(at, minlength=len(bins)), capacity)] = True
        first = (level << 58) + (TaskContext.get().partitionId() << 32)
        out = pa.Table.from_arrays(
            [rows["piece"], rows["length"], pa.array(first + at), pa.array(offset), pa.array(reopened[at])],
            ["piece", "length", "sequence_id", "offset", "open"],
        )
        yield from out.to_batches()

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, nodes: int = NODES) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with sequence_id and offset.

    The pieces of a sequence lie side by side from offset 0. ``pieces`` is counted and
    read again, so it should be cheap or written.
    """
    names = columns(pieces)
    rows = pieces.select(F.struct(*names).alias("piece"), "length")
    fields = [rows.schema["piece"], StructField("length", LongType()), StructField("sequence_id", LongType())]
    schema = StructType([*fields, StructField("offset", LongType())]).add("open", "boolean")
    tasks = max(1, math.ceil(pieces.count() / group))
    dealt = rows.repartition(tasks)
    done, level = [], 0
    while True:
        packed = written(dealt.mapInArrow(_pack(capacity, nodes, level), schema), f"packed-{level}")
        # Sequences that stay as they are; the others go to the next level.
        done.append(packed if tasks == 1 else packed.filter(~F.col("open")))
        if tasks == 1:
            break
        opened = packed.filter("open").select("piece", "length", "sequence_id")
        tasks, level = max(1, math.ceil(opened.count() / group)), level + 1
        dealt = opened.repartition(tasks, "sequence_id")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("piece.*", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True, nodes: int = NODES
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, doc_tokens, [ids], sequence_id, offset."""
    pieces = written(cut_pieces(docs, tokenizer, capacity, with_ids=with_ids), "completion")
    return pack(pieces, capacity, nodes=nodes)


def summary(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences, tokens, and the sequences that the tokens need at least."""
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    least = F.ceil(F.sum("filled") / capacity)
    return filled.agg(F.count("*").alias("sequences"), F.sum("filled").alias("tokens"), least.alias("least"))
