"""Whitening of embeddings by polarisation of their covariance.

A covariance follows from variances alone: cov(i, j) = (var(i + j) - var(i) - var(j)) / 2.
So one aggregate over the vectors suffices, of exact squared centred values for every
dimension and for the sum of every pair of dimensions. Entries become integers first
(``STEPS`` to one), and all sums stay integers: nothing rounds or cancels before the
covariance matrix is assembled, which is as large as the vectors are wide, whatever the
number of rows. Its eigenvectors are the components.

Values are centred on the floor of their mean, and the rest of the mean, r / n, is taken
out of the totals: n * sum((z - r/n)^2) = n * sum(z^2) - r^2, all of them integers.

Defined results:

* Rows whose vector is null, or holds a null or an entry that is not finite, are left
  out; so are empty vectors, and those with another length than most (of two lengths
  equally common the longer counts).
* Equal vectors count once in the fit, however many rows hold them. The copies are
  gathered in each task before the shuffle, so a vector held by a third of all rows is
  one row a task. Every row that remains, also a repeated one, is transformed.
* Other columns pass through, whatever their names and nulls.
* A table without a vector left gives no rows. A component without variance has null in
  ``whitened`` and is no part of ``identity_error``.
* Entries beyond a long's range stand at its end. ``deviation`` is null beyond 38 digits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from brooklet.llm.common import columns, written

STEPS = 256
#: Integers up to this size are squared and summed over a batch as longs, larger ones as Python's.
SMALL, BATCH = 1 << 22, 4096
LIMB = 32


def exact(vector: Column | str, steps: int = STEPS) -> Column:
    """The entries as integers, floor(``steps`` * entry); null unless all of them are finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * steps))
    return F.when(~bad & (F.size(vector) > 0), whole)


def _matrices(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The vectors of the batch, a few thousand rows at a time."""
    for at in range(0, batch.num_rows, BATCH):
        part = batch.slice(at, BATCH)
        flat = part.column(name).flatten().to_numpy(zero_copy_only=False)
        yield flat.reshape(part.num_rows, -1), part


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min()))


def _sized(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """``x - centre``, as longs where squares of pair sums cannot overflow, else as Python's integers."""
    if _largest(x) < SMALL and abs(centre).max() < SMALL:
        return x - centre.astype(np.int64)
    return x.astype(object) - centre


def _square_sums(z: np.ndarray) -> list[int]:
    """Of every dimension, then of every pair of dimensions: the sum of squares over the rows."""
    sums = list((z * z).sum(axis=0))
    for i in range(z.shape[1] - 1):
        pair = z[:, i + 1 :] + z[:, i : i + 1]
        sums += list((pair * pair).sum(axis=0))
    return [int(s) for s in sums]


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """Place and digits of an integer to the base 2^32, each with its sign."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << LIMB) - 1))
        value, place = value >> LIMB, place + 1


def totals(fit: DataFrame, of: Callable[[np.ndarray], list[int]]) -> list[int]:
    """Exact sums over all vectors of what ``of`` makes of some of them.

    A task sends one row for each number it has; the driver gets one for each number in all.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = defaultdict(int)
        for batch in batches:
            for x, _ in _matrices(batch, "x"):
                for at, value in enumerate(of(x)):
                    found[at] += value
        rows = [(at, *limb) for at, value in found.items() for limb in _limbs(value)]
        if rows:
            names = ["at", "place", "digits"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    parts = fit.select("x").mapInArrow(summed, "at long, place long, digits long")
    sums: dict[int, int] = defaultdict(int)
    for at, place, digits in parts.groupBy("at", "place").agg(F.sum("digits")).collect():
        sums[at] += digits << (LIMB * place)
    return [sums[at] for at in range(max(sums, default=-1) + 1)]


@dataclass
class Whitening:
    """Mean, covariance and components of a set of vectors."""

    n: int
    #: Floor of the mean, and the rest of it in n-ths.
    centre: np.ndarray
    rest: list[int]
    covariance: np.ndarray
    #: By falling eigenvalue; a column of ``components`` each.
    eigenvalues: np.ndarray
    components: np.ndarray
    identity_error: float | None = None

    @property
    def explained(self) -> np.ndarray:
        trace = np.trace(self.covariance)
        return self.eigenvalues / trace if trace > 0 else np.zeros(len(self.eigenvalues))

    @property
    def rank(self) -> int:
        """Number of components with variance, beyond what rounding leaves of none."""
        noise = len(self.eigenvalues) * np.finfo(float).eps * max(self.eigenvalues, default=0.0)
        return int((self.eigenvalues > noise).sum())

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        """The vectors' first ``k`` whitened coordinates, NaN where a component has no variance."""
        kept = min(k, self.rank)
        out = np.full((len(x), k), np.nan)
        z = _sized(x, self.centre).astype(float) - np.array([r / self.n for r in self.rest])
        out[:, :kept] = z @ self.components[:, :kept] / np.sqrt(self.eigenvalues[:kept])
        return out

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum((n * x - S)^2) of each vector, S being the sums of the fit."""
        n, rest = self.n, self.rest
        z = _sized(x, self.centre)
        squares = (z * z).sum(axis=1).tolist()
        small = z.dtype != object and n * len(rest) < 1 << 38
        cross = (z @ np.array(rest, np.int64 if small else object)).tolist()
        fixed = sum(r * r for r in rest)
        return [n * n * a - 2 * n * b + fixed for a, b in zip(squares, cross, strict=True)]


def _width(vectors: DataFrame) -> int | None:
    """The most common length of ``x``, of equally common ones the longer."""
    lengths = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    row = lengths.first()
    return row and row["d"]


def _assemble(n: int, rest: list[int], sums: list[int]) -> np.ndarray:
    """The covariance matrix from sums of squares of dimensions and pair sums, by exact fractions."""
    d = len(rest)
    own = [n * sums[i] - rest[i] ** 2 for i in range(d)]
    matrix, at = np.zeros((d, d)), d
    for i in range(d):
        matrix[i, i] = own[i] / (n * n)
        for j in range(i + 1, d):
            both = n * sums[at] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - own[i] - own[j]) / (2 * n * n)
            at += 1
    return matrix


def _identity_error(fit: DataFrame, model: Whitening, k: int) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity, over the fit itself."""
    kept = min(k, model.rank)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((kept + 1, kept))
        for batch in batches:
            for x, _ in _matrices(batch, "x"):
                w = model.project(x, kept)
                sums += np.vstack([w.sum(axis=0), w.T @ w])
        flat = sums.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int64()), pa.array(flat)], ["at", "value"])

    if not kept:
        return None
    parts = fit.select("x").mapInArrow(moments, "at long, value double")
    found = dict(parts.groupBy("at").agg(F.sum("value")).collect())
    sums = np.array([found[at] for at in range((kept + 1) * kept)]).reshape(kept + 1, kept) / model.n
    return float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(kept)).max())


def fit(rows: DataFrame, vector: str = "embedding", steps: int = STEPS, k: int = 4) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows``; None without any.

    ``identity_error`` is of the first ``k`` components. What the driver holds grows with
    the square of a vector's length only.
    """
    vectors = rows.select(exact(F.col(vector), steps).alias("x")).filter("x IS NOT NULL")
    distinct = written(vectors.distinct(), "vectors")
    width = _width(distinct)
    if width is None:
        return None
    distinct = distinct.filter(F.size("x") == width)

    def counted(x: np.ndarray) -> list[int]:
        whole = x if _largest(x) < SMALL else x.astype(object)
        return [len(x), *(int(s) for s in whole.sum(axis=0))]

    n, *sums = totals(distinct, counted)
    sums += [0] * (width - len(sums))
    centre = np.array([s // n for s in sums], dtype=object)
    rest = [s % n for s in sums]
    squares = totals(distinct, lambda x: _square_sums(_sized(x, centre)))
    squares += [0] * (width * (width + 1) // 2 - len(squares))
    covariance = _assemble(n, rest, squares)
    values, vectors_ = np.linalg.eigh(covariance)
    model = Whitening(n, centre, rest, covariance, values[::-1].clip(0), vectors_[:, ::-1].copy())
    model.identity_error = _identity_error(distinct, model, k)
    return model


def transform(
    rows: DataFrame, model: Whitening | None, vector: str = "embedding", steps: int = STEPS, k: int = 4
) -> DataFrame:
    """Every row with a vector of the model's length: ``row`` (a struct of all columns),
    ``whitened`` (``k`` doubles at most) and ``deviation`` (decimal(38, 0))."""
    k = min(k, len(model.rest)) if model else k

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, part in _matrices(batch, "x"):
                flat = model.project(x, k).ravel()
                offsets = pa.array(np.arange(0, len(flat) + 1, k), pa.int32())
                whitened = pa.ListArray.from_arrays(offsets, pa.array(flat, mask=np.isnan(flat)))
                deviation = pa.array([str(v) for v in model.deviations(x)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), whitened, deviation], ["row", "whitened", "deviation"]
                )

    width = len(model.rest) if model else -1
    held = rows.select(F.struct(*columns(rows)).alias("row"), exact(F.col(vector), steps).alias("x"))
    held = held.filter(F.size("x") == width)
    schema = StructType([
        held.schema["row"],
        StructField("whitened", ArrayType(DoubleType())),
        StructField("deviation", StringType()),
    ])
    out = held.mapInArrow(projected, schema)
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def components(transformed: DataFrame, model: Whitening | None, key: str = "vec_id") -> DataFrame:
    """One row per vector and component: the key, component (from 1), n, deviation, whitened,
    explained, identity_error."""
    explained = [float(e) for e in model.explained] if model else []
    return transformed.select(
        F.col(f"row.`{key}`").alias(key),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        F.posexplode("whitened").alias("place", "whitened"),
    ).select(
        key,
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )
