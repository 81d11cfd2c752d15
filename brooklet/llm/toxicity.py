"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: maximal runs of letters, lower-cased, hashed into
``BUCKETS``. Besides a weight per bucket the machine has a short vector per bucket, and
the inner product of two vectors is the weight of their pair: an insult together with a
mention of a group can weigh more than the sum of both.

    score = sigmoid(w0 + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

Fitting: which buckets tell the classes apart is counted over all labelled rows (a G-test
per bucket, ``BUCKETS`` counts at most). Terms may tell nothing alone and much together, so
pairs are tested as well, on about ``SAMPLE_ROWS`` labelled rows picked by a hash of their
id (their number varies by a hundredth or so): those of the ``PAIRED`` most frequent
buckets of these rows, by products of the rows' presence matrix. Both terms of a pair that
tells more than each of them are admitted. The machine itself is fitted by mini-batch
gradient steps in numpy on the same rows. The model is ``SELECTED`` and ``ADMITTED`` buckets
at most, about 170 kB, and goes along with the tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import bounded, id_text, named_text, slices, written

BUCKETS = 1 << 18
SELECTED = 4096
#: Buckets whose pairs are tested, and buckets that pairs admit at most.
PAIRED, ADMITTED = 1024, 256
FACTORS = 8
#: Labelled rows the machine is fitted on, as expected number; with fewer, all of them.
SAMPLE_ROWS = 20_000
#: Least G statistic of a bucket: one in a hundred thousand unrelated buckets exceeds it.
LEAST_G = 19.5
#: That of a pair, beyond twice the larger of its buckets': one in 10^10 unrelated pairs.
LEAST_PAIR_G = 42.0
EPOCHS, ROWS_A_STEP, RATE, DECAY = 60, 256, 0.1, 1e-5
THRESHOLD = 0.7
CACHED_TERMS = 300_000

TERM = re.compile(r"[^\W\d_]+")


def buckets(text: str, known: dict[str, int]) -> set[int]:
    """The hashed terms of a text; ``known`` remembers hashes."""
    out = set()
    for term in set(TERM.findall(text.lower())):
        at = known.get(term)
        if at is None:
            at = known[term] = zlib.crc32(term.encode()) % BUCKETS
        out.add(at)
    if len(known) > CACHED_TERMS:
        known.clear()
    return out


def _hash_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int] = {}
    for batch in slices(batches):
        terms = [sorted(buckets(text, known)) for text in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": terms})


@dataclass(frozen=True)
class Machine:
    """Weights of the selected buckets, in order of ``selected``."""

    selected: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, terms: list[list[int]]) -> np.ndarray:
        """Probability of label 1 for documents given as positions in ``selected``."""
        n = np.array([len(t) for t in terms])
        flat = np.array([i for t in terms for i in t], dtype=np.int64)
        row = np.repeat(np.arange(len(terms)), n)
        linear = np.bincount(row, self.weights[flat], len(terms))
        pairs = np.zeros(len(terms))
        for f in range(self.factors.shape[1]):
            v = self.factors[flat, f]
            pairs += np.bincount(row, v, len(terms)) ** 2 - np.bincount(row, v * v, len(terms))
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -40, 40)))


def fit(selected: np.ndarray, terms: list[list[int]], label: np.ndarray, seed: int = 0) -> Machine:
    """Adagrad on the logistic loss with weight decay. ``terms``: positions in ``selected``."""
    rng = np.random.default_rng(seed)
    rate = label.mean() if len(label) else 0.5
    rate = min(max(float(rate), 1e-3), 1 - 1e-3)
    bias, size = np.log(rate / (1 - rate)), len(selected)
    w, v = np.zeros(size), rng.normal(0, 0.05, (size, FACTORS))
    seen_b, seen_w, seen_v = 1e-6, np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)
    for _ in range(EPOCHS if size else 0):
        order = rng.permutation(len(label))
        for at in range(0, len(order), ROWS_A_STEP):
            rows = order[at : at + ROWS_A_STEP]
            x = np.zeros((len(rows), size))
            for i, r in enumerate(rows):
                x[i, terms[r]] = 1
            sums = x @ v
            y = bias + x @ w + ((sums**2).sum(1) - x @ (v**2).sum(1)) / 2
            slope = (1 / (1 + np.exp(-np.clip(y, -40, 40))) - label[rows]) / len(rows)
            grad_w = x.T @ slope + DECAY * w
            grad_v = x.T @ (slope[:, None] * sums) - (x.T @ slope)[:, None] * v + DECAY * v
            grad_b = slope.sum()
            seen_b, seen_w, seen_v = seen_b + grad_b**2, seen_w + grad_w**2, seen_v + grad_v**2
            bias -= RATE * grad_b / np.sqrt(seen_b)
            w -= RATE * grad_w / np.sqrt(seen_w)
            v -= RATE * grad_v / np.sqrt(seen_v)
    return Machine(selected, float(bias), w, v)


def _g_statistic(with_1: np.ndarray, with_all: np.ndarray, n_1: int, n: int) -> np.ndarray:
    """G of the 2 x 2 tables of bucket against label."""
    cells = [
        (with_1, with_all, n_1), (with_all - with_1, with_all, n - n_1),
        (n_1 - with_1, n - with_all, n_1), (n - with_all - n_1 + with_1, n - with_all, n - n_1),
    ]
    g = np.zeros(len(with_1))
    for seen, row, column in cells:
        expected = row * column / max(n, 1)
        g += np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0)
    return 2 * g


def partners(terms: np.ndarray, starts: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Buckets of pairs that tell the label more than each of their buckets does, the best pairs first.

    ``terms``: the distinct buckets of all rows, one row after another from ``starts`` on, and
    the end. Held at once: two square tables of ``PAIRED`` buckets, and some more of half
    their size, and the presence of these buckets in a thousand rows.
    """
    n, n_1 = len(label), label.sum()
    often = np.bincount(terms, minlength=BUCKETS)
    tested = np.argsort(-often, kind="stable")[:PAIRED]
    tested = tested[(often[tested] >= 5) & (often[tested] < n)]
    if not len(tested):
        return tested
    place = np.full(BUCKETS, -1, np.int32)
    place[tested] = np.arange(len(tested))
    both, both_1 = (np.zeros((len(tested), len(tested)), np.float32) for _ in range(2))
    for at in range(0, n, 1024):
        bounds = starts[at : at + 1025]
        column = place[terms[bounds[0] : bounds[-1]]]
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        x = np.zeros((len(bounds) - 1, len(tested)), np.float32)
        x[row[column >= 0], column[column >= 0]] = 1
        both += x.T @ x
        toxic = x[label[at : at + 1024] > 0]
        both_1 += toxic.T @ toxic
    alone = _g_statistic(both_1.diagonal().astype(float), both.diagonal().astype(float), n_1, n)
    i, j = np.nonzero(np.triu(both, 1) >= 5)
    seen, seen_1 = both[i, j].astype(float), both_1[i, j].astype(float)
    g = _g_statistic(seen_1, seen, n_1, n) - 2 * np.maximum(alone[i], alone[j])
    best = np.argsort(-g, kind="stable")[:ADMITTED]
    best = best[g[best] >= LEAST_PAIR_G]
    found = dict.fromkeys(np.stack([tested[i[best]], tested[j[best]]], 1).ravel().tolist())
    return np.array(list(found)[:ADMITTED], np.int64)


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Machine:
    """A machine fitted on the rows of ``docs`` that have a label in ``labels`` (doc_id, toxic).

    ``usable``, a condition on ``docs``, keeps rows out. Null labels and null ids count for
    nothing; of several labels of a document the largest holds. Without any labelled row
    the machine gives every text one half, without a telling bucket the share of label 1;
    so do empty tables. Buckets and pairs of fewer than five labelled rows are not
    considered. Equal G: the lower bucket first.
    """
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    rows = docs if usable is None else docs.filter(usable)
    labelled = id_text(rows).join(bounded(written(marks, "labels")), "doc_id").select("doc_id", "text", "toxic")
    marked = written(labelled.mapInPandas(_hash_terms, "doc_id bigint, toxic int, terms array<int>"), "labelled")
    n, n_1 = marked.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = marked.select("toxic", F.explode("terms").alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.count("*").alias("n"), F.sum("toxic").alias("n_1")).filter("n >= 5")
    table = counts.toPandas().sort_values("bucket")
    g = _g_statistic(table["n_1"].to_numpy(float), table["n"].to_numpy(float), n_1, n)
    best = np.argsort(-g, kind="stable")[:SELECTED]
    selected = np.sort(table["bucket"].to_numpy()[best[g[best] >= LEAST_G]]).astype(np.int64)

    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    keep = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    sample = marked.filter(keep).toArrow().sort_by("doc_id").combine_chunks()
    if not sample.num_rows:
        return fit(selected, [], np.zeros(0))
    label, lists = sample["toxic"].to_numpy().astype(float), sample["terms"].chunk(0)
    terms, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    selected = np.union1d(selected, partners(terms, starts, label))
    place = np.full(BUCKETS, -1, np.int32)
    place[selected] = np.arange(len(selected))
    chosen = place[terms]
    rows = [chosen[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    return fit(selected, [np.sort(row[row >= 0]).tolist() for row in rows], label)


class Scorer:
    """Scores of texts; remembers which selected bucket a term falls into."""

    def __init__(self, machine: Machine) -> None:
        self.machine = machine
        self.place = {int(b): i for i, b in enumerate(machine.selected)}
        self.known: dict[str, int] = {}

    def positions(self, text: str) -> list[int]:
        found, known = set(), self.known
        for term in set(TERM.findall(text.lower())):
            at = known.get(term)
            if at is None:
                at = known[term] = self.place.get(zlib.crc32(term.encode()) % BUCKETS, -1)
            found.add(at)
        if len(known) > CACHED_TERMS:
            known.clear()
        return sorted(found - {-1})

    def __call__(self, texts: pd.Series) -> np.ndarray:
        return self.machine.score([self.positions(text) for text in texts])


def _score_rows(machine: Machine):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(machine)
        for batch in slices(batches):
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scorer(batch["text"])})

    return score


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs``: doc_id, score, predicted (1 from ``threshold`` on).

    Whole texts of any length; a null text scores as an empty one. An empty table gives
    none. Repeated rows, also of a null
    doc_id, are each returned. Only doc_id and text are looked at.
    """
    scored = named_text(docs).mapInPandas(_score_rows(machine), "doc_id string, score double")
    scored = scored.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under ``threshold``."""

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for texts in batches:
            yield pd.Series(scorer(texts))

    return docs.filter(score_of(F.coalesce("text", F.lit(""))) < threshold)
