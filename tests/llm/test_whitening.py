"""Whitening against numpy on all rows, exact integers against Python's."""

import math
import random

import numpy as np
import pytest
from edge_cases import SF_DIR
from pyspark.sql import functions as F

from brooklet.llm import whitening
from brooklet.llm.queries import op11_whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def expected(rows, k=4):
    """n, deviations by id, absolute whitened coordinates by id, explained shares; rows: (id, vector)."""
    kept = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    fit = sorted({tuple(x) for x in kept.values()})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    deviations = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in kept.items()}
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    z = {i: np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)]) for i, x in kept.items()}
    whitened = {i: np.abs(v @ vectors / np.sqrt(values)) for i, v in z.items()}
    return n, deviations, whitened, values / np.trace(covariance)


def compare(found, rows, key="vec_id"):
    n, deviations, whitened, explained = expected(rows)
    k = len(explained)
    assert len(found) == k * len(rows)
    signs = {}
    for r in found:
        c = r["component"] - 1
        assert r["n"] == n
        assert int(r["deviation"]) == deviations[r[key]]
        assert abs(r["whitened"]) == pytest.approx(whitened[r[key]][c], rel=1e-6, abs=1e-6)
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert r["identity_error"] < 1e-9
        signs.setdefault(c, []).append(r["whitened"])
    # One sign for all rows: the sum over distinct vectors is zero, so both signs occur.
    assert all(min(v) < 0 < max(v) for v in signs.values())


def run(rows, **options):
    model = whitening.fit(rows, **options)
    return whitening.components(whitening.transform(rows, model, **options), model).collect()


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    compare(op11_whitening(spark, SF_DIR).collect(), [(r.vec_id, r.embedding) for r in rows])


def test_left_out_repeated_and_clashing(spark):
    rng = random.Random(2)
    good = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0]]
    rows = spark.createDataFrame([(i, v, None) for i, v in good] + [(500 + i, v, 1) for i, v in enumerate(bad)], SCHEMA)
    rows = rows.withColumns({name: F.lit("other") for name in ("x", "row", "whitened", "n", "deviation", "at")})
    compare(run(rows), good)


def test_signs_are_the_same_in_all_rows(spark):
    rng = random.Random(4)
    good = [(i, [rng.gauss(0, s) for s in (3, 2, 1, 0.5, 0.2)]) for i in range(60)]
    found = run(spark.createDataFrame([(i, v, 0) for i, v in good], SCHEMA).repartition(7))
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in found}
    w = np.array([[by[i, c] for c in range(1, 5)] for i, _ in good])
    assert np.allclose(w.T @ w / len(w) - np.outer(w.mean(0), w.mean(0)), np.eye(4), atol=1e-9)


@pytest.mark.parametrize("offset", [0.0, 1e5, 2.0**40, 1e13])
def test_far_from_zero(spark, offset):
    """A small spread far from zero, and integers beyond a long's squares."""
    rng = random.Random(5)
    good = [(i, [offset + rng.randrange(64) / 256 for _ in range(4)]) for i in range(50)]
    compare(run(spark.createDataFrame([(i, v, 0) for i, v in good], SCHEMA)), good)


def test_wide_spread(spark):
    rng = random.Random(6)
    good = [(i, [rng.uniform(-1e14, 1e14), rng.uniform(-1e14, 1e14)]) for i in range(20)]
    found = run(spark.createDataFrame([(i, v, 0) for i, v in good], SCHEMA))
    deviations = expected(good, 2)[1]
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == deviations


def test_components_without_variance(spark):
    rows = spark.createDataFrame([(i, [i / 8, 1.0, -i / 8], None) for i in range(9)] + [(None, [0.0, 1.0, 0.0], None)], SCHEMA)
    found = run(rows)
    assert len(found) == 30 and {r["component"] for r in found} == {1, 2, 3}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in found)
    assert max(r["identity_error"] for r in found) < 1e-12
    one = run(spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)], SCHEMA))
    assert len(one) == 4 and all(r["whitened"] is None and r["n"] == 1 and r["deviation"] == 0 for r in one)


def test_huge_entries_stand_at_a_longs_end(spark):
    rows = spark.createDataFrame([(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [0.0, 2.0], 0)], SCHEMA)
    found = run(rows)
    assert len(found) == 6
    assert {r["deviation"] for r in found if r["vec_id"] < 3} == {None}


def test_empty_tables(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)]):
        assert run(spark.createDataFrame(rows, SCHEMA)) == []
