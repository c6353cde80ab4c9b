"""Whitening against numpy on the whole fit list."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalogue, whitening

SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int, x array<int>, c string, component int"


def frame(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(i, v, None, [1], "c", 7) for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def brute(vectors):
    """Rows of integers, the fit list, eigenvalues and vectors of its covariance."""
    rows = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, rows))), dtype=object)
    n = len(fit)
    sums = fit.sum(axis=0)
    a = ((n * fit - sums) / n).astype(float)
    e, w = np.linalg.eigh(a.T @ a / n)
    return rows, n, sums, e[::-1], w[:, ::-1]


def check(got, vectors, ids, top):
    rows, n, sums, e, w = brute(vectors)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(vectors) * top and set(by_id) == set(ids)
    for i, row in zip(ids, rows):
        assert sorted(by_id[i]) == list(range(1, top + 1))
        deviation = sum((n * x - s) ** 2 for x, s in zip(row, sums))
        projected = np.array([(n * x - s) / n for x, s in zip(row, sums)], float) @ w[:, :top] / np.sqrt(e[:top])
        for k, r in by_id[i].items():
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert abs(abs(r.whitened) - abs(projected[k - 1])) < 1e-7 and abs(r.explained - e[k - 1] / e.sum()) < 1e-9


def test_random_vectors_equal_numpy(spark):
    dice = np.random.default_rng(3)
    base = dice.normal(size=(300, 20)) * np.linspace(3, 0.2, 20)
    vectors = [v.tolist() for v in base] + [base[0].tolist()] * 90
    ids = list(range(len(vectors)))
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors, ids, 16)


def test_given_vectors_equal_numpy(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    got = catalogue.QUERIES["op11_embedding_whitening"](spark, SMALL).collect()
    check(got, [r.embedding for r in table], [r.vec_id for r in table], 16)


def test_nearly_dependent_dimensions(spark):
    """Singular values over nine orders of magnitude; the covariance itself would lose the small ones."""
    dice = np.random.default_rng(4)
    base = dice.integers(-40, 40, (400, 3)).astype(float)
    big = base[:, 0] * 2.0**25
    vectors = [[b, b + r[1] / 64, r[2] / 64] for b, r in zip(big.tolist(), base.tolist())]
    wide = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id int, embedding array<double>")
    got = whitening.whiten(wide).collect()
    assert {r.component for r in got} == {1, 2, 3} and {r.deviation is None for r in got} >= {True}
    assert max(r.identity_error for r in got) < 1e-4
    white = np.zeros((400, 3))
    for r in got:
        white[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(np.cov(np.unique(white.round(12), axis=0).T, bias=True), np.eye(3), atol=1e-3)


def test_flat_directions_give_no_component(spark):
    dice = np.random.default_rng(5)
    few = [v.tolist() + [0.5] for v in dice.normal(size=(5, 9))]  # 5 distinct rows: 4 directions, one constant entry
    got = whitening.whiten(frame(spark, few)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and max(r.identity_error for r in got) < 1e-9
    check(got, few, list(range(5)), 4)


def test_awkward_rows(spark):
    good = [[0.1 * i, -0.2 * i * i, 0.3] for i in range(6)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1.0, 2.0], [-inf, 0.0, 0.0]]
    ids = [0, 1, 2, 3, 4, None, 10, 11, 12, 13, 14, 15, 16]
    got = whitening.whiten(frame(spark, good + odd, ids)).collect()
    check(got, good, [0, 1, 2, 3, 4, None], 2)
    assert whitening.whiten(frame(spark, odd, range(7))).filter("vec_id <> 15").count() == 0
    assert whitening.whiten(frame(spark, good[:1] * 3, [1, 2, 3])).count() == 0
    assert whitening.whiten(frame(spark, good).limit(0)).count() == 0
    named = frame(spark, good).withColumn("vec_id", F.concat_ws("-", "vec_id", "c"))
    assert whitening.whiten(named).schema["vec_id"].dataType.simpleString() == "string"


@pytest.mark.parametrize("scale", [1, 10**6, 10**12])
def test_deviation_is_exact(scale):
    centre = whitening.Centre(7, (10 * scale, -3 * scale))
    x = np.array([[5 * scale, 2], [0, 0]])
    whole = [sum((7 * int(a) - s) ** 2 for a, s in zip(row, centre.sums)) for row in x]
    assert centre.deviation(x) == [d if d < 2**63 else None for d in whole]
