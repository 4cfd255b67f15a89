import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import whitening
from tests.llm.helpers import SF

RNG = np.random.default_rng(3)
MATRICES = {
    "spread": np.cov(RNG.standard_normal((40, 900))), "equal": 3.0 * np.eye(20), "rank 3": (lambda q: q @ q.T)(RNG.standard_normal((30, 3))),
    "one": np.array([[2.0]]), "steps": np.diag(np.arange(40.0)), "close": np.diag([5.0] * 20 + [4.999999] * 10 + [1.0] * 10),
    "wide": np.diag(10.0 ** np.arange(6, -6, -1)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_inertia_counts_and_intervals(name):
    matrix = MATRICES[name]
    e = np.linalg.eigvalsh(matrix)[::-1]
    for shift in RNG.uniform(-1, 1.1 * e[0], 25):
        assert whitening.above(matrix, shift) == (e > shift).sum()
    wanted = min(16, int((e > 1e-9).sum()))
    parts = whitening.intervals(matrix, wanted)
    assert sum(p.count for p in parts) >= wanted and all(p.count == ((e > p.low) & (e <= p.high)).sum() for p in parts)


@pytest.mark.parametrize("name", MATRICES)
def test_pairs_are_those_of_the_matrix(spark, name):
    matrix = MATRICES[name]
    e = np.linalg.eigvalsh(matrix)[::-1]
    wanted = min(16, int((e > 1e-9).sum()))
    values, vectors = whitening.feast(spark, matrix, wanted)
    assert np.abs(values - e[:wanted]).max() <= 1e-13 * e[0]
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() <= 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * e[0]


def expected(rows, components=16):
    """Everything by plain Python and a dense solver."""
    held = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in held})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return held, n, sums, e, u, v


def check(rows, found, components=16):
    held, n, sums, e, u, v = expected(rows, components)
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], []).append(r)
    # repeated ids: as many rows for each
    assert len(found) == len(held) * len(e)
    for i, x in held:
        own = [r for r in by[i] if r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums))]
        assert {r["component"] for r in own} == set(range(1, len(e) + 1))
        for r in own:
            k = r["component"] - 1
            assert r["n"] == n and abs(r["explained"] / (e[k] / np.trace(v)) - 1) < 1e-9 and r["identity_error"] < 1e-9
            want = np.array([c - s / n for c, s in zip(x, sums)]) @ u[:, k] / e[k] ** 0.5
            assert abs(abs(r["whitened"]) - abs(want)) < 1e-6
    return {(r["component"], r["eigenvalue"], r["identity_error"]) for r in found}


def test_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert len(check(rows, whitening.op13_whitening(spark, SF).collect())) == 16


def test_copies_nulls_and_odd_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.standard_normal((60, 5)) * [9, 5, 3, 1, 0.5])]
    rows += [(100 + i, rows[0][1]) for i in range(500)] + [rows[3], (None, rows[4][1])]
    bad = [(700, None), (701, []), (702, [1.0, None, 0.0, 0.0, 0.0]), (703, [math.nan] * 5), (704, [math.inf, 0.0, 0.0, 0.0, 0.0]), (705, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect() if r["vec_id"] not in range(700, 706)]
    df = df.withColumns({c: F.lit("x") for c in ("x", "n", "i", "v", "size", "count", "component", "_one")}).repartition(5)
    found = whitening.whitened(df).collect()
    assert {c for c, _, _ in check(rows, found)} == {1, 2, 3, 4, 5}
    assert {r["vec_id"] for r in found if r["vec_id"] and r["vec_id"] >= 700} == set()
    again = whitening.whitened(df.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found)) or check(rows, again)


def test_without_rows_or_variance(spark):
    some = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whitened(some).collect() == [] and whitening.whitened(some.limit(0)).collect() == []
    constant = spark.createDataFrame([(1, [1.0, 2.0, 7.0]), (2, [3.0, 2.0, 7.0]), (3, [9.0, 2.0, 7.0])], "vec_id long, embedding array<float>")
    assert {r["component"] for r in whitening.whitened(constant).collect()} == {1}


def test_far_entries_keep_exact_moments(spark):
    values = [[1e30, 0.0], [-1e30, 1.0], [5.0, 2.0], [2.0**30, -3.0]]
    fit = whitening.distinct(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "vec_id long, embedding array<double>"))
    x = [[max(-whitening.BOUND, min(whitening.BOUND, math.floor(64 * c))) + 1_000_000 for c in v] for v in values]
    found, n = whitening.moments(fit), len(x)
    assert found.n == n and found.sums == [sum(c) for c in zip(*x)]
    for i in range(2):
        for j in range(2):
            exact = sum((n * a[i] - found.sums[i]) * (n * a[j] - found.sums[j]) for a in x) / n**3
            assert abs(found.covariance[i, j] - exact) <= 1e-15 * abs(exact)
    far = whitening.Whitening(found, np.ones(1), np.eye(2)[:, :1])
    assert None in far.deviation(np.array(x))
