import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import whitening


def fitted(rows):
    """(vec_id, whole numbers) of the rows that take part, padded to the longest."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v in kept), default=0)
    return [(i, [min(max(math.floor(1024 * x), -(1 << 61)), 1 << 61) + 100_000 for x in v] + [100_000] * (dims - len(v)))
            for i, v in kept]


def rows(n=300, dims=12):
    rng = np.random.default_rng(7)
    mixed = rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims))
    return [(i, v.tolist()) for i, v in enumerate(mixed)] + [
        (None, [0.5] * dims), (3, [0.25] * dims), (3, [0.25] * dims), (400, None), (401, [float("nan")] * dims),
        (402, [1.0, None]), (403, [float("inf")]), (404, []), (405, [-0.0] * dims), (406, [1.0, -2.0])]


@pytest.mark.parametrize("block", [1 << 14, 64, 7])
def test_against_whole_numbers(spark, block):
    df = spark.createDataFrame(rows(), "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("n", "component", "whitened", "deviation")})
    got = whitening.whiten(df, block_rows=block).collect()
    fit = fitted(rows())
    n, sums = len(fit), [sum(c) for c in zip(*(x for _, x in fit))]
    x = np.array([x for _, x in fit], float)
    v = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    want = sorted((str(i), sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in fit for _ in range(8))
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got) == want
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    projected = (x - np.array(sums) / n) @ vectors / np.sqrt(values)
    for c in range(8):
        own = sorted((str(r["vec_id"]), abs(r["whitened"]), r["explained"]) for r in got if r["component"] == c + 1)
        other = sorted((str(i), abs(p)) for (i, _), p in zip(fit, projected[:, c]))
        assert [o[0] for o in own] == [o[0] for o in other]
        assert np.allclose([o[1] for o in own], [o[1] for o in other], atol=1e-8)
        assert np.allclose([o[2] for o in own], values[c] / np.trace(v), rtol=1e-9)
    assert any(r["vec_id"] is None for r in got)


@pytest.mark.parametrize("high", [2, 1 << 12, 1 << 40, 1 << 61])
def test_bit_planes_give_exact_products(high):
    x = np.random.default_rng(high % 97).integers(-high, high, (131, 5))
    x[:, 2] = 7  # a dimension without planes
    sums, cross = whitening.cross_products(x)
    exact = x.astype(object)
    assert list(sums) == list(exact.sum(axis=0)) and (cross == exact.T @ exact).all()


def test_limbs_add_up():
    values = [0, 1, -1, (1 << 150) + 12345, -(1 << 150) - 77]
    columns = [c.to_pylist() for c in whitening.limbs(values)]
    assert [sum(c[i] << 32 * k for k, c in enumerate(columns)) for i in range(5)] == values


def test_directions_without_variance(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert len(got) == 27 and all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert got[0]["identity_error"] < 1e-9 and max(r["explained"] for r in got) == pytest.approx(1)


def test_components_beyond_machine_words(spark):
    big = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [1e12, 3.0])]
    got = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 6 and {r["deviation"] for r in got if r["vec_id"] < 2} == {2**63 - 1}
    fit = fitted(big)
    sums = [sum(c) for c in zip(*(x for _, x in fit))]
    top = [Fraction(3 * x[0] - sums[0], 1) for _, x in fit]
    e = float(sum(t * t for t in top) / 27)
    for r in got:
        if r["component"] == 1:
            assert abs(r["whitened"]) == pytest.approx(abs(float(top[r["vec_id"]]) / 3 / math.sqrt(e)), rel=1e-6)


@pytest.mark.parametrize("few", [[], [(1, None)], [(1, [])], [(1, [float("nan")])]])
def test_no_vectors(spark, few):
    got = whitening.whiten(spark.createDataFrame(few, "vec_id long, embedding array<double>"))
    assert got.count() == 0 and got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double")]


def test_one_vector(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], "vec_id long, embedding array<double>")).collect()
    assert [(r["deviation"], r["whitened"], r["explained"]) for r in got] == [(0, None, None)] * 2
