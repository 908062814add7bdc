import math

import pytest
from pyspark.sql import functions as F

from surveyloom.llm import topk


def brute(rows, k):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in usable if i % 20 == 0}:
        found = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q))[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(found, 1)}
    return out


def rows(n=150):
    some = [(i, [math.sin(i * j) if (i + j) % 3 else 0.0 for j in range(6)]) for i in range(n)]
    return some + [(200 + i, [0.5, 0.5, 0.5, 0.0, 0.0, 0.0]) for i in range(60)] + [
        (300, None), (301, [float("nan")] * 6), (302, [1.0, None]), (303, [float("inf")]), (None, [1.0] * 6), (304, []),
        (305, [1.0]), (340, [0.0] * 6), (5, [0.25] * 6), (400, [1e6, -1e6]), (420, [0.1] * 9)]


@pytest.mark.parametrize("k", [3, 20, 1000])
@pytest.mark.parametrize("groups", [1, 3])
def test_against_all_pairs(spark, monkeypatch, k, groups):
    monkeypatch.setattr(topk, "GROUPS", groups)  # with one, all blocks stream past each block of queries
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "QUERY_TILE", 3)
    df = spark.createDataFrame(rows(), "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect()}
    assert got == brute(rows(), k)


def test_components_too_large_for_machine_words(spark):
    big = [(0, [1e9, 1.0]), (1, [1e8, 1e8]), (2, [1e8, 1e8 + 2]), (3, [-1e9, 0.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = [r for r in topk.top_k(df, F.col("vec_id") == 0, 3).orderBy("rank").collect()]
    assert [r["vec_id"] for r in got] == [2, 1, 3]
    assert got[0]["score"] == min(2**63 - 1, 64 * 64 * (10**17 + 10**8 + 2))


def test_small_and_large_scores_meet_in_one_stream(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 2)
    monkeypatch.setattr(topk, "GROUPS", 1)
    data = [(0, [1e9, 1.0])] + [(i, [float(i % 7), 0.5]) for i in range(1, 30)] + [
        (40, [1e8, 1e8]), (41, [1e8, 1e8 + 2]), (42, [1e8, 1e8])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in topk.top_k(df, F.col("vec_id") == 0, 6).orderBy("rank").collect()]
    assert got == [41, 40, 42, 6, 13, 20]


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
