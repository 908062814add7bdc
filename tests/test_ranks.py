import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyloom.operators.bootstrap import median_interval, values_at
from surveyloom.operators.ranks import cells, value_counts, value_profile

numbers = st.one_of(
    st.none(),
    st.floats(-1e12, 1e12, allow_nan=False),
    st.sampled_from([0.0, -0.0, 1e-300, -1e-300, 1e300, 3500.5, 3500.5, 7001.0]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), numbers), max_size=60))
def test_profile_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in value_profile(df, ["g"], "v").collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        known = [v for v in values if v is not None]
        assert (got[g]["n"], got[g]["n_value"]) == (len(values), len(known))
        if known:
            assert math.isclose(got[g]["median"], np.median(known), rel_tol=1e-12, abs_tol=1e-290)
            assert math.isclose(got[g]["mean"], np.mean(known), rel_tol=1e-9, abs_tol=1e-3)
        else:
            assert got[g]["median"] is None and got[g]["mean"] is None


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.975, 1.0])
def test_other_quantiles(spark, q):
    df = spark.range(1001).select(F.lit("x").alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    values = [(i * 7919) % 1009 for i in range(1001)]
    assert value_profile(df, ["g"], "v", q).first()["median"] == pytest.approx(np.quantile(values, q))


def test_one_group_holds_most_rows(spark):
    """A third and more of the rows in one group, half of them one value: still exact."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 10 < 8, "quente").otherwise(F.col("id").cast("string")).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(5000.0)).otherwise(F.col("id") * 1.0).alias("v"),
    )
    got = value_profile(df, ["g"], "v").filter("g = 'quente'").first()
    values = [5000.0 if i % 2 == 0 else float(i) for i in range(60000) if i % 10 < 8]
    assert (got["n"], got["median"]) == (len(values), float(np.median(values)))


def test_cells_and_parts_keep_the_order(spark):
    """Next to every power of two, at zero, among subnormals, infinities and NaN."""
    powers = np.array([math.ldexp(1.0, e) for e in range(-1074, 1024)])
    near = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), [0.0, 1.1, 3500.5, np.inf]])
    values = np.unique(np.concatenate([-near, near]))
    df = spark.createDataFrame([("g", float(x)) for x in values] + [("g", math.nan)], "g string, v double")
    got = sorted(value_counts(df, ["g"], "v").collect(), key=lambda r: (math.isnan(r["_value"]), r["_value"]))
    bits = np.abs(values).view(np.int64) * np.where(values < 0, -1, 1)
    assert [r["_value"] for r in got[:-1]] == values.tolist()
    assert [(r["_cell"] << 22) + r["_part"] for r in got[:-1]] == (bits >> 20).tolist()
    assert (got[-1]["_cell"], got[-1]["_part"]) >= (got[-2]["_cell"], got[-2]["_part"])


@pytest.mark.parametrize("value", ["id / 2e8D", "1.7e15D + id * 1e4D", "-1e300D - id * 1e290D", "id * 5e-324D"])
def test_narrow_ranges_spread_over_parts(spark, value):
    """Values that agree in their leading digits are still spread, and exact."""
    df = spark.range(20001).selectExpr("'x' AS g", f"{value} AS v")
    held = [r["count"] for r in value_counts(df, ["g"], "v").groupBy("_cell", "_part").count().collect()]
    known = np.array([r["v"] for r in df.select("v").collect()])
    assert value_profile(df, ["g"], "v").first()["median"] == np.median(known)
    assert max(held) <= 2**20 and (len(held) > 100 or "5e-324" in value)


def test_infinite_median(spark):
    df = spark.createDataFrame([("a", math.inf), ("a", math.inf), ("a", 1.0), ("b", -math.inf)], "g string, v double")
    got = {r["g"]: r["median"] for r in value_profile(df, ["g"], "v").collect()}
    assert got == {"a": math.inf, "b": -math.inf}


def test_sums_ride_along(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", None, 3), ("b", None, 4)], "g string, v double, k int")
    got = {r["g"]: r for r in value_profile(df, ["g"], "v", sums={"total": F.sum("k")}).collect()}
    assert (got["a"]["total"], got["a"]["median"], got["b"]["total"], got["b"]["n_value"]) == (5, 1.0, 4, 0)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(7)
    bands = np.array([1501, 3501, 5001, 7001, 10001, 14001, 18001], float)
    return {
        "n9": rng.choice(bands, 9), "n16": rng.choice(bands, 16), "n33": rng.choice(bands, 33),
        "even": np.arange(40.0), "odd": np.arange(41.0), "one": np.array([5.0]), "two": np.array([1.0, 2.0]),
    }


def test_interval_matches_row_resampling(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in median_interval(df, ["g"], "v", 100000, 11).collect()}
    rng = np.random.default_rng(3)
    for g, values in groups.items():
        medians = np.median(rng.choice(values, size=(100000, len(values))), axis=1)
        low, high = np.percentile(medians, [2.5, 97.5])
        # resampled medians are discrete, so both methods land on the same or a neighbouring value
        step = np.max(np.diff(np.unique(values))) if len(set(values)) > 1 else 0
        slack = 0.5 if g in ("even", "odd", "one", "two") else step / 2
        assert got[g]["n"] == len(values)
        assert abs(got[g]["mediana"] - np.median(values)) <= 0.5
        assert abs(got[g]["ic_baixo"] - low) <= 0.5 + slack, g
        assert abs(got[g]["ic_alto"] - high) <= 0.5 + slack, g


def test_interval_does_not_depend_on_partitioning(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double")
    runs = [
        sorted(median_interval(part, ["g"], "v", 500, 43).collect())
        for part in (df.repartition(1), df.repartition(7), df.repartition(3, "v"))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_counted_values_are_never_gathered_on_the_driver(spark, tmp_path):
    """Values that lie in a small file, however many they are, meet the wanted cells by key."""
    path = str(tmp_path / "packed")
    spark.range(20000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS v").write.parquet(path)
    for found in (value_profile(spark.read.parquet(path), ["g"], "v"),
                  values_at(c := value_counts(spark.read.parquet(path), ["g"], "v"), cells(c, ["g"]),
                            spark.createDataFrame([(0, 7), (1, 1)], "g long, _at long"), ["g"])):
        found.collect()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == [(0, 7, 18.0), (1, 1, 1.0)]
