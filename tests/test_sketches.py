"""Sketches against exact figures: stored states merge, and errors stay within what is stated."""

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import sketches
from surveyloom.sources.folders import new_path


@pytest.mark.parametrize("value", ["id", "pow(id, 4)", "exp(rand(3) * 40) - 1e9", "id % 5"])
def test_merged_quantiles_are_within_the_rank_error(spark, value):
    """Wide ranges, skew and ties; states of parts are stored and merged."""
    rows = spark.range(60_000).select((F.col("id") % 7).alias("part"), F.expr(f"CAST({value} AS DOUBLE)").alias("v")).cache()
    path = new_path(spark, "states")
    sketches.quantile_states(rows, ["part"], "v").write.parquet(path)
    states = spark.read.parquet(path)
    assert states.count() == 7
    for q in (0.0, 0.1, 0.5, 0.9, 1.0):
        found = sketches.merged_quantiles(states, []).select("_n", sketches.quantile(q)).first()
        assert found[0] == 60_000
        low, upto = rows.agg(F.count_if(F.col("v") < found[1]), F.count_if(F.col("v") <= found[1])).first()
        room = sketches.rank_error() * 60_000 + 1
        assert low - room <= q * 60_000 <= upto + room
    rows.unpersist()


def test_groups_without_values(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 2.0)], "g string, v double")
    got = {r["g"]: (r["_n"], r["q"]) for r in sketches.quantile_states(rows, ["g"], "v").select(
        "g", "_n", sketches.quantile(0.5).alias("q")).collect()}
    assert got == {"a": (1, 1.0), None: (1, 2.0)}


def test_distinct_counts_and_what_editions_share(spark):
    """Exact while a sketch holds all keys, within four standard errors beyond; NULL is no key."""
    rows = spark.range(300_000).selectExpr("CAST(id DIV 100000 AS INT) AS ano", "CAST(id % 100000 + 50000 * (id DIV 100000) AS STRING) AS k")
    few = spark.createDataFrame([(7, "1"), (7, "1"), (7, None), (8, "1"), (8, "2")], "ano int, k string")
    path = new_path(spark, "states")
    sketches.distinct_states(rows.unionByName(few), ["ano"], "k").write.parquet(path)
    states = spark.read.parquet(path)
    got = {r["ano"]: (r["n"], r["_de_antes"]) for r in sketches.carried_over(states, "ano").select(
        "ano", sketches.distinct_count().alias("n"), "_de_antes").collect()}
    room = 4 * sketches.standard_error()
    assert all(abs(got[y][0] - 100_000) <= room * 100_000 for y in range(3))
    assert got[0][1] is None and all(abs(got[y][1] - 50_000) <= 2 * room * 100_000 for y in (1, 2))
    assert got[7][0] == 1 and got[8] == (2, 1)
    whole = sketches.merged_distinct(states, []).select(sketches.distinct_count()).first()[0]
    assert abs(whole - 200_000) <= room * 200_000
