"""Where two releases differ: only differing leaves are read, and their rows come back."""

import re

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import difference
from surveyloom.sources.folders import new_path


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).selectExpr("id", "concat('t', id % 11) AS texto", "CAST(id AS DOUBLE) / 3 AS valor")


def written(spark, df, bits=8):
    folder = new_path(spark, "release")
    difference.write_digested(df, folder, ["id"], bits)
    return folder


def test_one_changed_cell_is_found_by_reading_two_leaves(spark, rows):
    before = written(spark, rows)
    after = written(spark, rows.withColumn("texto", F.when(F.col("id") == 1234, "outro").otherwise(F.col("texto"))))
    leaves = difference.differing_leaves(spark, before, after, 8)
    assert leaves == [rows.where("id = 1234").select(difference.bucket(["id"], 8)).first()[0]]
    found = difference.differing_rows(spark, before, after, 8)
    assert sorted((r["lado"], r["id"], r["texto"]) for r in found.collect()) == [("antes", 1234, "t2"), ("depois", 1234, "outro")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters and all(f"_balde#" in f and str(leaves[0]) in f for f in filters)


def test_added_removed_and_repeated_rows(spark, rows):
    before = written(spark, rows.union(rows.where("id = 5")))
    after = written(spark, rows.where("id <> 9").union(spark.createDataFrame([(9000, None, None)], rows.schema)))
    found = {(r["lado"], r["id"]) for r in difference.differing_rows(spark, before, after, 8).collect()}
    assert found == {("antes", 5), ("antes", 9), ("depois", 9000)}


def test_order_and_files_make_no_difference(spark, rows):
    one, two = written(spark, rows), written(spark, rows.orderBy(F.desc("texto")).repartition(5))
    assert difference.differing_leaves(spark, one, two, 8) == []
    assert difference.differing_rows(spark, one, two, 8).count() == 0
    assert difference.differing_leaves(spark, one, written(spark, rows.limit(0)), 8) == list(range(256))
