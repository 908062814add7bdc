"""What the physical plans must look like before the data gets large."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import marts as mart_checks
from checks import survey
from checks.marts import land_raw
from surveyloom.operators import shape, shares
from surveyloom.plans import marts, silver
from surveyloom.plans import vocabulary as v
from surveyloom.sources.editions import read_edition
from surveyloom.sources.folders import new_path
from surveyloom.sources.tables import write_layer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
RESAMPLED, COUNTED_BY_QUOTES = "d10_bootstrap_median_ci", "d04_csv_shape"
LAZY = [k for k in queries() if k[0] in "gqiafwoujx" or k in ("d01_missing_columns", "d03_layer_reconcile")]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert not [n for n in PYTHON_NODES if n in text]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["g11_genai_usage", "g15_job_criteria", "g16_manager_challenges"])
def test_multi_response_reads_once_and_copies_no_rows(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert text.count("FileScan") == 1 and "Expand" not in text and text.count("Exchange") == 1


def test_shares_and_marks_gather_no_group(spark, sf_dir):
    labels = survey.every(spark, sf_dir, "ano", "id")
    assert "Window" not in plan(shares.distribution(labels, "id"))
    marked = plan(shape.flag_top_values(shares.count_by(labels, "ano", "id"), ["ano"], "n", 3, "destaque"))
    assert "WindowGroupLimit" in marked and marked.count("Window [") == 1


def test_ranked_groups_are_cut_before_the_shuffle(spark, sf_dir):
    counted = shares.count_by(survey.every(spark, sf_dir, "ano", "id"), "ano", "id")
    text = plan(shape.top_per_group(counted, ["ano"], "n", ["id"], 5))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(queries()["o02_global_topk"](spark, sf_dir))


def test_only_needed_columns_and_dates_are_read(spark, sf_dir):
    text = plan(marts.seniority(survey.core(spark, sf_dir, "ano", "nivel")))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in text


def test_edition_filter_prunes_directories(spark, sf_dir):
    path = new_path(spark, "layer")
    write_layer(survey.every(spark, sf_dir, "ano", "nivel"), path)
    text = plan(spark.read.parquet(path).filter(F.col("ano") == 2000))
    assert "PartitionFilters: [isnotnull(ano" in text


def test_silver_is_one_narrow_pass(spark, sf_dir):
    bronze = land_raw(spark, sf_dir, survey.CORE_YEARS)
    raw = {y: read_edition(spark, bronze, y) for y in survey.CORE_YEARS}
    text = plan(silver.silver_core(raw, survey.CORE_HEADERS))
    assert "Exchange" not in text and not [n for n in PYTHON_NODES if n in text]


def test_median_never_gathers_a_group(spark, sf_dir):
    text = plan(queries()["g04_salary_by_seniority"](spark, sf_dir))
    assert "percentile" not in text.lower() and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("name", ["g05_salary_by_role", "g05b_salary_by_role_seniority", "g12_regions"])
def test_median_marts_read_their_rows_once(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("orders.parquet") == 1 and "ReusedExchange" in final


def test_all_columns_of_the_layer():
    assert len(survey.SILVER) == 76
    assert len(silver.flag_columns(list(v.HEADERS_2025))) == 43


def test_texts_are_folded_and_searched_once(spark, sf_dir):
    bronze = mart_checks.land_raw(spark, sf_dir, survey.CORE_YEARS)
    core = mart_checks.core_from_files(spark, bronze)
    plan = core._jdf.queryExecution().optimizedPlan().toString()
    branches = plan.count("Relation [")
    assert plan.count("lower(") <= 3 * branches and plan.count("regexp_extract(") <= 3 * branches


def test_customers_are_never_gathered_on_the_driver(spark, tmp_path):
    """A well packed file of many customers looks smaller than the few places that they are joined to."""
    def put(name, rows):
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    put("nation", spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "CAST(id % 5 AS INT) AS n_regionkey"))
    put("region", spark.range(5).selectExpr("CAST(id AS INT) AS r_regionkey", "concat('R', id) AS r_name"))
    put("customer", spark.range(20000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey"))
    orders = spark.range(40).selectExpr("id * 500 AS c")
    found = survey._with_places(spark, str(tmp_path), orders, ["rname"])
    text = found._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"HashJoin \[[^]]*c_nationkey[^]]*\], \[[^]]*n_nationkey[^]]*\], Inner, BuildRight", text), text
    assert sorted(map(tuple, found.collect())) == [(c, f"R{c % 25 % 5}") for c in range(0, 20000, 500)]
