"""Marts from counted answers: the same rows as marts from the layers, from three scans, edition by edition."""

import re

import pytest
from pyspark.sql import functions as F

from checks import survey
from surveyloom.plans import cube, marts, release
from surveyloom.sources.folders import new_path
from surveyloom.sources.tables import read_table, replace_editions, write_layer


@pytest.fixture(scope="module")
def layers(spark, sf_dir):
    folder = new_path(spark, "layers")
    write_layer(survey.core(spark, sf_dir), f"{folder}/core")
    write_layer(survey.long_series(spark, sf_dir), f"{folder}/series")
    return folder, read_table(spark, f"{folder}/core"), read_table(spark, f"{folder}/series")


@pytest.fixture(scope="module")
def counted(spark, layers):
    return cube.write(cube.build(*layers[1:]), new_path(spark, "cubo"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", cube.rollups())
def test_rollup_equals_the_mart(layers, counted, name):
    got, want = cube.rollups()[name](counted), marts.marts()[name].build(*layers[1:])
    assert got.dtypes == want.dtypes and rows(got) == rows(want)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_three_scans_whatever_the_number_of_marts(layers):
    """Each table of the cube reads its layer once; marts read the cube."""
    assert [scans(df) for df in cube.build(*layers[1:])] == [1, 1, 1]
    assert set(cube.rollups()) == set(marts.marts())


def test_one_changed_edition_reads_only_itself(spark, layers, counted):
    folder, core, series = layers
    new = new_path(spark, "layers")
    write_layer(core, f"{new}/core")
    write_layer(series, f"{new}/series")
    year = survey.LAST
    for name, df in (("core", core), ("series", series)):
        replace_editions(df.filter((F.col("ano") == year) & (F.xxhash64("id" if name == "core" else "genero", "lang_sql") % 3 > 0)),
                         f"{new}/{name}")
    changed, changed_series = read_table(spark, f"{new}/core"), read_table(spark, f"{new}/series")
    fresh = cube.refreshed(counted, changed, changed_series, [year])
    for df in fresh:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[[^\]]*ano#\d+ = {year}", plan)
    full = cube.build(changed, changed_series)
    assert rows(fresh.respostas) == rows(full.respostas.select(fresh.respostas.columns))
    refreshed = cube.write(fresh, new_path(spark, "cubo"))
    for name in ("gold_salary_by_role", "gold_technologies", "gold_work_model"):
        assert rows(cube.rollups()[name](refreshed)) == rows(marts.marts()[name].build(changed, changed_series))


def test_marts_of_a_refreshed_release(spark, layers, monkeypatch):
    few = {n: marts.marts()[n] for n in ("gold_respondents", "gold_regions")}
    monkeypatch.setattr(release, "marts", lambda: few)
    first, second = new_path(spark, "gold"), new_path(spark, "gold")
    written = release.publish_marts(*layers[1:], first)
    assert release.publish_marts(*layers[1:], second, f"{first}/cubo", [survey.FIRST]) == written
    for name in few:
        assert rows(read_table(spark, f"{first}/{name}")) == rows(read_table(spark, f"{second}/{name}"))


def test_empty_layers(layers):
    empty = cube.build(layers[1].limit(0), layers[2].limit(0))
    assert all(df.count() == 0 for df in empty)
    assert all(build(empty).count() == 0 for name, build in cube.rollups().items() if name in (
        "gold_respondents", "gold_regions", "gold_genai_usage", "gold_market_pulse"))
