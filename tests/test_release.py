"""Raw files to marts, and the shape of everything that is published."""

from pathlib import Path

import pytest

from checks import marts as mart_checks
from checks import survey
from surveyloom.operators.quality import QualityError
from surveyloom.plans import contract, indicators, marts, release, silver, versions
from surveyloom.plans import vocabulary as v
from surveyloom.run import land, run
from surveyloom.sources.editions import edition_path, read_edition, write_raw
from surveyloom.sources.folders import new_path
from surveyloom.sources.headers import as_headers, read_mapping, write_mapping

# The columns of each published mart, in order.
COLUMNS = {
    "gold_respondents": "ano n",
    "gold_roles": "ano cargo_grupo n pct",
    "gold_seniority": "ano nivel n pct",
    "gold_salary_by_seniority": "ano nivel n salario_medio_pm salario_mediano_pm",
    "gold_salary_by_role": "ano cargo_grupo n salario_medio_pm salario_mediano_pm",
    "gold_salary_by_role_seniority":
        "ano cargo_grupo total_grupo pct_senior_mais n_senior salario_mediano_pm_senior",
    "gold_gender_participation": "ano genero n pct",
    "gold_gender_seniority_salary": "ano genero nivel n salario_medio_pm salario_mediano_pm",
    "gold_gender_leadership": "ano genero n gestores pct_gestores",
    "gold_gender_role_seniority": "ano genero cargo_grupo n n_salario salario_mediano_pm pct_do_genero",
    "gold_technologies": "ano categoria tecnologia usuarios base_valida pct",
    "gold_ai_priority": "ano prioridade_ia_h n pct",
    "gold_genai_usage": "ano modalidade usuarios base_valida pct",
    "gold_genai_usage_by_seniority": "ano nivel modalidade usuarios base_valida pct",
    "gold_regions": "ano regiao n n_salario salario_medio_pm salario_mediano_pm pct",
    "gold_regions_by_seniority": "ano regiao n_senior salario_medio_pm_senior salario_mediano_pm_senior",
    "gold_work_model": "ano tipo modelo n pct",
    "gold_market_pulse": "ano pct_satisfeitos n_satisfacao pct_layoff_sim n_layoff",
    "gold_job_change_intent": "ano mudar_emprego_6m n pct",
    "gold_job_criteria": "ano criterio usuarios base_valida pct",
    "gold_manager_challenges": "ano desafio usuarios base_valida pct",
}


def type_of(column):
    if column == "ano":
        return "int"
    if column.startswith(("pct", "salario_m")):
        return "double"
    if column in ("usuarios", "base_valida", "gestores", "total_grupo", "n") or column.startswith("n_"):
        return "bigint"
    return "string"


@pytest.mark.parametrize("name", COLUMNS)
def test_mart_schema(spark, sf_dir, name):
    df = marts.marts()[name].build(survey.core(spark, sf_dir), survey.long_series(spark, sf_dir))
    assert df.dtypes == [(c, type_of(c)) for c in COLUMNS[name].split()]


def test_release_end_to_end(spark, sf_dir):
    bronze = mart_checks.land_raw(spark, sf_dir, survey.ALL_YEARS)
    core_raw = {y: read_edition(spark, bronze, y) for y in survey.CORE_YEARS}
    history_raw = {y: read_edition(spark, bronze, y) for y in survey.HISTORY_YEARS}
    expected = {r["ano"]: r["count"] for r in survey.every(spark, sf_dir, "ano").groupBy("ano").count().collect()}

    target = new_path(spark, "silver")

    def build(volumes):
        return release.build_silver(
            spark, core_raw, history_raw, survey.CORE_HEADERS, survey.HISTORY_HEADERS, target, volumes)

    core, series = build(expected)
    assert core.count() == sum(expected[y] for y in survey.CORE_YEARS)
    assert series.count() == sum(expected.values())
    assert core.schema["salario_pm"].dataType == silver.core_contract(core.columns)["salario_pm"].dataType
    core.to(silver.core_contract(core.columns))
    with pytest.raises(QualityError):
        build(expected | {2001: expected[2001] + 1})
    assert core.count() == sum(expected[y] for y in survey.CORE_YEARS)  # the last good layer is still there
    assert {p.stat().st_mtime for p in Path(target).rglob("part-*")} and series.count() == sum(expected.values())

    folder = new_path(spark, "gold")
    written = release.publish_marts(core, series, folder)
    assert set(written) == set(COLUMNS) and min(written.values()) > 0
    for name, rows in written.items():
        part, = Path(f"{folder}/csv/{name}").glob("part-*.csv")
        lines = part.read_text(encoding="utf-8").splitlines()
        assert lines[0].split(",") == COLUMNS[name].split() and len(lines) == rows + 1

    # shares of a closed distribution add up, except for rounding
    totals = spark.read.parquet(f"{folder}/gold_roles").groupBy("ano").sum("pct").collect()
    assert all(abs(t["sum(pct)"] - 100) < 1 for t in totals)


# Published mart rows and the indicators quoted from them.
def test_quoted_indicators(spark):
    ai = spark.createDataFrame([
        (2023, "1. Principal prioridade da empresa", 10.7), (2023, "2. Entre as principais (2-4 anos)", 25.5),
        (2023, "4. Não é prioridade", 30.0), (2025, "1. Principal prioridade da empresa", 24.0),
        (2025, "2. Entre as principais (2-4 anos)", 36.6)], "ano int, prioridade_ia_h string, pct double")
    assert indicators.top_priority_growth(ai, 2023, 2025).first().asDict() == {
        "inicio": 36.2, "fim": 60.6, "delta_pp": 24.4, "multiplo": 1.7}

    genai = spark.createDataFrame([
        (2023, "Empresa paga", 3772, 6.4), (2024, "Empresa paga", 3619, 19.3), (2025, "Empresa paga", 2106, 42.4)],
        "ano int, modalidade string, base_valida long, pct double")
    assert indicators.base_caption(genai, v.EDITION_NAMES).first()["legenda"] == (
        "3.772 (2023) / 3.619 (2024) / 2.106 (2025/26)")
    growth = indicators.usage_growth(genai, 2023, 2025, ["Empresa paga"]).first()
    assert (growth["delta_pp"], growth["multiplo"]) == (36.0, 6.6)

    pay = spark.createDataFrame(
        [(2025, "Masculino", "Sênior", 14001.0), (2025, "Feminino", "Sênior", 10001.0)],
        "ano int, genero string, nivel string, salario_mediano_pm double")
    gap = indicators.gender_gap_at_level(pay, 2025).first()
    assert (gap["gap_pct"], gap["gap_absoluto"], gap["gap_relativo"]) == (-28.6, 4000.0, 28.6)


def test_run_over_a_folder(spark, sf_dir):
    """The published editions, headers and folders, from mapping JSON to marts."""
    base, mapping = new_path(spark, "base"), new_path(spark, "mapping")
    years = dict(zip((*v.HISTORY_EDITIONS, *v.CORE_EDITIONS), (1995, 1996, 1997, *survey.CORE_YEARS)))
    for edition, year in years.items():
        write_raw(survey.raw_edition(spark, sf_dir, year), edition_path(f"{base}/bronze", edition))
    write_mapping(spark, v.CORE_HEADERS, v.HISTORY_HEADERS, mapping)
    with pytest.raises(QualityError, match="2019"):
        run(spark, base, "silver", mapping)
    written = run(spark, base, mapping=mapping, gate=False)
    assert set(written) == set(COLUMNS) and written["gold_respondents"] == 6
    assert run(spark, base, "gold") == written
    tables = {name: versions.read_released(spark, base, f"qualidade/{name}").collect()
              for name in ("reconciliacao", "unicidade", "preenchimento", "grupos_pequenos", "metricas", "rotulos",
                           "intervalos", "impressoes", "formato_csv")}
    assert sorted(r["ano"] for r in tables["reconciliacao"]) == sorted(years)
    assert all(r["delta"] == 0 for r in tables["reconciliacao"])
    assert {r["coluna"] for r in tables["preenchimento"]} == set(v.EMPTY_REASONS)
    figures = {r["metrica"]: r["valor"] for r in tables["metricas"]}
    assert figures["tabelas_gold"] == len(written) and figures["descartados"] == 0
    asked = spark.sql("SELECT sum(n) AS n FROM gold_respondents").first()["n"]
    assert asked == spark.table("silver_serie_longa").count() == figures["linhas_bronze"]
    assert {r["ano"]: r["registros"] for r in tables["formato_csv"]} == {
        r["ano"]: r["n_bronze"] for r in tables["reconciliacao"]}
    assert {r["campo"] for r in tables["rotulos"]} == set(release.LABELLED) and tables["intervalos"]
    assert {r["tabela"]: r["n"] for r in tables["impressoes"]}["silver_serie_longa"] == asked
    exported = versions.table_path(base, "qualidade/mapeamento")
    assert as_headers(read_mapping(spark, exported)) == {**v.CORE_HEADERS, **v.HISTORY_HEADERS}


class Broken(Exception):
    """A run that ends half way."""


@pytest.fixture
def small_base(spark, sf_dir, monkeypatch):
    """Two editions that all steps run over, the older one with seven columns, and four of the marts."""
    few = {name: marts.marts()[name] for name in ("gold_respondents", "gold_roles", "gold_seniority", "gold_ai_priority")}
    monkeypatch.setattr(release, "marts", lambda: few)
    base, mapping = new_path(spark, "base"), new_path(spark, "mapping")
    for edition, year in ((2022, 1997), (2025, 2001)):
        write_raw(survey.raw_edition(spark, sf_dir, year), edition_path(f"{base}/bronze", edition))
    write_mapping(spark, {2025: v.CORE_HEADERS[2025]}, {2022: v.HISTORY_HEADERS[2022]}, mapping)
    return base, mapping


def seen(spark, base):
    """Rows of every table of the current release, as a reader finds them."""
    names = [n for n in versions.current(base).tables if n not in ("qualidade/mapeamento", "gold/cubo")]
    return {n: sorted(map(str, versions.read_released(spark, base, n).collect())) for n in names}


def test_a_run_that_fails_anywhere_changes_nothing(spark, small_base, monkeypatch):
    base, mapping = small_base
    run(spark, base, mapping=mapping, gate=False)
    before, version = seen(spark, base), versions.current(base).version
    (Path(edition_path(f"{base}/bronze", 2025)) / "mais.csv").write_text(
        "".join(next(Path(edition_path(f"{base}/bronze", 2025)).glob("part-*")).read_text().splitlines(True)[:3]))

    def fail(*_, **__):
        raise Broken

    wrote = release.publish_mart
    calls = []

    def third(*args, **kwargs):
        calls.append(args)
        return fail() if len(calls) == 3 else wrote(*args, **kwargs)

    monkeypatch.setattr(release, "publish_quality", lambda *_: {})
    for where, what, how in ((release.silver, "silver_long", fail), (release, "publish_mart", third), (versions, "publish", fail)):
        with monkeypatch.context() as patched:
            patched.setattr(where, what, how)
            with pytest.raises(Broken):
                run(spark, base, mapping=mapping, gate=False)
        assert versions.current(base).version == version
    assert versions.current(base).version == version and seen(spark, base) == before
    run(spark, base, mapping=mapping, gate=False)
    assert versions.current(base).version > version and seen(spark, base) != before
    # what broken runs left is gone, the release before can still be read
    left = {p.name for p in Path(base, "releases").iterdir()}
    assert left == {"CURRENT", version, versions.current(base).version}


def test_a_gold_step_reads_and_keeps_the_layers_before(spark, small_base):
    base, mapping = small_base
    run(spark, base, "silver", mapping, gate=False)
    first = versions.current(base)
    assert set(first.tables) == {"silver/silver_core", "silver/silver_serie_longa"}
    for _ in range(3):  # versions whose layers are still read are never collected
        run(spark, base, "gold", keep=1)
    now = versions.current(base)
    assert now.tables["silver/silver_core"] == first.tables["silver/silver_core"]
    assert versions.read_released(spark, base, "silver/silver_core").count() > 0
    assert {p.name for p in Path(base, "releases").iterdir()} == {"CURRENT", first.version, now.version}
    with pytest.raises(KeyError):
        versions.table_path(base, "gold/none")


def test_a_delivery_lands_and_layers_become_tables(spark, sf_dir, small_base):
    delivery, mapping = small_base
    base = new_path(spark, "base")
    assert land(spark, f"{delivery}/bronze", base).keys() == {2022, 2025}
    assert land(spark, f"{delivery}/bronze", base) == {}
    run(spark, base, "silver", mapping, gate=False, database="entrega")
    assert spark.table("entrega.silver_core").count() == spark.table("silver_core").count() > 0
    for name in ("silver_core", "silver_serie_longa"):
        spark.sql(f"DROP TABLE entrega.{name}")


def test_broken_rows_go_aside_in_a_run(spark, small_base):
    base, mapping = small_base
    rows = {2022: 0, 2025: 0}
    run(spark, base, "silver", mapping, gate=False)
    for e in rows:
        rows[e] = versions.read_released(spark, base, "silver/silver_serie_longa").filter(f"ano = {e}").count()
    whole = versions.read_released(spark, base, "silver/silver_core")
    listed = contract.with_violations(whole, contract.core_rules())
    broken = sorted(str(r) for r in listed.filter("size(violacoes) > 0").select("id", "violacoes").collect())
    assert 0 < len(broken) < rows[2025]

    written = run(spark, base, mapping=mapping, expected=rows, quarantine=True)
    core = versions.read_released(spark, base, "silver/silver_core")
    aside = contract.read_quarantine(spark, versions.table_path(base, versions.CHECKED))
    assert sorted(str(r) for r in aside.select("id", "violacoes").collect()) == broken
    assert core.count() == rows[2025] - len(broken) == spark.table("silver_core").count()
    assert core.filter("size(violacoes) > 0").isEmpty() and set(core.columns) == {*whole.columns, "violacoes"}
    asked = {r["ano"]: r["n"] for r in versions.read_released(spark, base, "gold/gold_respondents").collect()}
    assert asked == {2022: rows[2022], 2025: core.count()} and written["gold_respondents"] == 2
    found = {(r["ano"], r["regra"]): r["n"] for r in versions.read_released(spark, base, "qualidade/violacoes").collect()}
    listed = [x for r in aside.collect() for x in r["violacoes"]]
    assert found == {(2025, x): listed.count(x) for x in set(listed)}
    away = {r["ano"]: r["delta"] for r in versions.read_released(spark, base, "qualidade/reconciliacao").collect()}
    assert away == {2022: 0, 2025: -len(broken)}

    assert run(spark, base, "gold") == written  # a gold step reads the layer without them as well
    with pytest.raises(QualityError, match="2025"):
        run(spark, base, "silver", mapping, expected=rows | {2025: rows[2025] - len(broken)}, quarantine=True)
    run(spark, base, "silver", mapping, expected=rows)
    assert not {versions.CHECKED, "qualidade/violacoes"} & set(versions.current(base).tables)
    assert versions.read_released(spark, base, "silver/silver_core").count() == rows[2025]
