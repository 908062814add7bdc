"""The marts and both harmonised layers."""

from __future__ import annotations

from checks import survey
from checks.registry import query
from surveyloom.plans import marts, release, silver
from surveyloom.plans import vocabulary as v
from surveyloom.sources.editions import edition_path, read_edition, write_raw
from surveyloom.sources.folders import new_path
from surveyloom.sources.tables import read_table, write_layer


def dist_sql(label: str, view: str = "core") -> str:
    return f"""SELECT ano, {label}, n, round(100 * n / sum(n) OVER (PARTITION BY ano), 1) AS pct
 FROM (SELECT ano, {label}, count(*) AS n FROM {view} WHERE {label} IS NOT NULL GROUP BY ano, {label})"""


def pay_sql(keys: str, where: str, n: str = "n", suffix: str = "") -> str:
    return f"""SELECT {keys}, count(*) AS {n}, round(avg(salario_pm), 0) AS salario_medio_pm{suffix},
 round(quantile_cont(salario_pm, 0.5), 0) AS salario_mediano_pm{suffix}
 FROM core WHERE salario_pm IS NOT NULL AND {where} GROUP BY {keys}"""


def options_sql(options: dict[str, str], name: str, view: str = "core", keys: str = "ano", extra: str = "",
                where: str = "TRUE") -> str:
    """One block per option, so the comparison shares nothing with the single-pass plan."""
    blocks = [
        f"""SELECT {keys}, {extra} '{label}' AS {name}, CAST(sum({c}) AS BIGINT) AS usuarios,
 count(*) AS base_valida, round(100 * CAST(sum({c}) AS BIGINT) / count(*), 1) AS pct
 FROM {view} WHERE {c} IS NOT NULL AND {where} GROUP BY {keys}"""
        for c, label in options.items()
    ]
    return "\nUNION ALL\n".join(blocks)


TECH_SQL = "\nUNION ALL\n".join(
    options_sql(options, "tecnologia", view, extra=f"'{category}' AS categoria,")
    for options, view, category in (
        (v.LANGUAGES, "serie", "linguagem"), (v.CLOUDS, "serie", "cloud"), (v.BI_TOOLS, "core", "bi"))
)
WORK_SQL = """SELECT ano, tipo, modelo, n, round(100 * n / sum(n) OVER (PARTITION BY ano, tipo), 1) AS pct FROM (
 SELECT ano, 'Atual' AS tipo, modelo_atual_h AS modelo, count(*) AS n FROM core
 WHERE modelo_atual_h IS NOT NULL GROUP BY ano, modelo_atual_h
 UNION ALL SELECT ano, 'Ideal', modelo_ideal_h, count(*) FROM core
 WHERE modelo_ideal_h IS NOT NULL GROUP BY ano, modelo_ideal_h)"""
GENDERS = "genero IN ('Masculino', 'Feminino')"


@query("g01_respondents", "SELECT ano, count(*) AS n FROM serie GROUP BY ano", "serie")
def g01(spark, sf):
    return marts.respondents(survey.long_series(spark, sf, "ano"))


@query("g02_roles", dist_sql("cargo_grupo"))
def g02(spark, sf):
    return marts.roles(survey.core(spark, sf, "ano", "cargo_grupo"))


@query("g03_seniority", dist_sql("nivel"))
def g03(spark, sf):
    return marts.seniority(survey.core(spark, sf, "ano", "nivel"))


@query("g04_salary_by_seniority", pay_sql("ano, nivel", "nivel IS NOT NULL"))
def g04(spark, sf):
    return marts.salary_by_seniority(survey.core(spark, sf, "ano", "nivel", "salario_pm"))


@query("g05_salary_by_role", pay_sql("ano, cargo_grupo", "cargo_grupo IS NOT NULL"))
def g05(spark, sf):
    return marts.salary_by_role(survey.core(spark, sf, "ano", "cargo_grupo", "salario_pm"))


#: One grouped statement; each figure filters the rows it counts.
ROLE_LEVEL_SQL = """SELECT ano, cargo_grupo, count(nivel) AS total_grupo,
 round(100 * count(*) FILTER (nivel IN ('Especialista/Staff+', 'Sênior')) / count(nivel), 1) AS pct_senior_mais,
 nullif(count(salario_pm) FILTER (nivel = 'Sênior'), 0) AS n_senior,
 round(quantile_cont(salario_pm, 0.5) FILTER (nivel = 'Sênior'), 0) AS salario_mediano_pm_senior
FROM core WHERE cargo_grupo IS NOT NULL GROUP BY ano, cargo_grupo HAVING count(nivel) > 0"""


@query("g05b_salary_by_role_seniority", ROLE_LEVEL_SQL)
def g05b(spark, sf):
    return marts.salary_by_role_seniority(survey.core(spark, sf, "ano", "cargo_grupo", "nivel", "salario_pm"))


@query("g06_gender_participation", dist_sql("genero", "serie"), "serie")
def g06(spark, sf):
    return marts.gender_participation(survey.long_series(spark, sf, "ano", "genero"))


@query("g07_gender_seniority_salary", pay_sql("ano, genero, nivel", f"nivel IS NOT NULL AND {GENDERS}"))
def g07(spark, sf):
    return marts.gender_seniority_salary(survey.core(spark, sf, "ano", "genero", "nivel", "salario_pm"))


@query("g08_gender_leadership", f"""SELECT ano, genero, count(*) AS n, CAST(sum(gestor) AS BIGINT) AS gestores,
 round(100 * avg(gestor), 1) AS pct_gestores FROM core WHERE gestor IS NOT NULL AND {GENDERS} GROUP BY ano, genero""")
def g08(spark, sf):
    return marts.gender_leadership(survey.core(spark, sf, "ano", "genero", "gestor"))


ROLE_GENDER_SQL = f"""SELECT *, round(100 * n / sum(n) OVER (PARTITION BY ano, genero), 1) AS pct_do_genero FROM (
 SELECT ano, genero, cargo_grupo, count(*) AS n, count(salario_pm) AS n_salario,
 round(quantile_cont(salario_pm, 0.5), 0) AS salario_mediano_pm
 FROM core WHERE nivel = 'Sênior' AND cargo_grupo IS NOT NULL AND {GENDERS} GROUP BY ano, genero, cargo_grupo)"""


@query("g08b_gender_role_seniority", ROLE_GENDER_SQL)
def g08b(spark, sf):
    return marts.gender_role_seniority(
        survey.core(spark, sf, "ano", "genero", "cargo_grupo", "nivel", "salario_pm"))


@query("g09_technologies", TECH_SQL, "serie core")
def g09(spark, sf):
    return marts.technologies(survey.long_series(spark, sf), survey.core(spark, sf, "ano", *v.BI_TOOLS))


@query("g10_ai_priority", dist_sql("prioridade_ia_h"))
def g10(spark, sf):
    return marts.ai_priority(survey.core(spark, sf, "ano", "prioridade_ia_h"))


@query("g11_genai_usage", options_sql(v.GENAI_USES, "modalidade"))
def g11(spark, sf):
    return marts.genai_usage(survey.core(spark, sf, "ano", *v.GENAI_USES))


USE_LEVEL_SQL = options_sql(v.GENAI_USES, "modalidade", keys="ano, nivel", where="nivel IS NOT NULL")


@query("g11b_genai_usage_by_seniority", USE_LEVEL_SQL)
def g11b(spark, sf):
    return marts.genai_usage_by_seniority(survey.core(spark, sf, "ano", "nivel", *v.GENAI_USES))


@query("g12_regions", """SELECT *, round(100 * n / sum(n) OVER (PARTITION BY ano), 1) AS pct FROM (
 SELECT ano, regiao, count(*) AS n, count(salario_pm) AS n_salario, round(avg(salario_pm), 0) AS salario_medio_pm,
 round(quantile_cont(salario_pm, 0.5), 0) AS salario_mediano_pm
 FROM core WHERE regiao IS NOT NULL AND regiao <> '' GROUP BY ano, regiao)""")
def g12(spark, sf):
    return marts.regions(survey.core(spark, sf, "ano", "regiao", "salario_pm"))


REGION_SENIOR_SQL = pay_sql("ano, regiao", "nivel = 'Sênior' AND regiao <> ''", "n_senior", "_senior")


@query("g12b_regions_by_seniority", REGION_SENIOR_SQL)
def g12b(spark, sf):
    return marts.regions_by_seniority(survey.core(spark, sf, "ano", "regiao", "nivel", "salario_pm"))


@query("g13_work_model", WORK_SQL)
def g13(spark, sf):
    return marts.work_model(survey.core(spark, sf, "ano", "modelo_atual_h", "modelo_ideal_h"))


@query("g14_market_pulse", """SELECT ano, round(100 * avg(satisfeito), 1) AS pct_satisfeitos,
 count(satisfeito) AS n_satisfacao, round(100 * avg(layoff_sim), 1) AS pct_layoff_sim, count(layoff_sim) AS n_layoff
 FROM core GROUP BY ano""")
def g14(spark, sf):
    return marts.market_pulse(survey.core(spark, sf, "ano", "satisfeito", "layoff_sim"))


@query("g14b_job_change_intent", dist_sql("mudar_emprego_6m"))
def g14b(spark, sf):
    return marts.job_change_intent(survey.core(spark, sf, "ano", "mudar_emprego_6m"))


@query("g15_job_criteria", options_sql(v.JOB_CRITERIA, "criterio"))
def g15(spark, sf):
    return marts.job_criteria(survey.core(spark, sf, "ano", *v.JOB_CRITERIA))


@query("g16_manager_challenges", options_sql(v.MANAGER_CHALLENGES, "desafio"))
def g16(spark, sf):
    return marts.manager_challenges(survey.core(spark, sf, "ano", *v.MANAGER_CHALLENGES))


def land_raw(spark, sf, years) -> str:
    """Raw CSV files of the given editions, written by Spark from the order tables."""
    bronze = new_path(spark, "bronze")
    for year, df in survey.raw_editions(spark, sf, years).items():
        write_raw(df, edition_path(bronze, year))
    return bronze


def core_from_files(spark, bronze):
    """The core layer: raw CSV files to written Parquet."""
    raw = {y: read_edition(spark, bronze, y) for y in survey.CORE_YEARS}
    folder = new_path(spark, "silver_core")
    write_layer(silver.silver_core(raw, survey.CORE_HEADERS), folder)
    return read_table(spark, folder)


def layers_from_files(spark, bronze):
    return release.build_silver(
        spark,
        {y: read_edition(spark, bronze, y) for y in survey.CORE_YEARS},
        {y: read_edition(spark, bronze, y) for y in survey.HISTORY_YEARS},
        survey.CORE_HEADERS,
        survey.HISTORY_HEADERS,
        new_path(spark, "silver"),
    )


@query("v01_silver_core", "SELECT * FROM silver", "silver")
def v01(spark, sf):
    return core_from_files(spark, land_raw(spark, sf, survey.CORE_YEARS))


@query("v02_silver_long", "SELECT * FROM serie", "serie")
def v02(spark, sf):
    return layers_from_files(spark, land_raw(spark, sf, survey.ALL_YEARS))[1]
