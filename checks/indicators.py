"""Verification slices and derived indicators, computed from the marts in the same plan."""

from __future__ import annotations

from checks import survey
from checks.marts import (
    GENDERS,
    REGION_SENIOR_SQL,
    ROLE_GENDER_SQL,
    ROLE_LEVEL_SQL,
    TECH_SQL,
    USE_LEVEL_SQL,
    WORK_SQL,
    dist_sql,
    options_sql,
    pay_sql,
)
from checks.registry import QUERIES, query
from surveyloom.plans import indicators
from surveyloom.plans import vocabulary as v

FIRST, LAST, OLDEST = survey.FIRST, survey.LAST, survey.HISTORY_YEARS[0]
NAMES = {LAST: f"{LAST}/{LAST % 100 + 1:02d}"}
PAY_LEVEL_GENDER_SQL = pay_sql("ano, genero, nivel", f"nivel IS NOT NULL AND {GENDERS}")


@query("i01_role_seniority_check", f"SELECT * FROM ({ROLE_LEVEL_SQL}) WHERE ano = {LAST} AND total_grupo >= 30")
def i01(spark, sf):
    return indicators.role_seniority_check(QUERIES["g05b_salary_by_role_seniority"](spark, sf), LAST)


FAMILIES = ("Ciência de Dados", "Análise de Dados", "Engenharia/Arquitetura de Dados")


@query("i02_gender_role_check", f"SELECT * FROM ({ROLE_GENDER_SQL}) WHERE ano = {LAST} AND cargo_grupo IN {FAMILIES}")
def i02(spark, sf):
    return indicators.gender_role_check(QUERIES["g08b_gender_role_seniority"](spark, sf), LAST, FAMILIES)


@query("i03_company_paid_by_level", f"""SELECT * FROM ({USE_LEVEL_SQL})
 WHERE ano = {LAST} AND modalidade = 'Empresa paga' AND base_valida >= 30""")
def i03(spark, sf):
    return indicators.usage_by_level_check(
        QUERIES["g11b_genai_usage_by_seniority"](spark, sf), LAST, "Empresa paga")


@query("i04_region_senior_check", f"SELECT * FROM ({REGION_SENIOR_SQL}) WHERE ano = {LAST} AND n_senior >= 30")
def i04(spark, sf):
    return indicators.region_senior_check(QUERIES["g12b_regions_by_seniority"](spark, sf), LAST)


@query("i05_top9_roles", f"""SELECT * FROM ({dist_sql("cargo_grupo")}) WHERE ano = {LAST}
 ORDER BY n DESC, cargo_grupo LIMIT 9""")
def i05(spark, sf):
    return indicators.largest_roles(QUERIES["g02_roles"](spark, sf), LAST)


@query("i06_senior_plus_share", f"""SELECT ano, round(sum(pct), 1) AS pct_senior_mais
 FROM ({dist_sql("nivel")}) WHERE nivel IN ('Sênior', 'Especialista/Staff+') GROUP BY ano""")
def i06(spark, sf):
    return indicators.senior_plus_share(QUERIES["g03_seniority"](spark, sf))


@query("i07_top9_paid_roles", f"""SELECT * FROM ({pay_sql("ano, cargo_grupo", "cargo_grupo IS NOT NULL")})
 WHERE ano = {LAST} AND n >= 30 ORDER BY salario_mediano_pm DESC, cargo_grupo LIMIT 9""")
def i07(spark, sf):
    return indicators.best_paid_roles(QUERIES["g05_salary_by_role"](spark, sf), LAST)


@query("i08_female_peak_drop", f"""SELECT max(pct) AS pico, arg_max(pct, ano) AS atual,
 round(max(pct) - arg_max(pct, ano), 1) AS queda_pp FROM ({dist_sql("genero", "serie")})
 WHERE genero = 'Feminino'""", "serie")
def i08(spark, sf):
    return indicators.peak_and_drop(QUERIES["g06_gender_participation"](spark, sf))


@query("i09_gender_gap_senior", f"""SELECT f AS feminino, m AS masculino, round(100 * (f / m - 1), 1) AS gap_pct,
 m - f AS gap_absoluto, round((1 - f / m) * 100, 1) AS gap_relativo FROM (
 SELECT max(salario_mediano_pm) FILTER (genero = 'Feminino') AS f,
 max(salario_mediano_pm) FILTER (genero = 'Masculino') AS m
 FROM ({PAY_LEVEL_GENDER_SQL}) WHERE ano = {LAST} AND nivel = 'Sênior')""")
def i09(spark, sf):
    return indicators.gender_gap_at_level(QUERIES["g07_gender_seniority_salary"](spark, sf), LAST)


@query("i10_tech_latest", f"""SELECT categoria, tecnologia, max(ano) AS ano_atual, arg_max(pct, ano) AS pct_atual,
 max(pct) AS pct_pico FROM ({TECH_SQL}) WHERE categoria IN ('linguagem', 'cloud')
 GROUP BY categoria, tecnologia""", "serie core")
def i10(spark, sf):
    return indicators.latest_adoption(QUERIES["g09_technologies"](spark, sf))


@query("i11_bi_ranking", f"""SELECT CAST(row_number() OVER (ORDER BY pct DESC, tecnologia) AS INT) AS posicao,
 tecnologia, pct, max(base_valida) OVER () AS base_maxima
 FROM ({TECH_SQL}) WHERE ano = {LAST} AND categoria = 'bi'""", "serie core")
def i11(spark, sf):
    return indicators.tool_ranking(QUERIES["g09_technologies"](spark, sf), LAST)


TOP2_SQL = f"""SELECT ano, round(sum(pct), 1) AS pct_top2 FROM ({dist_sql("prioridade_ia_h")})
 WHERE starts_with(prioridade_ia_h, '1.') OR starts_with(prioridade_ia_h, '2.') GROUP BY ano"""


def growth_sql(rows: str, value: str, first: int, last: int, keys: str = "") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    shown = f"{keys}, " if keys else ""
    return f"""SELECT {shown}inicio, fim, round(fim - inicio, 1) AS delta_pp, round(fim / inicio, 1) AS multiplo
 FROM (SELECT {shown}max({value}) FILTER (ano = {first}) AS inicio, max({value}) FILTER (ano = {last}) AS fim
 FROM ({rows}) {group})"""


@query("i12_ai_top2", growth_sql(TOP2_SQL, "pct_top2", FIRST, LAST))
def i12(spark, sf):
    return indicators.top_priority_growth(QUERIES["g10_ai_priority"](spark, sf), FIRST, LAST)


USAGES = ("Não usa GenAI", "Empresa paga")
USE_SQL = options_sql(v.GENAI_USES, "modalidade")


@query("i13_genai_delta", growth_sql(f"SELECT * FROM ({USE_SQL}) WHERE modalidade IN {USAGES}", "pct", FIRST, LAST,
                                     "modalidade"))
def i13(spark, sf):
    return indicators.usage_growth(QUERIES["g11_genai_usage"](spark, sf), FIRST, LAST, USAGES)


@query("i14_base_by_edition", f"""SELECT string_agg(replace(format('{{:,}}', n), ',', '.') || ' (' ||
 CASE WHEN ano = {LAST} THEN '{NAMES[LAST]}' ELSE CAST(ano AS VARCHAR) END || ')', ' / ' ORDER BY ano) AS legenda
 FROM (SELECT ano, max(base_valida) AS n FROM ({USE_SQL}) GROUP BY ano)""")
def i14(spark, sf):
    return indicators.base_caption(QUERIES["g11_genai_usage"](spark, sf), NAMES)


@query("i15_region_amplitude", f"""SELECT
 round(100 * (max(salario_medio_pm_senior) / min(salario_medio_pm_senior) - 1), 1) AS amplitude_pct
 FROM ({REGION_SENIOR_SQL}) WHERE ano = {LAST} AND n_senior >= 30""")
def i15(spark, sf):
    return indicators.region_amplitude(QUERIES["g12b_regions_by_seniority"](spark, sf), LAST)


ORDERED = " UNION ALL ".join(
    f"SELECT {i + 1} AS ordem, '{m}' AS modelo" for i, m in enumerate(v.WORK_MODEL_ORDER))


@query("i16_model_practised_vs_desired", f"""SELECT CAST({LAST} AS INT) AS ano, ordem, o.modelo,
 max(pct) FILTER (tipo = 'Atual') AS pct_atual, max(pct) FILTER (tipo = 'Ideal') AS pct_ideal
 FROM ({ORDERED}) o LEFT JOIN (SELECT * FROM ({WORK_SQL}) WHERE ano = {LAST}) w ON o.modelo = w.modelo
 GROUP BY ordem, o.modelo""")
def i16(spark, sf):
    return indicators.practised_and_desired(QUERIES["g13_work_model"](spark, sf), LAST)


@query("i17_criteria_highlight", f"""WITH rows AS (SELECT criterio, pct, row_number() OVER (ORDER BY pct DESC) AS r
 FROM ({options_sql(v.JOB_CRITERIA, "criterio")}) WHERE ano = {LAST})
SELECT criterio, pct, CAST(pct IN (SELECT pct FROM rows WHERE r <= 2) AS INT) AS destaque FROM rows""")
def i17(spark, sf):
    return indicators.criteria_highlight(QUERIES["g15_job_criteria"](spark, sf), LAST)


@query("i18_language_growth", growth_sql(f"SELECT * FROM ({TECH_SQL}) WHERE tecnologia = 'Python'", "pct",
                                         OLDEST, LAST), "serie core")
def i18(spark, sf):
    return indicators.technology_growth(QUERIES["g09_technologies"](spark, sf), "Python", OLDEST, LAST)


LEVEL_ROWS = " UNION ALL ".join(f"SELECT {i + 1} AS ordem, '{m}' AS nivel" for i, m in enumerate(v.LEVELS))


@query("i19_category_densify_series", f"""SELECT e.ano, ordem, o.nivel, pct
 FROM (SELECT DISTINCT ano FROM core) e CROSS JOIN ({LEVEL_ROWS}) o
 LEFT JOIN ({dist_sql("nivel")}) d ON d.ano = e.ano AND d.nivel = o.nivel""")
def i19(spark, sf):
    return indicators.seniority_grid(QUERIES["g03_seniority"](spark, sf))
