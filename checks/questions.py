"""The published questions."""

from __future__ import annotations

from checks import survey
from checks.marts import dist_sql
from checks.registry import ORACLES, query
from surveyloom.plans import questions, sql_questions

LAST = survey.LAST


@query("q01_top_roles", f"""SELECT ano, cargo_grupo, n, pct FROM (
 SELECT *, row_number() OVER (PARTITION BY ano ORDER BY n DESC, cargo_grupo) AS place
 FROM ({dist_sql("cargo_grupo")})) WHERE place <= 5""")
def q01(spark, sf):
    return questions.top_roles(survey.core(spark, sf, "ano", "cargo_grupo"))


@query("q02_salary_ladder", """SELECT ano, nivel, count(*) AS n,
 round(quantile_disc(salario_pm, 0.5), 0) AS salario_mediano_pm
 FROM silver WHERE salario_pm IS NOT NULL AND nivel IS NOT NULL GROUP BY ano, nivel""", "silver")
def q02(spark, sf):
    return questions.salary_ladder(survey.banded(spark, sf, "ano", "nivel", "salario_pm", core_only=True))


#: One pass: both genders' pay side by side per level, by filtered aggregates.
GAP_SQL = f"""SELECT nivel, round(fem, 0) AS mediana_feminino, round(masc, 0) AS mediana_masculino,
 round((fem - masc) * 100 / masc, 1) AS gap_pct, n_feminino, n_masculino
FROM (SELECT nivel,
  quantile_disc(salario_pm, 0.5) FILTER (genero = 'Feminino') AS fem,
  quantile_disc(salario_pm, 0.5) FILTER (genero = 'Masculino') AS masc,
  count(salario_pm) FILTER (genero = 'Feminino') AS n_feminino,
  count(salario_pm) FILTER (genero = 'Masculino') AS n_masculino
 FROM silver WHERE ano = {LAST} AND nivel IS NOT NULL GROUP BY nivel)
WHERE n_feminino > 0 AND n_masculino > 0"""


@query("q03_gender_gap", GAP_SQL, "silver")
def q03(spark, sf):
    rows = survey.banded(spark, sf, "ano", "nivel", "genero", "salario_pm", core_only=True)
    return questions.gender_gap(rows, LAST)


def share_sql(flag: str, name: str) -> str:
    """Yes answers among all answers, in percent."""
    return f"round(100.0 * count(*) FILTER ({flag} = 1) / nullif(count({flag}), 0), 1) AS {name}"


@query("q04_tech_evolution", f"""SELECT ano, count(*) FILTER (lang_python IS NOT NULL) AS base_valida,
 {share_sql("lang_python", "pct_python")}, {share_sql("lang_sql", "pct_sql")}, {share_sql("cloud_aws", "pct_aws")}
 FROM serie GROUP BY ano""", "serie")
def q04(spark, sf):
    return questions.tech_evolution(survey.long_series(spark, sf, "ano", "lang_python", "lang_sql", "cloud_aws"))


@query("q05_ai_priority", dist_sql("prioridade_ia_h"))
def q05(spark, sf):
    return questions.ai_priority(survey.core(spark, sf, "ano", "prioridade_ia_h"))


#: Both answers of a row are stacked, counted in one pass per model, and related to all answers of their kind.
MODEL_GAP_SQL = f"""WITH stacked AS (
 SELECT unnest([modelo_atual_h, modelo_ideal_h]) AS modelo, unnest([true, false]) AS practised FROM core WHERE ano = {LAST}),
tally AS (SELECT modelo, count(*) FILTER (practised) AS now, count(*) FILTER (NOT practised) AS wished
 FROM stacked WHERE modelo IS NOT NULL GROUP BY modelo),
shares AS (SELECT modelo,
 CASE WHEN now > 0 THEN round(now * 100.0 / (SELECT sum(now) FROM tally), 1) END AS pct_atual,
 CASE WHEN wished > 0 THEN round(wished * 100.0 / (SELECT sum(wished) FROM tally), 1) END AS pct_ideal FROM tally)
SELECT modelo, pct_atual, pct_ideal, round(pct_ideal - pct_atual, 1) AS gap_pp FROM shares"""


@query("q06_model_gap", MODEL_GAP_SQL)
def q06(spark, sf):
    return questions.model_gap(survey.core(spark, sf, "ano", "modelo_atual_h", "modelo_ideal_h"), LAST)


@query("q07_market_pulse", f"""SELECT ano, count(*) FILTER (satisfeito IS NOT NULL) AS n_validos,
 {share_sql("satisfeito", "pct_satisfeitos")}, {share_sql("layoff_sim", "pct_layoff_sim")} FROM core GROUP BY ano""")
def q07(spark, sf):
    return questions.market_pulse(survey.core(spark, sf, "ano", "satisfeito", "layoff_sim"))


def asked(spark, sf, text):
    """The same questions in SQL, through table functions over the registered layers."""
    return sql_questions.ask(survey.banded(spark, sf, core_only=True), survey.long_series(spark, sf), text)


#: Question, its name here, and its text; pay is banded, as in the harmonised layer.
IN_SQL = {
    "q01_top_roles": "SELECT * FROM cargos_mais_frequentes(5)",
    "q02_salary_ladder": "SELECT * FROM escada_salarial()",
    "q03_gender_gap": f"SELECT * FROM diferenca_entre_generos({LAST})",
    "q04_tech_evolution": "SELECT * FROM evolucao_das_tecnologias()",
    "q05_ai_priority": "SELECT * FROM prioridade_da_ia()",
    "q06_model_gap": f"SELECT * FROM modelo_atual_e_desejado({LAST})",
    "q07_market_pulse": "SELECT * FROM pulso_do_mercado()",
}


def _in_sql(name: str, text: str) -> None:
    kept = f"{name[:3]}_sql{name[3:]}"
    query(kept)(lambda spark, sf: asked(spark, sf, text))
    ORACLES[kept] = ORACLES[name]


for _name, _text in IN_SQL.items():
    _in_sql(_name, _text)
