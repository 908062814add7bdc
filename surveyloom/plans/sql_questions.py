"""The seven questions as SQL table functions over the registered layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyloom.sources.tables import register_views

_PCT = "round(100 * {part} / {whole}, 1)"


def _rate(flag: str) -> str:
    return f"round(100 * avg({flag}), 1)"


_MEDIAN = "percentile_approx({}, 0.5, 10000)"

#: Name and parameters, columns, and body. Layers are the views silver_core and silver_serie_longa.
FUNCTIONS = {
    "cargos_mais_frequentes(quantos INT)": (
        "ano INT, cargo_grupo STRING, n BIGINT, pct DOUBLE",
        f"""SELECT ano, cargo_grupo, n, pct FROM (
 SELECT *, {_PCT.format(part="n", whole="sum(n) OVER (PARTITION BY ano)")} AS pct,
  row_number() OVER (PARTITION BY ano ORDER BY n DESC, cargo_grupo) AS lugar
 FROM (SELECT ano, cargo_grupo, count(1) AS n FROM silver_core WHERE cargo_grupo IS NOT NULL GROUP BY ano, cargo_grupo))
 WHERE lugar <= quantos"""),
    "escada_salarial()": (
        "ano INT, nivel STRING, n BIGINT, salario_mediano_pm DOUBLE",
        f"""SELECT ano, nivel, count(1), round({_MEDIAN.format("salario_pm")}, 0) FROM silver_core
 WHERE salario_pm IS NOT NULL AND nivel IS NOT NULL GROUP BY ano, nivel"""),
    "diferenca_entre_generos(edicao INT)": (
        "nivel STRING, mediana_feminino DOUBLE, mediana_masculino DOUBLE, gap_pct DOUBLE, n_feminino BIGINT, n_masculino BIGINT",
        f"""SELECT nivel, round(f, 0), round(m, 0), round((f - m) * 100 / m, 1), nf, nm FROM (
 SELECT nivel, {_MEDIAN.format("CASE WHEN genero = 'Feminino' THEN salario_pm END")} AS f,
  {_MEDIAN.format("CASE WHEN genero = 'Masculino' THEN salario_pm END")} AS m,
  count_if(genero = 'Feminino') AS nf, count_if(genero = 'Masculino') AS nm
 FROM silver_core WHERE ano = edicao AND salario_pm IS NOT NULL AND nivel IS NOT NULL GROUP BY nivel)
 WHERE nf > 0 AND nm > 0"""),
    "evolucao_das_tecnologias()": (
        "ano INT, pct_python DOUBLE, pct_sql DOUBLE, pct_aws DOUBLE, base_valida BIGINT",
        f"""SELECT ano, {_rate("lang_python")}, {_rate("lang_sql")}, {_rate("cloud_aws")}, count(lang_python)
 FROM silver_serie_longa GROUP BY ano"""),
    "prioridade_da_ia()": (
        "ano INT, prioridade_ia_h STRING, n BIGINT, pct DOUBLE",
        f"""SELECT ano, prioridade_ia_h, n, {_PCT.format(part="n", whole="sum(n) OVER (PARTITION BY ano)")} FROM (
 SELECT ano, prioridade_ia_h, count(1) AS n FROM silver_core WHERE prioridade_ia_h IS NOT NULL GROUP BY ano, prioridade_ia_h)"""),
    "modelo_atual_e_desejado(edicao INT)": (
        "modelo STRING, pct_atual DOUBLE, pct_ideal DOUBLE, gap_pp DOUBLE",
        f"""SELECT modelo, atual, ideal, round(ideal - atual, 1) FROM (
 SELECT modelo, max(CASE WHEN tipo = 'Atual' THEN pct END) AS atual, max(CASE WHEN tipo = 'Ideal' THEN pct END) AS ideal FROM (
  SELECT tipo, modelo, {_PCT.format(part="n", whole="sum(n) OVER (PARTITION BY tipo)")} AS pct FROM (
   SELECT tipo, modelo, count(1) AS n FROM (
    SELECT stack(2, 'Atual', modelo_atual_h, 'Ideal', modelo_ideal_h) AS (tipo, modelo) FROM silver_core WHERE ano = edicao)
   WHERE modelo IS NOT NULL GROUP BY tipo, modelo))
 GROUP BY modelo)"""),
    "pulso_do_mercado()": (
        "ano INT, pct_satisfeitos DOUBLE, pct_layoff_sim DOUBLE, n_validos BIGINT",
        f"""SELECT ano, {_rate("satisfeito")}, {_rate("layoff_sim")}, count(satisfeito) FROM silver_core GROUP BY ano"""),
}


def register_functions(spark: SparkSession) -> None:
    """Make the questions functions of the session. They read the views of the moment they are asked."""
    for signature, (columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")


def ask(core: DataFrame, long_series: DataFrame, text: str) -> DataFrame:
    """A question in SQL over two layers, which become the session's views."""
    register_views({"silver_core": core, "silver_serie_longa": long_series})
    register_functions(core.sparkSession)
    return core.sparkSession.sql(text)
