"""The published marts. Each takes a harmonised layer and returns one row per group.

`core` is the harmonised core layer, `long_series` the layer with all editions. Rows come unordered;
`MARTS` holds the order used for CSV exports. Exact medians and means come from `value_profile`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.scalars import percent
from surveyloom.operators.ranks import value_profile
from surveyloom.operators.shares import count_by, distribution, flag_rate, multi_response, share_within
from surveyloom.plans import vocabulary as v

_WHOLE = 0


def _answered(*columns: str) -> Column:
    test = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        test = test & F.col(c).isNotNull()
    return test


def _region_given() -> Column:
    return F.col("regiao").isNotNull() & (F.col("regiao") != "")


def pay_table(df: DataFrame, keys: Sequence[str], n: str = "n", suffix: str = "") -> DataFrame:
    """Paid respondents, mean and exact median of pay per group."""
    profile = value_profile(df.filter(_answered("salario_pm", *keys)), keys, "salario_pm")
    return profile.select(
        *keys,
        F.col("n").alias(n),
        F.round("mean", _WHOLE).alias("salario_medio_pm" + suffix),
        F.round("median", _WHOLE).alias("salario_mediano_pm" + suffix),
    )


def respondents(long_series: DataFrame) -> DataFrame:
    return count_by(long_series, "ano")


def roles(core: DataFrame) -> DataFrame:
    return distribution(core, "cargo_grupo")


def seniority(core: DataFrame) -> DataFrame:
    return distribution(core, "nivel")


def salary_by_seniority(core: DataFrame) -> DataFrame:
    return pay_table(core, ["ano", "nivel"])


def salary_by_role(core: DataFrame) -> DataFrame:
    return pay_table(core, ["ano", "cargo_grupo"])


def salary_by_role_seniority(core: DataFrame) -> DataFrame:
    """Role families with the pay of one fixed level, to take seniority out of the comparison.

    One scan: the level counts ride along with the value counts, and pay of other levels is NULL so
    that it stays out of the median.
    """
    keys = ["ano", "cargo_grupo"]
    rows = core.filter(_answered("cargo_grupo")).select(
        *keys, "nivel", F.when(F.col("nivel") == v.SENIOR, F.col("salario_pm")).alias("_senior_pay")
    )
    profile = value_profile(
        rows,
        keys,
        "_senior_pay",
        sums={
            "total_grupo": F.count("nivel"),
            "_plus": F.count_if(F.col("nivel").isin(*v.SENIOR_PLUS)),
        },
    )
    return profile.filter(F.col("total_grupo") > 0).select(
        *keys,
        "total_grupo",
        percent("_plus", "total_grupo").alias("pct_senior_mais"),
        F.nullif(F.col("n_value"), F.lit(0)).alias("n_senior"),
        F.round("median", _WHOLE).alias("salario_mediano_pm_senior"),
    )


def gender_participation(long_series: DataFrame) -> DataFrame:
    return distribution(long_series, "genero")


def gender_seniority_salary(core: DataFrame) -> DataFrame:
    return pay_table(core.filter(F.col("genero").isin(*v.COMPARED_GENDERS)), ["ano", "genero", "nivel"])


def gender_leadership(core: DataFrame) -> DataFrame:
    asked = core.filter(_answered("gestor") & F.col("genero").isin(*v.COMPARED_GENDERS))
    return asked.groupBy("ano", "genero").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("gestor").alias("gestores"),
        flag_rate("gestor").alias("pct_gestores"),
    )


def gender_role_seniority(core: DataFrame) -> DataFrame:
    seniors = core.filter(
        (F.col("nivel") == v.SENIOR) & _answered("cargo_grupo") & F.col("genero").isin(*v.COMPARED_GENDERS)
    )
    profile = value_profile(seniors, ["ano", "genero", "cargo_grupo"], "salario_pm").select(
        "ano", "genero", "cargo_grupo", "n",
        F.col("n_value").alias("n_salario"),
        F.round("median", _WHOLE).alias("salario_mediano_pm"),
    )
    return share_within(profile, ["ano", "genero"], name="pct_do_genero")


def technologies(long_series: DataFrame, core: DataFrame) -> DataFrame:
    def block(df: DataFrame, options: dict[str, str], category: str) -> DataFrame:
        return multi_response(df, options, "tecnologia").withColumn("categoria", F.lit(category))

    every = multi_response(long_series, v.LANGUAGES | v.CLOUDS, "tecnologia").withColumn(
        "categoria",
        F.when(F.col("tecnologia").isin(*v.LANGUAGES.values()), F.lit("linguagem")).otherwise(F.lit("cloud")),
    )
    return every.unionByName(block(core, v.BI_TOOLS, "bi")).select(
        "ano", "categoria", "tecnologia", "usuarios", "base_valida", "pct"
    )


def ai_priority(core: DataFrame) -> DataFrame:
    return distribution(core, "prioridade_ia_h")


def genai_usage(core: DataFrame) -> DataFrame:
    return multi_response(core, v.GENAI_USES, "modalidade")


def genai_usage_by_seniority(core: DataFrame) -> DataFrame:
    return multi_response(core.filter(_answered("nivel")), v.GENAI_USES, "modalidade", ["ano", "nivel"]).select(
        "ano", "nivel", "modalidade", "usuarios", "base_valida", "pct"
    )


def regions(core: DataFrame) -> DataFrame:
    profile = value_profile(core.filter(_region_given()), ["ano", "regiao"], "salario_pm").select(
        "ano", "regiao", "n",
        F.col("n_value").alias("n_salario"),
        F.round("mean", _WHOLE).alias("salario_medio_pm"),
        F.round("median", _WHOLE).alias("salario_mediano_pm"),
    )
    return share_within(profile, ["ano"])


def regions_by_seniority(core: DataFrame) -> DataFrame:
    seniors = core.filter((F.col("nivel") == v.SENIOR) & _region_given())
    return pay_table(seniors, ["ano", "regiao"], n="n_senior", suffix="_senior")


def work_model(core: DataFrame) -> DataFrame:
    """Practised and desired model from one pass over the pairs of both answers."""
    pairs = count_by(core, "ano", "modelo_atual_h", "modelo_ideal_h")
    answers = pairs.select(
        "ano",
        "n",
        F.inline(
            F.array(
                F.struct(F.lit("Atual").alias("tipo"), F.col("modelo_atual_h").alias("modelo")),
                F.struct(F.lit("Ideal").alias("tipo"), F.col("modelo_ideal_h").alias("modelo")),
            )
        ),
    )
    counted = answers.filter(_answered("modelo")).groupBy("ano", "tipo", "modelo").agg(F.sum("n").alias("n"))
    return share_within(counted, ["ano", "tipo"])


def market_pulse(core: DataFrame) -> DataFrame:
    return core.groupBy("ano").agg(
        flag_rate("satisfeito").alias("pct_satisfeitos"),
        F.count("satisfeito").alias("n_satisfacao"),
        flag_rate("layoff_sim").alias("pct_layoff_sim"),
        F.count("layoff_sim").alias("n_layoff"),
    )


def job_change_intent(core: DataFrame) -> DataFrame:
    return distribution(core, "mudar_emprego_6m")


def job_criteria(core: DataFrame) -> DataFrame:
    return multi_response(core, v.JOB_CRITERIA, "criterio")


def manager_challenges(core: DataFrame) -> DataFrame:
    return multi_response(core, v.MANAGER_CHALLENGES, "desafio")


@dataclass(frozen=True)
class Mart:
    build: Callable[[DataFrame, DataFrame], DataFrame]
    order: tuple[str | Column, ...]


def _desc(c: str) -> Column:
    return F.col(c).desc()


def marts() -> dict[str, Mart]:
    """All marts by published name, built from `(core, long_series)`, with their export order."""
    return {
        "gold_respondents": Mart(lambda c, s: respondents(s), ("ano",)),
        "gold_roles": Mart(lambda c, s: roles(c), ("ano", _desc("n"), "cargo_grupo")),
        "gold_seniority": Mart(lambda c, s: seniority(c), ("ano", "nivel")),
        "gold_salary_by_seniority": Mart(lambda c, s: salary_by_seniority(c), ("ano", "nivel")),
        "gold_salary_by_role": Mart(
            lambda c, s: salary_by_role(c), ("ano", _desc("salario_mediano_pm"), "cargo_grupo")),
        "gold_salary_by_role_seniority": Mart(
            lambda c, s: salary_by_role_seniority(c),
            ("ano", _desc("salario_mediano_pm_senior"), "cargo_grupo")),
        "gold_gender_participation": Mart(lambda c, s: gender_participation(s), ("ano", "genero")),
        "gold_gender_seniority_salary": Mart(
            lambda c, s: gender_seniority_salary(c), ("ano", "nivel", "genero")),
        "gold_gender_leadership": Mart(lambda c, s: gender_leadership(c), ("ano", "genero")),
        "gold_gender_role_seniority": Mart(
            lambda c, s: gender_role_seniority(c), ("ano", "genero", _desc("n"), "cargo_grupo")),
        "gold_technologies": Mart(lambda c, s: technologies(s, c), ("categoria", "tecnologia", "ano")),
        "gold_ai_priority": Mart(lambda c, s: ai_priority(c), ("ano", "prioridade_ia_h")),
        "gold_genai_usage": Mart(lambda c, s: genai_usage(c), ("modalidade", "ano")),
        "gold_genai_usage_by_seniority": Mart(
            lambda c, s: genai_usage_by_seniority(c), ("ano", "modalidade", "nivel")),
        "gold_regions": Mart(lambda c, s: regions(c), ("ano", _desc("n"), "regiao")),
        "gold_regions_by_seniority": Mart(
            lambda c, s: regions_by_seniority(c), ("ano", "salario_medio_pm_senior", "regiao")),
        "gold_work_model": Mart(lambda c, s: work_model(c), ("ano", "tipo", "modelo")),
        "gold_market_pulse": Mart(lambda c, s: market_pulse(c), ("ano",)),
        "gold_job_change_intent": Mart(
            lambda c, s: job_change_intent(c), ("ano", _desc("n"), "mudar_emprego_6m")),
        "gold_job_criteria": Mart(lambda c, s: job_criteria(c), ("ano", _desc("pct"), "criterio")),
        "gold_manager_challenges": Mart(
            lambda c, s: manager_challenges(c), ("ano", _desc("pct"), "desafio")),
    }
