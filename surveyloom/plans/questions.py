"""The seven published questions, on the harmonised layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.scalars import point_delta, relative_gap
from surveyloom.operators.shape import side_by_side, top_per_group
from surveyloom.operators.shares import distribution, flag_rate
from surveyloom.plans import marts
from surveyloom.plans import vocabulary as v

_ACCURACY = 10000


def approx_median(value: Column | str) -> Column:
    """Value at the middle rank, from a mergeable sketch."""
    return F.percentile_approx(value, 0.5, _ACCURACY)


def top_roles(core: DataFrame, k: int = 5) -> DataFrame:
    return top_per_group(marts.roles(core), ["ano"], "n", ["cargo_grupo"], k)


def salary_ladder(core: DataFrame) -> DataFrame:
    paid = core.filter(F.col("salario_pm").isNotNull() & F.col("nivel").isNotNull())
    return paid.groupBy("ano", "nivel").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(approx_median("salario_pm"), 0).alias("salario_mediano_pm"),
    )


def gender_gap(core: DataFrame, edition: int) -> DataFrame:
    """Both genders of a level in one aggregate; a level only one of them answered is left out."""
    women, men = (F.col("genero") == g for g in ("Feminino", "Masculino"))
    paid = core.filter(
        (F.col("ano") == edition)
        & F.col("salario_pm").isNotNull()
        & F.col("nivel").isNotNull()
        & F.col("genero").isin(*v.COMPARED_GENDERS)
    )
    return (
        paid.groupBy("nivel")
        .agg(
            approx_median(F.when(women, F.col("salario_pm"))).alias("f"),
            approx_median(F.when(men, F.col("salario_pm"))).alias("m"),
            F.count_if(women).alias("n_feminino"),
            F.count_if(men).alias("n_masculino"),
        )
        .filter((F.col("n_feminino") > 0) & (F.col("n_masculino") > 0))
        .select(
            "nivel",
            F.round("f", 0).alias("mediana_feminino"),
            F.round("m", 0).alias("mediana_masculino"),
            relative_gap("f", "m").alias("gap_pct"),
            "n_feminino",
            "n_masculino",
        )
    )


def tech_evolution(long_series: DataFrame) -> DataFrame:
    return long_series.groupBy("ano").agg(
        flag_rate("lang_python").alias("pct_python"),
        flag_rate("lang_sql").alias("pct_sql"),
        flag_rate("cloud_aws").alias("pct_aws"),
        F.count("lang_python").alias("base_valida"),
    )


def ai_priority(core: DataFrame) -> DataFrame:
    return distribution(core, "prioridade_ia_h")


def model_gap(core: DataFrame, edition: int) -> DataFrame:
    """Practised against desired share of one edition; a model on one side only keeps its row."""
    both = side_by_side(
        marts.work_model(core.filter(F.col("ano") == edition)),
        ["modelo"],
        "tipo",
        {"pct_atual": ("Atual", "pct"), "pct_ideal": ("Ideal", "pct")},
    )
    return both.withColumn("gap_pp", point_delta("pct_ideal", "pct_atual"))


def market_pulse(core: DataFrame) -> DataFrame:
    return core.groupBy("ano").agg(
        flag_rate("satisfeito").alias("pct_satisfeitos"),
        flag_rate("layoff_sim").alias("pct_layoff_sim"),
        F.count("satisfeito").alias("n_validos"),
    )
