"""Derived indicators: each takes marts and returns the figures quoted from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import scalars as x
from surveyloom.operators import shape
from surveyloom.plans import vocabulary as v


def _shown(df: DataFrame, edition: int, base: str) -> DataFrame:
    """One edition of a mart without the groups too small to show."""
    return df.filter((F.col("ano") == edition) & (F.col(base) >= v.DISPLAY_MINIMUM))


def role_seniority_check(mart: DataFrame, edition: int) -> DataFrame:
    return _shown(mart, edition, "total_grupo")


def gender_role_check(mart: DataFrame, edition: int, families: Sequence[str]) -> DataFrame:
    return mart.filter((F.col("ano") == edition) & F.col("cargo_grupo").isin(*families))


def usage_by_level_check(mart: DataFrame, edition: int, usage: str) -> DataFrame:
    return _shown(mart, edition, "base_valida").filter(F.col("modalidade") == usage)


def region_senior_check(mart: DataFrame, edition: int) -> DataFrame:
    return _shown(mart, edition, "n_senior")


def largest_roles(mart: DataFrame, edition: int, k: int = 9) -> DataFrame:
    return shape.top_k(mart.filter(F.col("ano") == edition), "n", ["cargo_grupo"], k)


def best_paid_roles(mart: DataFrame, edition: int, k: int = 9) -> DataFrame:
    return shape.top_k(_shown(mart, edition, "n"), "salario_mediano_pm", ["cargo_grupo"], k)


def senior_plus_share(mart: DataFrame) -> DataFrame:
    senior = F.col("nivel").isin(*v.SENIOR_PLUS)
    return mart.groupBy("ano").agg(F.round(F.sum(F.when(senior, F.col("pct"))), 1).alias("pct_senior_mais"))


def peak_and_drop(mart: DataFrame, gender: str = "Feminino") -> DataFrame:
    """Highest and latest share of a series and the points lost since the peak."""
    return (
        mart.filter(F.col("genero") == gender)
        .agg(F.max("pct").alias("pico"), F.max_by("pct", "ano").alias("atual"))
        .withColumn("queda_pp", x.point_delta("pico", "atual"))
    )


def gender_gap_at_level(mart: DataFrame, edition: int, level: str = v.SENIOR) -> DataFrame:
    women, men = F.col("feminino"), F.col("masculino")
    return (
        mart.filter((F.col("ano") == edition) & (F.col("nivel") == level))
        .agg(
            shape.at("salario_mediano_pm", genero="Feminino").alias("feminino"),
            shape.at("salario_mediano_pm", genero="Masculino").alias("masculino"),
        )
        .select(
            "feminino",
            "masculino",
            x.relative_gap(women, men).alias("gap_pct"),
            (men - women).alias("gap_absoluto"),
            F.round(100 * (1 - F.try_divide(women, men)), 1).alias("gap_relativo"),
        )
    )


def latest_adoption(mart: DataFrame, categories: Sequence[str] = ("linguagem", "cloud")) -> DataFrame:
    return (
        mart.filter(F.col("categoria").isin(*categories))
        .groupBy("categoria", "tecnologia")
        .agg(
            F.max("ano").alias("ano_atual"),
            F.max_by("pct", "ano").alias("pct_atual"),
            F.max("pct").alias("pct_pico"),
        )
    )


def tool_ranking(mart: DataFrame, edition: int, category: str = "bi") -> DataFrame:
    rows = mart.filter((F.col("ano") == edition) & (F.col("categoria") == category))
    order = Window.partitionBy("ano").orderBy(F.col("pct").desc(), "tecnologia")
    return rows.select(
        F.row_number().over(order).alias("posicao"),
        "tecnologia",
        "pct",
        F.max("base_valida").over(Window.partitionBy("ano")).alias("base_maxima"),
    )


def _first_last(df: DataFrame, value: str, first: int, last: int, *keys: str) -> DataFrame:
    ends = df.groupBy(*keys) if keys else df
    return (
        ends.agg(shape.at(value, ano=first).alias("inicio"), shape.at(value, ano=last).alias("fim"))
        .withColumn("delta_pp", x.point_delta("fim", "inicio"))
        .withColumn("multiplo", x.growth_multiple("fim", "inicio"))
    )


def _top_priority() -> Column:
    return x.any_prefix("prioridade_ia_h", ("1.", "2."))


def top_priority_share(mart: DataFrame) -> DataFrame:
    share = F.sum(F.when(_top_priority(), F.col("pct")))
    return mart.groupBy("ano").agg(F.round(share, 1).alias("pct_top2"))


def top_priority_growth(mart: DataFrame, first: int, last: int) -> DataFrame:
    return _first_last(top_priority_share(mart), "pct_top2", first, last)


def usage_growth(mart: DataFrame, first: int, last: int, usages: Sequence[str]) -> DataFrame:
    return _first_last(mart.filter(F.col("modalidade").isin(*usages)), "pct", first, last, "modalidade")


def technology_growth(mart: DataFrame, technology: str, first: int, last: int) -> DataFrame:
    return _first_last(mart.filter(F.col("tecnologia") == technology), "pct", first, last)


def base_caption(mart: DataFrame, names: dict[int, str]) -> DataFrame:
    """`n (edition) / n (edition)` over the largest valid base of each edition."""
    bases = mart.groupBy("ano").agg(F.max("base_valida").alias("n"))
    sizes = F.collect_list(F.struct("ano", "n"))
    return bases.agg(x.sizes_caption(sizes, names).alias("legenda"))


def region_amplitude(mart: DataFrame, edition: int) -> DataFrame:
    """Distance between the best and the least paid region at one level, in percent."""
    pay = F.col("salario_medio_pm_senior")
    return _shown(mart, edition, "n_senior").agg(
        x.relative_gap(F.max(pay), F.min(pay)).alias("amplitude_pct")
    )


def practised_and_desired(mart: DataFrame, edition: int) -> DataFrame:
    rows = mart.filter((F.col("ano") == edition) & (F.col("modelo") != v.WORK_MODEL_DEFAULT))
    wide = shape.side_by_side(
        rows, ["ano", "modelo"], "tipo", {"pct_atual": ("Atual", "pct"), "pct_ideal": ("Ideal", "pct")}
    )
    return shape.densify(wide, ["ano"], "modelo", v.WORK_MODEL_ORDER, ["pct_atual", "pct_ideal"])


def criteria_highlight(mart: DataFrame, edition: int, k: int = 2) -> DataFrame:
    rows = mart.filter(F.col("ano") == edition)
    return shape.flag_top_values(rows, ["ano"], "pct", k, "destaque").select("criterio", "pct", "destaque")


def seniority_grid(mart: DataFrame) -> DataFrame:
    """Level by edition; a level that did not exist yet stays NULL."""
    return shape.densify(mart, ["ano"], "nivel", v.LEVELS, ["pct"])
