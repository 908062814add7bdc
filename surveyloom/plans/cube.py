"""All marts from three scans: counts by answer, kept per edition as a table, of which every mart is a roll-up."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.scalars import percent
from surveyloom.operators.ranks import value_profile
from surveyloom.operators.shares import option_rows, share_within
from surveyloom.plans import vocabulary as v

#: Answers that are counted together, besides the edition. Pay is counted by value, so that medians stay exact.
SETS = {
    "pessoas": ("genero", "nivel", "cargo_grupo", "regiao", "gestor", "salario_pm"),
    "prioridade": ("prioridade_ia_h",),
    "modelos": ("modelo_atual_h", "modelo_ideal_h"),
    "mudanca": ("mudar_emprego_6m",),
}
CORE_FLAGS = (*v.BI_TOOLS, *v.GENAI_USES, *v.JOB_CRITERIA, *v.MANAGER_CHALLENGES, "satisfeito", "layoff_sim")
SERIES_FLAGS = (*v.LANGUAGES, *v.CLOUDS)
TABLES = ("respostas", "marcas", "serie")


class Cube(NamedTuple):
    """`respostas`: cells of all SETS, with `_set` and the rows `_n`; `marcas`: core flags by edition and level;
    `serie`: rows and flags of the long series by edition and gender. Counts of different rows add up."""

    respostas: DataFrame
    marcas: DataFrame
    serie: DataFrame


def answer_cells(core: DataFrame) -> DataFrame:
    """Rows of each combination of answers of each set, by one pass with grouping sets."""
    columns = ["ano", *dict.fromkeys(c for answers in SETS.values() for c in answers)]
    sets = {name: ["ano", *answers] for name, answers in SETS.items()}
    # a column's bit is set where a set leaves it out, the first column has the highest
    ids = {name: sum(1 << len(columns) - 1 - i for i, c in enumerate(columns) if c not in own) for name, own in sets.items()}
    name = F.element_at(F.create_map(*[F.lit(x) for n, i in ids.items() for x in (i, n)]), F.grouping_id().cast("int"))
    return core.groupingSets([[F.col(c) for c in own] for own in sets.values()], *[F.col(c) for c in columns]).agg(
        name.alias("_set"), F.count(F.lit(1)).alias("_n"))


def flag_cells(df: DataFrame, keys: Sequence[str], flags: Iterable[str]) -> DataFrame:
    """Rows, and answers and ones of each flag, side by side."""
    counts = [f(c).alias(f"{c}__{n}") for c in flags for n, f in (("count", F.count), ("sum", F.sum))]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *counts)


def build(core: DataFrame, long_series: DataFrame) -> Cube:
    return Cube(answer_cells(core), flag_cells(core, ["ano", "nivel"], CORE_FLAGS),
                flag_cells(long_series, ["ano", "genero"], SERIES_FLAGS))


def write(cube: Cube, folder: str) -> Cube:
    """Write the cube, one directory per edition, and read it back."""
    for name, df in zip(TABLES, cube):
        df.write.mode("overwrite").partitionBy("ano").parquet(f"{folder}/{name}")
    spark = cube.respostas.sparkSession
    return Cube(*(spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in zip(TABLES, cube)))


def read(spark: SparkSession, folder: str) -> Cube:
    return Cube(*(spark.read.parquet(f"{folder}/{name}") for name in TABLES))


def refreshed(before: Cube, core: DataFrame, long_series: DataFrame, editions: Sequence[int]) -> Cube:
    """The cube with some editions counted anew; of the layers only their directories are read."""
    changed = F.col("ano").isin(*editions)
    now = build(core.filter(changed), long_series.filter(changed))
    return Cube(*(old.filter(~changed).unionByName(new) for old, new in zip(before, now)))


def _set(cube: Cube, name: str) -> DataFrame:
    return cube.respostas.filter(F.col("_set") == name).select("ano", *SETS[name], "_n")


def _given(column: str) -> Column:
    return F.col(column).isNotNull()


def _region() -> Column:
    return _given("regiao") & (F.col("regiao") != "")


def _counted(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum("_n").alias("n"))


def _distribution(cells: DataFrame, label: str) -> DataFrame:
    return share_within(_counted(cells.filter(_given(label)), "ano", label), ["ano"])


def _pay(cells: DataFrame, keys: Sequence[str], n: str = "n", suffix: str = "") -> DataFrame:
    answered = _given("salario_pm")
    for c in keys:
        answered = answered & _given(c)
    return value_profile(cells.filter(answered), keys, "salario_pm", weight="_n").select(
        *keys, F.col("n").alias(n), F.round("mean", 0).alias("salario_medio_pm" + suffix),
        F.round("median", 0).alias("salario_mediano_pm" + suffix))


def _options(cells: DataFrame, options: Mapping[str, str], name: str, by: Sequence[str] = ("ano",)) -> DataFrame:
    sums = [F.sum(f"{c}__{n}").alias(f"{c}__{n}") for c in options for n in ("count", "sum")]
    return option_rows(cells.groupBy(*by).agg(*sums), options, name, by)


def _role_seniority(cube: Cube) -> DataFrame:
    keys = ["ano", "cargo_grupo"]
    rows = _set(cube, "pessoas").filter(_given("cargo_grupo")).select(
        *keys, "nivel", "_n", F.when(F.col("nivel") == v.SENIOR, F.col("salario_pm")).alias("_senior_pay"))

    def where(test: Column) -> Column:
        return F.sum(F.when(test, F.col("_n")).otherwise(0))

    profile = value_profile(rows, keys, "_senior_pay", weight="_n", sums={
        "total_grupo": where(_given("nivel")), "_plus": where(F.col("nivel").isin(*v.SENIOR_PLUS))})
    return profile.filter(F.col("total_grupo") > 0).select(
        *keys, "total_grupo", percent("_plus", "total_grupo").alias("pct_senior_mais"),
        F.nullif(F.col("n_value"), F.lit(0)).alias("n_senior"), F.round("median", 0).alias("salario_mediano_pm_senior"))


def _gender_role(cube: Cube) -> DataFrame:
    seniors = _compared(cube).filter((F.col("nivel") == v.SENIOR) & _given("cargo_grupo"))
    profile = value_profile(seniors, ["ano", "genero", "cargo_grupo"], "salario_pm", weight="_n").select(
        "ano", "genero", "cargo_grupo", "n", F.col("n_value").alias("n_salario"),
        F.round("median", 0).alias("salario_mediano_pm"))
    return share_within(profile, ["ano", "genero"], name="pct_do_genero")


def _compared(cube: Cube) -> DataFrame:
    return _set(cube, "pessoas").filter(F.col("genero").isin(*v.COMPARED_GENDERS))


def _leadership(cube: Cube) -> DataFrame:
    led = _compared(cube).filter(_given("gestor")).groupBy("ano", "genero").agg(
        F.sum("_n").alias("n"), F.sum(F.col("gestor") * F.col("_n")).alias("gestores"))
    return led.withColumn("pct_gestores", F.round(100 * (F.col("gestores") / F.col("n")), 1))


def _technologies(cube: Cube) -> DataFrame:
    every = _options(cube.serie, v.LANGUAGES | v.CLOUDS, "tecnologia").withColumn("categoria", F.when(
        F.col("tecnologia").isin(*v.LANGUAGES.values()), F.lit("linguagem")).otherwise(F.lit("cloud")))
    bi = _options(cube.marcas, v.BI_TOOLS, "tecnologia").withColumn("categoria", F.lit("bi"))
    return every.unionByName(bi).select("ano", "categoria", "tecnologia", "usuarios", "base_valida", "pct")


def _regions(cube: Cube) -> DataFrame:
    profile = value_profile(_set(cube, "pessoas").filter(_region()), ["ano", "regiao"], "salario_pm", weight="_n").select(
        "ano", "regiao", "n", F.col("n_value").alias("n_salario"), F.round("mean", 0).alias("salario_medio_pm"),
        F.round("median", 0).alias("salario_mediano_pm"))
    return share_within(profile, ["ano"])


def _work_model(cube: Cube) -> DataFrame:
    answers = _set(cube, "modelos").select("ano", "_n", F.inline(F.array(
        F.struct(F.lit("Atual").alias("tipo"), F.col("modelo_atual_h").alias("modelo")),
        F.struct(F.lit("Ideal").alias("tipo"), F.col("modelo_ideal_h").alias("modelo")))))
    return share_within(_counted(answers.filter(_given("modelo")), "ano", "tipo", "modelo"), ["ano", "tipo"])


def _pulse(cube: Cube) -> DataFrame:
    sums = cube.marcas.groupBy("ano").agg(*[
        F.sum(f"{c}__{n}").alias(f"{c}__{n}") for c in ("satisfeito", "layoff_sim") for n in ("count", "sum")])

    def rate(c: str) -> Column:
        return F.round(100 * F.try_divide(F.col(f"{c}__sum"), F.col(f"{c}__count")), 1)

    return sums.select("ano", rate("satisfeito").alias("pct_satisfeitos"), F.col("satisfeito__count").alias("n_satisfacao"),
                       rate("layoff_sim").alias("pct_layoff_sim"), F.col("layoff_sim__count").alias("n_layoff"))


def rollups() -> dict[str, Callable[[Cube], DataFrame]]:
    """Every mart by its published name, as a roll-up of the cube."""
    def people(cube: Cube) -> DataFrame:
        return _set(cube, "pessoas")

    return {
        "gold_respondents": lambda q: _counted(q.serie, "ano"),
        "gold_roles": lambda q: _distribution(people(q), "cargo_grupo"),
        "gold_seniority": lambda q: _distribution(people(q), "nivel"),
        "gold_salary_by_seniority": lambda q: _pay(people(q), ["ano", "nivel"]),
        "gold_salary_by_role": lambda q: _pay(people(q), ["ano", "cargo_grupo"]),
        "gold_salary_by_role_seniority": _role_seniority,
        "gold_gender_participation": lambda q: _distribution(q.serie, "genero"),
        "gold_gender_seniority_salary": lambda q: _pay(_compared(q), ["ano", "genero", "nivel"]),
        "gold_gender_leadership": _leadership,
        "gold_gender_role_seniority": _gender_role,
        "gold_technologies": _technologies,
        "gold_ai_priority": lambda q: _distribution(_set(q, "prioridade"), "prioridade_ia_h"),
        "gold_genai_usage": lambda q: _options(q.marcas, v.GENAI_USES, "modalidade"),
        "gold_genai_usage_by_seniority": lambda q: _options(
            q.marcas.filter(_given("nivel")), v.GENAI_USES, "modalidade", ["ano", "nivel"]),
        "gold_regions": _regions,
        "gold_regions_by_seniority": lambda q: _pay(
            people(q).filter((F.col("nivel") == v.SENIOR) & _region()), ["ano", "regiao"], n="n_senior", suffix="_senior"),
        "gold_work_model": _work_model,
        "gold_market_pulse": _pulse,
        "gold_job_change_intent": lambda q: _distribution(_set(q, "mudanca"), "mudar_emprego_6m"),
        "gold_job_criteria": lambda q: _options(q.marcas, v.JOB_CRITERIA, "criterio"),
        "gold_manager_challenges": lambda q: _options(q.marcas, v.MANAGER_CHALLENGES, "desafio"),
    }
