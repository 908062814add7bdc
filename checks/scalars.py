"""Scalar functions over the raw answers of every order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import survey
from checks.indicators import NAMES
from checks.marts import dist_sql
from checks.registry import query
from surveyloom.functions import scalars as x
from surveyloom.operators.shares import distribution
from surveyloom.plans import silver
from surveyloom.plans import vocabulary as v

NUMBERS = r"regexp_extract_all(faixa_salarial, '\d[\d\.]*')"


@query("x01_band_midpoint", "SELECT t.k, t.faixa_salarial, e.salario_pm FROM texts t JOIN silver_every e ON t.k = e.k",
       "texts silver_every")
def x01(spark, sf):
    return survey.texts(spark, sf, "k", "faixa_salarial").withColumn("salario_pm", x.band_midpoint("faixa_salarial"))


@query("x02_extract_numbers", f"SELECT k, array_to_string({NUMBERS}, ';') AS numeros FROM texts", "texts")
def x02(spark, sf):
    found = F.array_join(x.extract_numbers("faixa_salarial"), ";")
    return survey.texts(spark, sf, "k", "faixa_salarial").select("k", found.alias("numeros"))


@query("x03_strip_thousands", f"""SELECT k, CAST(replace({NUMBERS}[1], '.', '') AS DOUBLE) AS primeiro FROM texts""",
       "texts")
def x03(spark, sf):
    first = F.get(x.extract_numbers("faixa_salarial"), F.lit(0))
    return survey.texts(spark, sf, "k", "faixa_salarial").select("k", x.strip_thousands(first).alias("primeiro"))


@query("x04_repair_ceiling", f"""SELECT k, piso, CASE WHEN topo < piso THEN topo * 10 ELSE topo END AS teto FROM (
 SELECT k, CAST(replace({NUMBERS}[1], '.', '') AS DOUBLE) AS piso,
 CAST(replace({NUMBERS}[2], '.', '') AS DOUBLE) AS topo FROM texts)""", "texts")
def x04(spark, sf):
    numbers = x.extract_numbers("faixa_salarial")
    ends = survey.texts(spark, sf, "k", "faixa_salarial").select(
        "k",
        x.strip_thousands(F.get(numbers, F.lit(0))).alias("piso"),
        x.strip_thousands(F.get(numbers, F.lit(1))).alias("topo"),
    )
    return ends.select("k", "piso", x.repair_ceiling(F.col("piso"), F.col("topo")).alias("teto"))


@query("x05_role_family", "SELECT k, cargo, cargo_grupo FROM every", "every")
def x05(spark, sf):
    return survey.texts(spark, sf, "k", "cargo").withColumn("cargo_grupo", silver.role_family("cargo"))


@query("x06_work_model", "SELECT k, modelo_atual, modelo_atual_h, modelo_ideal, modelo_ideal_h FROM every", "every")
def x06(spark, sf):
    return (
        survey.texts(spark, sf, "k", "modelo_atual", "modelo_ideal")
        .withColumn("modelo_atual_h", silver.work_model("modelo_atual"))
        .withColumn("modelo_ideal_h", silver.work_model("modelo_ideal"))
    )


@query("x07_ordinal_prefix", "SELECT k, prioridade_ia, prioridade_ia_h FROM every", "every")
def x07(spark, sf):
    return survey.texts(spark, sf, "k", "prioridade_ia").withColumn(
        "prioridade_ia_h", silver.ai_priority("prioridade_ia"))


@query("x08_bool_normalise", "SELECT k, gestor, satisfeito, lang_python, crit_salario FROM every", "every")
def x08(spark, sf):
    flags = ["gestor", "satisfeito", "lang_python", "crit_salario"]
    return silver.apply_to(survey.texts(spark, sf, "k", *flags), flags, x.flag)


@query("x09_prefix_tristate", "SELECT k, layoff, layoff_sim FROM every", "every")
def x09(spark, sf):
    return survey.texts(spark, sf, "k", "layoff").withColumn("layoff_sim", x.prefix_tristate("layoff"))


@query("x10_lenient_int_cast", "SELECT k, idade FROM every", "every")
def x10(spark, sf):
    return survey.texts(spark, sf, "k", "idade").withColumn("idade", x.lenient_int("idade"))


@query("x11_round_half_up", """SELECT k, CAST(round(CAST(price AS DECIMAL(18, 2)), 0) AS DOUBLE) AS inteiro,
 CAST(round(CAST(price AS DECIMAL(18, 2)), 1) AS DOUBLE) AS uma_casa FROM texts""", "texts")
def x11(spark, sf):
    return survey.texts(spark, sf, "k", "price").select(
        "k", F.round("price", 0).alias("inteiro"), F.round("price", 1).alias("uma_casa"))


@query("x12_coalesce_default", """SELECT k, CASE WHEN gestor IS NULL THEN -1 ELSE gestor END AS gestor,
 CASE WHEN cargo IS NULL THEN CASE WHEN cargo_gestor IS NULL THEN '?' ELSE cargo_gestor END ELSE cargo END AS funcao
 FROM every""", "every")
def x12(spark, sf):
    return survey.every(spark, sf, "k", "gestor", "cargo", "cargo_gestor").select(
        "k",
        F.coalesce("gestor", F.lit(-1)).alias("gestor"),
        F.coalesce("cargo", "cargo_gestor", F.lit("?")).alias("funcao"),
    )


@query("x13_case_when", """SELECT k, CASE WHEN gestor = 1 THEN 'gestor' WHEN gestor = 0 THEN 'contribuidor' END AS papel,
 CASE WHEN nivel = 'Sênior' THEN salario_pm END AS salario_senior FROM every""", "every")
def x13(spark, sf):
    return survey.every(spark, sf, "k", "gestor", "nivel", "salario_pm").select(
        "k",
        F.when(F.col("gestor") == 1, "gestor").when(F.col("gestor") == 0, "contribuidor")
        .otherwise(F.lit(None).cast("string")).alias("papel"),
        F.when(F.col("nivel") == v.SENIOR, F.col("salario_pm")).alias("salario_senior"),
    )


@query("x14_case_fold", "SELECT k, upper(mudar_emprego_6m) AS maiuscula, lower(cargo) AS minuscula FROM every", "every")
def x14(spark, sf):
    return survey.every(spark, sf, "k", "mudar_emprego_6m", "cargo").select(
        "k", F.upper("mudar_emprego_6m").alias("maiuscula"), F.lower("cargo").alias("minuscula"))


@query("x15_contains_prefix", """SELECT k, CAST(contains(cargo, 'Dados') AS INT) AS tem_dados,
 CAST(starts_with(layoff, 'Sim') AS INT) AS comeca_sim FROM every""", "every")
def x15(spark, sf):
    return survey.every(spark, sf, "k", "cargo", "layoff").select(
        "k",
        x.any_contains(F.col("cargo"), ["Dados"]).cast("int").alias("tem_dados"),
        x.any_prefix("layoff", ["Sim"]).cast("int").alias("comeca_sim"),
    )


@query("x16_percent_ratio", """SELECT ano, uf, round(100 * sum(gestor) / nullif(count(gestor), 0), 1) AS pct_gestores,
 round(100 * count(genai_copilot) / count(*), 1) AS pct_respondido FROM every GROUP BY ano, uf""", "every")
def x16(spark, sf):
    return survey.every(spark, sf, "ano", "uf", "gestor", "genai_copilot").groupBy("ano", "uf").agg(
        x.percent(F.sum("gestor"), F.count("gestor")).alias("pct_gestores"),
        x.percent(F.count("genai_copilot"), F.count(F.lit(1))).alias("pct_respondido"),
    )


@query("x17_relative_gap", """SELECT ano, round(100 * (avg(salario_pm) FILTER (genero = 'Feminino') /
 avg(salario_pm) FILTER (genero = 'Masculino') - 1), 1) AS gap_pct FROM every GROUP BY ano""", "every")
def x17(spark, sf):
    def mean(g: str):
        return F.avg(F.when(F.col("genero") == g, F.col("salario_pm")))

    return survey.every(spark, sf, "ano", "genero", "salario_pm").groupBy("ano").agg(
        x.relative_gap(mean("Feminino"), mean("Masculino")).alias("gap_pct"))


@query("x18_point_delta", f"""SELECT ano, genero, round(pct - before, 1) AS delta_pp, round(pct / before, 1) AS multiplo
 FROM (SELECT *, lag(pct) OVER (PARTITION BY genero ORDER BY ano) AS before FROM ({dist_sql("genero", "serie")}))""",
       "serie")
def x18(spark, sf):
    shares = distribution(survey.long_series(spark, sf, "ano", "genero"), "genero")
    before = F.lag("pct").over(Window.partitionBy("genero").orderBy("ano"))
    return shares.withColumn("before", before).select(
        "ano", "genero",
        x.point_delta("pct", "before").alias("delta_pp"),
        x.growth_multiple("pct", "before").alias("multiplo"),
    )


@query("x19_locale_number", """SELECT k, translate(format('{:,.1f}', price), ',.', '.,') AS valor,
 translate(format('{:,.1f}', price / 100), ',.', '.,') || '%' AS percentual,
 replace(format('{:+.1f}', price - 250000), '.', ',') AS delta FROM texts""", "texts")
def x19(spark, sf):
    price = F.col("price")
    return survey.texts(spark, sf, "k", "price").select(
        "k",
        x.pt_number(price, 1).alias("valor"),
        x.pt_percent(price / 100).alias("percentual"),
        x.pt_signed(price - 250000).alias("delta"),
    )


LABEL_SQL = f"CASE WHEN ano = {survey.LAST} THEN '{NAMES[survey.LAST]}' ELSE CAST(ano AS VARCHAR) END"


@query("x20_edition_label", f"""SELECT id, CASE WHEN count(*) = 1 THEN 'Edição ' || min(rotulo)
 WHEN count(*) > 3 THEN 'Edições ' || arg_min(rotulo, ano) || ' a ' || arg_max(rotulo, ano)
 ELSE 'Edições ' || string_agg(rotulo, ', ' ORDER BY ano) END AS edicoes
 FROM (SELECT DISTINCT id, ano, {LABEL_SQL} AS rotulo FROM every) GROUP BY id""", "every")
def x20(spark, sf):
    seen = survey.every(spark, sf, "id", "ano").groupBy("id").agg(
        F.sort_array(F.collect_set("ano")).alias("anos"))
    return seen.select("id", x.editions_caption("anos", NAMES).alias("edicoes"))


@query("x21_label_rewrite", """SELECT k, replace(replace(substr(prioridade_ia_h, instr(prioridade_ia_h, '. ') + 2),
 ' (2-4 anos)', ' / 2-4 anos'), ', sem foco', ' / sem foco') AS rotulo FROM every""", "every")
def x21(spark, sf):
    swaps = {" (2-4 anos)": " / 2-4 anos", ", sem foco": " / sem foco"}
    label = x.replace_fragments(x.drop_ordinal("prioridade_ia_h"), swaps)
    return survey.every(spark, sf, "k", "prioridade_ia_h").select("k", label.alias("rotulo"))


@query("x22_caption_concat", f"""SELECT genero, string_agg(replace(format('{{:,}}', n), ',', '.') || ' (' || {LABEL_SQL}
 || ')', ' / ' ORDER BY ano) AS legenda FROM (SELECT genero, ano, count(*) AS n FROM serie GROUP BY genero, ano)
 GROUP BY genero""", "serie")
def x22(spark, sf):
    counts = survey.long_series(spark, sf, "ano", "genero").groupBy("genero", "ano").agg(F.count(F.lit(1)).alias("n"))
    sizes = F.collect_list(F.struct("ano", "n"))
    return counts.groupBy("genero").agg(x.sizes_caption(sizes, NAMES).alias("legenda"))
