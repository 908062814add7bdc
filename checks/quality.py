"""Quality gates and resampling, on raw files and harmonised rows derived from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import survey
from checks.marts import land_raw
from checks.registry import ORACLES, query
from surveyloom.functions import scalars
from surveyloom.operators import bootstrap, difference, quality, ranks, shares
from surveyloom.plans import contract, release, silver
from surveyloom.plans import vocabulary as v
from surveyloom.sources import editions, headers
from surveyloom.sources.folders import new_path

FIRST, LAST = survey.FIRST, survey.LAST
DROPPED = ("genero", "cargo", "lang_r")


def lost(year: int) -> list[tuple[str, str]]:
    return [(t, survey.HEADERS[year][t]) for t in DROPPED if t in survey.HEADERS[year]]


def quoted_rows(pairs) -> str:
    return ", ".join("('{}', '{}')".format(t, s.replace("'", "''")) for t, s in pairs)


@query("d01_missing_columns", " UNION ALL ".join(
    f"SELECT CAST({y} AS INT) AS edition, target, source, (SELECT count(*) FROM every WHERE ano = {y}) AS linhas"
    f" FROM (VALUES {quoted_rows(lost(y))}) AS m(target, source)" for y in survey.ALL_YEARS), "every")
def d01(spark, sf):
    """Files of all editions that lost three columns: what is absent, and how many rows that stops."""
    raw = {y: df.drop(*[source for _, source in lost(y)])
           for y, df in survey.raw_editions(spark, sf, survey.ALL_YEARS).items()}
    mapping = headers.mapping_table(spark, survey.HEADERS)
    header = spark.createDataFrame(
        [(y, c) for y, df in raw.items() for c in df.columns], "edition int, source string")
    stopped = silver.union_editions([
        df.agg(F.count(F.lit(1)).alias("linhas")).withColumn("edition", F.lit(y)) for y, df in raw.items()])
    return quality.missing_columns(mapping, header).join(stopped, "edition")


@query("d02_row_volume_gate", f"""SELECT ano AS edition, count(*) AS n,
 count(*) + CASE WHEN ano = {LAST} THEN 1 ELSE 0 END AS expected,
 CASE WHEN ano = {LAST} THEN 'DIVERGENTE' ELSE 'OK' END AS status FROM every GROUP BY ano""", "every")
def d02(spark, sf):
    """Rows of each landed edition against the orders of its year; the last year is declared one too large."""
    bronze = land_raw(spark, sf, survey.ALL_YEARS)
    arrived = silver.union_editions([
        editions.read_edition(spark, bronze, y).agg(F.count(F.lit(1)).alias("n")).withColumn("edition", F.lit(y))
        for y in survey.ALL_YEARS])
    declared = shares.count_by(survey.every(spark, sf, "ano"), "ano", name="rows").select(
        F.col("ano").alias("edition"),
        (F.col("rows") + (F.col("ano") == LAST).cast("long")).alias("expected"),
    )
    return quality.volume_gate(arrived, declared)


@query("d03_layer_reconcile", f"""SELECT ano, count(*) AS n_bronze, count(*) AS n_silver, CAST(0 AS BIGINT) AS delta
 FROM every GROUP BY ano""", "every")
def d03(spark, sf):
    """Rows of landed files against harmonised rows, edition by edition."""
    landed = land_raw(spark, sf, survey.ALL_YEARS)
    raw = {y: editions.read_edition(spark, landed, y) for y in survey.ALL_YEARS}
    bronze = silver.union_editions([df.select(F.lit(y).alias("ano")) for y, df in raw.items()])
    core = silver.silver_core({y: raw[y] for y in survey.CORE_YEARS}, survey.CORE_HEADERS)
    every = silver.silver_long({y: raw[y] for y in survey.HISTORY_YEARS}, survey.HISTORY_HEADERS, core)
    return quality.reconcile(bronze, every)


COMMENT = "concat('disse \"sim\", talvez', chr(10), 'linha ', CAST(k AS STRING))"


@query("d04_csv_shape", f"""SELECT ano, count(*) AS registros,
 CAST(CASE WHEN ano >= {FIRST} THEN 70 ELSE 8 END AS INT) AS colunas FROM every GROUP BY ano""", "every")
def d04(spark, sf):
    """Records and columns of raw files whose last answer has quotes, commas and line breaks."""
    bronze = new_path(spark, "bronze_shape")
    shapes = []
    for y, df in survey.raw_editions(spark, sf, survey.ALL_YEARS, {"comentario": COMMENT}).items():
        path = editions.edition_path(bronze, y)
        editions.write_raw(df, path)
        width = len(editions.read_raw(spark, path).columns)
        shapes.append(
            editions.count_records(spark, path)
            .agg(F.sum("registros").alias("registros"))
            .select(F.lit(y).alias("ano"), "registros", F.lit(width).alias("colunas"))
        )
    return silver.union_editions(shapes)


@query("d05_fill_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, round(100 * count({c}) / count(*), 1) AS pct_preenchido, '{why}' AS motivo FROM every"
    for c, why in v.EMPTY_REASONS.items()), "every")
def d05(spark, sf):
    return quality.fill_profile(survey.every(spark, sf, *v.EMPTY_REASONS), v.EMPTY_REASONS)


@query("d06_uniqueness", """SELECT ano, count(*) AS linhas, count(DISTINCT id) AS ids_distintos,
 count(*) - count(DISTINCT id) AS tokens_repetidos FROM every GROUP BY ano""", "every")
def d06(spark, sf):
    return quality.uniqueness(survey.every(spark, sf, "ano", "id"), "id")


LABELS = {
    "cargo": ("cargo_grupo", silver.role_family),
    "modelo_atual": ("modelo_atual_h", silver.work_model),
    "modelo_ideal": ("modelo_ideal_h", silver.work_model),
    "prioridade_ia": ("prioridade_ia_h", silver.ai_priority),
    "faixa_salarial": ("salario_pm", scalars.band_midpoint),
}


@query("d07_domain_check", " UNION ALL ".join(
    f"""SELECT '{c}' AS campo, ano, {c} AS resposta, CAST({label} AS VARCHAR) AS rotulo, count(*) AS n
 FROM silver_every GROUP BY ano, {c}, {label}""" for c, (label, _) in LABELS.items()), "silver_every")
def d07(spark, sf):
    """Every answer that is given a label, with the label, in all editions."""
    rows = survey.texts(spark, sf, "ano", *LABELS)
    return silver.union_editions([
        quality.label_pairs(rows.withColumn(label, of(c)), c, label).select(
            F.lit(c).alias("campo"), "ano", F.col(c).alias("resposta"), F.col(label).cast("string").alias("rotulo"), "n")
        for c, (label, of) in LABELS.items()])


@query("d08_run_metrics", f"""SELECT 'linhas_bronze' AS metrica, count(*) AS valor FROM serie
 UNION ALL SELECT 'linhas_nucleo', count(*) FROM core
 UNION ALL SELECT 'descartados', (SELECT count(*) FROM serie WHERE ano >= {FIRST}) - (SELECT count(*) FROM core)
 UNION ALL SELECT 'tokens_repetidos', CAST(sum(d) AS BIGINT) FROM
  (SELECT count(*) - count(DISTINCT id) AS d FROM core GROUP BY ano)
 UNION ALL SELECT 'colunas_nucleo', 76 UNION ALL SELECT 'tabelas_gold', {" + ".join(
    f"CAST(EXISTS (SELECT 1 FROM ({sql})) AS BIGINT)" for key, sql in ORACLES.items() if key[0] == "g")}""", "core serie")
def d08(spark, sf):
    """The run in numbers; marts are counted as they are written, if they have rows."""
    core, series = survey.core(spark, sf, *survey.SILVER), survey.long_series(spark, sf)
    written = release.publish_marts(core, series, new_path(spark, "gold"))
    return quality.run_metrics(core, series, "id", survey.CORE_YEARS, sum(n > 0 for n in written.values()))


DIGESTED = tuple(survey.ANSWERS)


def field_sql(c: str) -> str:
    text = f"CAST({'CAST(salario_pm AS DECIMAL(38,4))' if c == 'salario_pm' else c} AS VARCHAR)"
    return f"coalesce(length({text}) || ':' || {text}, 'N')"


@query("d09_content_checksum", f"""SELECT count(*) AS n,
 CAST(sum(CAST('0x' || substr(md5({" || ".join(map(field_sql, DIGESTED))}), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum
 FROM every""", "every")
def d09(spark, sf):
    """Every column of every edition in one digest."""
    return quality.content_checksum(survey.every(spark, sf, *DIGESTED), DIGESTED)


#: Ranks between which an interval end has to lie: 1.6 and 2.4 standard errors of the median's rank around n / 2.
END_RANKS = {
    "piso_baixo": "greatest(1, floor(n / 2.0 - 1.2 * sqrt(n)))",
    "teto_baixo": "greatest(1, least(n, ceil(n / 2.0 - 0.8 * sqrt(n)) + 1))",
    "piso_alto": "greatest(1, floor(n / 2.0 + 0.8 * sqrt(n)))",
    "teto_alto": "greatest(1, least(n, ceil(n / 2.0 + 1.2 * sqrt(n)) + 1))",
}


@query("d10_bootstrap_median_ci", f"""WITH pay AS (
 SELECT ano, cargo_grupo, count(salario_pm) AS n, median(salario_pm) AS mid, list_sort(list(salario_pm)) AS ordered
 FROM every WHERE salario_pm IS NOT NULL AND cargo_grupo IS NOT NULL GROUP BY ano, cargo_grupo)
SELECT ano, cargo_grupo, n, round(mid, 0) AS mediana,
 {", ".join(f"round(ordered[CAST({rank} AS BIGINT)], 0) AS {name}" for name, rank in END_RANKS.items())},
 true AS baixo_dentro, true AS alto_dentro FROM pay""", "every")
def d10(spark, sf):
    """95% interval of the median pay per edition and role family, from 3000 resamples of each group.

    Resamples are random; what is compared is the values between which theory puts either end, and whether it is there.
    """
    keys = ["ano", "cargo_grupo"]
    paid = survey.every(spark, sf, *keys, "salario_pm").filter("cargo_grupo IS NOT NULL AND salario_pm IS NOT NULL")
    found = bootstrap.median_interval(paid, keys, "salario_pm", v.RESAMPLES, v.RESAMPLE_SEED)
    counted = ranks.value_counts(paid, keys, "salario_pm")
    sizes = paid.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    placed = sizes.selectExpr(*keys, *[f"CAST({rank} AS BIGINT) AS _{name}" for name, rank in END_RANKS.items()])
    asked = placed.selectExpr(*keys, f"explode(array({', '.join(f'_{name}' for name in END_RANKS)})) AS _at").distinct()
    known = bootstrap.values_at(counted, ranks.cells(counted, keys), asked, keys)
    at = known.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_at", F.round("_value", 0)))).alias("_values"))
    valued = found.join(placed.join(at, keys), keys).selectExpr("*", *[f"_values[_{name}] AS {name}" for name in END_RANKS])
    return valued.selectExpr(
        *keys, "n", "mediana", *END_RANKS, "ic_baixo BETWEEN piso_baixo AND teto_baixo AS baixo_dentro",
        "ic_alto BETWEEN piso_alto AND teto_alto AS alto_dentro")


@query("d11_small_group_impact", """SELECT * FROM (SELECT ano, cargo_grupo, nivel, n,
 round(100 * n / sum(n) OVER (PARTITION BY ano), 1) AS pct FROM (
 SELECT ano, cargo_grupo, nivel, count(*) AS n FROM every GROUP BY ano, cargo_grupo, nivel)) WHERE n < 30""", "every")
def d11(spark, sf):
    keys = ["ano", "cargo_grupo", "nivel"]
    return quality.small_groups(survey.every(spark, sf, *keys), keys, v.DISPLAY_MINIMUM)


CHANGED = "k % 1009 = 5"
GONE = "k % 2003 = 7"


@query("d12_release_difference", f"""SELECT 'antes' AS lado, k, genero, nivel FROM every WHERE {CHANGED} OR {GONE}
 UNION ALL SELECT 'depois', k, coalesce(genero, '') || '?', nivel FROM every WHERE {CHANGED} AND NOT {GONE}""", "every")
def d12(spark, sf):
    """Rows that differ between two written releases: some answers changed, some rows are gone."""
    before = survey.every(spark, sf, "k", "genero", "nivel")
    after = before.filter(f"NOT {GONE}").withColumn(
        "genero", F.expr(f"CASE WHEN {CHANGED} THEN concat(coalesce(genero, ''), '?') ELSE genero END"))
    folders = [new_path(spark, "release") for _ in range(2)]
    for df, folder in zip((before, after), folders):
        difference.write_digested(df, folder, ["k"], bits=5)
    return difference.differing_rows(spark, *folders, bits=5)


#: The rules that answers of the order tables can break, in the comparison engine's words.
BROKEN = {"idade_improvavel": "NOT (idade BETWEEN 14 AND 100)",
          "faixa_ilegivel": "faixa_salarial IS NOT NULL AND salario_pm IS NULL"}


@query("d13_quarantine", f"""SELECT situacao, ano, count(*) AS n, count(*) FILTER (faixa) AS faixa_ilegivel FROM (
 SELECT ano, coalesce({BROKEN["faixa_ilegivel"]}, false) AS faixa, CASE WHEN {" OR ".join(
    f"coalesce({c}, false)" for c in BROKEN.values())} THEN 'quarentena' ELSE 'boa' END AS situacao FROM silver)
 GROUP BY situacao, ano""", "silver")
def d13(spark, sf):
    """Harmonised rows that keep the contract and those that break it, from one write."""
    folder = new_path(spark, "checked")
    contract.write_checked(survey.banded(spark, sf, core_only=True), folder, contract.core_rules())
    good = contract.read_good(spark, folder).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("faixa_ilegivel"))
    bad = contract.read_quarantine(spark, folder).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("violacoes", "faixa_ilegivel")).alias("faixa_ilegivel"))
    return good.withColumn("situacao", F.lit(contract.GOOD)).unionByName(bad.withColumn("situacao", F.lit(contract.BAD)))
