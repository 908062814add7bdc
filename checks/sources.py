"""Readers and writers: every query writes below the shared folder and reads the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import survey
from checks.marts import dist_sql, pay_sql
from checks.operators import filled_sql
from checks.registry import ORACLES, QUERIES, query
from surveyloom.operators.quality import filled_counts
from surveyloom.plans import release, silver
from surveyloom.plans import vocabulary as v
from surveyloom.sources import editions, headers, tables
from surveyloom.sources.folders import new_path
from surveyloom.streaming.landing import land_new_files

LAST = survey.LAST
#: An answer with quotes, commas and line breaks, at the end of every row.
COMMENT = "concat('disse \"sim\", talvez', chr(10), 'linha ', CAST(k AS STRING))"
EVERY = " UNION ALL ".join(
    f"SELECT ano, {COMMENT} AS comentario, " + ", ".join(
        (f"nullif({c}, '')" if c in survey.HEADERS[y] else "CAST(NULL AS VARCHAR)") + f" AS {c}" for c in v.HEADERS_2025)
    + f" FROM texts WHERE ano = {y}" for y in survey.ALL_YEARS)


def offered(spark, sf):
    """All editions as they would arrive, each row over two lines."""
    return survey.raw_editions(spark, sf, survey.ALL_YEARS, {"comentario": COMMENT})


def delivered(spark, raw) -> str:
    """Raw CSV files of the given editions."""
    inbox = new_path(spark, "entrega")
    for y, df in raw.items():
        editions.write_raw(df, editions.edition_path(inbox, y))
    return inbox


def mapped_files(spark, bronze):
    """All rows of all files under harmonised names, answers as typed; what an edition did not ask is NULL."""
    def edition(y):
        raw = editions.read_edition(spark, bronze, y, multiline=True)
        rows = silver.mapped_edition(raw, {**survey.HEADERS[y], "comentario": "comentario"}, y)
        return rows.withColumns({c: F.lit(None).cast("string") for c in v.HEADERS_2025 if c not in survey.HEADERS[y]})

    return silver.union_editions([edition(y) for y in survey.ALL_YEARS])


@query("s01_csv_scan", EVERY, "texts")
def s01(spark, sf):
    """Every mapped answer of files whose records go over several lines."""
    return mapped_files(spark, delivered(spark, offered(spark, sf)))


@query("s02_land_if_absent", EVERY, "texts")
def s02(spark, sf):
    """Delivered files land as they are; landing a second time changes nothing, even if the delivery differs."""
    raw = offered(spark, sf)
    inbox, other, bronze = delivered(spark, raw), new_path(spark, "entrega"), new_path(spark, "bronze")
    editions.write_raw(raw[LAST].drop("comentario"), other)  # what comes second is the same for all editions
    for y in survey.ALL_YEARS:
        for source in (editions.edition_path(inbox, y), other):
            editions.land_delivery(spark, source, bronze, y)
    return mapped_files(spark, bronze)


@query("s02b_land_new_files", EVERY, "texts")
def s02b(spark, sf):
    """The incremental form: the same inbox is offered twice and taken once."""
    inbox, bronze = delivered(spark, offered(spark, sf)), new_path(spark, "bronze_stream")
    for y in survey.ALL_YEARS:
        source, memory = editions.edition_path(inbox, y), new_path(spark, f"landed_{y}")
        for _ in range(2):
            land_new_files(spark, source, bronze, y, memory)
    return mapped_files(spark, bronze)


LAYER = ("id", "genero", "nivel", "salario_pm", "ano")


def layer(spark, sf) -> str:
    folder = new_path(spark, "layer")
    tables.write_layer(survey.every(spark, sf, *LAYER), folder)
    return folder


@query("s03_parquet_scan", f"SELECT {', '.join(LAYER)} FROM every", "every")
def s03(spark, sf):
    return tables.read_table(spark, layer(spark, sf))


@query("s04_parquet_partitioned_write", f"""SELECT id, genero, nivel, ano,
 CASE WHEN ano = {LAST} THEN salario_pm * 2 ELSE salario_pm END AS salario_pm FROM every""", "every")
def s04(spark, sf):
    """One edition is replaced in place; the other partitions stay."""
    folder = layer(spark, sf)
    again = survey.every(spark, sf, *LAYER).filter(F.col("ano") == LAST)
    tables.replace_editions(again.withColumn("salario_pm", F.col("salario_pm") * 2), folder)
    return tables.read_table(spark, folder)


@query("s05_parquet_mart_write", dist_sql("nivel"))
def s05(spark, sf):
    path = new_path(spark, "mart")
    tables.write_mart(QUERIES["g03_seniority"](spark, sf), path)
    return tables.read_table(spark, path)


@query("s06_single_csv_write", dist_sql("nivel"))
def s06(spark, sf):
    path = new_path(spark, "csv_mart")
    tables.export_csv(QUERIES["g03_seniority"](spark, sf), path, ["ano", "nivel"])
    return tables.read_csv_mart(spark, path, "ano int, nivel string, n bigint, pct double")


@query("s07_mapping_json", " UNION ALL ".join(
    "SELECT CAST({0} AS INT) AS edition, m.target, source, preenchidos FROM (VALUES {1}) AS m(target, source) "
    "JOIN {2} f ON m.target = f.target".format(
        y,
        ", ".join("('{}', '{}')".format(t, s.replace("'", "''")) for t, s in pairs.items()),
        filled_sql(pairs, f"ano = {y}"),
    )
    for y, pairs in survey.HEADERS.items()), "texts")
def s07(spark, sf):
    """The exported mapping, loaded again and joined to the answers found under each header."""
    path = new_path(spark, "mapping")
    headers.write_mapping(spark, survey.CORE_HEADERS, survey.HISTORY_HEADERS, path)
    filled = silver.union_editions([
        filled_counts(df, "source", "preenchidos").withColumn("edition", F.lit(y))
        for y, df in survey.raw_editions(spark, sf, survey.ALL_YEARS).items()])
    return headers.read_mapping(spark, path).join(filled, ["edition", "source"]).select(
        "edition", "target", "source", "preenchidos")


@query("s08_temp_views", """SELECT c.ano, c.n AS nucleo, s.n AS serie
 FROM (SELECT ano, count(*) AS n FROM core GROUP BY ano) c JOIN (SELECT ano, count(*) AS n FROM serie GROUP BY ano) s
 ON c.ano = s.ano""", "core serie")
def s08(spark, sf):
    tables.register_views({
        "silver_core": survey.core(spark, sf, "ano"),
        "silver_serie_longa": survey.long_series(spark, sf, "ano"),
    })
    return spark.sql("""
        SELECT c.ano, c.n AS nucleo, s.n AS serie
        FROM (SELECT ano, count(*) AS n FROM silver_core GROUP BY ano) c
        JOIN (SELECT ano, count(*) AS n FROM silver_serie_longa GROUP BY ano) s USING (ano)""")


@query("s09_external_table", f"SELECT {', '.join(LAYER)} FROM every", "every")
def s09(spark, sf):
    return tables.register_external(
        spark, "pesquisa", "respostas", "id string, genero string, nivel string, salario_pm double", layer(spark, sf))


@query("s10_gold_csv_read", pay_sql("ano, nivel", "nivel IS NOT NULL"))
def s10(spark, sf):
    path = new_path(spark, "csv_mart")
    tables.export_csv(QUERIES["g04_salary_by_seniority"](spark, sf), path, ["ano", "nivel"])
    return tables.read_csv_mart(
        spark, path, "ano int, nivel string, n bigint, salario_medio_pm double, salario_mediano_pm double")


ROWCOUNTED = {f"gold_{key.partition('_')[2]}": key for key in QUERIES if key[0] == "g"}


@query("s11_mart_rowcount", " UNION ALL ".join(
    f"SELECT '{name}' AS tabela, count(*) AS linhas FROM ({ORACLES[key]})" for name, key in ROWCOUNTED.items()))
def s11(spark, sf):
    """Rows of every mart as reported by its own write."""
    written = release.publish_marts(survey.core(spark, sf), survey.long_series(spark, sf), new_path(spark, "gold"))
    return spark.createDataFrame(list(written.items()), "tabela string, linhas bigint")
