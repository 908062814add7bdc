"""Raw editions -> silver -> marts, end to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.scalars import quoted
from surveyloom.operators import quality
from surveyloom.operators.bootstrap import median_interval
from surveyloom.operators.quality import QualityError, require_volumes, volume_gate
from surveyloom.operators.shares import count_by
from surveyloom.plans import contract, cube, silver, versions
from surveyloom.plans import vocabulary as v
from surveyloom.plans.marts import Mart, marts
from surveyloom.sources import store
from surveyloom.sources.editions import count_records
from surveyloom.sources.tables import publish_mart, read_table, register_external, register_views, write_layer

Headers = Mapping[int, Mapping[str, str]]


def build_silver(
    spark: SparkSession,
    core_raw: Mapping[int, DataFrame],
    history_raw: Mapping[int, DataFrame],
    core_headers: Headers,
    history_headers: Headers,
    folder: str,
    expected: Mapping[int, int] | None = None,
    rules: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write both layers and return them as read back.

    The long series takes its core rows from the written core layer, so the wide raw files are
    parsed once. The core layer is written under its declared names and types. The row-volume gate counts the raw rows
    before anything is written, and the written layers once more, where a count reads no columns. A run that writes
    into a folder of its own (see `plans.versions`) leaves earlier layers as they are, wherever it fails.

    With `rules` (see `plans.contract`) rows that break some go aside in the write of the core layer, and neither layer
    returned holds them; the gate counts them among the rows that arrived. No row that keeps all rules is an error.
    """
    if expected is not None:
        arrived = silver.union_editions([
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(e).alias("edition"), "n")
            for e, df in {**history_raw, **core_raw}.items()])
        require_volumes(volume_gate(arrived, spark.createDataFrame(list(expected.items()), "edition int, expected long")))
    harmonised = silver.silver_core(core_raw, core_headers)
    declared, target = harmonised.to(silver.core_contract(harmonised.columns)), f"{folder}/silver_core"
    if rules is None:
        write_layer(declared, target)
        core = every = read_table(spark, target)
    else:
        if not contract.write_checked(declared, target, rules)[contract.GOOD]:
            raise QualityError("no row of the core layer keeps all rules")
        core, every = contract.read_good(spark, target), read_table(spark, target)
    write_layer(silver.silver_long(history_raw, history_headers, core), f"{folder}/silver_serie_longa")
    long_series = read_table(spark, f"{folder}/silver_serie_longa")
    if expected is not None:
        wanted = spark.createDataFrame(list(expected.items()), "edition int, expected long")
        in_core = wanted.filter(F.col("edition").isin(*core_raw))
        require_volumes(volume_gate(count_by(every, "ano").withColumnRenamed("ano", "edition"), in_core))
        counts = count_by(long_series, "ano")
        if rules is not None:
            aside = count_by(contract.read_quarantine(spark, target), "ano")
            counts = counts.unionByName(aside).groupBy("ano").agg(F.sum("n").alias("n"))
        require_volumes(volume_gate(counts.withColumnRenamed("ano", "edition"), wanted))
    return core, long_series


def publish_marts(
    core: DataFrame, long_series: DataFrame, folder: str, before: str | None = None, editions: Sequence[int] = (),
) -> dict[str, int]:
    """Write the counts that all marts are made of (`cubo`), and every mart as Parquet and CSV; rows per mart.

    Two scans of the core layer and one of the long series, whatever the number of marts. With the counts of an earlier
    release (`before`) only the directories of the changed `editions` are read.
    """
    now = (cube.refreshed(cube.read(core.sparkSession, before), core, long_series, editions) if before
           else cube.build(core, long_series))
    kept, builders = cube.write(now, f"{folder}/cubo"), cube.rollups()

    def publish(item: tuple[str, Mart]) -> int:
        name, mart = item
        return publish_mart(builders[name](kept), folder, name, mart.order)

    found = marts()
    with ThreadPoolExecutor(AT_ONCE) as pool:  # marts are small jobs; Spark runs several side by side
        return dict(zip(found, pool.map(publish, found.items())))


#: Marts that are written at a time.
AT_ONCE = 4
#: Answers that are given a label, and the label's column.
LABELLED = {"cargo": "cargo_grupo", "modelo_atual": "modelo_atual_h", "modelo_ideal": "modelo_ideal_h",
            "prioridade_ia": "prioridade_ia_h", "faixa_salarial": "salario_pm"}


def label_table(core: DataFrame) -> DataFrame:
    """campo, ano, resposta, rotulo and n: every answer that is given a label, with the label."""
    return silver.union_editions([
        quality.label_pairs(core, c, label).select(
            F.lit(c).alias("campo"), "ano", F.col(c).alias("resposta"), F.col(label).cast("string").alias("rotulo"), "n")
        for c, label in LABELLED.items() if {c, label} <= set(core.columns)])


def shape_table(spark: SparkSession, paths: Mapping[int, str], raw: Mapping[int, DataFrame]) -> DataFrame:
    """ano, registros and colunas of the raw files of each edition, counted by quotes."""
    return silver.union_editions([
        count_records(spark, path).agg(F.sum("registros").alias("registros")).select(
            F.lit(e).alias("ano"), "registros", F.lit(len(raw[e].columns)).alias("colunas")) for e, path in paths.items()])


def violation_table(aside: DataFrame) -> DataFrame:
    """ano, regra and n: rows in quarantine by the rules they break; a row counts for each of them."""
    return count_by(aside.select("ano", F.explode("violacoes").alias("regra")), "ano", "regra")


def checksum_table(layers: Mapping[str, DataFrame]) -> DataFrame:
    """tabela, n and checksum of each layer: the same rows in any order give the same pair."""
    return silver.union_editions([
        quality.content_checksum(df).select(F.lit(name).alias("tabela"), "n", "checksum") for name, df in layers.items()])


def publish_quality(
    raw: Mapping[int, DataFrame], core: DataFrame, long_series: DataFrame, folder: str, mart_rows: Mapping[str, int],
    paths: Mapping[int, str] | None = None, aside: DataFrame | None = None,
) -> dict[str, int]:
    """Write what a reader needs to trust the release, as Parquet and CSV; rows per table.

    Raw rows against the long series, repeated ids, filled shares with the reason for gaps, groups under the display
    cut, every label given to an answer, resampled intervals of the median pay, checksums of the layers, the run in
    numbers (with the marts that were written), with the raw files' `paths` their records and columns, and with the rows
    in quarantine (`aside`) how many break each rule.
    """
    arrived = silver.union_editions([df.select(F.lit(e).alias("ano")) for e, df in raw.items()])
    editions = [row["ano"] for row in core.select("ano").distinct().collect()]
    paid = core.filter("salario_pm IS NOT NULL AND cargo_grupo IS NOT NULL AND nivel IS NOT NULL")
    tables = {
        "reconciliacao": (quality.reconcile(arrived, long_series), ["ano"]),
        "unicidade": (quality.uniqueness(core, "id"), ["ano"]),
        "preenchimento": (quality.fill_profile(core, v.EMPTY_REASONS), ["coluna"]),
        "grupos_pequenos": (
            quality.small_groups(paid, ["ano", "cargo_grupo", "nivel"], v.DISPLAY_MINIMUM), ["ano", "cargo_grupo", "nivel"]),
        "rotulos": (label_table(core), ["campo", "ano", "resposta", "rotulo"]),
        "intervalos": (median_interval(paid, ["ano", "nivel"], "salario_pm", v.RESAMPLES, v.RESAMPLE_SEED), ["ano", "nivel"]),
        "impressoes": (checksum_table({"silver_core": core, "silver_serie_longa": long_series}), ["tabela"]),
        "metricas": (quality.run_metrics(core, long_series, "id", editions, len(mart_rows)), ["metrica"]),
    }
    if paths:
        tables["formato_csv"] = shape_table(core.sparkSession, paths, raw), ["ano"]
    if aside is not None:
        tables["violacoes"] = violation_table(aside), ["ano", "regra"]
    return {name: publish_mart(df, folder, name, order) for name, (df, order) in tables.items()}


def register_release(spark: SparkSession, base: str, database: str | None = None) -> None:
    """Layers and marts of the current release as views, for questions in SQL; in a database, the layers as external
    tables too."""
    found = versions.current(base)
    paths = {name.split("/")[1]: store.joined(base, path) for name, path in found.tables.items()
             if name.startswith(("silver/", "gold/")) and name not in ("gold/cubo", versions.CHECKED)}
    register_views({name: read_table(spark, path) for name, path in paths.items()})
    for name in ("silver_core", "silver_serie_longa") if database else ():
        df = read_table(spark, paths[name])
        columns = ", ".join(f"{quoted(c)} {kind}" for c, kind in df.dtypes if c != "ano")
        register_external(spark, database, name, columns, paths[name])
