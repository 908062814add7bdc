"""The versioned column mapping: target column <- header of each edition."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HISTORY = "historico"
Headers = Mapping[int, Mapping[str, str]]


def mapping_table(spark: SparkSession, headers: Headers) -> DataFrame:
    """edition, target, source: one row per mapped column (a few hundred, whatever the data size)."""
    rows = [(int(e), t, s) for e, pairs in headers.items() for t, s in pairs.items()]
    return spark.createDataFrame(rows, "edition int, target string, source string")


def overlay(base: DataFrame, changes: DataFrame) -> DataFrame:
    """A base mapping with the headers that changed replaced; both are (target, source)."""
    changed = changes.select("target", F.col("source").alias("changed"))
    return base.join(changed, "target", "left").select(
        "target", F.coalesce("changed", "source").alias("source")
    )


def write_mapping(spark: SparkSession, core: Headers, history: Headers, path: str) -> None:
    """One JSON object: `{edition: {target: source}}` with the older editions one level deeper."""
    tree: dict[str, object] = {str(e): dict(pairs) for e, pairs in core.items()}
    tree[_HISTORY] = {str(e): dict(pairs) for e, pairs in history.items()}
    text = json.dumps(tree, ensure_ascii=False, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """edition, target, source from the exported JSON, core and older editions alike."""
    pairs = "map<string,string>"
    whole = spark.read.text(path, wholetext=True).select("value")
    core = whole.select(F.explode(F.from_json("value", f"map<string,{pairs}>")).alias("e", "p"))
    older = whole.select(
        F.explode(F.from_json(F.get_json_object("value", f"$.{_HISTORY}"), f"map<string,{pairs}>"))
        .alias("e", "p")
    )
    return (
        core.filter(F.col("e") != _HISTORY)
        .unionAll(older)
        .select(F.col("e").cast("int").alias("edition"), F.explode("p").alias("target", "source"))
    )


def as_headers(mapping: DataFrame) -> dict[int, dict[str, str]]:
    """The mapping as plain dictionaries, for building a projection."""
    out: dict[int, dict[str, str]] = {}
    for row in mapping.collect():
        out.setdefault(row["edition"], {})[row["target"]] = row["source"]
    return out


def older_editions(spark: SparkSession, path: str) -> set[int]:
    """The editions that an exported JSON lists as older ones."""
    whole = spark.read.text(path, wholetext=True).select(F.get_json_object("value", f"$.{_HISTORY}").alias("value"))
    keys = whole.select(F.explode(F.json_object_keys("value")).alias("edition"))
    return {int(row["edition"]) for row in keys.collect()}
