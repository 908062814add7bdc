"""Parquet layers, marts and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.scalars import quoted


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_layer(df: DataFrame, path: str, by: str = "ano") -> None:
    """Overwrite a layer, one directory per edition."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def replace_editions(df: DataFrame, path: str, by: str = "ano") -> None:
    """Overwrite only the editions present in `df`; the others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def write_mart(df: DataFrame, path: str) -> int:
    """Write a mart and report its rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(seen.get["n"])


def export_csv(df: DataFrame, path: str, order: Sequence[Column | str] = ()) -> None:
    """One CSV file with a header, in the given order. For marts: a few rows per edition."""
    one = df.coalesce(1)
    if order:
        one = one.sortWithinPartitions(*order)
    one.write.mode("overwrite").csv(path, header=True)


def read_csv_mart(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV mart with declared types."""
    return spark.read.schema(schema).csv(path, header=True)


def publish_mart(df: DataFrame, folder: str, name: str, order: Sequence[Column | str] = ()) -> int:
    """Parquet and CSV of one mart: it is computed once, the CSV is made from the written Parquet."""
    rows = write_mart(df, f"{folder}/{name}")
    export_csv(df.sparkSession.read.parquet(f"{folder}/{name}"), f"{folder}/csv/{name}", order)
    return rows


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_external(
    spark: SparkSession, database: str, table: str, columns: str, path: str, by: str = "ano int"
) -> DataFrame:
    """External partitioned table over a written layer, with its editions discovered.

    An earlier external table of that name is replaced, so that location, columns and editions are those of now; its
    files are not touched. A managed table is never dropped.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    name = f"{quoted(database)}.{quoted(table)}"
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not an external table")
        spark.sql(f"DROP TABLE {name}")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {by}) USING parquet "
        f"PARTITIONED BY ({by.split()[0]}) LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
