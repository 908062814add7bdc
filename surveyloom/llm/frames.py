"""Small DataFrame helpers that the operators of this package share."""

from __future__ import annotations

import math
import sys
import types
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def new_path(spark: SparkSession, kind: str) -> str:
    """An unused path in the folder all executors share: spark.checkpoint.dir, or where it is unset, the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """The rows, written once as Parquet to the shared folder: lineage ends here and lost executors cost nothing."""
    path = new_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_for(rows: int) -> int:
    """As many buckets as a bucket has rows: no window of `with_offsets` sorts more than about sqrt(rows) rows."""
    return math.isqrt(rows) + 1


#: Copies of a row that one generated list stands for.
COPIES = 1 << 16


def with_offsets(df: DataFrame, by: list[str], order: list[str], value: Column, buckets: int, name: str,
                 repeats: bool = True) -> DataFrame:
    """Add the exclusive running sum of `value` inside each group `by`, in an order that is fixed by the rows.

    A group may hold most of the rows: it is cut into hash buckets of the order columns, sums of buckets are summed
    first, and no window sorts more than a bucket. Rows are ordered by bucket, then by `order`. Rows that are alike are
    one weighted row until they are numbered, so however many there are of them they fill no bucket; columns that are
    in neither list must follow from those that are. `repeats` False says that there are none. `by` must not hold nulls.
    """
    valued = df.withColumn("__v", value.cast("long"))
    if repeats:
        valued = valued.groupBy(*df.columns, "__v").agg(F.count("*").alias("__m"))
    else:
        valued = valued.withColumn("__m", F.lit(1).cast("long"))
    weight = F.col("__v") * F.col("__m")
    spread = valued.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = spread.groupBy(*by, "__b").agg(F.sum(weight).alias("__s"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*by, "__b", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*by, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn("__in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    placed = local.join(bases, [*by, "__b"])
    zero, copy = F.lit(0).cast("long"), F.lit(0).cast("long")
    if repeats:
        lists = placed.withColumn("__c", F.explode(F.sequence(zero, F.floor((F.col("__m") - 1) / COPIES))))
        placed = lists.withColumn("__k", F.explode(F.sequence(
            F.col("__c") * COPIES, F.least((F.col("__c") + 1) * COPIES, "__m") - 1))).drop("__c")
        copy = F.col("__k")
    return placed.withColumn(name, F.col("__base") + F.col("__in") + copy * F.col("__v")).select(*df.columns, name)


def kept_by_worker(key: str, make: Callable[[], Any]) -> Any:
    """What a reused Python worker keeps from task to task: the object of the last key, whichever operator asked.

    The one before goes first, so a worker never holds the memories of two operators that run one after the other.
    """
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if kept.get("key") != key:
        kept.update(key=None, value=None)
        pa.default_memory_pool().release_unused()
        kept.update(value=make(), key=key)
    return kept["value"]


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Vectors without nulls as rows of doubles; missing trailing components are 0."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out
