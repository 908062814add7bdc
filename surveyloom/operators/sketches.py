"""Sketches that are kept per group and merge: quantiles within a rank error, distinct counts within a standard error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a quantile sketch, and of a distinct sketch as a power of two. Both bound a group's state, whatever its rows.
QUANTILE_SIZE = 800
DISTINCT_BITS = 14


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far a quantile's rank may be off, as a share of the rows, with 99% confidence (the sketch's published fit)."""
    return 2.296 / size ** 0.9723


def standard_error(bits: int = DISTINCT_BITS) -> float:
    """Standard error of a distinct count, as a share of it. Up to 2 ** bits different keys the count is exact."""
    return 1 / (2 ** bits - 1) ** 0.5


def quantile_states(df: DataFrame, keys: Sequence[str], value: str, size: int = QUANTILE_SIZE) -> DataFrame:
    """keys, `_n` (rows with a value) and `_quantis` (their sketch), to be stored. Groups without a value have no row."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("_quantis"))


def merged_quantiles(states: DataFrame, keys: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """Stored states put together to fewer keys: nothing but sketches is read."""
    return states.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.kll_merge_agg_double("_quantis", size).alias("_quantis"))


def quantile(q: float, state: Column | str = "_quantis") -> Column:
    return F.kll_sketch_get_quantile_double(state, F.lit(float(q)))


def rank(value: Column, state: Column | str = "_quantis") -> Column:
    """Share of the rows up to a value."""
    return F.kll_sketch_get_rank_double(state, value.cast("double"))


def distinct_states(df: DataFrame, keys: Sequence[str], key: str, bits: int = DISTINCT_BITS) -> DataFrame:
    """keys and `_distintos`, a sketch of the different keys of each group, to be stored. NULL is no key."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(key, bits).alias("_distintos"))


def merged_distinct(states: DataFrame, keys: Sequence[str], bits: int = DISTINCT_BITS) -> DataFrame:
    return states.groupBy(*keys).agg(F.theta_union_agg("_distintos", bits).alias("_distintos"))


def distinct_count(state: Column | str = "_distintos") -> Column:
    return F.theta_sketch_estimate(state)


def carried_over(states: DataFrame, order: str) -> DataFrame:
    """Adds `_de_antes`: about how many keys of a group were in the one before. One row per group is sorted."""
    before = F.lag("_distintos").over(Window.partitionBy().orderBy(order))
    shared = F.theta_sketch_estimate(F.theta_intersection(F.col("_distintos"), F.col("_antes")))
    return states.withColumn("_antes", before).withColumn(
        "_de_antes", F.when(F.col("_antes").isNotNull(), shared)).drop("_antes")
