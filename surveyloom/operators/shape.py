"""Reshaping of mart rows: fixed category grids, rankings, editions side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.operators.ranks import renamed, same


def densify(
    df: DataFrame,
    by: Sequence[str],
    label: str,
    categories: Sequence[str],
    values: Sequence[str],
    order: str = "ordem",
) -> DataFrame:
    """One row per group and declared category, in declared order; absent ones carry NULL values.

    The grid comes from one conditional aggregate per category, so nothing is joined or read twice.
    """
    picks: list[Column] = []
    rows: list[Column] = []
    for place, category in enumerate(categories):
        cells: list[Column] = [F.lit(place + 1).alias(order), F.lit(category).alias(label)]
        for value in values:
            name = f"{value}__{place}"
            picks.append(F.max(F.when(F.col(label) == category, F.col(value))).alias(name))
            cells.append(F.col(name).alias(value))
        rows.append(F.struct(*cells))
    return df.groupBy(*by).agg(*picks).select(*by, F.inline(F.array(*rows)))


def category_order(label: str | Column, categories: Sequence[str]) -> Column:
    """1-based place of a label in a declared sequence, 0 for others."""
    c = F.col(label) if isinstance(label, str) else label
    return F.array_position(F.array(*[F.lit(x) for x in categories]), c).cast("int")


def top_per_group(df: DataFrame, by: Sequence[str], measure: str, tie: Sequence[str], k: int) -> DataFrame:
    """The k largest rows of every group; equal measures fall back to the tie columns."""
    order = Window.partitionBy(*by).orderBy(F.col(measure).desc(), *[F.col(c) for c in tie])
    return df.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k).drop("_place")


def top_k(df: DataFrame, measure: str, tie: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *[F.col(c) for c in tie]).limit(k)


def flag_top_values(df: DataFrame, by: Sequence[str], measure: str, k: int, name: str) -> DataFrame:
    """1 where the measure is one of the k largest entries of its group; equal values share the mark.

    The k entries are cut out before the shuffle and their smallest is joined back, so no task sorts a whole group.
    """
    largest = top_per_group(df.select(*by, measure), by, measure, [], k)
    smallest = largest.groupBy(*by).agg(F.min(measure).alias("_smallest")).selectExpr(*renamed(by), "_smallest")
    marked = df.join(smallest, same(by), "left").withColumn(name, (F.col(measure) >= F.col("_smallest")).cast("int"))
    return marked.drop("_smallest", *[f"{c}_w" for c in by])


def at(value: str, **where: object) -> Column:
    """Aggregate: the value of the one row matching all conditions, e.g. `at("pct", ano=2025)`."""
    test = F.lit(True)
    for name, wanted in where.items():
        test = test & (F.col(name) == F.lit(wanted))
    return F.max(F.when(test, F.col(value)))


def side_by_side(df: DataFrame, keys: Sequence[str], on: str, columns: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Rows of a group as columns: `{name: (value of on, measure)}`."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(on) == F.lit(pick), F.col(measure))).alias(name)
          for name, (pick, measure) in columns.items()]
    )
