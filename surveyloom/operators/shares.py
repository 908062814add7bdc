"""Counts, shares and multi-response tables. Rows are reduced first; windows only see group rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.scalars import percent, quoted
from surveyloom.operators.ranks import renamed, same


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def share_within(df: DataFrame, by: Sequence[str], part: str = "n", name: str = "pct") -> DataFrame:
    """Share of each row in its `by` group. Meant for already grouped rows (one per label)."""
    return df.withColumn(name, percent(F.col(part), F.sum(part).over(Window.partitionBy(*by))))


def distribution(
    df: DataFrame, label: str, by: Sequence[str] = ("ano",), n: str = "n", pct: str = "pct"
) -> DataFrame:
    """Answered rows per label with their share of all answered rows of the `by` group.

    The label may have very many values: totals are summed from the counts and joined back, both from one shuffle.
    """
    counted = count_by(df.filter(F.col(label).isNotNull()), *by, label, name=n)
    if not by:
        return counted.withColumn(pct, percent(F.col(n), counted.agg(F.sum(n)).scalar()))
    totals = counted.groupBy(*by).agg(F.sum(n).alias("_total")).selectExpr(*renamed(by), "_total")
    shared = counted.join(totals, same(by)).withColumn(pct, percent(F.col(n), F.col("_total")))
    return shared.drop("_total", *[f"{c}_w" for c in by])


def multi_response(
    df: DataFrame, options: Mapping[str, str], name: str, by: Sequence[str] = ("ano",)
) -> DataFrame:
    """Users, valid base and adoption of each yes/no column.

    One pass counts all columns side by side, so the scan does not grow with the number of options
    and no row is copied; only the few group rows are then turned into one row per option. A column
    nobody answered in a group gives no row.
    """
    counts = [
        F.expr(f"{fn}(`{c}`) AS `{c}__{fn}`") for c in options for fn in ("count", "sum")
    ]
    return option_rows(df.groupBy(*by).agg(*counts), options, name, by)


def option_rows(counted: DataFrame, options: Mapping[str, str], name: str, by: Sequence[str]) -> DataFrame:
    """Group rows with `c__count` and `c__sum` of each yes/no column, as one row per option with its adoption."""
    per_option = ", ".join(
        f"named_struct('{name}', {_text(label)}, 'usuarios', `{c}__sum`, 'base_valida', `{c}__count`)"
        for c, label in options.items()
    )
    return (
        counted
        .selectExpr(*map(quoted, by), f"inline(array({per_option}))")
        .filter("base_valida > 0")
        .withColumn("pct", percent("usuarios", "base_valida"))
    )


def _text(value: str) -> str:
    body = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{body}'"


def flag_rate(column: str) -> Column:
    """Share of 1 among the answered rows of a 0/1 column."""
    return F.round(100 * F.avg(column), 1)


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: percentage of filled rows per column."""
    return df.agg(*[percent(F.count(c), F.count(F.lit(1))).alias(c) for c in columns])
