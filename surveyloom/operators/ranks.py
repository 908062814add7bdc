"""Exact medians of groups of any size.

`percentile` keeps every distinct value of a group in one task. Here the values are counted first,
spread by value, and the wanted rank is found digit by digit: each double has a whole number of 64
bits that sorts as it does, the upper 22 bits are a value's cell, the next 22 its part of the cell.
A histogram of the group's cells tells which cell holds the rank, one of that cell's parts which part
does, and only that part is sorted. No window or sort meets more than 2^22 rows of a group, whatever
the distribution: equal values are one row by then, and a part has 2^20 different ones at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.scalars import quoted

_PART_BITS, _REST_BITS = 22, 20

# Order-keeping 64-bit number of `_value`: sign, exponent and the 52 bits behind the point. The first guess of the
# exponent may be one off next to a power of two.
_EXPONENT = (
    "transform(array(least(greatest(floor(log2(abs(_value))), -1022L), 1023L)), e -> e + CASE "
    "WHEN abs(_value) >= pow(2D, e + 1) THEN 1L WHEN e > -1022 AND abs(_value) < pow(2D, e) THEN -1L ELSE 0L END)"
)
_KEY = (
    f"CASE WHEN isnan(_value) THEN {2**63 - 1} WHEN _value = 0 THEN 0L "
    f"ELSE if(_value < 0, -1L, 1L) * if(abs(_value) = double('infinity'), {2047 * 2**52}, get(transform({_EXPONENT}, "
    f"e -> (e + 1022) * {2**52} + CAST(abs(_value) / pow(2D, e) * {float(2**52)!r}D AS BIGINT)), 0)) END"
)
# Larger values never get a smaller cell, nor a smaller part inside their cell.
_CELL = f"shiftright(_key, {_PART_BITS + _REST_BITS})"
_PART = f"shiftright(_key, {_REST_BITS}) & {2**_PART_BITS - 1}L"


def _list(columns: Sequence[str]) -> str:
    return ", ".join(quoted(c) for c in columns)


def renamed(columns: Sequence[str], suffix: str = "_w") -> list[str]:
    """Projection of key columns under a second name, for joining a table to its own aggregate."""
    return [f"{quoted(c)} AS {quoted(c + suffix)}" for c in columns]


def same(columns: Sequence[str], suffix: str = "_w") -> Column:
    """Join condition for `renamed` keys; NULL is a group like any other."""
    return F.expr(" AND ".join(f"{quoted(c)} <=> {quoted(c + suffix)}" for c in columns))


def narrowed(counted: DataFrame, wanted: DataFrame, within: Sequence[str], suffix: str = "_w") -> DataFrame:
    """Counted values of the `wanted` cells or parts (a few rows per group, keys `renamed`).

    Both sides meet by key, and the wanted rows are the ones held. A file in which values are packed well looks small
    to the planner, which would then gather all counted values on the driver to broadcast them.
    """
    return counted.join(wanted.hint("shuffle_hash"), same(within, suffix))


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, sums: Mapping[str, Column] | None = None, weight: str | None = None
) -> DataFrame:
    """keys, `_value`, `_rows`, `_cell`, `_part`: how often each value occurs in each group, and where it lies.

    `sums` are further counts of the same rows, kept per value so that they add up again. A row stands for as many rows
    as its column `weight` says.
    """
    rows = "count(1)" if weight is None else f"sum({quoted(weight)})"
    return (
        df.withColumn("_value", F.expr(f"CAST({quoted(value)} AS DOUBLE)"))
        .groupBy(*keys, "_value")
        .agg(F.expr(f"{rows} AS _rows"), *[c.alias(name) for name, c in (sums or {}).items()])
        .withColumn("_key", F.expr(f"CASE WHEN _value IS NOT NULL THEN {_KEY} END"))
        .withColumns({"_cell": F.expr(_CELL), "_part": F.expr(_PART)})
        .drop("_key")
    )


def cells(counted: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """One row per group and cell with running and total counts; NULL values form the NULL cell."""
    group = f"OVER (PARTITION BY {_list(keys)})"
    running = f"OVER (PARTITION BY {_list(keys)} ORDER BY _cell NULLS FIRST ROWS UNBOUNDED PRECEDING)"
    return (
        counted.groupBy(*keys, "_cell")
        .agg(
            F.expr("sum(_rows) AS _rows"),
            F.expr("sum(_value * _rows) AS _sum"),
            F.expr("if(_cell IS NULL, 0L, sum(_rows)) AS _held"),
            *[F.expr(f"sum({quoted(c)}) AS {quoted(c)}") for c in sums],
        )
        .selectExpr(
            *map(quoted, keys),
            "_cell",
            f"sum(_rows) {group} AS n",
            f"sum(_held) {group} AS n_value",
            f"sum(_sum) {group} AS _total",
            f"sum(_held) {running} - _held AS _before",
            f"sum(_held) {running} AS _upto",
            *[f"sum({quoted(c)}) {group} AS {quoted(c)}" for c in sums],
        )
    )


def parts(in_cells: DataFrame, within: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """One row per cell and part of `in_cells` (counted values with `_before`, the rows before their cell): the rows
    before (`_start`) and up to (`_end`) the part's last, and the maxima of the `carried` columns."""
    running = f"OVER (PARTITION BY {_list(within)} ORDER BY _part NULLS FIRST ROWS UNBOUNDED PRECEDING)"
    return (
        in_cells.groupBy(*within, "_part")
        .agg(F.expr("sum(_rows) AS _held"), F.expr("max(_before) AS _before"),
             *[F.expr(f"max({quoted(c)}) AS {quoted(c)}") for c in carried])
        .selectExpr(*map(quoted, [*within, "_part", *carried]),
                    f"_before + sum(_held) {running} - _held AS _start", f"_before + sum(_held) {running} AS _end")
    )


def value_profile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float = 0.5,
    sums: Mapping[str, Column] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """keys, n, n_value, mean, median: rows, rows with a value, their mean and interpolated quantile.

    `sums` adds named counts (nothing negative) over all rows of the group to the same pass. Rows that were counted
    before have their number in `weight`.
    """
    keys, extra = list(keys), list(sums or {})
    within = [*keys, "_cell"]
    counted = value_counts(df, keys, value, sums, weight)
    wanted = (
        cells(counted, keys, extra)
        .selectExpr("*", f"(n_value - 1) * {float(q)!r}D AS _position")
        .selectExpr("*", "floor(_position) + 1 AS _low", "ceil(_position) + 1 AS _high")
        .filter("n_value = 0 OR (_cell IS NOT NULL AND _upto >= _low AND _before < _high)")
        .selectExpr(
            *renamed(within + extra),
            "n", "n_value", "_total", "_before", "_low", "_high", "_position - floor(_position) AS _share",
        )
    )
    in_cells = narrowed(counted, wanted, within)
    finer = [*within, "_part"]
    asked = (
        parts(in_cells, within, ["n_value", "_low", "_high", *extra, *(f"{c}_w" for c in extra)])
        .filter("n_value = 0 OR (_end >= _low AND _start < _high)")
        .selectExpr(*renamed(finer, "_p"), "_start",
                    *[f"greatest({quoted(c)}, {quoted(c + '_w')}) AS {quoted(c + '_p')}" for c in extra])
    )
    in_part = f"OVER (PARTITION BY {_list(finer)} ORDER BY _value ROWS UNBOUNDED PRECEDING)"
    ranked = (
        narrowed(in_cells, asked, finer, "_p")
        .selectExpr("*", f"_start + sum(_rows) {in_part} AS _last")
    )

    def at(rank: str) -> str:
        return f"max(if({rank} > _last - _rows AND {rank} <= _last, _value, NULL))"

    return ranked.groupBy(*keys).agg(
        F.expr("max(n) AS n"),
        F.expr("max(n_value) AS n_value"),
        F.expr("try_divide(max(_total), max(n_value)) AS mean"),
        F.expr(f"if({at('_low')} = {at('_high')}, {at('_low')}, "
               f"(1 - max(_share)) * {at('_low')} + max(_share) * {at('_high')}) AS median"),
        # the count of a part is never above the total; naming it keeps the sides of the joins alike,
        # so that they share one scan and one shuffle
        *[F.expr(f"greatest(max({quoted(c + '_w')}), max({quoted(c + '_p')}), max({quoted(c)})) AS {quoted(c)}")
          for c in extra],
    )
