"""Bootstrap interval of the median for groups of any size.

A resample of n rows, drawn with replacement, has a median that depends only on its middle order
statistics. The k-th of n uniform draws follows Beta(k, n-k+1), so each replicate needs one or two
numbers instead of n: a rank in the sorted group is drawn directly, with the same distribution as
drawing the rows. Spark then looks the ranks up in the value histogram. Work per group is the number
of replicates, however many rows the group has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.scalars import quoted
from surveyloom.operators.ranks import cells, narrowed, parts, renamed, same, value_counts


def _draw_ranks(sizes: DataFrame, keys: Sequence[str], resamples: int, seed: int) -> DataFrame:
    """keys, n, `_low`, `_high`, `_times`: the two middle ranks of every resample, equal pairs counted.

    `sizes` has one row per group (keys, n_value). The generator is seeded by the group's own key, so
    the numbers do not depend on how Spark spreads the groups.
    """
    keys = list(keys)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            for row in batch.to_dict("records"):
                n = int(row["n_value"])
                rng = np.random.default_rng([seed, int(row["_key_hash"]) & 0xFFFFFFFFFFFFFFFF])
                k = (n + 1) // 2
                lower = rng.beta(k, n - k + 1, size=resamples)
                if n % 2:
                    upper = lower
                else:
                    # the next of the n-k draws above: minimum of n-k uniforms on the rest
                    upper = lower + (1 - lower) * -np.expm1(np.log1p(-rng.random(resamples)) / (n - k))
                ends = np.clip(np.ceil(np.stack([lower, upper]) * n), 1, n).astype("int64")
                pairs, times = np.unique(ends, axis=1, return_counts=True)
                out = pd.DataFrame({"n": n, "_low": pairs[0], "_high": pairs[1], "_times": times})
                for key in keys:
                    out[key] = row[key]
                yield out[[*keys, "n", "_low", "_high", "_times"]]

    schema = T.StructType(
        [sizes.schema[k] for k in keys]
        + [T.StructField(name, T.LongType()) for name in ("n", "_low", "_high", "_times")]
    )
    hashed = sizes.select(*keys, "n_value", F.xxhash64(*keys).alias("_key_hash"))
    return hashed.mapInPandas(draw, schema)


def _next_known(df: DataFrame, within: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill the asking rows (`_kind` 0) with the columns of the first mark (`_kind` 1) at or after `_at`.

    Rows are read from the far end, so that the next mark is the last one seen and the frame is a
    running one.
    """
    seen = Window.partitionBy(*within).orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.withColumns({c: F.last(c, ignorenulls=True).over(seen) for c in columns}).filter("_kind = 0")


def values_at(counted: DataFrame, cell: DataFrame, asked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, `_at`, `_value`: the value at each asked rank (keys, `_at`) of the sorted group.

    First the cell that holds the rank, among the group's cells; then the part of the cell; then the value,
    among the values of the parts that were asked for.
    """
    keys = list(keys)
    within = [*keys, "_cell"]
    key = [quoted(k) for k in keys]
    marks = cell.filter("_cell IS NOT NULL").selectExpr(*key, "_upto AS _at", "_cell", "_before", "1 AS _kind")
    asked = asked.selectExpr(
        *key, "_at", "CAST(NULL AS BIGINT) AS _cell", "CAST(NULL AS BIGINT) AS _before", "0 AS _kind"
    )
    placed = _next_known(marks.unionByName(asked), keys, ["_cell", "_before"])

    used = placed.groupBy(*within).agg(F.max("_before").alias("_before"))
    in_cells = narrowed(counted, used.selectExpr(*renamed(within), "_before"), within)
    finer = [*within, "_part"]
    cell_key = [*key, "_cell"]
    marks = parts(in_cells, within).selectExpr(*cell_key, "_end AS _at", "_part", "_start", "1 AS _kind")
    asked = placed.selectExpr(
        *cell_key, "_at", "CAST(NULL AS BIGINT) AS _part", "CAST(NULL AS BIGINT) AS _start", "_kind"
    )
    placed = _next_known(marks.unionByName(asked), within, ["_part", "_start"])

    used = placed.groupBy(*finer).agg(F.max("_start").alias("_start"))
    part_key = [*cell_key, "_part"]
    in_part = f"OVER (PARTITION BY {', '.join(part_key)} ORDER BY _value ROWS UNBOUNDED PRECEDING)"
    in_parts = narrowed(
        in_cells.selectExpr(*part_key, "_value", "_rows"), used.selectExpr(*renamed(finer), "_start"), finer)
    values = in_parts.selectExpr(*part_key, f"_start + sum(_rows) {in_part} AS _at", "_value", "1 AS _kind")
    wanted = placed.selectExpr(*part_key, "_at", "CAST(NULL AS DOUBLE) AS _value", "_kind")
    return _next_known(values.unionByName(wanted), finer, ["_value"]).select(*keys, "_at", "_value")


def median_interval(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    resamples: int = 3000,
    seed: int = 43,
    level: float = 0.95,
) -> DataFrame:
    """keys, n, mediana, ic_baixo, ic_alto: median and percentile interval of the resampled medians.

    Groups without a value give no row. Figures are rounded to units.
    """
    keys = list(keys)
    counted = value_counts(df.filter(F.col(value).isNotNull()), keys, value)
    cell = cells(counted, keys)
    sizes = cell.groupBy(*keys).agg(F.max("n_value").alias("n_value"))
    # the plain median asks for its own two ranks, with no weight among the resamples
    plain = sizes.selectExpr(
        *[quoted(k) for k in keys],
        "n_value AS n", "ceil(n_value / 2) AS _low", "floor(n_value / 2) + 1 AS _high", "0L AS _times",
    )
    pair = ["_low", "_high", "_times"]
    pairs = _draw_ranks(sizes, keys, resamples, seed).unionByName(plain)
    ranks = pairs.select(*keys, "n", *pair, F.explode(F.array("_low", "_high")).alias("_at"))
    known = values_at(counted, cell, ranks.select(*keys, "_at").distinct(), keys)
    known = known.selectExpr(*renamed([*keys, "_at"]), "_value")
    medians = (
        ranks.join(known, same([*keys, "_at"]))
        .groupBy(*keys, "n", *pair)
        .agg(F.avg("_value").alias("_median"))
    )
    tail = (1 - level) / 2
    ends = F.percentile("_median", [tail, 1 - tail], F.col("_times"))
    return (
        medians.groupBy(*keys)
        .agg(
            F.max("n").alias("n"),
            F.max(F.when(F.col("_times") == 0, F.col("_median"))).alias("_plain"),
            ends.alias("_ends"),
        )
        .select(
            *keys,
            "n",
            F.round("_plain", 0).alias("mediana"),
            F.round(F.get("_ends", F.lit(0)), 0).alias("ic_baixo"),
            F.round(F.get("_ends", F.lit(1)), 0).alias("ic_alto"),
        )
    )
