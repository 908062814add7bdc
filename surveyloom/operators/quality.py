"""Data-quality results as tables, with raising wrappers where a run must stop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.scalars import quoted
from surveyloom.operators.shares import count_by, fill_rates, share_within


class QualityError(ValueError):
    """A gate found data that must not be published."""


def missing_columns(mapping: DataFrame, header: DataFrame) -> DataFrame:
    """Mapped sources (edition, target, source) absent from the file headers (edition, source)."""
    return mapping.join(header, ["edition", "source"], "left_anti").select("edition", "target", "source")


def require_columns(columns: Sequence[str], headers: Mapping[str, str], edition: int) -> None:
    """Driver-side form of the same check: it needs no job, only the header that was read."""
    present = set(columns)
    absent = [f"{target} <- {source}" for target, source in headers.items() if source not in present]
    if absent:
        raise QualityError(f"edition {edition}: mapped columns absent: {absent}")


def volume_gate(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows per edition against the expected number; editions on one side only also show up."""
    joined = counts.join(expected, "edition", "full")
    ok = F.col("n").eqNullSafe(F.col("expected"))
    return joined.select(
        "edition", "n", "expected", F.when(ok, F.lit("OK")).otherwise(F.lit("DIVERGENTE")).alias("status")
    )


def require_volumes(gate: DataFrame) -> None:
    """Gate rows are one per edition, so listing the failed ones on the driver is safe."""
    failed = gate.filter(F.col("status") != "OK").orderBy("edition").collect()
    if failed:
        raise QualityError(f"row volume: {[r.asDict() for r in failed]}")


def reconcile(upstream: DataFrame, downstream: DataFrame) -> DataFrame:
    """Rows per edition in two layers, and the difference."""
    up = count_by(upstream, "ano", name="n_bronze")
    down = count_by(downstream, "ano", name="n_silver")
    n_up, n_down = F.coalesce("n_bronze", F.lit(0)), F.coalesce("n_silver", F.lit(0))
    return up.join(down, "ano", "full").select(
        "ano", n_up.alias("n_bronze"), n_down.alias("n_silver"), (n_down - n_up).alias("delta")
    )


def uniqueness(df: DataFrame, key: str, by: str = "ano") -> DataFrame:
    """Rows, distinct keys and repeats per group; repeated rows are kept."""
    return (
        df.groupBy(by)
        .agg(F.count(F.lit(1)).alias("linhas"), F.countDistinct(key).alias("ids_distintos"))
        .withColumn("tokens_repetidos", F.col("linhas") - F.col("ids_distintos"))
    )


def fill_profile(df: DataFrame, reasons: Mapping[str, str]) -> DataFrame:
    """Filled share of each listed column with the reason it may be empty; one pass over the data."""
    rows = [
        F.struct(F.lit(c).alias("coluna"), F.col(c).alias("pct_preenchido"), F.lit(why).alias("motivo"))
        for c, why in reasons.items()
    ]
    return fill_rates(df, list(reasons)).select(F.inline(F.array(*rows)))


def filled_counts(df: DataFrame, name: str, count: str) -> DataFrame:
    """One row per column of `df` with its number of filled rows; one pass over the data."""
    counts = [f"count({quoted(c)}) AS `_{i}`" for i, c in enumerate(df.columns)]
    rows = [F.struct(F.lit(c).alias(name), F.col(f"_{i}").alias(count)) for i, c in enumerate(df.columns)]
    return df.groupBy().agg(*[F.expr(c) for c in counts]).select(F.inline(F.array(*rows)))


def label_pairs(df: DataFrame, raw: str, label: str, by: Sequence[str] = ("ano",)) -> DataFrame:
    """Every raw answer with the label it became and how often: unseen answers become visible."""
    return count_by(df, *by, raw, label)


def small_groups(df: DataFrame, keys: Sequence[str], minimum: int, by: Sequence[str] = ("ano",)) -> DataFrame:
    """Groups under the display cut and the share of rows they hold."""
    return share_within(count_by(df, *keys), by).filter(F.col("n") < minimum)


def run_metrics(
    core: DataFrame, long_series: DataFrame, key: str, editions: Sequence[int], marts: int
) -> DataFrame:
    """The run in numbers, one row per metric: rows in, rows kept, rows lost, repeats, widths.

    Each layer is aggregated once; the two one-row results meet in a union, not in a join.
    """
    null = F.lit(None).cast("long")
    arrived = long_series.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("ano").isin(*editions)).alias("core")
    ).select("all", "core", null.alias("rows"), null.alias("repeats"))
    kept = uniqueness(core, key).agg(
        F.coalesce(F.sum("linhas"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("tokens_repetidos"), F.lit(0)).alias("repeats"),
    ).select(null.alias("all"), null.alias("core"), "rows", "repeats")
    figures = {
        "linhas_bronze": F.col("all"),
        "linhas_nucleo": F.col("rows"),
        "descartados": F.col("core") - F.col("rows"),
        "tokens_repetidos": F.col("repeats"),
        "colunas_nucleo": F.lit(len(core.columns)).cast("long"),
        "tabelas_gold": F.lit(marts).cast("long"),
    }
    rows = [F.struct(F.lit(name).alias("metrica"), c.alias("valor")) for name, c in figures.items()]
    return (
        arrived.unionByName(kept)
        .agg(*[F.max(c).alias(c) for c in ("all", "core", "rows", "repeats")])
        .select(F.inline(F.array(*rows)))
    )


def content_checksum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and a sum of row digests: the same rows in any order give the same pair."""
    digest = F.sum(row_digest(df, columns or df.columns))
    return df.agg(F.count(F.lit(1)).alias("n"), digest.cast("string").alias("checksum"))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """60 bits of a row as a decimal, so that they add up.

    A row is digested as its fields, each with its length before it (NULL: N), so no two rows of different fields
    read alike. Doubles are digested to four decimals.
    """
    def field(c: str) -> Column:
        value = F.col(quoted(c))
        text = (value.cast("decimal(38,4)") if dict(df.dtypes)[c] == "double" else value).cast("string")
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("N"))

    row = F.concat(*[field(c) for c in columns])
    return F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")
