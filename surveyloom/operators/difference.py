"""Where two releases of a table differ: digests of key buckets as a tree, compared from the root down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.quality import row_digest

#: Bits of a leaf's number, and those that one level of the tree adds.
LEAF_BITS, LEVEL_BITS = 12, 4
ROWS, TREE = "linhas", "arvore"


def bucket(key: Sequence[str], bits: int = LEAF_BITS) -> Column:
    """The leaf of a row, by its key alone: a changed row stays in its leaf."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << bits)).cast("int")


def write_digested(df: DataFrame, folder: str, key: Sequence[str], bits: int = LEAF_BITS) -> None:
    """Write rows by leaf, one directory each, and the digests of the leaves (rows and a sum of row digests)."""
    rows = df.withColumn("_balde", bucket(key, bits))
    rows.repartition("_balde").write.mode("overwrite").partitionBy("_balde").parquet(f"{folder}/{ROWS}")
    kept = df.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{ROWS}")
    kept.groupBy("_balde").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_digest(kept, df.columns)).alias("soma")).write.mode("overwrite").parquet(
        f"{folder}/{TREE}")


def _level(tree: DataFrame, shift: int) -> DataFrame:
    return tree.groupBy(F.shiftright("_balde", shift).alias("no")).agg(F.sum("n").alias("n"), F.sum("soma").alias("soma"))


def differing_leaves(spark: SparkSession, before: str, after: str, bits: int = LEAF_BITS, step: int = LEVEL_BITS) -> list[int]:
    """Leaves whose rows differ. Each level looks only below nodes that differ above; a tree has 2 ** bits leaves."""
    trees = [spark.read.parquet(f"{folder}/{TREE}") for folder in (before, after)]
    found: list[int] | None = None
    for shift in [*range(bits - step, 0, -step), 0] if bits > step else [0]:
        one, two = (_level(t if found is None else t.filter(F.shiftright("_balde", above).isin(found)), shift) for t in trees)
        same = F.equal_null(one.n, two.n) & F.equal_null(one.soma, two.soma)
        differ = one.join(two, one.no == two.no, "full").filter(~same).select(F.coalesce(one.no, two.no).alias("no"))
        found, above = sorted(r["no"] for r in differ.collect()), shift
        if not found:
            return []
    return found


def differing_rows(spark: SparkSession, before: str, after: str, bits: int = LEAF_BITS) -> DataFrame:
    """Rows that one release has more often than the other, with `lado` (antes, depois): a changed row has both.

    Only the directories of differing leaves are read, in either release.
    """
    leaves = differing_leaves(spark, before, after, bits)
    one, two = (spark.read.parquet(f"{folder}/{ROWS}").filter(F.col("_balde").isin(leaves)).drop("_balde")
                for folder in (before, after))
    return one.exceptAll(two).withColumn("lado", F.lit("antes")).unionByName(
        two.exceptAll(one).withColumn("lado", F.lit("depois")))
