"""What a row of the core layer promises: violations are listed per row, and broken rows go aside in the same write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

GOOD, BAD = "boa", "quarentena"
_LIST, _STATE = "violacoes", "situacao"
#: Where the good rows lie below the folder of a checked layer.
GOOD_FOLDER = f"{_STATE}={GOOD}"


def core_rules() -> dict[str, Column]:
    """Name and condition of each violation. A missing answer is none; an answer that could not be read is."""
    def unread(answer: str, reading: str) -> Column:
        return F.col(answer).isNotNull() & (F.trim(answer) != "") & F.col(reading).isNull()

    return {
        "id_ausente": F.col("id").isNull(),
        "idade_improvavel": ~F.col("idade").between(14, 100),
        "faixa_ilegivel": unread("faixa_salarial", "salario_pm"),
        "cargo_sem_familia": unread("cargo", "cargo_grupo"),
        "modelo_sem_rotulo": unread("modelo_atual", "modelo_atual_h") | unread("modelo_ideal", "modelo_ideal_h"),
        "prioridade_sem_rotulo": unread("prioridade_ia", "prioridade_ia_h"),
    }


def with_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add `violacoes`, the names of the rules that a row breaks, in their order; one projection."""
    broken = F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()])
    return df.withColumn(_LIST, F.array_compact(broken) if rules else F.array().cast("array<string>"))


def write_checked(df: DataFrame, folder: str, rules: Mapping[str, Column], by: str = "ano") -> dict[str, int]:
    """Write rows that keep all rules and rows that break some, each under its own directory, in one pass.

    Returns the rows written (`boa`, `quarentena`) and how many break each rule, counted by the write itself.
    """
    seen = Observation()
    checked = with_violations(df, rules)
    broken = F.size(_LIST) > 0
    counts = {GOOD: F.count_if(~broken), BAD: F.count_if(broken)} | {
        name: F.count_if(F.array_contains(_LIST, name)) for name in rules}
    (checked.withColumn(_STATE, F.when(broken, F.lit(BAD)).otherwise(F.lit(GOOD)))
     .observe(seen, *[c.alias(name) for name, c in counts.items()])
     .write.mode("overwrite").partitionBy(_STATE, by).parquet(folder))
    return {name: int(seen.get[name]) for name in counts}


def read_good(spark: SparkSession, folder: str) -> DataFrame:
    """The layer: rows that keep all rules. The directory alone decides which are read."""
    return spark.read.parquet(folder).filter(F.col(_STATE) == GOOD).drop(_STATE, _LIST)


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).filter(F.col(_STATE) == BAD).drop(_STATE)
