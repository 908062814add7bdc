"""Raw editions -> the two harmonised layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions import scalars as x
from surveyloom.operators.quality import require_columns
from surveyloom.plans import vocabulary as v


def mapped_select(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{x.quoted(source)} AS {x.quoted(target)}" for target, source in headers.items()])


def flag_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.startswith(v.FLAG_PREFIXES) or c in v.SINGLE_FLAGS]


def apply_to(df: DataFrame, columns: Sequence[str], expression) -> DataFrame:
    """One projection that replaces all listed columns by `expression(column)`."""
    return df.withColumns({c: expression(c) for c in columns})


def role_family(c: Column | str) -> Column:
    return x.label_by_fragment(c, v.ROLE_FAMILIES, v.ROLE_DEFAULT)


def work_model(c: Column | str) -> Column:
    return x.label_by_fragment(c, v.WORK_MODELS, v.WORK_MODEL_DEFAULT)


def ai_priority(c: Column | str) -> Column:
    return x.label_by_prefix(c, v.AI_PRIORITIES, v.AI_PRIORITY_DEFAULT)


def mapped_edition(raw: DataFrame, headers: Mapping[str, str], edition: int) -> DataFrame:
    """The mapped columns of one edition, still as typed, with the edition beside them."""
    require_columns(raw.columns, headers, edition)
    return mapped_select(raw, headers).withColumn("ano", F.lit(edition))


def union_editions(editions: Sequence[DataFrame]) -> DataFrame:
    """Append by name; a column missing in one edition is an error, repeated rows are kept."""
    return reduce(DataFrame.unionByName, editions)


def harmonised_core(mapped: DataFrame) -> DataFrame:
    """Normalised flags and derived labels, in one projection over all editions."""
    derived = {
        "idade": x.lenient_int("idade"),
        "salario_pm": x.band_midpoint("faixa_salarial"),
        "cargo_grupo": role_family("cargo"),
        "modelo_atual_h": work_model("modelo_atual"),
        "modelo_ideal_h": work_model("modelo_ideal"),
        "prioridade_ia_h": ai_priority("prioridade_ia"),
        "layoff_sim": x.prefix_tristate("layoff"),
    }
    return apply_to(mapped, flag_columns(mapped.columns), x.flag).withColumns(derived)


def silver_core(raw: Mapping[int, DataFrame], headers: Mapping[int, Mapping[str, str]]) -> DataFrame:
    return harmonised_core(union_editions([mapped_edition(df, headers[e], e) for e, df in raw.items()]))


def silver_long(
    raw: Mapping[int, DataFrame], headers: Mapping[int, Mapping[str, str]], core: DataFrame
) -> DataFrame:
    """All editions in the columns they share; the core rows come from the harmonised core layer."""
    older = union_editions([mapped_edition(df, headers[e], e) for e, df in raw.items()])
    older = apply_to(older, flag_columns(older.columns), x.flag)
    return union_editions([older.select(*v.LONG_COLUMNS), core.select(*v.LONG_COLUMNS)])


_INTEGERS = ("idade", "ano", "layoff_sim")


def core_contract(columns: Sequence[str]) -> T.StructType:
    """Declared types of the core layer."""
    def type_of(c: str) -> T.DataType:
        if c == "salario_pm":
            return T.DoubleType()
        return T.IntegerType() if c in _INTEGERS or flag_columns([c]) else T.StringType()

    return T.StructType([T.StructField(c, type_of(c)) for c in columns])
