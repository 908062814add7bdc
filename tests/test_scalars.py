import pytest
from pyspark.sql import functions as F

from surveyloom.functions import scalars as x
from surveyloom.plans import silver


def apply(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select("i", expression).orderBy("i").drop("i").collect()]


TABLES = {
    "band": (x.band_midpoint, [
        ("de R$ 3.001/mês a R$ 4.000/mês", 3500.5), ("Menos de R$ 1.000/mês", 500.0),
        ("Acima de R$ 40.001/mês", 45001.125), ("de R$ 25.001/mês a R$ 3000/mês", 27500.5),
        ("R$ 5.000", 5000.0), ("menos de R$ 1.000", 1000.0), ("a combinar", None), ("", None), (None, None),
        ("de 1 a 2 ou 9", 1.5), ("12,50", 31.0)]),
    "role": (silver.role_family, [
        ("Outra Opção", "Outros"), ("Cientista de Dados e outras", "Outros"),
        ("Analista de BI/BI Analyst", "Business Intelligence"),
        ("Analista de Negócios/Business Analyst", "Análise de Negócios"),
        ("Arquiteto de Dados", "Engenharia/Arquitetura de Dados"), ("Data Architect", "Outros"), ("DBA", "DBA"),
        ("Feedback Lead", "DBA"), ("Analista de Suporte", "Outros"), ("ESTATÍSTICO", "Estatística/Economia"),
        (None, None)]),
    "model": (silver.work_model, [
        ("Modelo 100% remoto", "100% remoto"), ("híbrido com dias fixos", "Híbrido (dias fixos)"),
        ("Modelo híbrido flexível", "Híbrido flexível"), ("FLEXIVEL", "Híbrido flexível"), ("outro", "Outro"),
        (None, None)]),
    "priority": (silver.ai_priority, [
        ("Sim, é nossa principal prioridade", "1. Principal prioridade da empresa"),
        ("Sim, está entre as principais", "2. Entre as principais (2-4 anos)"),
        ("Mais ou menos", "3. Iniciativas isoladas, sem foco"), ("Não é uma iniciativa", "4. Não é prioridade"),
        ("Não sei", "5. Não sabe opinar"), ("qualquer outro", "5. Não sabe opinar"),
        ("sim, é nossa principal", "5. Não sabe opinar"), (None, None)]),
    "flag": (x.flag, [
        ("1", 1), ("1.0", 1), ("true", 1), ("TRUE", 1), ("True", 1), ("0", 0), ("0.0", 0), ("false", 0),
        ("Sim", None), (" 1", None), ("", None), (None, None)]),
    "tristate": (x.prefix_tristate, [
        ("Sim, ocorreu", 1), ("Não ocorreu", 0), ("Prefiro não responder", None), (None, None)]),
    "int": (x.lenient_int, [
        ("27", 27), (" 27 ", 27), ("27.0", 27), ("27.9", 27), ("-3", -3), ("", None), ("abc", None), ("1e2", None),
        ("99999999999", None), (None, None)]),
    "ordinal": (x.drop_ordinal, [("2. Label", "Label"), ("1. A. B", "A. B"), ("sem", "sem"), (None, None)]),
}


@pytest.mark.parametrize("name", TABLES)
def test_truth_table(spark, name):
    fn, rows = TABLES[name]
    assert apply(spark, fn("v"), [r[0] for r in rows]) == [r[1] for r in rows]


def test_display_numbers(spark):
    values = [1234.5, -0.25, 1000000.0, 0.0, 28.05]
    assert apply(spark, x.pt_number("v", 1), values, "double") == ["1.234,5", "-0,2", "1.000.000,0", "0,0", "28,1"]
    assert apply(spark, x.pt_signed("v"), values, "double") == ["+1234,5", "-0,2", "+1000000,0", "+0,0", "+28,1"]
    assert apply(spark, x.pt_percent("v"), [42.4], "double") == ["42,4%"]


def test_round_half_up(spark):
    assert apply(spark, F.round("v", 0), [3500.5, 10000.5, 2.5], "double") == [3501.0, 10001.0, 3.0]
    assert apply(spark, F.round("v", 1), [0.25, 0.35], "double") == [0.3, 0.4]


def test_empty_base_is_null_not_an_error(spark):
    assert apply(spark, x.percent(F.lit(1), "v"), [0, 8], "bigint") == [None, 12.5]
    assert apply(spark, x.relative_gap(F.lit(1.0), "v"), [0.0, 2.0], "double") == [None, -50.0]


def test_edition_captions(spark):
    names = {2025: "2025/26"}
    rows = spark.createDataFrame([([2025],), ([2023, 2024, 2025],), ([2019, 2021, 2022, 2025],)], "v array<int>")
    assert [r[0] for r in rows.select(x.editions_caption("v", names)).collect()] == [
        "Edição 2025/26", "Edições 2023, 2024, 2025/26", "Edições 2019 a 2025/26"]
