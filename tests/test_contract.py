"""Broken rows go aside in the same write, with the rules they break."""

from pyspark.sql import functions as F

from surveyloom.plans import contract, silver
from surveyloom.sources.folders import new_path

COLUMNS = ("id string, idade int, faixa_salarial string, salario_pm double, cargo string, cargo_grupo string, modelo_atual string, "
           "modelo_atual_h string, modelo_ideal string, modelo_ideal_h string, prioridade_ia string, prioridade_ia_h string, ano int")
FINE = ("1", 30, "de R$ 1.001/mês a R$ 2.000/mês", 1500.5, "DBA", "DBA", "x", "Outro", None, None, None, None, 2025)


def row(**changes):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return tuple({**dict(zip(names, FINE)), **changes}.values())


def test_rules_and_counts(spark):
    rows = [row(), row(id=None), row(idade=7, faixa_salarial="a combinar", salario_pm=None), row(idade=None, salario_pm=None, faixa_salarial=None),
            row(faixa_salarial=" ", salario_pm=None), row(prioridade_ia="talvez", ano=2024), row(cargo="?", cargo_grupo=None, ano=2024)]
    df = spark.createDataFrame(rows, COLUMNS)
    folder = new_path(spark, "checked")
    counts = contract.write_checked(df, folder, contract.core_rules())
    assert counts == {"boa": 3, "quarentena": 4, "id_ausente": 1, "idade_improvavel": 1, "faixa_ilegivel": 1,
                      "cargo_sem_familia": 1, "modelo_sem_rotulo": 0, "prioridade_sem_rotulo": 1}
    good, bad = contract.read_good(spark, folder), contract.read_quarantine(spark, folder)
    assert set(good.columns) == set(df.columns) and good.count() == 3
    assert sorted(tuple(r["violacoes"]) for r in bad.collect()) == [
        ("cargo_sem_familia",), ("id_ausente",), ("idade_improvavel", "faixa_ilegivel"), ("prioridade_sem_rotulo",)]
    assert sorted(map(str, good.select(df.columns).union(bad.select(df.columns)).collect())) == sorted(map(str, df.collect()))


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([row()], COLUMNS)
    folder = new_path(spark, "checked")
    assert contract.write_checked(df, folder, {}) == {"boa": 1, "quarentena": 0}
    assert contract.write_checked(df.limit(0), new_path(spark, "checked"), contract.core_rules())["boa"] == 0


def test_the_layer_is_written_under_its_declared_types(spark):
    declared = silver.core_contract(["id", "idade", "salario_pm", "lang_sql"])
    assert [f.dataType.simpleString() for f in declared] == ["string", "int", "double", "int"]
    df = spark.createDataFrame([("1", 3, 1.0, 1)], "id string, idade int, salario_pm double, lang_sql int")
    assert df.select(F.col("lang_sql"), "id", "salario_pm", "idade").to(declared).columns == declared.names
