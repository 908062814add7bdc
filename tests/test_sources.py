import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import survey
from surveyloom.plans import vocabulary as v
from surveyloom.sources import editions, headers, tables
from surveyloom.sources.folders import new_path, shared_folder
from surveyloom.streaming.landing import land_new_files


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x").startswith(shared_folder(spark))


def test_mapping_sizes():
    assert [len(v.CORE_HEADERS[e]) for e in v.CORE_EDITIONS] == [69, 69, 69]
    assert [len(v.HISTORY_HEADERS[e]) for e in v.HISTORY_EDITIONS] == [7, 7, 7]
    assert sum(v.CORE_HEADERS[2024][t] != v.CORE_HEADERS[2025][t] for t in v.HEADERS_2025) == 21


def test_mapping_round_trip(spark):
    path = new_path(spark, "mapping")
    headers.write_mapping(spark, v.CORE_HEADERS, v.HISTORY_HEADERS, path)
    assert headers.as_headers(headers.read_mapping(spark, path)) == {**v.CORE_HEADERS, **v.HISTORY_HEADERS}


def test_overlay_equals_the_edition(spark):
    both = headers.mapping_table(spark, {2025: v.HEADERS_2025, 2024: v.CHANGED_HEADERS_2024})
    base, changes = (both.filter(F.col("edition") == e) for e in (2025, 2024))
    assert {r["target"]: r["source"] for r in headers.overlay(base, changes).collect()} == v.CORE_HEADERS[2024]


def test_single_json_document(spark):
    path = new_path(spark, "mapping")
    headers.write_mapping(spark, v.CORE_HEADERS, v.HISTORY_HEADERS, path)
    text = "\n".join(p.read_text() for p in sorted(Path(path).glob("part-*")))
    assert list(json.loads(text)) == ["2023", "2024", "2025", "historico"]


ODD = [("a", 'disse "sim", ok\nsegunda linha'), ("b", None), ("c", '""'), ("d", "\n\n"), ("e", "simples")]


@pytest.mark.parametrize("split", [16, 64, 1 << 20])
def test_records_counted_across_splits(spark, tmp_path, split):
    path = tmp_path / "odd.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(["x", "texto, livre"])
        writer.writerows(ODD * 20)
    with open(path, newline="", encoding="utf-8") as f:
        expected = sum(1 for _ in csv.reader(f)) - 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = editions.count_records(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["registros"] for r in rows] == [expected]


def test_raw_round_trip_with_line_breaks(spark):
    path = new_path(spark, "raw")
    df = spark.createDataFrame(ODD, "`('P1 ', 'x.y')` string, `texto` string")
    editions.write_raw(df, path)
    back = editions.read_raw(spark, path, multiline=True)
    assert back.columns == df.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_landing_is_idempotent(spark):
    bronze = new_path(spark, "bronze")
    one, other = (spark.createDataFrame([(t,)], "x string") for t in ("um", "dois"))
    editions.land_edition(one, bronze, 2025)
    editions.land_edition(other, bronze, 2025)
    assert [r["x"] for r in editions.read_edition(spark, bronze, 2025).collect()] == ["um"]


def test_interrupted_landing_is_done_again(spark):
    bronze = new_path(spark, "bronze")
    Path(editions.edition_path(bronze, 2025), "_temporary", "0").mkdir(parents=True)
    editions.land_edition(spark.createDataFrame([("um",)], "x string"), bronze, 2025)
    assert [r["x"] for r in editions.read_edition(spark, bronze, 2025).collect()] == ["um"]


def test_parts_of_a_broken_commit_are_an_error(spark):
    """Neither taken for a whole edition nor written over."""
    bronze = new_path(spark, "bronze")
    folder = Path(editions.edition_path(bronze, 2025))
    folder.mkdir(parents=True)
    (folder / "part-00000.csv").write_text("x\nzero\n")
    with pytest.raises(RuntimeError, match="not completed"):
        editions.land_edition(spark.createDataFrame([("um",)], "x string"), bronze, 2025)
    (folder / "_SUCCESS").touch()
    editions.land_edition(spark.createDataFrame([("um",)], "x string"), bronze, 2025)
    assert [r["x"] for r in editions.read_edition(spark, bronze, 2025).collect()] == ["zero"]


def test_delivered_file_is_never_overwritten(spark):
    bronze = new_path(spark, "bronze")
    folder = Path(editions.edition_path(bronze, 2025))
    folder.mkdir(parents=True)
    (folder / "entrega.csv").write_text("x\nzero\n")
    editions.land_edition(spark.createDataFrame([("um",)], "x string"), bronze, 2025)
    assert [r["x"] for r in editions.read_edition(spark, bronze, 2025).collect()] == ["zero"]


def test_stream_takes_each_file_once(spark):
    inbox, bronze, memory = (new_path(spark, n) for n in ("inbox", "bronze", "memory"))
    for text, expected in (("um", ["um"]), (None, ["um"]), ("dois", ["dois", "um"])):
        if text:
            editions.write_raw(spark.createDataFrame([(text,)], "x string"), inbox, "append")
        land_new_files(spark, inbox, bronze, 2025, memory)
        assert sorted(r["x"] for r in editions.read_edition(spark, bronze, 2025).collect()) == expected


def test_stream_hides_no_delivered_file_and_changes_no_byte(spark):
    inbox, bronze, memory = (new_path(spark, n) for n in ("inbox", "bronze", "memory"))
    folder = Path(editions.edition_path(bronze, 2025))
    folder.mkdir(parents=True)
    (folder / "entrega.csv").write_text("x,y\nzero,0\n")
    Path(inbox).mkdir(parents=True)
    sent = {"a.csv": 'x,y\n"um\nlinha",""\n', "b.csv": 'x,y\n"d""ois",2,sobra\n'}
    for name, text in sent.items():
        (Path(inbox) / name).write_text(text)
    land_new_files(spark, inbox, bronze, 2025, memory)
    landed = {p.read_text() for p in folder.glob("lote-*/*.csv")}
    assert landed == set(sent.values())
    rows = editions.read_edition(spark, bronze, 2025, multiline=True).collect()
    assert sorted(r["x"] for r in rows) == ['d"ois', "um\nlinha", "zero"]
    assert editions.landed_editions(spark, bronze) == {2025}


def test_files_with_other_headers_are_an_error(spark):
    folder = Path(editions.edition_path(new_path(spark, "bronze"), 2025))
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,genero\n1,F\n")
    (folder / "b.csv").write_text("genero,id\nM,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        editions.read_edition(spark, str(folder.parent), 2025).collect()


def test_replacing_one_edition_keeps_the_others(spark):
    path = new_path(spark, "layer")
    tables.write_layer(spark.createDataFrame([(1, 2023), (2, 2024)], "x int, ano int"), path)
    tables.replace_editions(spark.createDataFrame([(9, 2024)], "x int, ano int"), path)
    assert sorted(tuple(r) for r in tables.read_table(spark, path).collect()) == [(1, 2023), (9, 2024)]


def test_mart_is_one_ordered_csv_and_counts_itself(spark):
    folder = new_path(spark, "gold")
    df = spark.range(100).select(((F.col("id") * 37) % 100).alias("n")).repartition(5)
    assert tables.publish_mart(df, folder, "m", ["n"]) == 100
    parts = list(Path(f"{folder}/csv/m").glob("part-*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text().split() == ["n", *map(str, range(100))]


def test_external_table_sees_its_editions(spark):
    path = new_path(spark, "layer")
    tables.write_layer(spark.createDataFrame([(1, 2023), (2, 2024)], "x int, ano int"), path)
    df = tables.register_external(spark, "testes", "camada", "x int", path)
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2023), (2, 2024)]
    spark.sql("DROP TABLE testes.camada")


def test_external_table_follows_its_layer(spark):
    """Another location, another column, a vanished edition: the table shows what is there now."""
    rows = spark.createDataFrame([(1, "a", 2024), (2, "b", 2025)], "n int, k string, ano int")
    old, new = new_path(spark, "layer"), new_path(spark, "layer o'clock")
    tables.write_layer(rows.drop("k"), old)
    tables.write_layer(rows.where("ano = 2025"), new)
    assert tables.register_external(spark, "pesquisa", "follows", "n int", old).count() == 2
    got = tables.register_external(spark, "pesquisa", "follows", "n int, k string", new)
    assert [tuple(r) for r in got.collect()] == [(2, "b", 2025)]
    assert spark.read.parquet(old).count() == 2
    spark.sql("DROP TABLE pesquisa.follows")


def test_editions_are_joined_to_their_items_once(spark, sf_dir, tmp_path):
    """No edition reads the items again; keys that come twice give the rows that each edition by itself has."""
    twice, years = str(tmp_path), (1998, 2001)
    for name in ("orders", "lineitem", "customer", "nation", "region"):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (rows.union(rows.limit(20)) if name in ("customer", "lineitem") else rows).write.parquet(f"{twice}/{name}.parquet")
    found = survey.raw_editions(spark, twice, years, {"chave": "k"})
    assert list(found) == list(years)
    for y, df in found.items():
        assert "lineitem" not in df._jdf.queryExecution().executedPlan().toString()
        alone = survey.raw_edition(spark, twice, y, {"chave": "k"})
        assert df.columns == alone.columns and df.count() > 0
        assert df.exceptAll(alone).count() == alone.exceptAll(df).count() == 0


def test_landing_twice_joins_the_items_once(spark, sf_dir, monkeypatch):
    read = []
    monkeypatch.setattr(survey, "_with_items", lambda *a, f=survey._with_items: read.append(a) or f(*a))
    assert queries()["s02_land_if_absent"](spark, sf_dir).count() > 0 and len(read) == 1
