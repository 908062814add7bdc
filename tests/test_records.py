"""Records over several lines: many tasks, and the rows of Spark's own multi-line reader."""

import csv
import random

import pytest

from surveyloom.sources import editions, records

ANSWERS = ["simples", "", 'disse "sim"', "duas\nlinhas", "três\n\nlinhas\n", 'aspas\n"no meio"\r\nfim', "vírgula, aqui", " bordas ",
           "\r\n", "não quebra", '"', "x" * 60, "ção\n" * 5, ",\n,"]


def write(path, rows, header=("a", "texto, livre", "c"), end="\n", last=True, bom=False):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)
    if not last:
        path.write_bytes(path.read_bytes().rstrip(b"\r\n"))


@pytest.fixture
def split(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def by(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)

    yield by
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def whole(spark, path, columns=None):
    return spark.read.csv(str(path), header=True, escape='"', multiLine=True, recursiveFileLookup=True, enforceSchema=False)


@pytest.mark.parametrize("size", [9, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_as_the_multiline_reader(spark, split, tmp_path, size, end):
    rng = random.Random(size)
    rows = [[rng.choice(ANSWERS) for _ in range(3)] for _ in range(60 if size > 50 else 10)]
    write(tmp_path / "um.csv", rows[::2], end=end)
    write(tmp_path / "dois.csv", rows[1::2], end=end, last=False)
    split(size)
    got = editions.read_raw(spark, str(tmp_path), multiline=True)
    want = whole(spark, tmp_path)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sum(r["registros"] for r in editions.count_records(spark, str(tmp_path)).collect()) == len(rows)


def test_ragged_rows_and_blank_lines(spark, split, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n1\n\n2,"x\ny",3,4\n\n"",,""\n5,6\n')
    split(5)
    got = editions.read_raw(spark, str(tmp_path), multiline=True).collect()
    assert sorted(map(str, got)) == sorted(map(str, whole(spark, tmp_path).collect())) and len(got) == 4


@pytest.mark.parametrize("header", [("a", "a", ""), ("q\nr", 'x"y', "z"), ("('P1 ', 'x.y')", "a.b", "`c`")])
def test_headers_of_all_kinds(spark, split, tmp_path, header):
    for name in "xy":
        write(tmp_path / f"{name}.csv", [["1", "2\n2", "3"]], header)
    split(6)
    got = editions.read_raw(spark, str(tmp_path), multiline=True)
    assert got.columns == whole(spark, tmp_path).columns
    assert [tuple(r) for r in got.collect()] == [("1", "2\n2", "3")] * 2


def test_other_headers_are_an_error(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "2\n2", "3"]])
    write(tmp_path / "b.csv", [["1", "2\n2", "3"]], ("texto, livre", "a", "c"))
    with pytest.raises(Exception, match="header differs"):
        editions.read_raw(spark, str(tmp_path), multiline=True).collect()


def test_open_quotes_are_an_error(spark, tmp_path):
    (tmp_path / "broken.csv").write_text('a,b\n1,"2\n3,4\n')
    with pytest.raises(ValueError, match="broken.csv"):
        editions.read_raw(spark, str(tmp_path), multiline=True)


def test_only_a_header_and_empty_files(spark, tmp_path):
    write(tmp_path / "a.csv", [])
    assert editions.read_raw(spark, str(tmp_path), multiline=True).count() == 0
    (tmp_path / "b.csv").write_text("")
    assert editions.read_raw(spark, str(tmp_path), multiline=True).count() == 0


def test_compressed_files_are_read_whole(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt", newline="") as f:
        f.write('a,b\n1,"2\n2"\n')
    assert [tuple(r) for r in editions.read_raw(spark, str(tmp_path), multiline=True).collect()] == [("1", "2\n2")]


def test_one_file_is_read_by_many_tasks(spark, split, tmp_path):
    rows = [[str(i), f'resposta "{i}"\nsegunda linha', "c"] for i in range(20_000)]
    write(tmp_path / "large.csv", rows)
    split(1 << 16)
    found = records.records_of(spark, str(tmp_path)).selectExpr("spark_partition_id() AS task", "header")
    assert found.select("task").distinct().count() >= 10
    got = editions.read_raw(spark, str(tmp_path), multiline=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_a_record_over_many_blocks(spark, split, tmp_path):
    long = "linha\n" * 300
    write(tmp_path / "f.csv", [["1", long, "x"], ["2", "kurz", long], ["3", "", "z"]])
    split(100)
    got = {r["a"]: tuple(r) for r in editions.read_raw(spark, str(tmp_path), multiline=True).collect()}
    assert got == {"1": ("1", long, "x"), "2": ("2", "kurz", long), "3": ("3", None, "z")}
