"""Files land byte by byte, whole or not at all."""

import hashlib
import json
import os
from pathlib import Path

import pytest

from surveyloom.sources import editions, store
from surveyloom.sources.folders import new_path
from surveyloom.streaming.landing import land_new_files

BYTES = {
    "latim.csv": "id,cidade\n1,São João\n".encode("latin-1"),
    "sem fim.csv": b'x,y\n1,"a\nb"',
    "crlf.csv": b"x,y\r\n1,2\r\n",
    "zero.csv": b"x\n\x00\xff\xfe\n",
    "ação%20.csv": b"x\n1\n",
}


def delivery(spark, files=BYTES):
    folder = Path(new_path(spark, "entrega"))
    for name, data in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return folder


def landed(bronze, edition=2025):
    folder = Path(editions.edition_path(bronze, edition))
    return {p.name[9:]: p.read_bytes() for p in folder.rglob("*.csv")}


def test_every_byte_arrives(spark):
    bronze, source = new_path(spark, "bronze"), delivery(spark)
    done = editions.land_delivery(spark, str(source), bronze, 2025)
    assert landed(bronze) == BYTES
    assert {r["name"][9:]: (r["length"], r["sha256"]) for r in done} == {
        n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in BYTES.items()}
    folder = editions.edition_path(bronze, 2025)
    assert store.manifest(folder) == done and store.damaged(spark, folder).count() == 0


def test_empty_files_are_passed_over(spark):
    bronze, source = new_path(spark, "bronze"), delivery(spark, {"vazio.csv": b"", "f.csv": b"x\n"})
    editions.land_delivery(spark, str(source), bronze, 2025)
    assert landed(bronze) == {"f.csv": b"x\n"}


def test_files_of_one_name_from_two_folders(spark):
    bronze, source = new_path(spark, "bronze"), delivery(spark, {"a/f.csv": b"x\n1\n", "b/f.csv": b"x\n2\n"})
    editions.land_delivery(spark, str(source), bronze, 2025)
    assert sorted(r["x"] for r in editions.read_edition(spark, bronze, 2025).collect()) == ["1", "2"]


def test_a_landed_edition_is_left_alone(spark):
    bronze = new_path(spark, "bronze")
    editions.land_delivery(spark, str(delivery(spark, {"f.csv": b"x\n1\n"})), bronze, 2025)
    assert editions.land_delivery(spark, str(delivery(spark, {"g.csv": b"x\n2\n"})), bronze, 2025) is None
    assert landed(bronze) == {"f.csv": b"x\n1\n"}


def test_a_broken_landing_is_done_again(spark):
    """Files without a manifest that are those of the delivery, and hidden files, are the beginning of a landing."""
    bronze, source = new_path(spark, "bronze"), delivery(spark)
    folder = Path(editions.edition_path(bronze, 2025))
    editions.land_delivery(spark, str(source), bronze, 2025)
    (folder / store.MANIFEST).unlink()
    next(folder.glob("*latim.csv")).unlink()
    next(folder.glob("*crlf.csv")).write_bytes(b"half")
    (folder / "_x.csv.0123").write_bytes(b"half")
    assert len(editions.land_delivery(spark, str(source), bronze, 2025)) == len(BYTES)
    assert {n: b for n, b in landed(bronze).items() if not n.startswith("_")} == BYTES
    assert editions.read_edition(spark, bronze, 2025) is not None


def test_damage_is_found(spark):
    bronze, source = new_path(spark, "bronze"), delivery(spark)
    editions.land_delivery(spark, str(source), bronze, 2025)
    folder = Path(editions.edition_path(bronze, 2025))
    next(folder.glob("*zero.csv")).write_bytes(b"x\n\x00\xff\xff\n")
    next(folder.glob("*latim.csv")).unlink()
    assert sorted((r["name"][9:], r["found"] is None) for r in store.damaged(spark, str(folder)).collect()) == [
        ("latim.csv", True), ("zero.csv", False)]


def test_a_file_that_changes_while_it_is_copied_is_an_error(spark):
    source = delivery(spark, {"f.csv": b"x\n1\n"})
    files = store.listed(spark, str(source)).selectExpr("source", "length + 1 AS length")
    with pytest.raises(Exception, match="bytes were listed"):
        store.copy_files(files, new_path(spark, "bronze"))


def test_more_than_two_gigabytes(spark):
    """A file that fits no string: it streams through a buffer (sparse, so that the test writes it once)."""
    source = Path(new_path(spark, "entrega"))
    source.mkdir(parents=True)
    size = (1 << 31) + 5
    with open(source / "grande.csv", "wb") as file:
        file.write(b"x\n1\n")
        file.truncate(size)
    folder = new_path(spark, "bronze")
    done = store.land_files(spark, str(source), folder)
    assert [r["length"] for r in done] == [size]
    path = Path(folder, done[0]["name"])
    assert path.stat().st_size == size
    os.truncate(path, 0)
    os.truncate(source / "grande.csv", 0)


def test_stream_lands_bytes_once(spark):
    inbox, bronze, memory = delivery(spark), new_path(spark, "bronze"), new_path(spark, "memory")
    for more in (None, None, {"novo.csv": b"x\n9\xe7\n"}):
        for name, data in (more or {}).items():
            (inbox / name).write_bytes(data)
        land_new_files(spark, str(inbox), bronze, 2025, memory)
        assert landed(bronze) == {**BYTES, **(more or {})}


def test_small_files_are_put_in_place_whole(spark):
    path = store.joined(new_path(spark, "small"), "a", "CURRENT")
    assert store.read_text(path) is None
    for text in ("um", "dois ç"):
        store.write_text(path, json.dumps(text))
        assert json.loads(store.read_text(path)) == text
    assert store.names_in(os.path.dirname(path)) == {"CURRENT"}
