import hashlib

import pytest

from surveyloom.llm import warc
from surveyloom.llm.frames import new_path

BODY = "é" * 500 + "x"  # 1001 bytes
PAGES = (
    [(i, f"http://a/{i}", BODY) for i in (4, 9, 2, 9)]
    + [(20 + i, "u", "short") for i in range(3)]
    + [(30, None, None), (31, "http://b/\r\nEvil: 1", ""), (None, "n", "q" * 2000), (None, "n", "z" * 1500), (40, "n", "z" * 1500),
       (50, "w", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n" * 40), (51, "big", "k" * 3_000_000), (52, "u", "a\0b\r\n")])


@pytest.fixture(scope="module")
def archive(spark):
    path = new_path(spark, "warc-test")
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS n")
    warc.write_archives(df, path, records_per_file=4)
    return path


def expected():
    best = {}
    for i, _, html in PAGES:
        if html and len(html.encode()) >= 1000 and i is not None:
            best[html] = max(best.get(html, i), i)
    out = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        keep = best.get(html or "")
        revisit = keep is not None and (i is None or i < keep)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    keep if revisit else None))
    return sorted(out, key=str)


def test_pages_come_back(spark, archive):
    assert sorted(map(tuple, warc.archived_pages(spark, archive).collect()), key=str) == expected()


def test_payloads_come_back(spark, archive):
    got = warc.read_archives(spark, archive).where("page_id IN (51, 50, 52)").collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got} == {i: h for i, _, h in PAGES if i in (50, 51, 52)}


def test_conditions_reach_the_reader(spark, archive):
    df = warc.read_archives(spark, archive, payload=False)
    got = df.where("warc_type = 'revisit' AND page_id > 2 AND target_uri LIKE 'http%'").collect()
    assert [(r["page_id"], r["payload"]) for r in got] == [(4, None)]
    assert df.where("NOT page_id IN (1, 2) AND refers_to IS NULL").count() == 11
    assert df.where("length(target_uri) = 1 AND page_id = 20").count() == 1  # what it does not know, Spark decides


@pytest.mark.parametrize("condition", ["EqualTo", "IsNull", "Not"])
def test_unwanted_payloads_are_passed_over(condition):
    import io

    from pyspark.sql import datasource as ds

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counting.taken += len(out)
            return out

    record = b"WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 1\r\nContent-Length: 9000\r\n\r\n" + b"p" * 9000 + b"\r\n\r\n"
    test = {"EqualTo": ds.EqualTo(("page_id",), 2), "IsNull": ds.IsNull(("page_id",)),
            "Not": ds.Not(ds.EqualTo(("warc_type",), "response"))}[condition]
    assert warc.known(test)
    assert list(warc.records(Counting(record * 3), "f", [test], True)) == [] and Counting.taken == 0


def test_damage_is_an_error(tmp_path):
    import io

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\n12345"
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(io.BufferedReader(io.BytesIO(record)), "f", [], True))
    with pytest.raises(ValueError, match="no record"):
        list(warc.records(io.BufferedReader(io.BytesIO(b"junk\r\n")), "f", [], True))


def test_no_pages(spark):
    path = new_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.archived_pages(spark, path).count() == 0


def test_files_are_bounded_by_bytes(spark):
    import pathlib
    import urllib.parse

    path = new_path(spark, "warc-bytes")
    sizes = [10, 900, 5_000, 40_000, 70_000, 300_000] * 40 + [3_000_000, 9_000_000] * 3
    df = spark.createDataFrame([(i, "u" * (i % 50), chr(97 + i % 26) * n) for i, n in enumerate(sizes)],
                               "page_id long, url string, html string").coalesce(1)
    limit = 4 << 20
    warc.write_archives(df, path, least=1 << 40, file_bytes=limit)
    root = pathlib.Path(urllib.parse.urlparse(path).path)
    files = [f for f in root.rglob("part-*") if f.stat().st_size]
    for file in files:
        assert file.stat().st_size <= limit or file.read_bytes().count(b"WARC/1.1") == 1
    assert len(files) < 100
    got = {r["page_id"]: r["payload_bytes"] for r in warc.archived_pages(spark, path).collect()}
    assert got == dict(enumerate(sizes))


def test_no_pages(spark):
    path = new_path(spark, "warc-none")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.archived_pages(spark, path).count() == 0
