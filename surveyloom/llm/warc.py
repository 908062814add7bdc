"""WARC archives: written by Spark's text writer, read by a Python data source that skips what is not asked for."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from surveyloom.llm.frames import stored

RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of a file, by size class, and what headers take at most beside the URL.
CLASSES = (16_384, 1024, 64, 4, 1)
HEADER_BYTES = 1024
SCHEMA = ("warc_type string, record_id string, target_uri string, page_id long, refers_to long, "
          "payload_length long, payload_digest string, payload binary")
ARROW = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                   ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_length", pa.int64()),
                   ("payload_digest", pa.string()), ("payload", pa.binary())])


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))


def write_archives(pages: DataFrame, path: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z",
                   records_per_file: int = 20_000, file_bytes: int = 256 << 20) -> None:
    """Write one record per page; of equal payloads of `least` bytes or more all but one become revisits.

    Records of like size share files, in a folder for each size class, so that a file stays below `file_bytes` or holds one
    record, whatever the pages: the class of the smallest records has 16,384 to a file, each further one a sixteenth of that.

    The payload is the html in UTF-8 (null: empty). The response is the page with the largest page_id (rows that
    share that id are all responses; a null id counts as smallest). Only keys and counts are aggregated, and the kept
    ids are written first: with their size known, Spark sends them to the pages where they fit its broadcast limit and
    else joins by digest, where adaptive execution splits a payload with a third of all pages. Spark's text writer ends each record with
    CRLF CRLF, which is the WARC record end, so archives are committed like any other output and survive lost tasks.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha1(html).alias("digest"), F.unhex(F.sha1(html)).alias("key"),
                        F.octet_length(html).cast("long").alias("n"))
    # a page's record without its headers of fixed names; URLs are part of what is unbounded
    size = F.col("n") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES
    rows = rows.withColumn("class", sum((size > file_bytes // records).cast("int") for records in CLASSES[:-1]))
    classes = sorted(r["class"] for r in rows.groupBy("class").count().collect()) or [0]  # one row per class
    kept = stored(rows.where(F.col("n") >= least).groupBy("key").agg(
        F.max("page_id").alias("keep"), F.count("*").alias("copies")).where("copies > 1").select("key", "keep"),
        "kept-payloads")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("keep"), F.col("keep").isNotNull()), F.col("keep"))
    rows = rows.join(kept, "key", "left").withColumn("refers", refers)
    revisit = F.col("refers").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(f">\r\nWARC-Date: {date}"),
        _line("WARC-Target-URI", uri),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers").cast("string"), F.lit(">"))),
        _line("X-Refers-To-Page", F.col("refers").cast("string")),
        F.when(revisit, f"\r\nWARC-Profile: {REVISIT_PROFILE}").otherwise(""),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Length", F.col("n").cast("string")),
        F.lit("\r\nContent-Type: application/http; msgtype=response"),
        _line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string")),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    for k in classes:
        (rows.where(F.col("class") == k).select(F.concat(head, block).alias("value")).write.option("lineSep", RECORD_END)
         .option("maxRecordsPerFile", min(records_per_file, CLASSES[k])).text(f"{path}/size-{k}"))


COMPARE = {
    EqualTo: lambda x, v: x == v, EqualNullSafe: lambda x, v: x == v, GreaterThan: lambda x, v: x > v,
    GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x in v, StringStartsWith: lambda x, v: x.startswith(v),
    StringEndsWith: lambda x, v: x.endswith(v), StringContains: lambda x, v: v in x,
}


def known(condition: Filter) -> bool:
    """Whether the reader decides this condition from a record's headers."""
    inner = condition.child if isinstance(condition, Not) else condition
    return (type(inner) in COMPARE or isinstance(inner, IsNull | IsNotNull)) and len(
        inner.attribute) == 1 and inner.attribute[0] != "payload" and not (
            isinstance(condition, Not) and isinstance(inner, Not))


def holds(condition: Filter, row: dict) -> bool:
    """SQL truth of a known condition: comparisons with null are not true, nor are their negations."""
    inner, wanted = (condition.child, False) if isinstance(condition, Not) else (condition, True)
    x = row[inner.attribute[0]]
    if isinstance(inner, IsNull | IsNotNull):
        return ((x is None) == isinstance(inner, IsNull)) == wanted
    if isinstance(inner, EqualNullSafe):
        return (x == inner.value) == wanted
    if x is None or inner.value is None:
        return False
    return COMPARE[type(inner)](x, inner.value) == wanted


def records(file: io.BufferedReader, name: str, conditions: Iterable[Filter], payload: bool) -> Iterator[dict]:
    """Records whose headers meet all conditions. Headers are parsed first; other content is passed over by a seek."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record before byte {file.tell()}")
        fields = {}
        while (line := file.readline()).strip():
            key, _, value = line.decode().partition(":")
            fields[key.lower()] = value.strip()
        left = int(fields["content-length"])

        def number(key: str) -> int | None:
            return int(fields[key]) if fields.get(key) else None

        digest = fields.get("warc-payload-digest")
        row = {
            "warc_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
            "target_uri": fields.get("warc-target-uri"), "page_id": number("x-page-id"),
            "refers_to": number("x-refers-to-page"), "payload_length": number("x-payload-length"),
            "payload_digest": digest.removeprefix("sha1:") if digest else None, "payload": None,
        }
        wanted = all(holds(c, row) for c in conditions)
        if wanted and payload and row["warc_type"] != "revisit":
            if fields.get("content-type", "").startswith("application/http"):
                while left > 0 and (line := file.readline(left)):
                    left -= len(line)
                    if not line.strip():
                        break
            row["payload"] = file.read(left)
            if len(row["payload"]) != left:
                raise ValueError(f"{name}: the last record is cut off")
        else:
            file.seek(left, io.SEEK_CUR)
        if wanted:
            yield row


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.target = int(options.get("partitionbytes", 64 << 20))
        self.batch = int(options.get("batchbytes", 8 << 20))
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            if known(condition):
                self.conditions.append(condition)
            else:
                yield condition

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def partitions(self) -> list[Files]:
        """Whole files, in order, packed up to the target size: record borders are known from a file's start only."""
        store, root = self._open()
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found
                       if f.type == fs.FileType.File and f.size and f.base_name[0] not in "._")
        plan, size = [], self.target
        for path, n in files:
            if size + n > self.target:
                plan.append(Files([]))
                size = 0
            plan[-1].paths.append(path)
            size += n
        return plan or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = self._open()
        rows, size = [], 0
        for path in partition.paths:
            with io.BufferedReader(store.open_input_file(path), 1 << 20) as file:
                for row in records(file, path, self.conditions, self.payload):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size >= self.batch:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class WarcSource(DataSource):
    """Records of all WARC files below `path`. Options: payload (false: headers only), partitionBytes, batchBytes.

    Conditions on header columns (record type, ids, URI, digest) are decided before a payload is touched. Revisits
    have no payload. Hidden files are passed over; an empty folder has no records; a damaged record is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below `path`, as `WarcSource` describes; turns on Python filter pushdown in the session.

    Spark reads that setting when a plan runs, and without it refuses a source that takes conditions.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record.

    Responses are measured on the payload that was read; revisits are read as headers alone.
    """
    responses = read_archives(spark, path).where("warc_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), F.col("warc_type").alias("record_type"), "refers_to")
    revisits = read_archives(spark, path, payload=False).where("warc_type = 'revisit'").select(
        "page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest",
        F.col("warc_type").alias("record_type"), "refers_to")
    return responses.union(revisits)
