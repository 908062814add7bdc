"""Raw edition files: landing, scanning, counting."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.sources import store
from surveyloom.sources.records import block_table, file_names, lines_of, placed_blocks, read_records


def edition_path(bronze: str, edition: int) -> str:
    return f"{bronze.rstrip('/')}/ano={edition}"


#: Files that cannot be split.
_PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


def read_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Header-named, all-string scan of all files below `path`.

    A file whose header differs from the first one's is an error, not a shift of its columns. `multiline` is for
    answers with line breaks: files are split all the same, and each task reads whole records (see
    `sources.records`); only compressed files are read by one task each.
    """
    options = {"header": True, "inferSchema": False, "enforceSchema": False, "escape": '"', "recursiveFileLookup": True}
    plain = spark.read.csv(path, multiLine=multiline, **options)
    if not multiline or file_names(spark, path).where(
            F.lower(F.col("arquivo")).rlike("(" + "|".join(map(re.escape, _PACKED)) + ")$")).limit(1).count():
        return plain
    return read_records(spark, path, plain.columns)


def read_edition(spark: SparkSession, bronze: str, edition: int, multiline: bool = False) -> DataFrame:
    return read_raw(spark, edition_path(bronze, edition), multiline)


def landed_editions(spark: SparkSession, bronze: str) -> set[int]:
    """The editions that have files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(bronze)
    found = files.select(F.regexp_extract("path", r"/ano=(\d+)/", 1).alias("e")).where("e <> ''").distinct()
    return {int(row["e"]) for row in found.collect()}


# How raw answers are written: a header in every part, so that parts stay readable on their own, and
# blanks and line breaks at the ends of an answer kept.
RAW_WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_raw(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).options(**RAW_WRITE).csv(path)


def is_landed(path: str) -> bool:
    """Whether a folder holds files. What an interrupted write leaves (`_temporary`, hidden files) does not count.

    Parts of a Spark write without its `_SUCCESS` may be the beginning of a broken commit or somebody's delivery; to
    take them for whole would lose rows, to write over them might, so they are an error.
    """
    names = store.names_in(path)
    files = {name for name in names if not name.startswith(("_", "."))}
    if files and not names & {"_SUCCESS", store.MANIFEST} and all(name.startswith("part-") for name in files):
        raise RuntimeError(f"{path} holds parts of a write that was not completed: remove them, or add _SUCCESS")
    return bool(files)


def land_edition(df: DataFrame, bronze: str, edition: int) -> None:
    """Put the rows of an edition under `ano=YYYY`; one that is already there is left alone."""
    path = edition_path(bronze, edition)
    if not is_landed(path):
        write_raw(df, path, mode="overwrite")


def land_delivery(spark: SparkSession, source: str, bronze: str, edition: int) -> list[dict] | None:
    """Put the delivered files below `source` under `ano=YYYY` byte by byte; an edition already there is left alone.

    Returns what was landed (name, source, length, sha256 of each file), None if the edition was there. A landing that
    was broken off left no manifest, and is done again; files of other names that somebody put there are a delivery.
    """
    path = edition_path(bronze, edition)
    given = {store.landed_name(r["source"]) for r in store.listed(spark, source).select("source").collect()}
    there = {name for name in store.names_in(path) if not name.startswith(("_", "."))}
    if store.MANIFEST not in store.names_in(path) and there and there <= given:
        return store.land_files(spark, source, path)
    return None if is_landed(path) else store.land_files(spark, source, path)


def count_records(spark: SparkSession, path: str) -> DataFrame:
    """arquivo and registros: records per CSV file, counted by quotes instead of by Spark's CSV reader.

    Files are split as plain text. A line ends a record when the quotes seen so far are even, which needs the parity at
    the start of its block: each block is counted for both, and a running parity over the blocks of a file picks
    the right one. Two numbers and a byte of each line reach Python, and a quoted line break never forces a whole file
    into one task. The header is not a record.
    """
    counted = placed_blocks(block_table(lines_of(spark, path))).groupBy("file").agg(
        (F.sum("records") - 1).alias("registros"))
    return counted.join(file_names(spark, path), "file").select("arquivo", "registros")
