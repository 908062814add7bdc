"""CSV records that go over several lines, read by many tasks: quote parity by block, then whole records."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.functions.scalars import quoted

# what tasks run travels with the plan, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: How raw answers are read: a quote inside a quoted answer is doubled, blanks are kept, an empty field is NULL.
OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files below `path`: file (a hash of its name), start (of the block), mark, value.

    Files are split as text, whatever stands between quotes. A line ends at a line feed, which `value` keeps. Its mark
    is 1 if it has an odd number of quotes, and 2 more if a carriage return comes before the line feed.
    """
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        (quotes % 2 + F.when(F.endswith("value", F.lit("\r")), 2).otherwise(0)).cast("byte").alias("mark"), F.concat("value", F.lit("\n")).alias("value"))


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """file (hash) and arquivo (name) of all files below `path`; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("arquivo"))


def _runs(file: np.ndarray, start: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of rows that belong to one block; a task reads its blocks one after another."""
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    ends = [0, *cuts.tolist(), len(file)]
    return [(a, b) for a, b in zip(ends, ends[1:]) if b > a]


def block_table(lines: DataFrame) -> DataFrame:
    """One row per block: file, start, lines, odd (all its quotes), after_even (lines after which the quotes so far are
    even, if the block begins outside of quotes), last_even (whether its last line is one of them), and crlf (whether
    its first line ends with carriage return and line feed).

    Two numbers and one byte of each line reach Python.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, crlf = None, [0, 0, 0], False  # lines, parity, lines after which it is even

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "file": [key[0]], "start": [key[1]], "lines": [state[0]], "odd": [state[1]], "after_even": [state[2]],
                "last_even": [state[1] == 0], "crlf": [crlf]})

        for batch in batches:
            file, start, mark = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for a, b in _runs(file, start):
                if key != (here := (int(file[a]), int(start[a]))):
                    if key is not None:
                        yield row()
                    key, state, crlf = here, [0, 0, 0], bool(mark[a] & 2)
                after = (np.cumsum((mark[a:b] & 1).astype(np.int64)) + state[1]) % 2
                state = [state[0] + b - a, int(after[-1]), state[2] + int((after == 0).sum())]
        if key is not None:
            yield row()

    return lines.select("file", "start", "mark").mapInArrow(
        run, "file long, start long, lines long, odd long, after_even long, last_even boolean, crlf boolean")


def placed_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with `inside` (0/1: the block begins within quotes), `records` (that end in it) and `owner`: the block in
    which the record began that goes on at its start.

    The parity at a block's start is a running sum over the earlier blocks of its file. A block begins a record unless
    it lies inside of one as a whole: outside of quotes its first line does, else the line after the first that
    closes them.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    ended = F.when(F.col("inside") == 0, F.col("after_even")).otherwise(F.col("lines") - F.col("after_even"))
    # a line starts a record if the one before ended one: all ends but one on the last line start the next here
    ends_last = F.col("last_even") == (F.col("inside") == 0)
    begins = (F.col("inside") == 0) | (ended - ends_last.cast("long") > 0)
    return (blocks.withColumn("inside", inside).withColumns({"records": ended, "_begins": begins})
            .withColumn("owner", F.last(F.when(F.col("_begins"), F.col("start")), ignorenulls=True).over(before))
            .drop("_begins"))


def records_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV record of all files below `path`: header (the first of its file) and record, its text.

    Records are cut where the quotes before a line feed are even, so the quotes of a file must balance, as they do
    where an answer that holds a quote is quoted; a file that ends inside quotes is an error. Lines end with a line
    feed or carriage return and line feed; where a file's first line ends with both, line breaks inside its answers
    become line feeds, as in Spark's reader. Blank lines outside of quotes are no records.

    The first scan finds each block's parity; what the second needs to know about blocks is one row for each that
    begins inside a quoted answer, so at most one for each split of the input. Records stay in the task that
    reads them; only those that a block border cuts travel, to be put together.
    """
    lines = lines_of(spark, path)
    blocks = placed_blocks(block_table(lines)).select("file", "start", "inside", "owner", "odd", "crlf").collect()
    left_open = {}
    for b in blocks:
        left_open[b["file"]] = left_open.get(b["file"], 0) ^ b["odd"]
    if broken := {f for f, odd in left_open.items() if odd}:
        names = [r["arquivo"] for r in file_names(spark, path).collect() if r["file"] in broken]
        raise ValueError(f"files that end inside quotes: {sorted(names)}")
    entered = {(b["file"], b["start"]): b["owner"] for b in blocks if b["inside"]}
    known = {(b["file"], b["start"]) for b in blocks}
    both = {b["file"] for b in blocks if b["crlf"] and b["start"] == 0}
    names = ["file", "owner", "piece", "header", "both", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, parity, owner, header = None, None, 0, None, False

        def rows(texts: pa.Array, whose: int | None, piece: int | None, first: bool) -> pa.RecordBatch:
            n = len(texts)
            flags = np.zeros(n, bool)
            flags[:1] = first
            return pa.RecordBatch.from_arrays([
                pa.array([key[0]] * n, pa.int64()), pa.array([whose] * n, pa.int64()), pa.array([piece] * n, pa.int64()),
                pa.array(flags), pa.array([key[0] in both] * n), texts], names=names)

        def close() -> Iterator[pa.RecordBatch]:
            if held is not None and len(held):  # the next block goes on with it, or it is all of a block inside a record
                yield rows(_joined(held), owner if owner is not None else key[1], key[1], header)

        for batch in batches:
            file, start, mark = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for a, b in _runs(file, start):
                if key != (here := (int(file[a]), int(start[a]))):
                    if key is not None:
                        yield from close()
                    if here not in known:
                        raise RuntimeError("the input is not split as it was when its blocks were read")
                    key, held = here, None
                    owner = entered.get(here)
                    parity, header = int(here in entered), here[1] == 0
                text = batch.column(3).slice(a, b - a)
                after = (np.cumsum((mark[a:b] & 1).astype(np.int64)) + parity) % 2
                parity = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if held is not None:
                    ends, text = ends + len(held), pa.concat_arrays([held, text])
                whole = ends[-1] if len(ends) else 0
                held = text.slice(whole)
                if not len(ends):
                    continue
                found = _cut(text, ends)
                if owner is not None:  # the first of them began in an earlier block
                    yield rows(found.slice(0, 1), owner, key[1], False)
                    owner, found = None, found.slice(1)
                if len(found):
                    yield rows(found, None, None, header)
                    header = False
        if key is not None:
            yield from close()

    pieces = lines.select("file", "start", "mark", "value").mapInArrow(
        run, "file long, owner long, piece long, header boolean, both boolean, record string")
    cut = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "record"))), lambda p: p["record"]), "")
    joined = pieces.where("owner is not null").groupBy("file", "owner").agg(
        F.max("header").alias("header"), F.max("both").alias("both"), cut.alias("record"))
    columns = ["header", "both", "record"]
    whole = pieces.where("owner is null").select(columns).unionByName(joined.select(columns))
    plain = F.rtrim("record", F.lit("\r\n"))
    text = F.when(F.col("both"), F.replace(plain, F.lit("\r\n"), F.lit("\n"))).otherwise(plain)
    return whole.select("header", text.alias("record")).where("record <> ''")


def _cut(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """Consecutive lines as one text up to each end: the same bytes under fewer offsets."""
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset: lines.offset + len(lines) + 1]
    chosen = np.concatenate([offsets[:1], offsets[ends]]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(chosen), lines.buffers()[2]])


def _joined(lines: pa.Array) -> pa.Array:
    return _cut(lines, np.array([len(lines)]))


def read_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of all files below `path` as text columns named `columns`, parsed by Spark's own CSV parser.

    Fields that a record lacks are NULL, surplus ones are dropped. A file whose header is not that of `columns` is an
    error (unnamed and repeated headers count as Spark names them: `_c3`, `name3`).
    """
    schema = ", ".join(f"{quoted(f'c{i}')} string" for i in range(len(columns)))
    parsed = records_of(spark, path).select("header", F.from_csv("record", schema, OPTIONS).alias("r"))

    def named(i: int, name: str) -> Column:
        given = F.col(f"r.c{i}")
        return F.coalesce((given == name) | (F.concat(given, F.lit(str(i))) == name), F.lit(name == f"_c{i}"))

    same = F.lit(True)
    for i, name in enumerate(columns):
        same = same & named(i, name)
    fine = F.when(~F.col("header"), True).when(same, False).otherwise(
        F.raise_error(F.lit("a file's header differs from the first one's")).cast("boolean"))
    return parsed.where(fine).select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(columns)])
