"""Files as bytes: copied by tasks in bounded buffers, checked by digest, put in place by a rename."""

from __future__ import annotations

import hashlib
import json
import posixpath
import sys
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# what tasks run travels with the plan, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that a copy holds at a time.
BUFFER = 8 << 20
MOST_TASKS = 50_000
#: Names that readers pass over: what is not there yet, and what was landed.
HIDDEN = "_"
MANIFEST = "_manifest.json"


class LandingError(RuntimeError):
    """A copy that is not what was delivered."""


def resolved(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it. Names are as Spark lists them, not escaped; without scheme: local."""
    scheme, colon, rest = path.partition(":")
    if scheme == "file" and colon:
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(quote(path, safe="/:@?=&%"))


def joined(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def names_in(folder: str) -> set[str]:
    """Names of what lies directly in a folder; a missing folder holds nothing."""
    store, path = resolved(folder)
    return {info.base_name for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True))}


def read_text(path: str) -> str | None:
    """A small file's text, None if there is none."""
    store, name = resolved(path)
    if store.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(name) as file:
        return file.read().decode("utf-8")


def write_text(path: str, text: str) -> None:
    """Put a small file in place as a whole: it is written under a hidden name and then renamed."""
    store, name = resolved(path)
    folder, base = posixpath.split(name)
    store.create_dir(folder, recursive=True)
    hidden = posixpath.join(folder, f"{HIDDEN}{base.lstrip(HIDDEN)}.{uuid.uuid4().hex}")
    with store.open_output_stream(hidden) as file:
        file.write(text.encode("utf-8"))
    store.move(hidden, name)


def delete_folder(path: str) -> None:
    store, name = resolved(path)
    if store.get_file_info(name).type == fs.FileType.Directory:
        store.delete_dir(name)


def copied(source: str, target: str) -> tuple[int, str]:
    """Copy one file byte by byte; its length and SHA-256. An earlier file of that name is replaced by the rename.

    What is digested is what was read; the landed file is then read once more, and must give the same.
    """
    def digest(store: fs.FileSystem, name: str, out=None) -> tuple[int, str]:
        size, sha = 0, hashlib.sha256()
        with store.open_input_stream(name) as file:
            while chunk := file.read(BUFFER):
                size += len(chunk)
                sha.update(chunk)
                if out is not None:
                    out.write(chunk)
        return size, sha.hexdigest()

    (origin, given), (store, name) = resolved(source), resolved(target)
    folder, base = posixpath.split(name)
    store.create_dir(folder, recursive=True)
    hidden = posixpath.join(folder, f"{HIDDEN}{base}.{uuid.uuid4().hex}")
    with store.open_output_stream(hidden) as out:
        sent = digest(origin, given, out)
    if (arrived := digest(store, hidden)) != sent:
        store.delete_file(hidden)
        raise LandingError(f"{target}: {arrived} arrived of {sent}")
    store.move(hidden, name)
    return sent


def listed(spark: SparkSession, path: str) -> DataFrame:
    """source and length of all files below `path` that hold a byte; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("source"), "length")


def landed_name(source: str) -> str:
    """A file's name where it lands: its own, with a mark of the folder it came from, so that no two are alike."""
    folder, base = posixpath.split(source)
    return f"{hashlib.sha1(folder.encode()).hexdigest()[:8]}-{base}"


def copy_files(files: DataFrame, folder: str) -> list[dict]:
    """Copy `files` (source, length) into a folder, by as many tasks as there are files; what was landed, by name.

    A task streams its file through a buffer, so files of any size are copied in bounded memory, and a repeated task
    replaces its own file with the same bytes. A file that is shorter or longer than it was listed is an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = landed_name(source)
                size, sha = copied(source, joined(folder, name))
                if size != length:
                    raise LandingError(f"{source}: {length} bytes were listed, {size} read")
                yield pa.RecordBatch.from_pylist([{"name": name, "source": source, "length": size, "sha256": sha}])

    count = files.count()
    if not count:
        return []
    dealt = files.select("source", "length").repartition(min(count, MOST_TASKS), "source")
    done = dealt.mapInArrow(run, "name string, source string, length long, sha256 string")
    return sorted((r.asDict() for r in done.collect()), key=lambda r: r["name"])  # one row per file


def land_files(spark: SparkSession, source: str, folder: str) -> list[dict]:
    """Put all files below `source` into `folder` as they are, and a manifest of their lengths and digests beside them.

    The manifest comes last and as a whole: a folder that has one is complete. Returns what it lists.
    """
    done = copy_files(listed(spark, source), folder)
    write_text(joined(folder, MANIFEST), json.dumps(done, ensure_ascii=False, indent=1))
    return done


def manifest(folder: str) -> list[dict] | None:
    """What was landed in a folder, None if no landing there was completed."""
    text = read_text(joined(folder, MANIFEST))
    return None if text is None else json.loads(text)


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    """name, expected and found (length:digest) of landed files that are no longer what the manifest lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length, sha in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = resolved(joined(folder, name))
                found = None
                if store.get_file_info(path).type != fs.FileType.NotFound:
                    size, now = 0, hashlib.sha256()
                    with store.open_input_stream(path) as file:
                        while chunk := file.read(BUFFER):
                            size += len(chunk)
                            now.update(chunk)
                    found = f"{size}:{now.hexdigest()}"
                if found != f"{length}:{sha}":
                    yield pa.RecordBatch.from_pylist([{"name": name, "expected": f"{length}:{sha}", "found": found}], schema)

    schema = pa.schema([("name", pa.string()), ("expected", pa.string()), ("found", pa.string())])
    rows = [(r["name"], r["length"], r["sha256"]) for r in manifest(folder) or []]
    listing = spark.createDataFrame(rows, "name string, length long, sha256 string")
    return listing.repartition(max(1, min(len(rows), MOST_TASKS)), "name").mapInArrow(
        run, "name string, expected string, found string")
