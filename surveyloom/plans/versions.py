"""Releases: each run writes folders of its own and becomes current as a whole, by one rename."""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from surveyloom.sources import store

#: Good rows and rows in quarantine of the core layer, where a run sets such rows aside.
CHECKED = "silver/core_verificada"
_FOLDER, _POINTER, _MANIFEST = "releases", "CURRENT", "manifest.json"


class Release(NamedTuple):
    """A published run: where each table lies (below the base folder), and its rows where they were counted."""

    version: str
    tables: dict[str, str]
    rows: dict[str, int]


def new_version() -> str:
    """A name that sorts by time."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_folder(base: str, version: str) -> str:
    return store.joined(base, _FOLDER, version)


def read_release(base: str, version: str) -> Release | None:
    """A version's manifest; None if that run did not come to its end."""
    text = store.read_text(store.joined(version_folder(base, version), _MANIFEST))
    return None if text is None else Release(**json.loads(text))


def current(base: str) -> Release | None:
    """The release that readers should see, None before the first one."""
    name = store.read_text(store.joined(base, _FOLDER, _POINTER))
    return None if name is None else read_release(base, name.strip())


def publish(
    base: str, version: str, tables: Mapping[str, str], rows: Mapping[str, int], dropped: Collection[str] = (),
) -> Release:
    """Make a version current: `tables` are its own folders by name, relative to its folder.

    Tables that it did not write are those of the release before, but for the `dropped` ones. The manifest is written first, then the pointer is
    replaced by one rename: a reader sees the earlier release or this one, never a part of either.
    """
    before = current(base)
    kept = before or Release("", {}, {})
    earlier = {name: path for name, path in kept.tables.items() if name not in dropped}
    found = {**earlier, **{name: f"{_FOLDER}/{version}/{path}" for name, path in tables.items()}}
    counted = {name: n for name, n in {**kept.rows, **rows}.items()
               if name in found and (name in rows or name not in tables)}
    release = Release(version, found, counted)
    store.write_text(store.joined(version_folder(base, version), _MANIFEST),
                     json.dumps(release._asdict(), ensure_ascii=False, indent=1))
    store.write_text(store.joined(base, _FOLDER, _POINTER), version)
    return release


def table_path(base: str, name: str) -> str:
    """Where a table of the current release lies."""
    release = current(base)
    if release is None or name not in release.tables:
        raise KeyError(f"{name} is in no current release of {base}")
    return store.joined(base, release.tables[name])


def read_released(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name))


def collect_old(base: str, keep: int = 2) -> list[str]:
    """Delete the folders of versions that no kept release reads; their names.

    Kept are the current release and the `keep` - 1 published before it, with all folders their manifests name.
    Folders newer than the current release may belong to a run that is still writing, and stay.
    """
    now = current(base)
    if now is None:
        return []
    versions = sorted(v for v in store.names_in(store.joined(base, _FOLDER)) if v != _POINTER and v <= now.version)
    published = [r for v in versions if (r := read_release(base, v)) is not None]
    read = {path.split("/")[1] for r in published[-keep:] for path in r.tables.values()} | {
        r.version for r in published[-keep:]}
    gone = [v for v in versions if v not in read and not v.startswith("_")]
    for version in gone:
        store.delete_folder(version_folder(base, version))
    return gone
