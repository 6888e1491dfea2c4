"""Catalog versions as Parquet folders.

A version is a folder `version=N`; it counts once Spark's commit has put its _SUCCESS file there, so readers
never see half a version. Which one is read, and up to which change it holds the feed, stands in one pointer file, so both move
together. Pointer N + 1 is created only if absent by a writer that has begun from N: of two writers who began from the same
state the second fails. A store without pointers has its newest complete version as the current one.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Rebuild = Callable[[DataFrame], DataFrame]
Replay = Callable[[DataFrame, DataFrame], DataFrame]


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, fs = hadoop_path(spark, path)
    return fs.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    location, fs = hadoop_path(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(location)) if fs.exists(location) else []


def read_text(spark: SparkSession, path: str) -> str:
    location, fs = hadoop_path(spark, path)
    stream = fs.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a name of its own first, so that it is never seen half. Raises OSError where the store refuses its name.

    Needs a store that does not rename onto an existing file, as HDFS, or a local disk that has links; on one without, writers
    that start at the same moment can both succeed.
    """
    location, fs = hadoop_path(spark, path)
    half = location.suffix(f".new-{uuid.uuid4().hex}")
    stream = fs.create(half, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    here, there = (str(p).removeprefix("file:") for p in (half, location))
    if os.path.exists(here):
        # A local disk: a rename looks for the name and then replaces what another writer has put there since, a link is refused.
        try:
            os.link(here, there)
        except FileExistsError:
            fs.delete(half, False)
            raise
        except OSError:
            pass
        else:
            fs.delete(half, False)
            return
    if not fs.rename(half, location):
        raise OSError(f"could not rename {half} to {location}")


def delete(spark: SparkSession, path: str) -> None:
    location, fs = hadoop_path(spark, path)
    fs.delete(location, True)


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """The N of every child folder `label=N`."""
    found = (re.fullmatch(rf"{label}=(\d+)", name) for name in children(spark, path))
    return sorted(int(match.group(1)) for match in found if match)


def snapshot_name(at: dt.datetime) -> str:
    # Fixed value: how snapshots are named.
    return at.strftime("snapshot_%Y-%m-%d_%H-%M-%S")


class Conflict(RuntimeError):
    """Another writer has moved the pointer since this one began."""


class CatalogVersions:
    """Full catalog versions below one folder; versions are only ever added or retired.

    With a schema, reading a version looks into no file for it.
    """

    def __init__(self, spark: SparkSession, base: str, schema: StructType | None = None):
        self.spark, self.base, self.schema = spark, base, schema

    def path(self, version: int) -> str:
        return f"{self.base}/version={version}"

    def versions(self) -> list[int]:
        complete = lambda v: exists(self.spark, f"{self.path(v)}/_SUCCESS")
        return [v for v in numbered(self.spark, self.base, "version") if complete(v)]

    def _last(self, folder: str) -> int:
        return max((int(n) for n in children(self.spark, f"{self.base}/{folder}") if n.isdigit()), default=0)

    def pointer(self) -> dict:
        """The number of the newest pointer, the version that is read (None: none yet), and the number of the last change in it."""
        number = self._last("pointers")
        if number:
            return {"number": number} | json.loads(read_text(self.spark, f"{self.base}/pointers/{number}"))
        return {"number": 0, "version": max(self.versions(), default=None), "changes": 0}

    def _move(self, old: dict, version: int, changes: int) -> int:
        """Make a version the current one, if the pointer has not moved since `old`; else remove the version and raise Conflict."""
        try:
            now = json.dumps({"version": version, "changes": changes})
            write_text(self.spark, f"{self.base}/pointers/{old['number'] + 1}", now)
        except OSError as refused:
            delete(self.spark, self.path(version))
            raise Conflict(f"{self.base} has moved on from pointer {old['number']}") from refused
        return version

    def current(self) -> int:
        version = self.pointer()["version"]
        if version is None:
            raise ValueError(f"no complete catalog version in {self.base}")
        return version

    def _store(self, documents: DataFrame, version: int | None = None) -> int:
        """Write a version that nobody reads yet, under a number that no other writer has."""
        last = max(numbered(self.spark, self.base, "version"), default=0)
        if version is not None and version <= last:
            raise ValueError(f"version {last} is newer than {version}")
        number = version or max(last, self._last("claims")) + 1
        while True:
            try:
                write_text(self.spark, f"{self.base}/claims/{number}", "")
                break
            except OSError:
                if version is not None:
                    raise Conflict(f"another writer has taken version {version}") from None
                number += 1
        documents.write.parquet(self.path(number))
        return number

    def write(self, documents: DataFrame, version: int | None = None, began: dict | None = None) -> int:
        """Store the documents as the next version, or one with a higher number, make it current, and return its number.

        Documents derived from the store should come with the `pointer()` they began from: Conflict is raised, and nothing
        changed, if another writer has moved it since.
        """
        began = began or self.pointer()
        return self._move(began, self._store(documents, version), began["changes"])

    def add_changes(self, changes: DataFrame) -> int:
        """Store a batch of changes and return its number. Numbers are given when a batch is complete, without gaps."""
        folder = f"changes/{uuid.uuid4().hex}"
        changes.write.parquet(f"{self.base}/{folder}")
        number = self._last("arrived") + 1
        while True:
            try:
                write_text(self.spark, f"{self.base}/arrived/{number}", folder)
                return number
            except OSError:
                number += 1

    def changes(self, after: int, last: int | None = None) -> DataFrame | None:
        """The changes with numbers above `after`, up to `last` or all; None if there are none."""
        numbers = range(after + 1, (self._last("arrived") if last is None else last) + 1)
        paths = [f"{self.base}/{read_text(self.spark, f'{self.base}/arrived/{n}')}" for n in numbers]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, version: int | None = None) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(self.path(self.current() if version is None else version))

    def snapshot(self, documents: DataFrame, at: dt.datetime) -> str:
        """Store the documents beside the versions, under a name with their time; returns the name."""
        name = snapshot_name(at)
        documents.write.parquet(f"{self.base}/{name}")
        return name

    def read_snapshot(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(f"{self.base}/{name}")

    def reindex(self, rebuild: Rebuild, replay: Replay | None = None) -> int:
        """Write the current version, passed through `rebuild`, as the next one; the old one stays.

        `replay` folds changes into rebuilt documents: those that the old version lacks, and then those that have arrived
        while the new one was written. Only then the pointer moves, and says which changes are in; any later ones wait for the
        next reindex. Without `replay` all changes go on waiting.
        """
        began = self.pointer()
        documents, done, version = rebuild(self.read()), began["changes"], None
        for _ in range(2):
            last = self._last("arrived") if replay else done
            if version is not None and last == done:
                break
            if last > done:
                documents = replay(documents, self.changes(done, last))
            behind, version, done = version, self._store(documents), last
            if behind is not None:
                delete(self.spark, self.path(behind))
            documents = self.spark.read.schema(documents.schema).parquet(self.path(version))
        return self._move(began, version, done)

    def restore(self, version: int) -> int:
        """Make an older version current again by writing it as a new one."""
        if version not in self.versions():
            raise ValueError(f"no complete catalog version {version}")
        began = self.pointer()
        return self.write(self.read(version), began=began)

    def retire(self, keep: int = 7) -> list[int]:
        """Remove all but the newest complete versions and the current one; returns the removed ones."""
        current = self.pointer()["version"]
        old = [v for v in self.versions()[:-keep] if v != current]
        for version in old:
            delete(self.spark, self.path(version))
        return old
