"""Loads of a table, published whole.

A load is a folder of files under the table. Which loads make up the table is said by
snapshots, numbered lists in its folder ``_snapshots``; the last one counts. A load is
written first and published by one rename of a list that names it, so a reader sees all
of a load or nothing of it, whatever becomes of the job that writes it. A load has
an id, and one that is published already is not written again. Earlier lists stay, and
so do the folders they name: an earlier state of the table can be read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

SNAPSHOTS = "_snapshots"
LOAD = "loaded"
_NAME = re.compile(r"^(\d{12})\.json$")


@dataclass(frozen=True)
class Load:
    """``folder`` is relative to the table; a load without rows has none."""

    id: str
    folder: str | None
    rows: int


@dataclass(frozen=True)
class Snapshot:
    version: int
    loads: tuple[Load, ...]

    def load(self, load_id: str) -> Load | None:
        return next((x for x in self.loads if x.id == load_id), None)


class _Files:
    """The file system of a table, as Spark reaches it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = root.getFileSystem(conf)
        self._root = self._fs.makeQualified(root)
        self._renamer = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._root.toUri(), conf
        )

    def at(self, *names: str):
        found = self._root
        for name in names:
            found = self._jvm.org.apache.hadoop.fs.Path(found, name)
        return found

    def names(self, folder: str) -> list[str]:
        at = self.at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def text(self, *names: str) -> str:
        stream = self._fs.open(self.at(*names))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        stream = self._fs.create(self.at(*names), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def renamed(self, folder: str, source: str, target: str) -> bool:
        """False if there is a file of the new name, which stays."""
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 0)
        try:
            self._renamer.rename(self.at(folder, source), self.at(folder, target), options)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise

    def delete(self, *names: str) -> None:
        self._fs.delete(self.at(*names), True)


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's snapshots, the last one last; none for a table without any."""
    found = (_NAME.match(name) for name in _Files(spark, path).names(SNAPSHOTS))
    return sorted(int(m.group(1)) for m in found if m)


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The last snapshot, or that of a number; None for a table without any."""
    there = snapshots(spark, path)
    if version is not None and version not in there:
        raise ValueError(f"no snapshot {version} of {path}")
    if not there:
        return None
    version = there[-1] if version is None else version
    listed = json.loads(_Files(spark, path).text(SNAPSHOTS, f"{version:012d}.json"))
    return Snapshot(version, tuple(Load(**x) for x in listed))


def publish(
    spark: SparkSession, path: str, change: Callable[[tuple[Load, ...]], tuple[Load, ...] | None]
) -> bool:
    """Make ``change`` of the last snapshot's loads the next one; False if it gives None.

    If another writer publishes in between, the change is worked out again from what that
    one published.
    """
    files = _Files(spark, path)
    while True:
        last = snapshot(spark, path)
        loads = change(last.loads if last else ())
        if loads is None:
            return False
        unnamed = f".{uuid.uuid4().hex}"
        files.write(json.dumps([asdict(x) for x in loads]), SNAPSHOTS, unnamed)
        target = f"{last.version + 1 if last else 1:012d}.json"
        if files.renamed(SNAPSHOTS, unnamed, target):
            return True
        files.delete(SNAPSHOTS, unnamed)


def load(
    spark: SparkSession,
    path: str,
    write: Callable[[str], int],
    load_id: str | None = None,
    replace: bool = False,
) -> int:
    """Rows of the load that ``write`` writes to the folder it is given, once published.

    A load of a published id is not written; its rows are told from the snapshot. With
    ``replace`` the next snapshot holds this load alone. No rows without an id leave nothing.
    """
    if load_id is not None:
        last = snapshot(spark, path)
        done = last.load(load_id) if last else None
        if done is not None:
            return done.rows
    name = load_id or datetime.now(UTC).strftime("%Y%m%dT%H%M%S.%f")
    folder = f"{LOAD}={quote(name, safe='')}-{uuid.uuid4().hex[:8]}"
    rows = write(f"{path}/{folder}")
    if rows == 0:
        _Files(spark, path).delete(folder)  # what this call has just written
    own = Load(name, folder if rows else None, rows)

    def added(loads: tuple[Load, ...]) -> tuple[Load, ...] | None:
        if any(x.id == name for x in loads):
            return None
        if rows == 0 and load_id is None:
            return () if replace and loads else None
        return (own,) if replace else (*loads, own)

    publish(spark, path, added)
    return rows
