"""Numbered states of a stored table, and folders that only states refer to.

A stored table here is a set of Parquet folders that are written once and a small JSON state
that says which of them count. A change writes its folders first and then the next state under its number;
until that one rename, readers see the state before, whole, and after it the new one. What a writer that
died has left behind is named by no state, so nobody reads it. States are as small as the number of folders and
buckets; rows are only ever read and written by Spark.

Two writers that take the same number are told apart by the rename, which fails where the file is there
(HDFS) or is preceded by a look (local disks); stores without such a rename need one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import delete_path

State = dict[str, Any]


class VersionLog:
    """The states below ``path/_versions``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _on(self, relative: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{relative}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, relative: str) -> list[str]:
        """What a folder holds; nothing where it isn't there."""
        place, store = self._on(relative)
        return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.names("_versions") if n.endswith(".json")]

    def state(self, version: int | None = None) -> State | None:
        """The state of a version, the newest by default; None where nothing was committed."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return None
        place, store = self._on(f"_versions/{version:012d}.json")
        stream = store.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, change: Callable[[State | None], State | None]) -> int | None:
        """Put ``change(newest state)`` in place as the next version; None from it commits nothing.

        Where another writer was faster, ``change`` is asked again with the state that it left.
        """
        while True:
            version = max(self.versions(), default=-1) + 1
            new = change(self.state(version - 1) if version else None)
            if new is None:
                return None
            staged, store = self._on(f"_versions/.{uuid.uuid4().hex}")
            out = store.create(staged, True)
            out.write(bytearray(json.dumps(new).encode()))
            out.close()
            target, _ = self._on(f"_versions/{version:012d}.json")
            if not store.exists(target) and store.rename(staged, target):
                return version
            store.delete(staged, False)

    def folder(self, name: str) -> str:
        """A fresh folder for one change."""
        return f"data/{name}-{uuid.uuid4().hex}"

    def expire(self, keep: int, named: Callable[[State], set[str]]) -> list[str]:
        """Drop all but the newest ``keep`` states and what the rest don't name; returns the folders and parts deleted.

        ``named`` gives the folders of a state, or those of their parts that it still uses. Not to be run beside a
        writer, whose folders no state names yet.
        """
        versions = self.versions()
        for version in versions[:-keep]:
            delete_path(self.spark, f"{self.path}/_versions/{version:012d}.json")
        used = set().union(*(named(self.state(v)) for v in versions[-keep:]))
        in_parts = {u.rsplit("/", 1)[0] for u in used if u.count("/") == 2}
        gone = []
        for folder in (f"data/{n}" for n in self.names("data")):
            if folder in in_parts:
                gone += [f"{folder}/{n}" for n in self.names(folder) if "=" in n and f"{folder}/{n}" not in used]
            elif folder not in used:
                gone.append(folder)
        for path in gone:
            delete_path(self.spark, f"{self.path}/{path}")
        return gone


class PartedFolders:
    """Rows of one schema in folders parted by one column, of which a state picks some parts."""

    def __init__(self, log: VersionLog, schema, column: str, kind: str):
        self.log, self.schema, self.column, self.kind = log, schema, column, kind

    def write(self, df: DataFrame, name: str) -> tuple[str, list[str]]:
        """The new folder and the parts that it holds; a large part is cut into several files."""
        folder = self.log.folder(name)
        df.hint("rebalance", self.column).write.partitionBy(self.column).parquet(f"{self.log.path}/{folder}")
        prefix = f"{self.column}="
        return folder, [n.removeprefix(prefix) for n in self.log.names(folder) if n.startswith(prefix)]

    def read(self, parts: dict[str, str]) -> DataFrame:
        """The rows of ``parts`` (part to folder), with the part's column; only those parts' files are read."""
        spark = self.log.spark
        by: dict[str, list[str]] = {}
        for part, folder in parts.items():
            by.setdefault(folder, []).append(part)
        whole = spark.createDataFrame([], self.schema).withColumn(self.column, F.lit(None).cast(self.kind))
        for folder, some in sorted(by.items()):
            stored = spark.read.schema(whole.schema).parquet(f"{self.log.path}/{folder}")
            whole = whole.union(stored.where(F.col(self.column).isin([F.lit(p).cast(self.kind) for p in some])))
        return whole
