"""Versioned Parquet tables: commits, time travel, change feed, idempotent writes, properties.

A table is `<path>/data/<version>-<id>/` (Parquet), `<path>/changes/<version>-<id>/`
and `<path>/_log/<20 digits>.json`. A commit writes its files first and then
creates the next log entry, failing if another writer has created it. Entries
hold the live folders, the schema, metadata and the newest transaction of each
writer. A table made with buckets lies in one folder a bucket of its key's
hash, and a merge reads and rewrites only the buckets that its source touches;
of a table without buckets it rewrites only the files that hold one of its
keys. A merge writes its result once, in a folder for each kind of change: the
next version and the change feed both name those folders. All files go through
Hadoop's file systems, so any of them will do.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import current

CHANGE = "_change_type"
BUCKET = "_bucket"
KIND = "_change"
#: What a merge's folders are to the change feed.
FEEDS = {"insert": "insert", "update": "update_postimage"}
#: A guard this old was left by a writer that died: the step it guards takes milliseconds.
GUARD_SECONDS = 60


class Conflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Entry:
    version: int
    operation: str
    folders: tuple[str, ...]
    schema: str
    #: The change feed: folders with the kind of all their rows, or '' where the rows say it.
    changes: tuple[tuple[str, str], ...] = ()
    metadata: dict[str, Any] = field(default_factory=dict)
    #: The newest value of every metadata key so far.
    known: dict[str, Any] = field(default_factory=dict)
    txns: dict[str, int] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)
    #: The key columns and the number of buckets, or nothing.
    keys: tuple[str, ...] = ()
    buckets: int = 0

    def of(self, buckets: set[int]) -> tuple[str, ...]:
        """The live folders of these buckets."""
        return tuple(f for f in self.folders if int(re.search(rf"/{BUCKET}=(\d+)", f)[1]) in buckets)  # type: ignore[index]


class Files:
    """The few file operations that a log needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts: str):  # noqa: ANN201
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root.toString(), *parts]))

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> bool:
        """Write a new file whole; False if it exists or another writer is about to make it. The bytes go to a file of their own first, which is renamed under a guard; the guard of a writer that died is removed."""
        target, own, guard = self.path(*parts), self.path(*parts[:-1], f".{uuid.uuid4().hex}"), self.path(*parts[:-1], f".lock-{parts[-1]}")
        if self.fs.exists(target):
            return False
        stream = self.fs.create(own, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._guarded(guard):
            self.fs.delete(own, False)
            return False
        try:
            if self.fs.exists(target) or not self.fs.rename(own, target):
                self.fs.delete(own, False)
                return False
            return True
        finally:
            self.fs.delete(guard, False)

    def _guarded(self, guard) -> bool:  # noqa: ANN001
        """Whether this writer made the guard (create without overwrite lets one through)."""
        for _ in range(2):
            try:
                self.fs.create(guard, False).close()
                return True
            except Py4JJavaError:
                if not self.fs.exists(guard):
                    continue
                if time.time() - self.fs.getFileStatus(guard).getModificationTime() / 1000 < GUARD_SECONDS:
                    return False
                dead = self.path(f".dead-{uuid.uuid4().hex}")
                if self.fs.rename(guard, dead):  # of many that try, one moves it
                    self.fs.delete(dead, False)
        return False

    def age(self, *parts: str) -> float:
        """Seconds since a file or folder was last changed."""
        return time.time() - self.fs.getFileStatus(self.path(*parts)).getModificationTime() / 1000

    def move(self, old: str, new: str) -> bool:
        return self.exists(old) and bool(self.fs.rename(self.path(old), self.path(new)))

    def below(self, folder: str) -> list[str]:
        """The Parquet files below a folder (or the file itself), by their path from the root."""
        if folder.endswith(".parquet"):
            return [folder]
        out: list[str] = []
        for name in self.names(folder):
            if name.endswith(".parquet"):
                out.append(f"{folder}/{name}")
            elif "=" in name:
                out += self.below(f"{folder}/{name}")
        return out

    def exists(self, *parts: str) -> bool:
        return bool(self.fs.exists(self.path(*parts)))

    def delete(self, *parts: str) -> bool:
        return bool(self.fs.delete(self.path(*parts), True))


class Table:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 0):
        """`buckets` counts for a table that is yet to be made."""
        self.spark, self.path, self.files, self.buckets = spark, path.rstrip("/"), Files(spark, path.rstrip("/")), buckets

    def versions(self) -> list[int]:
        return [int(n[:20]) for n in self.files.names("_log") if n.endswith(".json") and n[0] != "."]

    def exists(self) -> bool:
        return bool(self.versions())

    def entry(self, version: int | None = None) -> Entry:
        all_versions = self.versions()
        if not all_versions or (version is not None and version not in all_versions):
            raise ValueError(f"no version {'' if version is None else version} of {self.path}")
        raw = json.loads(self.files.read("_log", f"{all_versions[-1] if version is None else version:020d}.json"))
        return Entry(**raw | {"folders": tuple(raw["folders"]), "keys": tuple(raw.get("keys", ())), "changes": tuple(map(tuple, raw["changes"]))})

    def history(self, most: int = 100) -> list[Entry]:
        return [self.entry(v) for v in self.versions()[::-1][:most]]

    def metadata(self, key: str) -> Any:
        """The newest value of a metadata key. Every entry carries what is known so far, so it doesn't matter how many commits ago it was set."""
        return self.entry().known.get(key)

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        e = self.entry(version)
        schema = StructType.fromJson(json.loads(e.schema))
        folders = e.folders if buckets is None else e.of(buckets)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    @staticmethod
    def _bucket(schema: StructType, keys: Sequence[str], n: int) -> Column:
        """A row's bucket; keys are hashed in the table's types."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(n)).cast("int")

    def _touched(self, entry: Entry, *frames: DataFrame) -> set[int]:
        """Buckets that rows fall into: as many as the table has at most."""
        at = self._bucket(StructType.fromJson(json.loads(entry.schema)), entry.keys, entry.buckets)
        return {r[0] for df in frames for r in df.select(at.alias("b")).distinct().collect()}

    def changes(self, first: int, last: int) -> DataFrame:
        """Rows changed in versions first..last, with _change_type and _commit_version."""
        parts = []
        for v in range(first, last + 1):
            for kind, folder in self.entry(v).changes:
                rows = self.spark.read.parquet(f"{self.path}/{folder}").drop(BUCKET)
                rows = rows.withColumn(CHANGE, F.lit(kind)) if kind else rows
                parts.append(rows.withColumn("_commit_version", F.lit(v).cast("bigint")))
        if not parts:
            schema = StructType.fromJson(json.loads(self.entry(last).schema)).add(CHANGE, "string").add("_commit_version", "long")
            return self.spark.createDataFrame([], schema)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _committed(self, writer: str | None, txn: int | None) -> bool:
        return writer is not None and txn is not None and self.exists() and self.entry().txns.get(writer, -1) >= txn

    def commit(self, operation: str, data: DataFrame | None, *, inserted: bool = False, add: bool = False, metadata: dict[str, Any] | None = None, writer: str | None = None, txn: int | None = None, properties: dict[str, str] | None = None, expected: int | None = None, check: Callable[[DataFrame], dict[str, Any]] | None = None, keys: Sequence[str] = (), kept: Sequence[str] = ()) -> int | None:
        """Commit the next version; None if this writer's transaction is already in. `add` keeps the live folders; `inserted` says that all rows are new, so they are their own change feed; `expected` is the version the work was based on; `check` reads the written rows before they count, and gives more metadata or raises; `keys` are hashed into buckets, where the table has any; `kept` are live folders that stay."""
        if self._committed(writer, txn):
            return None
        before = self.entry() if self.exists() else None
        version = before.version + 1 if before else 0
        if expected is not None and version != expected + 1:
            raise Conflict(f"{self.path}: based on {expected}, now at {version - 1}")
        tag = f"{version}-{uuid.uuid4().hex}"
        folders = list(before.folders) if before and (add or data is None) else list(kept)
        buckets = before.buckets if before and (add or data is None or kept) else self.buckets if keys else 0
        keys = before.keys if before and buckets and (add or data is None or kept) else tuple(keys)
        schema = before.schema if before else ""
        if data is not None:
            if add and before:
                old = StructType.fromJson(json.loads(before.schema))
                both = self.spark.createDataFrame([], old).unionByName(data.limit(0), allowMissingColumns=True).schema
            else:
                both = data.schema
            schema = json.dumps(json.loads(both.json()))
            if buckets:
                data.withColumn(BUCKET, self._bucket(StructType.fromJson(json.loads(schema)), keys, buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{tag}")
            else:
                data.write.parquet(f"{self.path}/data/{tag}")
            if check:
                try:
                    metadata = (metadata or {}) | check(self.spark.read.schema(data.schema).parquet(f"{self.path}/data/{tag}").drop(BUCKET))
                except Exception:
                    self.files.delete("data", tag)
                    raise
            folders += [f"data/{tag}/{n}" for n in self.files.names(f"data/{tag}") if n.startswith(f"{BUCKET}=")] if buckets else [f"data/{tag}"]
        return self._publish(before, version, operation, folders, schema, [("insert", f"data/{tag}")] if inserted else [], metadata, writer, txn, properties, keys, buckets)

    def _publish(self, before: Entry | None, version: int, operation: str, folders: Sequence[str], schema: str, feed: Sequence[tuple[str, str]], metadata: dict[str, Any] | None, writer: str | None, txn: int | None, properties: dict[str, str] | None, keys: Sequence[str], buckets: int) -> int:
        """The log entry, by which a commit counts."""
        txns = dict(before.txns) if before else {}
        if writer is not None and txn is not None:
            txns[writer] = txn
        known = (before.known if before else {}) | (metadata or {})
        entry = Entry(version, operation, tuple(folders), schema, tuple(feed), metadata or {}, known, txns, (before.properties if before else {}) | (properties or {}), tuple(keys) if buckets else (), buckets)
        if not self.files.create(json.dumps(entry.__dict__), "_log", f"{version:020d}.json"):
            raise Conflict(f"{self.path}: version {version} exists")
        return version

    def create(self, schema: StructType) -> None:
        """An empty table, unless there is one (another writer may win the race)."""
        if not self.exists():
            try:
                self.commit("create", self.spark.createDataFrame([], schema))
            except Conflict:
                if not self.exists():
                    raise

    def overwrite(self, data: DataFrame, **commit: Any) -> int | None:
        return self.commit("overwrite", data, inserted=True, **commit)

    def append(self, data: DataFrame, **commit: Any) -> int | None:
        return self.commit("append", data, add=True, inserted=True, **commit)

    def _holding(self, entry: Entry, keys: Sequence[str], *frames: DataFrame) -> tuple[list[str], list[str]]:
        """The live files that hold a key of the frames, and all other live folders and files. Only key columns are read; what comes to the driver is a list of files."""
        named = [df.select(*[F.col(k).cast(t).alias(k) for k, t in self._types(entry, keys).items()]) for df in frames]
        asked = reduce(DataFrame.unionByName, named).distinct()
        held = self.read(entry.version).select(*keys, F.col("_metadata.file_path").alias("_file")).join(asked, list(keys), "left_semi")
        found = {"data/" + r[0].rsplit("/data/", 1)[1] for r in held.select("_file").distinct().collect()}
        touched, rest = [], []
        for folder in entry.folders:
            if not any(f == folder or f.startswith(f"{folder}/") for f in found):
                rest.append(folder)
                continue
            for f in self.files.below(folder):
                (touched if f in found else rest).append(f)
        return touched, rest

    @staticmethod
    def _types(entry: Entry, keys: Sequence[str]) -> dict[str, Any]:
        schema = StructType.fromJson(json.loads(entry.schema))
        return {k: schema[k].dataType for k in keys}

    def _parts(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def merge(self, source: DataFrame, keys: Sequence[str], sequence: Sequence[str] = (), *, delete_keys: DataFrame | None = None, hard: bool = False, drop_missing: bool = False, metadata: dict[str, Any] | None = None, writer: str | None = None, txn: int | None = None, properties: dict[str, str] | None = None) -> int | None:
        """Keyed upsert; None if nothing changed or the transaction is in. The result is written once, in folders by kind of change; the next version and its change feed name them. Only rows as they were before are written besides."""
        if self._committed(writer, txn):
            return None
        if not self.exists():
            first = source.where("_operation <> 'DELETE'") if hard else source
            return self.overwrite(first, keys=tuple(keys), metadata=metadata, writer=writer, txn=txn, properties=properties)
        entry = self.entry()
        schema = StructType.fromJson(json.loads(entry.schema))
        frames = [source, *([delete_keys] if delete_keys is not None else [])]
        if drop_missing:
            inside, left = list(entry.folders), []
        elif entry.buckets and entry.keys == tuple(keys):
            inside = list(entry.of(self._touched(entry, *frames)))
            left = [f for f in entry.folders if f not in set(inside)]
        else:
            inside, left = self._holding(entry, keys, *frames)
        target = self._parts(inside, schema)
        typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        result = current.upsert(target, typed, keys, sequence, delete_keys=delete_keys, hard=hard, drop_missing=drop_missing)
        version = entry.version + 1
        tag = f"{version}-{uuid.uuid4().hex}"
        if entry.buckets:
            placed = result.withColumn(BUCKET, self._bucket(schema, entry.keys, entry.buckets)).repartition(BUCKET)
            placed.write.partitionBy(BUCKET, KIND).parquet(f"{self.path}/data/{tag}")
        else:
            result.write.partitionBy(KIND).parquet(f"{self.path}/data/{tag}")
        try:
            outer = [f"data/{tag}/{n}" for n in self.files.names(f"data/{tag}") if n.startswith(f"{BUCKET}=")] if entry.buckets else [f"data/{tag}"]
            made = [(n.split("=")[1], f"{o}/{n}") for o in outer for n in self.files.names(o) if n.startswith(f"{KIND}=")]
            if not any(kind != "none" for kind, _ in made):
                self.files.delete("data", tag)
                return None
            feed = [(FEEDS[kind], f) for kind, f in made if kind in FEEDS]
            if old := [(kind, f) for kind, f in made if kind in ("update", "delete")]:
                gone = reduce(DataFrame.unionByName, [self._parts([f], schema).select(*keys, F.lit("delete" if kind == "delete" else "update_preimage").alias(CHANGE)) for kind, f in old])
                target.join(gone, list(keys)).select(*target.columns, CHANGE).write.parquet(f"{self.path}/changes/{tag}")
                feed.append(("", f"changes/{tag}"))
            live = [*left, *[f for kind, f in made if kind != "delete"]]
            return self._publish(entry, version, "merge", live, entry.schema, feed, metadata, writer, txn, properties, entry.keys, entry.buckets)
        except Exception:  # a merge that fails or loses a race leaves nothing behind
            self.files.delete("data", tag)
            self.files.delete("changes", tag)
            raise

    def compact(self) -> int | None:
        """The same rows in as few folders as the table's layout has; no change feed."""
        entry = self.entry()
        return self.commit("compact", self.read(entry.version), expected=entry.version, keys=entry.keys) if entry.folders else None

    def vacuum(self, keep: int = 100, pinned: Iterable[int] = (), older: float = 86_400) -> int:
        """Forget all versions but the newest `keep` and the pinned ones, and delete folders that none of the kept names and that are `older` seconds old (younger ones may be another writer's). Returns how many folders went."""
        versions = self.versions()
        kept = set(versions[-max(keep, 1) :]) | set(pinned)
        for v in versions:
            if v not in kept:
                self.files.delete("_log", f"{v:020d}.json")
        entries = [self.entry(v) for v in versions if v in kept]
        used = {"/".join(f.split("/")[:2]) for e in entries for f in (*e.folders, *[c for _, c in e.changes])}
        idle = [(kind, n) for kind in ("data", "changes") for n in self.files.names(kind) if f"{kind}/{n}" not in used and self.files.age(kind, n) >= older]
        for kind, n in idle:
            self.files.delete(kind, n)
        return len(idle)

    def set_properties(self, **properties: str) -> int | None:
        return self.commit("properties", None, properties=properties)

    def ensure(self, **properties: str) -> int | None:
        """Repair properties that are missing or differ; None if all are as they should be."""
        held = self.entry().properties
        off = {k: v for k, v in properties.items() if held.get(k) != v}
        return self.set_properties(**off) if off else None
