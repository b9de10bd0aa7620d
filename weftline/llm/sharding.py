"""Sharding: arrivals become small immutable shards; runs of like size are merged into files of a target size; every state is a
manifest with a version, committed at once.

A store is a folder: runs/<id>/ holds Parquet files that never change, manifest/<version>.json names the runs of a version. A
commit writes the manifest under another name and renames it to the next version, which fails if that exists; so of two
writers one wins, readers see a whole version or the one before, and files of a writer that died are in no manifest.

Two writers need a file system whose rename without overwriting is atomic, as HDFS's is and a local one's; object stores need a commit service of
their own.

Compaction is size-tiered: runs are like in size if they lie within LIKE times their bucket's mean; a bucket of FANOUT runs
is merged into one run. Each row is thus rewritten about log_FANOUT(number of arrivals) times. A merge reads and writes whole
files and joins scan partitions without a shuffle. Manifests hold only runs, of which compaction leaves O(log arrivals), each with the
number of its arrivals and the first and last of them; so their size follows the runs, not the arrivals.

vacuum(keep) deletes versions but the last keep and the runs that only those had; compaction after each arrival does so with the store's
keep. Runs that no manifest names, as another writer's that is still to commit, stay.

Defined results. Rows are kept as they are, nulls, empty texts and repeated rows included, whatever their columns; the first
arrival fixes the columns, and others must have the same; no column name is reserved. An empty arrival is committed without files. Null arrival numbers are
arrival 0.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import free_name, scratch_path

LIKE = (0.5, 1.5)
FANOUT = 4
TARGET_BYTES = 128 << 20


@dataclass(frozen=True)
class Run:
    path: str
    bytes: int
    arrivals: int
    first: int
    last: int


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT, keep: int = 1):
        self.spark, self.path, self.target_bytes, self.fanout, self.keep = spark, path.rstrip("/"), target_bytes, fanout, keep
        jvm = spark.sparkContext._jvm
        self._Path, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.path).getFileSystem(self._conf)

    # Manifests

    def versions(self) -> list[int]:
        folder = self._Path(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        """version, schema (JSON, or null before the first arrival) and runs."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "schema": None, "runs": []}
        stream = self._fs.open(self._Path(f"{self.path}/manifest/{version}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, before: dict[str, Any], runs: list[Run], schema: str | None) -> int:
        version = before["version"] + 1
        body = json.dumps({"version": version, "schema": schema, "runs": [asdict(r) for r in runs]})
        own = self._Path(f"{self.path}/manifest/.{version}.{uuid.uuid4().hex}")
        out = self._fs.create(own, False)
        try:
            out.write(body.encode())
        finally:
            out.close()
        options = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri() if own.toUri().getScheme() else self._fs.getUri(), self._conf)
            context.rename(own, self._Path(f"{self.path}/manifest/{version}.json"), self.spark.sparkContext._gateway.new_array(options, 0))
        except Exception as e:
            self._fs.delete(own, False)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(str(version)) from e
            raise
        return version

    def _runs(self, manifest: dict[str, Any]) -> list[Run]:
        return [Run(**r) for r in manifest["runs"]]

    def _bytes(self, path: str) -> int:
        return self._fs.getContentSummary(self._Path(path)).getLength() if self._fs.exists(self._Path(path)) else 0

    # Arrivals

    def append(self, df: DataFrame) -> int:
        """One arrival; its number is one more than the last. Returns the version."""
        now = self.manifest()
        number = 1 + max((r["last"] for r in now["runs"]), default=-1)
        return self.append_many(df, F.lit(number))

    def append_many(self, df: DataFrame, arrival: Column, compact: bool = False) -> int:
        """Arrivals by number, written in one scan and committed in order, each as a version; with compact, full buckets are merged
        after each, as if they had come one by one."""
        now = self.manifest()
        schema = df.schema.json()
        if now["schema"] not in (None, schema):
            raise ValueError("the columns differ from those of the store")
        base = f"{self.path}/runs/{uuid.uuid4().hex}"
        part = free_name(df, "arrival")
        df.select("*", F.coalesce(arrival.cast("int"), F.lit(0)).alias(part)).write.partitionBy(part).parquet(base)
        found = [f.getPath().getName() for f in self._fs.listStatus(self._Path(base)) if f.isDirectory()]
        numbers = sorted(int(n.removeprefix(f"{part}=")) for n in found if n.startswith(f"{part}="))
        if not numbers:
            return self._commit(now, self._runs(now), schema)
        version = now["version"]
        for number in numbers:
            path = f"{base}/{part}={number}"
            now = self.manifest()
            version = self._commit(now, [*self._runs(now), Run(path, self._bytes(path), 1, number, number)], schema)
            if compact:
                version = self.compact()
                self.vacuum(self.keep)
        return version

    # Compaction

    def full_bucket(self, runs: list[Run]) -> list[Run]:
        """The runs to merge: the bucket of the smallest runs that has fanout of them; empty if none has."""
        buckets: list[list[Run]] = []
        for r in sorted(runs, key=lambda r: (r.bytes, r.path)):
            mean = sum(x.bytes for x in buckets[-1]) / len(buckets[-1]) if buckets else 0
            if buckets and LIKE[0] * mean <= r.bytes <= LIKE[1] * mean:
                buckets[-1].append(r)
            else:
                buckets.append([r])
        return next((b for b in buckets if len(b) >= self.fanout), [])

    def compact(self) -> int:
        """Merge full buckets until there is none. Returns the version."""
        while True:
            now = self.manifest()
            runs = self._runs(now)
            chosen = self.full_bucket(runs)
            if not chosen:
                return now["version"]
            size = sum(r.bytes for r in chosen)
            path = f"{self.path}/runs/{uuid.uuid4().hex}"
            self._read(chosen, now["schema"]).coalesce(max(1, round(size / self.target_bytes))).write.parquet(path)
            merged = Run(path, self._bytes(path), sum(r.arrivals for r in chosen), min(r.first for r in chosen), max(r.last for r in chosen))
            self._commit(now, [*(r for r in runs if r not in chosen), merged], now["schema"])

    def vacuum(self, keep: int = 1) -> None:
        """Delete manifests but the last keep, and the runs that only they name."""
        versions = self.versions()
        for v in versions[:-keep]:
            old = {r.path for r in self._runs(self.manifest(v))}
            kept = {r.path for k in versions[-keep:] for r in self._runs(self.manifest(k))}
            for path in old - kept:
                self._fs.delete(self._Path(path), True)
            self._fs.delete(self._Path(f"{self.path}/manifest/{v}.json"), False)

    # Reading

    def _read(self, runs: list[Run], schema: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(*[r.path for r in runs])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (the last)."""
        now = self.manifest(version)
        if now["schema"] is None:
            raise ValueError("the store is empty")
        if not now["runs"]:
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(now["schema"])))
        return self._read(self._runs(now), now["schema"])


def sharded(docs: DataFrame, arrival: Column, target_bytes: int = TARGET_BYTES, keep: int = 1) -> ShardStore:
    """A store in the shared folder that has taken docs in as the arrivals that arrival numbers, compacted after each; the last keep
    versions can be read."""
    store = ShardStore(docs.sparkSession, scratch_path(docs.sparkSession, "store"), target_bytes, keep=keep)
    store.append_many(docs, arrival, compact=True)
    return store
