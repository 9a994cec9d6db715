"""A keyed table in hash partitions, changed by copy on write.

    data/<change>/bucket=<b>/   Parquet files of one partition
    commits/<version>.json      which folder holds each partition, the largest
                                `seq`, the schema, and the last epoch that each
                                stream has applied

A change reads and writes the partitions that its keys fall in; all others stay
in the folders they are in. It becomes visible by one rename of its commit, and
only if no other writer has taken that version, so readers see whole versions
and a lost job leaves nothing but files that `vacuum` removes. The store's
rename must be atomic, as that of HDFS or a local disk is.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taleweave.operators import ordering
from taleweave.operators import registry as R

#: Partitions of a new table. A partition is rewritten whole, so it should be
#: of the size of a few files: 4,096 of them for a table of some TB.
BUCKETS = 64


class CommitConflict(RuntimeError):
    """Another writer has committed the version first; read again and retry."""


@dataclass(frozen=True)
class Commit:
    """One version. `folders` maps partitions that have rows to their folder."""

    version: int = -1
    buckets: int = BUCKETS
    top: int = 0
    schema: str | None = None
    folders: dict[str, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


def bucket_of(key: str | Column, buckets: int) -> Column:
    """Partition of a key; a null key has one as well."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets).cast("int")


class _Store:
    """The few file operations that DataFrames do not have."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what a folder holds."""
        at = self._path(folder)
        if not self._fs.exists(at):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(at)]

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """Write a whole file under another name, then rename it; fails if
        `path` is there already."""
        folder, _, name = path.rpartition("/")
        other = self._path(f"{folder}/_{name}.{uuid.uuid4().hex}")
        out = self._fs.create(other, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        names = self._jvm.org.apache.hadoop.fs
        context = names.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self._gateway().new_array(getattr(names, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(other), self._fs.makeQualified(self._path(path)), options)
        except Py4JJavaError as e:
            self._fs.delete(other, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise CommitConflict(path) from e
            raise

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def _gateway(self):
        from pyspark import SparkContext

        return SparkContext._gateway


class PartitionedTable:
    """Rows by key with their insertion order in `seq`."""

    def __init__(self, spark: SparkSession, path: str, key: str = "npc_id", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self._buckets = spark, path.rstrip("/"), key, buckets
        self._store = _Store(spark, path)

    # ---- reading

    def versions(self) -> list[int]:
        found = (re.fullmatch(r"(\d+)\.json", n) for n, _ in self._store.names(f"{self.path}/commits"))
        return sorted(int(m[1]) for m in found if m)

    def commit(self, version: int | None = None) -> Commit:
        """The given version, or the newest; of no table, an empty one."""
        if version is None:
            versions = self.versions()
            if not versions:
                return Commit(buckets=self._buckets)
            version = versions[-1]
        return Commit(**json.loads(self._store.read(self._commit_path(version))))

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version; only its files are listed and read."""
        return self._rows(self.commit(version))

    def _rows(self, at: Commit, buckets: list[str] | None = None) -> DataFrame:
        if at.schema is None:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(json.loads(at.schema))
        wanted = [f for b, f in at.folders.items() if buckets is None or b in buckets]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in wanted])

    # ---- writing

    def upsert(self, new: DataFrame, order, stream: str | None = None, epoch: int | None = None, drop=()) -> int | None:
        """Latest row of a key wins and keeps the first position of its key;
        `new` applies in `order`, after all rows before. Columns of `new` are
        those of the table but `seq`, and those to `drop` once it is ordered.

        With `stream` and `epoch` a batch is applied once: a replay of an epoch
        that some version holds does nothing and returns None.
        """
        last = self.commit()
        if stream is not None and last.applied.get(stream, -1) >= epoch:
            return None
        placed = ordering.ordinal(new, order, out="_n").withColumn("seq", F.col("_n") + F.lit(last.top)).drop("_n", *drop).persist()
        try:
            last = replace(last, schema=last.schema or placed.schema.json(), top=last.top + placed.count())
            return self._change(last, placed, lambda old: R.upsert(old, placed.select(*old.columns), self.key), stream, epoch)
        finally:
            placed.unpersist()

    def remove(self, ids: DataFrame, stream: str | None = None, epoch: int | None = None) -> int | None:
        """Rows whose key is among `ids` go."""
        last = self.commit()
        if stream is not None and last.applied.get(stream, -1) >= epoch:
            return None
        ids = ids.select(self.key).distinct().persist()
        try:
            return self._change(last, ids, lambda old: R.remove(old, ids, self.key), stream, epoch)
        finally:
            ids.unpersist()

    def _change(self, last: Commit, keys: DataFrame, make: Callable[[DataFrame], DataFrame], stream, epoch) -> int:
        """Rewrite the partitions of some keys and commit the next version."""
        bucket = bucket_of(self.key, last.buckets)
        # at most one row for each partition
        touched = {str(r["b"]) for r in keys.select(bucket.alias("b")).distinct().collect()}
        folders = {b: f for b, f in last.folders.items() if b not in touched}
        if touched:
            change = f"{last.version + 1}-{uuid.uuid4().hex}"
            rows = make(self._rows(last, list(touched))).withColumn("bucket", bucket)
            # partitions come together, and large ones are split by size
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{change}")
            for name, _ in self._store.names(f"{self.path}/data/{change}"):
                if name.startswith("bucket="):
                    folders[name.removeprefix("bucket=")] = f"{change}/{name}"
        applied = last.applied | ({stream: epoch} if stream is not None else {})
        done = replace(last, version=last.version + 1, folders=folders, applied=applied)
        self._store.write_new(self._commit_path(done.version), json.dumps(done.__dict__))
        return done.version

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:010d}.json"

    def vacuum(self, keep: int = 1, older_than: float = 3600) -> list[str]:
        """Delete folders that none of the last `keep` versions names, and the
        older commits. Changes of the last `older_than` seconds stay, since
        they may belong to a job that has not committed yet."""
        versions = self.versions()
        used = {f for v in versions[-keep:] for f in self.commit(v).folders.values()}
        limit, gone = (time.time() - older_than) * 1000, []
        for v in versions[:-keep]:
            self._store.delete(self._commit_path(v))
        for change, at in self._store.names(f"{self.path}/data"):
            if at > limit:
                continue
            held = [f"{change}/{n}" for n, _ in self._store.names(f"{self.path}/data/{change}")]
            idle = [f for f in held if f not in used]
            if len(idle) == len(held) or all("/bucket=" not in f for f in held if f not in idle):
                idle = [change]
            for f in idle:
                self._store.delete(f"{self.path}/data/{f}")
            gone += idle
        return gone
