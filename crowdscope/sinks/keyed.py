"""Tables that stay whole while they are written: a keyed table with one
commit point (K4), and appends that can be repeated (K1).

Both write data files first and make them visible by one small file at the
end. Readers take only what such a file names, so they see the table before
or after a write, never between; a failed write leaves files nobody reads.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdscope.session import path_exists, remove_path
from crowdscope.sinks.writers import clustered, key_bucket, latest_by_key


class WriterBusy(RuntimeError):
    """Another writer holds the table."""


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name that must not exist yet: the text goes
    to a private name first, then one rename. False if the name is taken."""
    draft, fs = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    target, _ = _files(spark, path)
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _files(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished files in a folder."""
    target, fs = _files(spark, path)
    if not fs.exists(target):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(target)) if not n.endswith(".draft") and not n.startswith("."))


class KeyedTable:
    """One row per key, the newest by ``version_col`` (K4).

    ``data/<version>-<id>/key_bucket=<b>`` holds the rows of one hash bucket;
    ``_versions/<number>`` names, for every bucket, the folder that is
    current. An upsert rewrites the buckets that its rows touch into a new
    folder, then adds the next version file: that rename is the only moment
    at which the table changes. ``_writer`` is held while a writer works, and
    a second writer is refused; so is one whose version number was taken.
    Folders of older versions stay for readers that began earlier, until
    :meth:`vacuum`. Bucket count and keys are fixed when the table is created.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], version_col: str = "written_at",
                 tiebreak: list | None = None, buckets: int = 256):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.order = [F.desc(version_col), *(tiebreak or [])]
        self.buckets = buckets

    def version(self) -> int:
        """Number of the current version, 0 without any."""
        return max((int(n) for n in names(self.spark, f"{self.path}/_versions")), default=0)

    def _current(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        number = self.version() if version is None else version
        if not number:
            return 0, {}
        held = json.loads(read_text(self.spark, f"{self.path}/_versions/{number:012d}"))
        if held["keys"] != self.keys:
            raise ValueError(f"the table at {self.path} has the keys {held['keys']}")
        self.buckets = held["buckets"]
        return number, held["folders"]

    def _rows(self, folders: dict[str, str], wanted: list[int] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/data/{f}/key_bucket={b}" for b, f in sorted(folders.items()) if wanted is None or int(b) in wanted]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the current (or an older) version, as of this call."""
        number, folders = self._current(version)
        rows = self._rows(folders)
        if rows is None:
            raise ValueError(f"no table at {self.path}")
        return rows

    def upsert(self, updates: DataFrame) -> int:
        """Merge rows by key and return the new version number."""
        lock = f"{self.path}/_writer"
        if not write_new(self.spark, lock, uuid.uuid4().hex):
            raise WriterBusy(f"{lock} is held; remove it if its writer is gone")
        try:
            number, folders = self._current()
            folder = f"{number + 1}-{uuid.uuid4().hex[:8]}"
            landed = f"{self.path}/data/{folder}/_updates"
            new = updates.withColumn("key_bucket", key_bucket(self.keys, self.buckets))
            latest_by_key(new, self.keys, self.order).write.parquet(landed)
            new = self.spark.read.parquet(landed)
            touched = [r.key_bucket for r in new.select("key_bucket").distinct().collect()]  # at most the bucket count
            old = self._rows(folders, touched)
            if old is not None:
                old = old.withColumn("key_bucket", key_bucket(self.keys, self.buckets))
                new = latest_by_key(old.unionByName(new, allowMissingColumns=True), self.keys, self.order)
            clustered(new, ["key_bucket"]).write.mode("append").partitionBy("key_bucket").parquet(f"{self.path}/data/{folder}")
            remove_path(self.spark, landed)
            held = {"keys": self.keys, "buckets": self.buckets, "folders": folders | {str(b): folder for b in touched}}
            if touched and not write_new(self.spark, f"{self.path}/_versions/{number + 1:012d}", json.dumps(held)):
                raise WriterBusy(f"version {number + 1} of {self.path} was written meanwhile")
            return number + bool(touched)
        finally:
            remove_path(self.spark, lock)

    def vacuum(self, keep: int = 2) -> int:
        """Remove version files but the last ``keep`` and the folders that no
        kept one names; returns the number of folders removed."""
        numbers = [int(n) for n in names(self.spark, f"{self.path}/_versions")]
        used = {f for n in numbers[-keep:] for f in self._current(n)[1].values()}
        gone = [f for f in names(self.spark, f"{self.path}/data") if f not in used and int(f.split("-")[0]) <= max(numbers, default=0)]
        for n in numbers[:-keep]:
            remove_path(self.spark, f"{self.path}/_versions/{n:012d}")
        for f in gone:
            remove_path(self.spark, f"{self.path}/data/{f}")
        return len(gone)


def append_once(df: DataFrame, path: str, run_id: str, partition_by: list[str] | None = None) -> bool:
    """Append the rows of one run (K1). A run id in the log beside the data
    makes a repetition a no-op (False), whatever its rows are. A run that
    failed half-way left no log entry, so it is written again from scratch."""
    spark, name = df.sparkSession, str(run_id)
    if not name or any(c in name for c in "/=.") or name[0] in "_ ":
        raise ValueError(f"a run id can't be {run_id!r}")
    if path_exists(spark, f"{path}/_runs/{name}"):
        return False
    folder = f"{name}={uuid.uuid4().hex[:8]}"  # two tries of one run never share files
    rows = clustered(df, partition_by) if partition_by else df
    writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
    writer.parquet(f"{path}/runs/{folder}")
    if write_new(spark, f"{path}/_runs/{name}", folder):
        return True
    remove_path(spark, f"{path}/runs/{folder}")
    return False


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all runs in the log. Runs may differ in columns."""
    folders = [read_text(spark, f"{path}/_runs/{n}") for n in names(spark, f"{path}/_runs")]
    if not folders:
        raise ValueError(f"no run was appended at {path}")
    frames = [spark.read.option("basePath", f"{path}/runs/{f}").parquet(f"{path}/runs/{f}") for f in folders]
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out
