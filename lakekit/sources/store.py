"""Versioned Parquet snapshots committed by write-once markers, and append-only logs.

A table is a folder ``<root>/<name>/``; each write goes to a new ``v=<id>/`` folder and is then committed by creating
an empty marker ``_commits/<sequence>.<id>``.  The greatest marker names the current version and no marker is ever
replaced or removed, so readers see the old version or the new one, and a failed write leaves the old one current.
Appends add files to ``<root>/<name>/log/``.  Filesystem calls go through Hadoop's
``FileSystem`` (works for local, HDFS and object stores), reached from the session.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(conf)

    # -- paths ----------------------------------------------------------------------------------------------
    def _table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _names(self, path: str) -> list[str]:
        p = self._Path(path)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _last_commit(self, name: str) -> tuple[int, str | None]:
        marks = [m for m in self._names(f"{self._table(name)}/_commits") if m[:1].isdigit()]
        if not marks:
            return 0, None
        sequence, version = max(marks).split(".", 1)
        return int(sequence), version

    # -- snapshots (replace table / insert overwrite) -------------------------------------------------------
    def current_version(self, name: str) -> str | None:
        return self._last_commit(name)[1]

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write a new version and make it current; returns the version id."""
        version = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self._table(name)}/v={version}")
        sequence, _ = self._last_commit(name)
        self._fs.createNewFile(self._Path(f"{self._table(name)}/_commits/{sequence + 1:012d}.{version}"))
        return version

    def read(self, name: str, version: str | None = None) -> DataFrame:
        v = version or self.current_version(name)
        if v is None:
            raise FileNotFoundError(f"table {name} has no current version")
        return self.spark.read.parquet(f"{self._table(name)}/v={v}")

    def versions(self, name: str) -> list[str]:
        p = self._Path(self._table(name))
        if not self._fs.exists(p):
            return []
        return sorted(s.getPath().getName()[2:] for s in self._fs.listStatus(p)
                      if s.isDirectory() and s.getPath().getName().startswith("v="))

    # -- append-only logs -----------------------------------------------------------------------------------
    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self._table(name)}/log")

    def read_log(self, name: str, schema=None) -> DataFrame:
        path = f"{self._table(name)}/log"
        if not self._fs.exists(self._Path(path)):
            if schema is None:
                raise FileNotFoundError(path)
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)

    # -- partition-scoped overwrite (idempotent restart) -----------------------------------------------------
    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: list[str]) -> None:
        """Replace only the partitions present in ``df`` (dynamic partition overwrite): re-running the load of
        a batch rewrites that batch's partition instead of appending a second copy."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*partition_by).parquet(f"{self._table(name)}/data")

    def drop_partitions(self, name: str, column: str, values: list[str]) -> None:
        """``DELETE WHERE column IN values`` for a partition column: remove those partition folders, many at a time."""
        def drop(v: str) -> None:
            self._fs.delete(self._Path(f"{self._table(name)}/data/{column}={v}"), True)  # a folder that is gone: no error

        if values:
            with ThreadPoolExecutor(max_workers=min(32, len(values))) as pool:
                list(pool.map(drop, values))

    def partitioned_path(self, name: str) -> str:
        """Folder of a partition-overwritten table's files."""
        return f"{self._table(name)}/data"

    def partition_values(self, name: str, column: str) -> list[str]:
        """Values of a partition column, from the folder names (one name a partition, no file is read)."""
        head = f"{column}="
        return [n[len(head):] for n in self._names(f"{self._table(name)}/data") if n.startswith(head)]

    def read_partitioned(self, name: str, schema=None) -> DataFrame:
        """The table's rows; with a schema, a table whose partitions were all dropped reads as empty."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self._table(name)}/data")
