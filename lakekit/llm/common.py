"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


def give_back() -> None:
    """At the end of a task: hand freed memory back to the system.  A worker lives on after its task, and the next stage's
    workers and the JVM share the executor's memory with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, wish: str) -> str:
    """``wish``, or with underscores in front where ``df`` has a column of that name (case aside)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns ``id`` (long) and ``text`` (null as empty); every other column, whatever its name, is left out."""
    return df.select(df[id_col].cast("long").alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that ``column`` has about ``limit`` bytes a slice (one row at least)."""
    if batch.num_rows == 0:
        return
    col = batch.column(column)
    wide = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    part = (off[:-1].astype(np.int64) - int(off[0])) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def utf8_values(col: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column without decoding them (null as empty)."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    return [x or b"" for x in col.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size of a plan; 0 if it is unknown (Spark then assumes exabytes)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 0 if size >= 1 << 60 else size


def input_partitions(df: DataFrame, bytes_each: int = 32 << 20) -> int:
    """Partitions for the rows of ``df`` by the optimizer's size of its plan, at least the session's shuffle count.

    A plan whose size is unknown (Spark then assumes exabytes) gets the session's count.
    """
    size = plan_bytes(df)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(1_000_000, size // bytes_each + 1))
