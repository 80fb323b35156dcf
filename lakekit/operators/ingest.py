"""Content-hash incremental loading: discover new work, land it idempotently, reconcile, close batches.

A file is new work when **no SUCCESS batch exists for its content OR the target holds no rows of that content**
(either condition alone triggers a reload).  Discovery follows content, never event time, so late or old-dated
rows in a new file are loaded and only flagged downstream.  Landing overwrites the content's own partition, so a
restarted or repeated load never duplicates rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.digest import row_digest
from lakekit.operators.fingerprint import content_fingerprint, source_period


class ReconciliationError(RuntimeError):
    pass


def file_fingerprints(rows: DataFrame, digest_cols: list, file_col: str = "source_object",
                      extra_file_cols: list[str] = (), landed_object: Column | None = None) -> DataFrame:
    """Per landed file: content hash over the multiset of row digests, row count, period parsed from the name.

    ``landed_object`` is what a file belongs to, of ``file_col``, if several files land as one; it then stands in ``file_col``."""
    d = rows.select(file_col, *extra_file_cols, row_digest(*digest_cols).alias("row_digest"))
    fp = content_fingerprint(d, [file_col, *extra_file_cols], regroup=None if landed_object is None else {file_col: landed_object})
    return fp.withColumn("source_period", source_period(file_col))


LEDGER_SCHEMA = "raw_uri string, file_size long, file_modified_time timestamp, content_sha256 string"


def unseen_files(listing: DataFrame, ledger: DataFrame, held_contents: DataFrame) -> DataFrame:
    """Files of a listing that must be opened: those whose path, size and modification time are not in the ledger, or
    whose content the ledger names but the target does not hold any more.

    ``held_contents`` is ``content_sha256`` of what is loaded (a live batch and rows in the target).  Only names are joined;
    no file is read.  A file replaced within the same clock tick by one of equal size goes unnoticed.
    """
    known = ledger.join(held_contents.distinct(), "content_sha256", "left_semi")
    return listing.join(known.select("raw_uri", "file_size", "file_modified_time").distinct(),
                        ["raw_uri", "file_size", "file_modified_time"], "left_anti")


def discover_new(files: DataFrame, batch_state: DataFrame, target_contents: DataFrame,
                 source_system: str) -> DataFrame:
    """Files whose content has no SUCCESS batch, or whose content has no rows in the target.

    ``target_contents`` is the distinct ``content_sha256`` present in the target (one small grouped scan of the
    target's partition column).  Two left joins on distinct keys replace ``NOT EXISTS … OR NOT EXISTS``.
    """
    ok = (batch_state.filter((F.col("status") == "SUCCESS") & (F.col("source_system") == source_system))
          .select(F.col("content_sha256").alias("__ok")).distinct())
    present = target_contents.select(F.col("content_sha256").alias("__present")).distinct()
    j = (files.join(ok, files["content_sha256"] == ok["__ok"], "left")
         .join(present, files["content_sha256"] == present["__present"], "left"))
    return j.filter(F.col("__ok").isNull() | F.col("__present").isNull()).drop("__ok", "__present")


def one_file_per_content(new_files: DataFrame, file_col: str = "source_object") -> DataFrame:
    """Two files with identical content in one run: the first name carries the content, the others are flagged
    ``duplicate_content`` and name it in ``duplicate_of``; the caller registers only the first and records the rest.
    (Joining rows to batches by content would otherwise fan out.)"""
    first = new_files.groupBy("content_sha256").agg(F.min(file_col).alias("__first"))
    repeat = F.col(file_col) != F.col("__first")
    return new_files.join(first, "content_sha256").withColumn("duplicate_content", repeat).withColumn(
        "duplicate_of", F.when(repeat, F.col("__first"))).drop("__first")


def land(rows: DataFrame, new_files: DataFrame, file_col: str = "source_object",
         batch_cols: list[str] = ("batch_id", "content_sha256")) -> DataFrame:
    """Rows of the new files, stamped with their batch id and content hash (inner join on the file: the new-file
    list is one row per file, broadcast by AQE when small)."""
    keep = new_files.filter(~F.coalesce(F.col("duplicate_content"), F.lit(False))) \
        if "duplicate_content" in new_files.columns else new_files
    return rows.join(keep.select(file_col, *batch_cols), file_col)


def landed_counts(landed: DataFrame, key: str = "batch_id") -> DataFrame:
    return landed.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("row_count"))


def reconcile(new_files: DataFrame, counts: DataFrame, key: str = "batch_id") -> DataFrame:
    """Per new file: source rows vs landed rows; ``mismatch`` when they differ (missing landed = 0)."""
    j = new_files.select(key, F.col("row_count").alias("source_rows")).join(
        counts.select(key, F.col("row_count").alias("landed_rows")), key, "full_outer")
    return j.withColumn("landed_rows", F.coalesce("landed_rows", F.lit(0))).withColumn(
        "mismatch", ~F.col("source_rows").eqNullSafe(F.col("landed_rows")))


def reconcile_guard(report: DataFrame) -> None:
    """Raise when any new file's landed rows differ from its source rows (the report is one row per file)."""
    bad = report.filter("mismatch")
    n = bad.count()
    if n:
        examples = ", ".join(f"{r['batch_id']}: {r['source_rows']} vs {r['landed_rows']}" for r in bad.limit(20).collect())
        raise ReconciliationError(f"{n} file(s) landed a different row count, for example {examples}")
