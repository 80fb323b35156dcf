"""Arrival-driven loading with Structured Streaming: a file-source stream over the landing folder, each
micro-batch landed by ``foreachBatch`` with a partition-scoped overwrite per content hash.

The file source remembers which files it has processed in its checkpoint, so a restart resumes after the last
committed micro-batch; the overwrite of a content's own partition makes re-processing a micro-batch idempotent.
``trigger(availableNow=True)`` drains what is there and stops (scheduled runs); drop it for a continuous stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.fingerprint import content_fingerprint
from lakekit.functions.digest import row_digest


def land_micro_batch(batch: DataFrame, digest_cols: list[str], target: str, period_pattern: str) -> None:
    """Fingerprint the files of one micro-batch and overwrite their content partitions in ``target``."""
    d = batch.select("raw_uri", row_digest(*digest_cols).alias("row_digest"))
    fp = content_fingerprint(d, ["raw_uri"]).select("raw_uri", "content_sha256")
    landed = (batch.join(fp, "raw_uri")  # one row per file in this micro-batch
              .withColumn("source_period", F.nullif(F.regexp_extract("raw_uri", period_pattern, 1), F.lit(""))))
    (landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("content_sha256").parquet(target))


def stream_landing_folder(spark: SparkSession, landing: str, schema: StructType, digest_cols: list[str],
                          target: str, checkpoint: str, period_pattern: str = r"(\d{4}-\d{2})",
                          max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, drain) the landing stream; returns the finished query handle."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(landing).select("*", F.col("_metadata.file_path").alias("raw_uri"))
    writer = (rows.writeStream
              .foreachBatch(lambda b, _epoch: land_micro_batch(b, digest_cols, target, period_pattern))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
