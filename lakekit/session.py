"""Spark session defaults and lineage helpers.

Business times are wall-clock ``TIMESTAMP_NTZ``; the session time zone is pinned to UTC so that nothing that
still consults it (parquet instant columns, ``current_timestamp``) drifts between clusters.  ANSI mode and AQE
(partition coalescing + skew-join splitting) are on.  ``spark.checkpoint.dir`` is read from the session; a
scratch directory is only created in local mode; on a cluster the folder must be named.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet timestamps without an instant flag are read as wall-clock NTZ
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # a long-lived driver runs many jobs with large plans (the gates span the whole star); keep only recent
    # execution / job / stage records in the status store so they do not fill the driver heap
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
}


def get_spark(master: str | None = None, app: str = "lakekit", shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # runtime-settable SQL confs also apply to an already running session
    for k, v in settings.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a live session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; a scratch folder only in local mode when none is configured.

    On a cluster without ``spark.checkpoint.dir`` this raises: a machine-local folder would leave each executor's part
    of a staged table on its own disk.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lakekit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


# of the star's staged tables: hex digests, most of a trip row, take half the room that Parquet's default gives them
STAGED_CODEC = "zstd"


def cut_lineage(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job computes and writes it (``checkpoint()`` would compute it twice), executor loss after the write costs
    nothing, and the re-read carries file statistics, so the optimizer sizes joins against it exactly.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "staged", name)
