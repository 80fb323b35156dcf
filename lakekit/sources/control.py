"""Batch lifecycle and run log as append-only events; "current state" is the latest event per key.

DISCOVERED → STARTED → SUCCESS | FAILED, and SUCCESS → SUPERSEDED when the same source object is reloaded with new
content.  An in-place UPDATE becomes one more appended event, so the log is also the audit trail and needs no
mutable table format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ["DISCOVERED", "STARTED", "SUCCESS", "FAILED", "SUPERSEDED"]
# Order of lifecycle states, used to break ties between events written with the same timestamp.
STATUS_ORDER = {"DISCOVERED": 1, "STARTED": 2, "SUCCESS": 3, "FAILED": 3, "SUPERSEDED": 4}

BATCH_EVENT_SCHEMA = ("batch_id string, source_system string, source_object string, source_period string, "
                      "content_sha256 string, source_version_id string, row_count long, file_size long, "
                      "target_table string, status string, event_at timestamp, supersedes_batch_id string, "
                      "schema_fingerprint string, raw_uri string, file_modified_time timestamp, request_parameters string")


def batch_id_for(source_system, content_sha256) -> F.Column:
    """Batch id of one attempt: source system, start of the content hash (for readers) and a random part, so two
    contents never share an id and a reload of the same content is a new batch.  Materialise before use."""
    return F.concat(F.lit("batch_"), F.col(source_system) if isinstance(source_system, str) else source_system,
                    F.lit("_"), F.substring(F.col(content_sha256), 1, 16), F.lit("_"), F.expr("uuid()"))


def batch_events(files: DataFrame, status: str, at_col: str = "event_at", target_table: str | None = None) -> DataFrame:
    """Lifecycle events for a set of files/batches in the batch-event schema (missing columns as null)."""
    cols = [c.split(" ")[0] for c in BATCH_EVENT_SCHEMA.split(", ")]
    types = dict(c.split(" ") for c in BATCH_EVENT_SCHEMA.split(", "))
    out = []
    for c in cols:
        if c == "status":
            out.append(F.lit(status).alias(c))
        elif c == "event_at":
            out.append((F.col(at_col) if at_col in files.columns else F.current_timestamp()).cast("timestamp").alias(c))
        elif c == "target_table" and target_table is not None:
            out.append(F.lit(target_table).alias(c))
        elif c in files.columns:
            out.append(F.col(c).cast(types[c]).alias(c))
        else:
            out.append(F.lit(None).cast(types[c]).alias(c))
    return files.select(*out)


def latest_state(events: DataFrame, key: str = "batch_id", ts: str = "event_at") -> DataFrame:
    """Latest event per key: ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC, lifecycle rank DESC)``.

    Partitioned by batch: each group holds the handful of events of one batch.
    """
    order = F.create_map(*[x for k, v in STATUS_ORDER.items() for x in (F.lit(k), F.lit(v))])
    w = Window.partitionBy(key).orderBy(F.col(ts).desc(), order[F.col("status")].desc())
    return events.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def batch_lifecycle(events: DataFrame, key: str = "batch_id", ts: str = "event_at") -> DataFrame:
    """One row per batch with its lifecycle timestamps: latest status, content, landed row count, and when it was
    discovered, started and completed (the columns a mutable batch table would hold).

    A grouped aggregate per batch (a handful of events each), partially aggregated before the shuffle.
    """
    order = F.create_map(*[x for k, v in STATUS_ORDER.items() for x in (F.lit(k), F.lit(v))])
    latest = F.struct(F.col(ts), order[F.col("status")])

    def first_at(*statuses):
        return F.min(F.when(F.col("status").isin(*statuses), F.col(ts)))

    return events.groupBy(key).agg(
        F.max_by("status", latest).alias("status"),
        F.max_by("source_system", latest).alias("source_system"),
        F.max_by("content_sha256", latest).alias("content_sha256"),
        F.max_by("row_count", F.when(F.col("row_count").isNotNull(), latest)).alias("row_count"),
        first_at("DISCOVERED").alias("discovered_at"),
        first_at("STARTED").alias("started_at"),
        F.max(F.when(F.col("status").isin("SUCCESS", "FAILED"), F.col(ts))).alias("completed_at"))


def batch_versions(events: DataFrame) -> DataFrame:
    """Per loaded batch its file version and how often the log closed it, ``(batch_id, source_file_version,
    control_row_count)``; a batch whose version the log does not know has none."""
    return events.filter("status = 'SUCCESS'").groupBy("batch_id").agg(
        F.max("source_version_id").alias("source_file_version"), F.count(F.lit(1)).cast("long").alias("control_row_count"))


def close_with_counts(started: DataFrame, landed_counts: DataFrame, key: str = "batch_id") -> DataFrame:
    """SUCCESS events for started batches, carrying the landed row count (aggregate merged back per batch)."""
    j = started.drop("row_count").join(landed_counts, key, "left")
    return batch_events(j.withColumn("row_count", F.coalesce("row_count", F.lit(0))), "SUCCESS")


def supersede(current: DataFrame, new_batches: DataFrame) -> DataFrame:
    """SUPERSEDED events for live SUCCESS batches that a new batch replaces: the same source object delivered again,
    or the same content loaded again (its rows were lost from the target)."""
    live = current.filter(F.col("status") == "SUCCESS")
    hits = [live.join(new_batches.select(*on).distinct(), on, "left_semi").select(*live.columns)
            for on in (["source_system", "source_object"], ["source_system", "content_sha256"])]
    return batch_events(hits[0].unionByName(hits[1]).dropDuplicates(["batch_id"]).drop("event_at"), "SUPERSEDED")


def control_checks_frame(state: DataFrame, events: DataFrame, stuck_hours: int = 6, now_col=None):
    """The control-log checks as one aggregation over current state + one over events:
    duplicate SUCCESS per content, stuck STARTED batches, lifecycle consistency, status domain, batch id
    uniqueness, emptiness.  Returns one row of counts."""
    now = now_col if now_col is not None else F.current_timestamp()
    st = state.agg(
        F.count(F.lit(1)).cast("long").alias("batches"),
        F.count_if(~F.col("status").isin(STATUSES) | F.col("status").isNull()).cast("long").alias("bad_status"),
        F.count_if((F.col("status") == "STARTED")
                   & (F.col("event_at") < now - F.make_interval(hours=F.lit(stuck_hours)))).cast("long")
        .alias("stuck_batches"),
        F.count_if((F.col("status") == "SUCCESS") & F.col("row_count").isNull()).cast("long")
        .alias("success_without_rows"))
    dup = (state.filter(F.col("status") == "SUCCESS").groupBy("source_system", "content_sha256")
           .agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0))
                                                  .cast("long").alias("duplicate_success")))
    return st.crossJoin(dup)  # two one-row aggregates
