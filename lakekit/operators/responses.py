"""Landing of keyed responses (weather documents, zone snapshots): new-work detection, change-gated merge, batches.

A delivery is work when its content has no SUCCESS batch, when the target is empty, when a stored row differs from what
would be stored now (volatile fields left out), or when stored rows name a batch that is not live any more.  Work gets a
batch, the merge inserts and updates only what differs, and a version is written only if something does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators import fingerprint, merge
from lakekit.session import cut_lineage
from lakekit.sources import control

PROVENANCE = ["content_sha256", "source_response_version", "source_system", "source_url", "batch_id"]


def request_parameters(columns: list[str]) -> F.Column:
    """The request as JSON with explicit nulls, as a batch names it."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def work_reasons(delivered: DataFrame, stored: DataFrame, state: DataFrame, content: str, source_system: str, keys: list[str],
                 compare: list[str]) -> dict[str, int]:
    """Counts of the reasons to load, each 0 if it does not apply: content without a SUCCESS batch, empty target, stored rows
    that differ, stored rows whose batch is not live.  ``stored`` needs ``batch_id``; keys compare null-safely."""
    live = state.filter(F.col("status") == "SUCCESS")
    loaded = live.filter((F.col("source_system") == source_system) & (F.col("content_sha256") == content)).limit(1).count()
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    differing = stored.alias("t").join(delivered.alias("s"), cond).filter(~same).count()
    orphaned = stored.join(live.select("batch_id"), "batch_id", "left_anti").count()
    return {"content_not_loaded": 1 - loaded, "target_empty": int(stored.limit(1).count() == 0), "rows_differ": differing,
            "rows_of_dead_batches": orphaned}


def land_responses(store, name: str, delivered: DataFrame, keys: list[str], volatile: list[str], source_system: str,
                   source_url: str, source_object: str) -> dict:
    """Land one delivery of responses; returns the reasons, the merge's counts and whether a version was written.

    ``delivered`` holds ``keys`` and the payload; repeated keys raise.  Stored rows are the payload with provenance.
    A row that did not change keeps its batch, unless that batch is dead: then it is taken over by the new one.  A batch of
    which no stored row is left is superseded.  The version is written before its batch closes.
    """
    spark = delivered.sparkSession
    payload = [c for c in delivered.columns if c not in keys]
    rows = fingerprint.response_identity(delivered, volatile, [*keys, *payload])
    rows = cut_lineage(rows.withColumn("source_system", F.lit(source_system)).withColumn("source_url", F.lit(source_url)), f"{name}-delivered")
    whole = fingerprint.snapshot_fingerprint(rows, "content_sha256").first()  # one row
    content = whole["content_sha256"] if whole else None
    state = control.latest_state(store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA))
    stored = store.read(name) if store.exists(name) else spark.createDataFrame([], rows.withColumn("batch_id", F.lit("")).schema)
    compare = ["source_response_version", "source_system", "source_url"]
    reasons = work_reasons(rows, stored, state, content, source_system, keys, compare)
    report = {**reasons, "insert": 0, "update": 0, "unchanged": 0, "written": False}
    if not any(reasons.values()):
        return report
    batch = f"batch_{source_system}_{uuid.uuid4().hex}"
    request = rows.agg(F.min(request_parameters(keys)).alias("r")).first()["r"]
    one = spark.createDataFrame([(batch, source_system, source_object, content, request, whole["row_count"] if whole else 0)],
                                "batch_id string, source_system string, source_object string, content_sha256 string, "
                                "request_parameters string, row_count long")
    for status in ("DISCOVERED", "STARTED"):
        store.append("ingestion_batches", control.batch_events(one.drop("row_count"), status, target_table=name))
    live = state.filter("status = 'SUCCESS'").select("batch_id", F.lit(True).alias("alive"))
    target = stored.join(live, "batch_id", "left").withColumn("alive", F.coalesce("alive", F.lit(False))).select(*stored.columns, "alive")
    source = rows.withColumn("batch_id", F.lit(batch)).withColumn("alive", F.lit(True))
    plan = cut_lineage(merge.merge_plan(target, source, keys, [*compare, "alive"]), f"{name}-plan")
    report |= {r["_merge_action"]: r["keys"] for r in merge.merge_counts(plan).collect()}
    if report["insert"] or report["update"]:
        store.write(name, plan.drop("_merge_action", "alive"))
        report["written"] = True
    store.append("ingestion_batches", control.batch_events(one.withColumn("target_table", F.lit(name)), "SUCCESS"))
    left = store.read(name).select("batch_id").distinct()
    emptied = (state.filter((F.col("status") == "SUCCESS") & (F.col("target_table") == name))
               .join(left, "batch_id", "left_anti").filter(F.lit(report["written"])))
    store.append("ingestion_batches", control.batch_events(cut_lineage(emptied, "emptied").drop("event_at"), "SUPERSEDED"))
    return report
