"""Queries over the incremental landing protocol, the control log, the snapshot store and the stream path.

Each query delivers ``lineitem`` as monthly files into a fresh run folder under the shared checkpoint folder and
runs the protocol over them, so its work grows with the table.  Oracles state what the protocol must produce
from the same table (one SUCCESS batch per month with its row count, no new work on a re-run, …).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.digest import row_digest
from lakekit.operators import ingest, merge, profile
from lakekit.operators.resolve import GuardError
from lakekit.operators.responses import land_responses
from lakekit.plans import checks, landing, oracle
from lakekit.plans.catalog import register, star
from lakekit.plans.job import Job, run_summary
from lakekit.plans.catalog_ops import TYPE_MAP_SQL, TABLE_LIST_SQL
from lakekit.plans.tables import REPORTING_WINDOW, TABLES, Tables
from lakekit.sources import control
from lakekit.sources.files import file_bytes_chunked_sha256, list_files, parquet_footers, per_file_totals, scan_parquet_folder
from lakekit.plans.trips import StarBuild
from lakekit.sources.store import SnapshotStore
from lakekit.session import cut_lineage, scratch_path

MONTHS_SQL = "SELECT strftime(l_shipdate, '%Y-%m') AS source_period, COUNT(*) AS n FROM lineitem GROUP BY 1"


def _period(col="raw_uri"):
    return F.regexp_extract(col, landing.PERIOD_PATTERN, 1)


@register("i1_first_load_batch_state", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, 'SUCCESS' AS status, CAST(n AS BIGINT) AS row_count, 'bronze_lineitem' AS target_table FROM m""")
def i1_state(spark, d):
    st = landing.first_load_state(spark, d)
    return st.select("source_period", "status", "row_count", "target_table")


@register("c7_batch_lifecycle_event_counts", f"""WITH m AS ({MONTHS_SQL})
SELECT s.status, CAST(COUNT(*) AS BIGINT) AS events
FROM m CROSS JOIN (VALUES ('DISCOVERED'), ('STARTED'), ('SUCCESS')) s(status) GROUP BY s.status""")
def c7_events(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    ev = run.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
    return ev.groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("events"))


@register("c8_load_reconciliation_report", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, CAST(n AS BIGINT) AS source_rows, CAST(n AS BIGINT) AS landed_rows, false AS mismatch FROM m""")
def c8_report(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    report = run.load()
    periods = run.batch_state().select("batch_id", "source_period")
    return report.join(periods, "batch_id").select("source_period", "source_rows", "landed_rows", "mismatch")


@register("i3_rerun_finds_no_new_work", f"""
SELECT CAST((SELECT COUNT(DISTINCT strftime(l_shipdate, '%Y-%m')) FROM lineitem) AS BIGINT) AS first_run_files,
       CAST(0 AS BIGINT) AS second_run_files,
       CAST((SELECT COUNT(*) FROM lineitem) AS BIGINT) AS landed_rows""")
def i3_rerun(spark, d):
    run, first, second = landing.rerun_state(spark, d)
    f = first.agg(F.count(F.lit(1)).cast("long").alias("first_run_files"))
    s = second.agg(F.count(F.lit(1)).cast("long").alias("second_run_files"))
    t = run.store.read_partitioned("bronze_lineitem").agg(F.count(F.lit(1)).cast("long").alias("landed_rows"))
    return f.crossJoin(s).crossJoin(t)  # three one-row aggregates


@register("k11_landed_rows_per_period_after_rerun", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, CAST(n AS BIGINT) AS rows FROM m""")
def k11_rows(spark, d):
    run, _, _ = landing.rerun_state(spark, d)
    t = run.store.read_partitioned("bronze_lineitem")
    return t.groupBy(_period().alias("source_period")).agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("c53_control_log_checks", f"""
SELECT CAST((SELECT COUNT(DISTINCT strftime(l_shipdate, '%Y-%m')) FROM lineitem) AS BIGINT) AS batches,
       CAST(0 AS BIGINT) AS bad_status, CAST(0 AS BIGINT) AS stuck_batches,
       CAST(0 AS BIGINT) AS success_without_rows, CAST(0 AS BIGINT) AS duplicate_success""")
def c53_checks(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    ev = run.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
    return control.control_checks_frame(control.latest_state(ev), ev)


CONTROL_CTES = f"""m AS ({MONTHS_SQL}),
batch_state AS (
  SELECT 'batch_' || source_period AS batch_id, 'tpch_lineitem' AS source_system, 'c_' || source_period AS content_sha256,
         'SUCCESS' AS status, n AS row_count, now() AS discovered_at, now() AS started_at, now() AS completed_at
  FROM m),
batch_registrations AS (SELECT batch_id FROM batch_state),
success_per_content AS (
  SELECT source_system, content_sha256, COUNT_IF(status = 'SUCCESS') AS success_count
  FROM batch_state GROUP BY source_system, content_sha256)"""


@register("dq_gate_control", checks.control_gate().sql(CONTROL_CTES))
def dq_gate_control(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    ev = run.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
    return checks.control_gate().run(checks.control_tables(ev))


@register("c55_lineage_trace_rows_to_batches", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, 'SUCCESS' AS status, CAST(n AS BIGINT) AS rows FROM m""")
def c55_lineage(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    t = run.store.read_partitioned("bronze_lineitem")
    st = run.batch_state().select("batch_id", "source_period", "status")
    return t.join(st, "batch_id").groupBy("source_period", "status").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("c5_new_work_or_semantics", f"""
WITH m AS (SELECT COUNT(DISTINCT strftime(l_shipdate, '%Y-%m')) AS n FROM lineitem)
SELECT scenario, CAST(new_files AS BIGINT) AS new_files FROM (
  SELECT 'batches_and_target_present' AS scenario, 0 AS new_files
  UNION ALL SELECT 'target_missing', n FROM m
  UNION ALL SELECT 'batches_missing', n FROM m)""")
def c5_or(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    files = ingest.file_fingerprints(run.scan(run.opened), landing.LINE_COLS, "raw_uri")
    state, target = run.batch_state(), run.target_contents()
    empty_state = spark.createDataFrame([], control.BATCH_EVENT_SCHEMA)
    empty_target = spark.createDataFrame([], "content_sha256 string")
    src = landing.SOURCE_SYSTEM

    def n(name, df):
        return df.agg(F.count(F.lit(1)).cast("long").alias("new_files")).select(F.lit(name).alias("scenario"),
                                                                               "new_files")
    return (n("batches_and_target_present", ingest.discover_new(files, state, target, src))
            .unionByName(n("target_missing", ingest.discover_new(files, state, empty_target, src)))
            .unionByName(n("batches_missing", ingest.discover_new(files, empty_state, target, src))))


@register("s1_landing_folder_scan", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, CAST(1 AS BIGINT) AS files, CAST(n AS BIGINT) AS rows FROM m""")
def s1_scan(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    rows = scan_parquet_folder(spark, run.landing)
    return rows.groupBy(_period().alias("source_period")).agg(
        F.countDistinct("source_object").cast("long").alias("files"), F.count(F.lit(1)).cast("long").alias("rows"))


@register("s4_per_file_reread_totals", """
SELECT strftime(l_shipdate, '%Y-%m') AS source_period, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS l_extendedprice_total
FROM lineitem GROUP BY 1""")
def s4_totals(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    rows = scan_parquet_folder(spark, run.landing).withColumn("source_period", _period())
    t = per_file_totals(rows, "l_extendedprice")
    return t.select(_period().alias("source_period"), "rows", "l_extendedprice_total")


@register("d3_landed_file_byte_hashes")
def d3_hashes(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    # byte ranges hashed in parallel, so a landed file of any size is never read whole by one task
    h = file_bytes_chunked_sha256(spark, run.landing, "*.parquet")
    return h.select(_period("path").alias("source_period"), "length", "sha256")


@register("d4_schema_fingerprints", f"""
SELECT table_name AS dataset,
       sha256(string_agg(column_name || ':' || {TYPE_MAP_SQL}, '|' ORDER BY ordinal_position)) AS schema_fingerprint
FROM information_schema.columns WHERE table_name IN ({TABLE_LIST_SQL}) GROUP BY table_name""")
def d4_fingerprints(spark, d):
    from lakekit.operators.profile import schema_fingerprint
    t = Tables(spark, d)
    rows = [(n, schema_fingerprint(getattr(t, n).schema)) for n in TABLES]
    return spark.createDataFrame(rows, "dataset string, schema_fingerprint string")


@register("i1_streamed_landing_rows", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, CAST(n AS BIGINT) AS rows FROM m""")
def i1_stream(spark, d):
    t = landing.streamed_target(spark, d)
    return t.groupBy("source_period").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("k2_replace_snapshot_current_version", """
SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone, r_name AS service_zone,
       'tpch_nation' AS source_system, CAST(2 AS BIGINT) AS versions
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def k2_replace(spark, d):
    store = SnapshotStore(spark, scratch_path(spark, "store-k2-" + __import__("uuid").uuid4().hex))
    zones = star(spark, d).raw_zones()
    store.write("zones_raw", zones)
    store.write("zones_raw", zones)  # unchanged re-delivery: a second version, identical content
    return store.read("zones_raw").withColumn("location_id", F.col("location_id").cast("int")) \
        .withColumn("versions", F.lit(len(store.versions("zones_raw"))).cast("long"))


@register("k8_delete_orders_without_lines", """
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE NOT (o_orderkey IN (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem))""")
def k8_delete(spark, d):
    t = Tables(spark, d)
    doomed = t.orders.select("o_orderkey").join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")),
                                                "o_orderkey", "left_anti")
    return t.orders.join(doomed, "o_orderkey", "left_anti").select("o_orderkey", "o_orderstatus")


# --- I1/C5: the file ledger; D4/D5/D8: footers, drift and file facts on batches ---------------------------------

@register("i1_files_opened_per_run", f"""WITH m AS ({MONTHS_SQL}), n AS (SELECT COUNT(*) AS n FROM m)
SELECT run, CAST(listed AS BIGINT) AS listed, CAST(opened AS BIGINT) AS opened, CAST(batches AS BIGINT) AS batches FROM (
  SELECT 'first' AS run, n AS listed, n AS opened, n AS batches FROM n
  UNION ALL SELECT 'unchanged', n, 0, 0 FROM n
  UNION ALL SELECT 'renamed copy', n + 1, 1, 0 FROM n
  UNION ALL SELECT 'rows lost', n + 1, n + 1, n FROM n)""")
def i1_opened(spark, d):
    """What each of four runs lists, opens and loads: a first one, one over the same files, one after a month's file came
    again under another name, and one after the target's rows were lost."""
    run = landing.LandingRun(spark, d)
    run.deliver()
    out = []

    def go(name):
        report = run.load()
        out.append((name, list_files(spark, run.landing).count(), len(run.opened), report.count()))

    go("first")
    go("unchanged")
    month = run.batch_state().agg(F.min("source_period").alias("p")).first()["p"]
    spark.read.schema(landing.LINE_SCHEMA).parquet(f"{run.landing}/period={month}").coalesce(1).write.parquet(f"{run.landing}/again/period={month}")
    go("renamed copy")
    run.store.drop_partitions("bronze_lineitem", "content_sha256", run.store.partition_values("bronze_lineitem", "content_sha256"))
    go("rows lost")
    return spark.createDataFrame(out, "run string, listed long, opened long, batches long")


LINE_TYPES = "|".join(f"{f.name}:{f.dataType.simpleString()}" for f in landing.LINE_SCHEMA.fields)


@register("d5_batch_file_facts", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, sha256('{LINE_TYPES}') AS schema_fingerprint, true AS has_size, true AS has_modified_time,
       'period=' || source_period AS folder FROM m""")
def d5_facts(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    ev = run.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA).filter("status = 'SUCCESS'")
    return ev.select("source_period", "schema_fingerprint", (F.col("file_size") > 0).alias("has_size"),
                     F.col("file_modified_time").isNotNull().alias("has_modified_time"),
                     F.element_at(F.split("raw_uri", "/"), -2).alias("folder"))


def _drifted_run(spark, d):
    """Monthly deliveries of which the first lacks a column, the second has one more and the third another type."""
    run = landing.LandingRun(spark, d)
    run.deliver()
    li = Tables(spark, d).lineitem.select(*landing.LINE_COLS).withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    months = [r["period"] for r in li.select("period").distinct().orderBy("period").limit(3).collect()]
    changed = (li.drop("l_tax"), li.withColumn("l_comment", F.lit("new")), li.withColumn("l_quantity", F.col("l_quantity").cast("int")))
    for month, rows in zip(months, changed):
        (rows.filter(F.col("period") == month).repartition(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(run.landing))
    return run


DECLARED_SQL = "(VALUES " + ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in landing.LINE_SCHEMA.fields) + ") t(column_name, declared_type)"


@register("d8_landing_folder_drift", f"""WITH n AS (SELECT COUNT(*) AS n FROM ({MONTHS_SQL}))
SELECT column_name, declared_type,
       CASE WHEN column_name = 'l_quantity' THEN 'double,int' ELSE declared_type END AS types,
       CAST(CASE WHEN column_name = 'l_tax' THEN n - 1 ELSE n END AS BIGINT) AS files_with,
       CAST(CASE WHEN column_name = 'l_tax' THEN 1 ELSE 0 END AS BIGINT) AS files_without,
       CAST(CASE WHEN column_name = 'l_quantity' THEN 1 ELSE 0 END AS BIGINT) AS files_retyped,
       CASE column_name WHEN 'l_tax' THEN 'missing' WHEN 'l_quantity' THEN 'retyped' ELSE 'ok' END AS verdict,
       column_name IN ('l_tax', 'l_quantity') AS fails
FROM n CROSS JOIN {DECLARED_SQL}
UNION ALL SELECT 'l_comment', NULL, 'string', 1, n - 1, 0, 'extra', false FROM n""")
def d8_drift(spark, d):
    run = _drifted_run(spark, d)
    return profile.drift_verdicts(parquet_footers(list_files(spark, run.landing)), landing.LINE_SCHEMA)


@register("d8_drifted_files_batch_state", f"""WITH m AS ({MONTHS_SQL}), r AS (SELECT *, row_number() OVER (ORDER BY source_period) AS k FROM m)
SELECT source_period, CASE WHEN k IN (1, 3) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(CASE WHEN k IN (1, 3) THEN NULL ELSE n END AS BIGINT) AS row_count FROM r""")
def d8_state(spark, d):
    run = _drifted_run(spark, d)
    run.load()
    return run.batch_state().select("source_period", "status", "row_count")


# --- C47: every profile kind per landed file; K6: converge; C6/C9: keyed responses; F-error: guards ---------------

def _planted_delivery(spark, d):
    """Monthly files; the first one also holds a repeated row, a row of a far later month and a row with an unlisted code."""
    run = landing.LandingRun(spark, d)
    run.deliver()
    li = Tables(spark, d).lineitem.select(*landing.LINE_COLS).withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    month = li.agg(F.min("period").alias("p")).first()["p"]
    one = li.filter(F.col("period") == month).orderBy(*landing.LINE_COLS).limit(1)
    late = one.withColumn("l_shipdate", F.col("l_shipdate") + F.expr("INTERVAL 400 DAYS"))
    rows = one.unionByName(late).unionByName(one.withColumn("l_returnflag", F.lit("X")))
    rows.coalesce(1).write.mode("append").partitionBy("period").parquet(run.landing)
    return run


PROFILE_ROWS_SQL = f"""li AS (SELECT {', '.join(landing.LINE_COLS)} FROM lineitem),
p AS (SELECT min(strftime(l_shipdate, '%Y-%m')) AS p FROM li),
one AS (SELECT * FROM li WHERE strftime(l_shipdate, '%Y-%m') = (SELECT p FROM p) ORDER BY {', '.join(landing.LINE_COLS)} LIMIT 1),
landed AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS source_period, *  FROM li
  UNION ALL SELECT (SELECT p FROM p), * FROM one
  UNION ALL SELECT (SELECT p FROM p), * REPLACE (l_shipdate + INTERVAL 400 DAY AS l_shipdate) FROM one
  UNION ALL SELECT (SELECT p FROM p), * REPLACE ('X' AS l_returnflag) FROM one)"""


@register("c47_landed_file_profile", f"""WITH {PROFILE_ROWS_SQL},
found AS (
  SELECT source_period, 'rows' AS kind, '' AS value FROM landed
  UNION ALL SELECT source_period, 'month', strftime(l_shipdate, '%Y-%m') FROM landed
  UNION ALL SELECT source_period, 'out_of_period', strftime(l_shipdate, '%Y-%m') FROM landed WHERE strftime(l_shipdate, '%Y-%m') <> source_period
  UNION ALL SELECT source_period, 'unlisted_code', 'l_returnflag=' || l_returnflag FROM landed WHERE l_returnflag NOT IN ('A', 'N', 'R')
  UNION ALL SELECT source_period, 'out_of_range', 'l_quantity' FROM landed WHERE l_quantity < 1 OR l_quantity > 49
  UNION ALL SELECT source_period, 'broken_logic', 'discount above tax' FROM landed WHERE l_discount > l_tax
  UNION ALL SELECT source_period, 'null', 'l_linestatus' FROM landed WHERE l_linestatus IS NULL),
repeats AS (SELECT source_period, COUNT(*) - 1 AS n FROM landed GROUP BY source_period, {', '.join(landing.LINE_COLS)})
SELECT source_period, kind, value, CAST(COUNT(*) AS BIGINT) AS rows FROM found GROUP BY ALL
UNION ALL SELECT source_period, 'duplicate_rows', '', CAST(SUM(n) AS BIGINT) FROM repeats GROUP BY source_period""")
def c47_profile(spark, d):
    run = _planted_delivery(spark, d)
    rows = scan_parquet_folder(spark, run.landing, landing.LINE_SCHEMA).withColumn("source_period", _period())
    month = F.date_format("l_shipdate", "yyyy-MM")
    return profile.file_profile(rows, "source_period", {
        "month": month,
        "out_of_period": F.when(month != F.col("source_period"), month),
        "unlisted_code": F.when(~F.col("l_returnflag").isin("A", "N", "R"), F.concat(F.lit("l_returnflag="), "l_returnflag")),
        "out_of_range": F.when(~F.col("l_quantity").between(1, 49), F.lit("l_quantity")),
        "broken_logic": F.when(F.col("l_discount") > F.col("l_tax"), F.lit("discount above tax")),
        "null": F.when(F.col("l_linestatus").isNull(), F.lit("l_linestatus"))}, row_digest(*landing.LINE_COLS))


@register("k6_converge_partitions_written", f"""WITH m AS (SELECT COUNT(*) AS n FROM ({MONTHS_SQL}))
SELECT run, CAST(written AS BIGINT) AS written, CAST(dropped AS BIGINT) AS dropped, CAST(same AS BIGINT) AS unchanged FROM (
  SELECT 'first' AS run, n AS written, 0 AS dropped, 0 AS same FROM m
  UNION ALL SELECT 'equal source', 0, 0, n FROM m
  UNION ALL SELECT 'one value changed', 1, 0, n - 1 FROM m
  UNION ALL SELECT 'one month gone', 0, 1, n - 1 FROM m)""")
def k6_written(spark, d):
    """Partitions that four converging merges of the monthly rows write, drop and leave alone."""
    store = SnapshotStore(spark, scratch_path(spark, f"store-k6-{uuid.uuid4().hex}"))
    li = Tables(spark, d).lineitem.select(*landing.LINE_COLS).withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    last = li.agg(F.max("period").alias("p")).first()["p"]
    revised = li.withColumn("l_tax", F.when(F.col("period") == last, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    out = []
    for name, source in (("first", li), ("equal source", li.repartition(7)), ("one value changed", revised),
                         ("one month gone", revised.filter(F.col("period") != last))):
        got = merge.converge(store, "lines", source, "period")
        out.append((name, got["partitions_written"], got["partitions_dropped"], got["partitions_unchanged"]))
    return spark.createDataFrame(out, "run string, written long, dropped long, unchanged long")


@register("k6_converged_rows", """
SELECT strftime(l_shipdate, '%Y-%m') AS period, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS tax
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""")
def k6_rows(spark, d):
    store = SnapshotStore(spark, scratch_path(spark, f"store-k6-{uuid.uuid4().hex}"))
    li = Tables(spark, d).lineitem.select(*landing.LINE_COLS).withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    merge.converge(store, "lines", li, "period")
    merge.converge(store, "lines", li.filter("l_returnflag <> 'R'"), "period")
    return store.read_partitioned("lines").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("period")).agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.sum(F.col("l_tax").cast("decimal(18,2)")).cast("decimal(38,2)").alias("tax"))


RESPONSE_KEYS = ["coordinate_id", "requested_start_date", "requested_end_date", "weather_model"]


@register("c6_response_landing_scenarios", f"""
WITH n AS (SELECT COUNT(DISTINCT coordinate_id || CAST(CAST(ts AS DATE) AS VARCHAR)) AS d FROM {oracle.OBSERVED})
SELECT scenario, CAST(content_not_loaded AS BIGINT) AS content_not_loaded, CAST(target_empty AS BIGINT) AS target_empty,
       CAST(rows_differ AS BIGINT) AS rows_differ, CAST(rows_of_dead_batches AS BIGINT) AS rows_of_dead_batches,
       CAST(ins AS BIGINT) AS inserted, CAST(upd AS BIGINT) AS updated, CAST(same AS BIGINT) AS unchanged, written FROM (
  SELECT '1 first load' AS scenario, 1 AS content_not_loaded, 1 AS target_empty, 0 AS rows_differ, 0 AS rows_of_dead_batches,
         d AS ins, 0 AS upd, 0 AS same, true AS written FROM n
  UNION ALL SELECT '2 same again', 0, 0, 0, 0, 0, 0, 0, false FROM n
  UNION ALL SELECT '3 volatile field only', 1, 0, 0, 0, 0, 0, d, false FROM n
  UNION ALL SELECT '4 revised value', 1, 0, 1, 0, 0, 1, d - 1, true FROM n
  UNION ALL SELECT '5 demoted batch', 0, 0, 0, d - 1, 0, d - 1, 1, true FROM n
  UNION ALL SELECT '6 emptied target', 0, 1, 0, 0, d, 0, 0, true FROM n)""")
def c6_scenarios(spark, d):
    """Six deliveries of the daily weather responses to one target; what each finds and does."""
    store = SnapshotStore(spark, scratch_path(spark, f"store-c6-{uuid.uuid4().hex}"))
    docs = star(spark, d).weather_documents().drop("source_system")
    first_day = docs.agg(F.min("requested_start_date").alias("d")).first()["d"]
    at = lambda seconds: docs.withColumn("generationtime_ms", F.lit(seconds))
    value = F.when(F.col("requested_start_date") == F.lit(first_day), F.col("hourly").withField(
        "precipitation", F.transform("hourly.precipitation", lambda x: x + 1))).otherwise(F.col("hourly"))
    revised = at(3.0).withColumn("hourly", value)
    out = []

    def go(name, delivered):
        r = land_responses(store, "weather_raw", delivered, RESPONSE_KEYS, ["generationtime_ms"], "hourly_events", "events", name)
        out.append((name, r["content_not_loaded"], r["target_empty"], r["rows_differ"], r["rows_of_dead_batches"], r["insert"],
                    r["update"], r["unchanged"], r["written"]))

    go("1 first load", at(1.0))
    first = control.latest_state(store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA))
    first = spark.createDataFrame(first.collect(), first.schema)  # one batch
    go("2 same again", at(1.0))
    go("3 volatile field only", at(2.5))
    go("4 revised value", revised)
    store.append("ingestion_batches", control.batch_events(first.drop("event_at"), "SUPERSEDED"))
    go("5 demoted batch", revised)
    store.write("weather_raw", store.read("weather_raw").limit(0))
    go("6 emptied target", revised)
    return spark.createDataFrame(out, "scenario string, content_not_loaded long, target_empty long, rows_differ long, "
                                      "rows_of_dead_batches long, inserted long, updated long, unchanged long, written boolean")


@register("c9_landed_responses", f"""
WITH h AS (SELECT CAST(date_trunc('hour', ts) AS DATE) AS day, COUNT(DISTINCT date_trunc('hour', ts)) AS hours, coordinate_id FROM {oracle.OBSERVED} GROUP BY 1, 3)
SELECT day AS requested_start_date, CAST(hours AS INTEGER) AS hours, 'hourly_events' AS source_system, 'events' AS source_url, 'SUCCESS' AS status,
       (SELECT min(CAST(to_json({{'coordinate_id': coordinate_id, 'requested_start_date': day, 'requested_end_date': day,
                                 'weather_model': 'events_hourly'}}) AS VARCHAR)) FROM h) AS request_parameters
FROM h""")
def c9_landed(spark, d):
    """The stored rows with the batch that the log names for them."""
    store = SnapshotStore(spark, scratch_path(spark, f"store-c9-{uuid.uuid4().hex}"))
    docs = star(spark, d).weather_documents().drop("source_system").withColumn("generationtime_ms", F.lit(1.0))
    land_responses(store, "weather_raw", docs, RESPONSE_KEYS, ["generationtime_ms"], "hourly_events", "events", "events.json")
    state = control.latest_state(store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA))
    rows = store.read("weather_raw").join(state.select("batch_id", "status", "request_parameters"), "batch_id")
    return rows.select("requested_start_date", F.size("hourly.time").alias("hours"), "source_system", "source_url", "status", "request_parameters")


@register("c21_guards_stop_publication", """
WITH r AS (SELECT COUNT(*) AS n FROM (SELECT 1 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                                      GROUP BY l.l_orderkey, l.l_linenumber HAVING COUNT(*) > 1))
SELECT guard, stopped FROM (
  SELECT 'none broken' AS guard, false AS stopped FROM r UNION ALL SELECT 'quarantine rate', n > 0 FROM r
  UNION ALL SELECT 'repeated zone key', true FROM r UNION ALL SELECT 'dates missing', true FROM r
  UNION ALL SELECT 'classifications missing', true FROM r)""")
def c21_guards(spark, d):
    """The star's build with nothing broken, and with one violation planted per guard: does it stop?"""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    base = star(spark, d)
    shared = {"raw_trips": base.raw_trips(), "weather_documents": base.weather_documents()}
    measured = {}
    out = []

    def stops(name, build, **options):
        s = StarBuild(spark, d, **options)
        s.cache |= shared if not options else {k: shared[k] for k in ("raw_trips", "weather_documents")}
        s.measured |= {} if options else measured
        try:
            build(s)
            out.append((name, False))
            if not options:  # the whole build passed: later ones start from its Silver, which no planted violation touches
                shared.update({k: s.cache[k] for k in ("decided", "weather")})
                measured["decided"] = s.measured["decided"]
        except (GuardError, PySparkException, Py4JJavaError) as e:  # the last where both roles' lookups fail at once
            if not isinstance(e, GuardError) and "lookup key is not unique" not in str(e):
                raise
            out.append((name, True))

    def with_table(name, change, then):
        def build(s):
            s.cache[name] = change(getattr(s, {"dim_wc": "dim_weather_classification"}.get(name, name))())
            then(s)
        return build

    stops("none broken", lambda s: s.materialise())
    stops("quarantine rate", lambda s: s.decided(), max_quarantine_pct=0.0)
    stops("repeated zone key", with_table("zones", lambda z: z.unionByName(z), lambda s: s.zone_map()))
    stops("dates missing", with_table("dim_date", lambda x: x.limit(1), lambda s: s.materialise()))
    stops("classifications missing", with_table("dim_wc", lambda x: x.limit(0), lambda s: s.weather_fact()))
    return spark.createDataFrame(out, "guard string, stopped boolean")


# --- trips from landed files: provenance on the fact (I2, C30, C31, C51, C55) -----------------------------------

# the month whose file brings a trip: its drop-off's (see TripLandingRun.deliver)
TRIP_MONTH = "COALESCE(strftime({}.dropoff_datetime_local, '%Y-%m'), '2024-03')"
IN_FILE = "'trips_' || " + TRIP_MONTH + " || '.parquet'"


def landed_star(spark, d):
    run = landing.TripLandingRun(spark, d)
    run.deliver()
    run.load()
    return run, StarBuild(spark, d, landed=run)


@register("c30_trip_fact_provenance", oracle.with_star(f"""
SELECT f.trip_key, {IN_FILE.format('f')} AS source_file, {TRIP_MONTH.format('f')} AS batch_period, 'SUCCESS' AS batch_status,
       CAST(1 AS BIGINT) AS control_row_count, true AS version_names_content,
       COALESCE(strftime(f.pickup_datetime_local, '%Y-%m') <> {TRIP_MONTH.format('f')}, false) AS out_of_source_file_month_flag,
       f.pickup_in_reporting_window_flag
FROM fact f"""))
def c30_provenance(spark, d):
    """The trip fact over landed files, each trip traced to the batch that brought it and that batch's file version."""
    run, s = landed_star(spark, d)
    batches = run.batch_state().select("batch_id", F.col("source_period").alias("batch_period"), F.col("status").alias("batch_status"),
                                       F.col("content_sha256").alias("batch_content"))
    fact = s.materialise().trip_fact().join(batches, "batch_id", "left")
    named = F.col("source_file_version") == F.concat(F.lit("trips_"), F.substring("batch_content", 1, 12))
    return fact.select("trip_key", "source_file", "batch_period", "batch_status", "control_row_count",
                       F.coalesce(named, F.lit(False)).alias("version_names_content"),
                       "out_of_source_file_month_flag", "pickup_in_reporting_window_flag")


@register("i2_late_trips_per_file", oracle.with_star(f"""
SELECT {IN_FILE.format('t')} AS source_file, CAST(COUNT(*) AS BIGINT) AS landed_rows,
       CAST(COUNT_IF(collision_count = 1) AS BIGINT) AS published_trips,
       CAST(COUNT_IF(collision_count > 1) AS BIGINT) AS quarantined_trips,
       CAST(COUNT_IF(collision_count = 1 AND strftime(t.pickup_datetime_local, '%Y-%m') <> {TRIP_MONTH.format('t')}) AS BIGINT) AS late_trips
FROM decided t GROUP BY 1"""))
def i2_late(spark, d):
    """Rows that each file landed, and what became of them: late trips are kept and flagged, ambiguous ones quarantined."""
    _, s = landed_star(spark, d)
    count = F.count(F.lit(1)).cast("long")
    landed = s.raw_trips().groupBy("source_file").agg(count.alias("landed_rows"))
    held = s.quarantine().groupBy("source_file").agg(count.alias("quarantined_trips"))
    out = s.trip_fact().groupBy("source_file").agg(count.alias("published_trips"),
                                                   F.count_if("out_of_source_file_month_flag").cast("long").alias("late_trips"))
    return landed.join(out, "source_file", "left").join(held, "source_file", "left").na.fill(0)


@register("c51_landed_files_reconciliation", oracle.with_star(f""",
files AS (SELECT {TRIP_MONTH.format('r')} AS period, COUNT(*) AS n,
                 SUM(CAST(fare_amount_raw AS DECIMAL(18,2))) AS fare FROM raw_trips r GROUP BY 1)
SELECT scenario, period, CAST(n AS BIGINT) AS source_rows, CAST(CASE WHEN kept THEN n END AS BIGINT) AS landed_rows,
       CAST(fare AS DECIMAL(38,2)) AS source_fare, CAST(CASE WHEN kept THEN fare END AS DECIMAL(38,2)) AS landed_fare, kept AS reconciled
FROM (SELECT s.scenario, f.*, s.scenario = 'loaded' OR f.period <> (SELECT MAX(period) FROM files) AS kept
      FROM files f CROSS JOIN (VALUES ('loaded'), ('last month lost')) s(scenario))"""))
def c51_landed_files(spark, d):
    """The delivered files, read again, against the Bronze rows of each file: after the load, and after Bronze lost a file's rows."""
    run = landing.TripLandingRun(spark, d)
    run.deliver()
    run.load()
    source = per_file_totals(run.delivered_rows(), "fare_amount_raw").select(
        _period().alias("period"), F.col("rows").alias("source_rows"), F.col("fare_amount_raw_total").alias("source_fare"))
    landed = run.store.read_partitioned(run.target)
    per_file = per_file_totals(landed, "fare_amount_raw").select(
        _period().alias("period"), F.col("rows").alias("landed_rows"), F.col("fare_amount_raw_total").alias("landed_fare"))
    last = source.agg(F.max("period").alias("last"))
    lost = per_file.join(last, F.col("period") == F.col("last"), "left_anti")
    out = [source.join(side, "period", "full_outer").withColumn("scenario", F.lit(name))
           for name, side in (("loaded", per_file), ("last month lost", lost))]
    return out[0].unionByName(out[1]).select(
        "scenario", "period", "source_rows", "landed_rows", "source_fare", "landed_fare",
        (F.col("source_rows").eqNullSafe(F.col("landed_rows"))
         & F.col("source_fare").eqNullSafe(F.col("landed_fare"))).alias("reconciled"))


LANDED_SCENARIOS = ("loaded", "batch demoted", "stray rows", "file revised")


@register("dq_gate_landed_trips_scenarios", oracle.with_star(f""",
r AS (SELECT {TRIP_MONTH.format('r')} AS period, pickup_datetime_local < TIMESTAMP '{REPORTING_WINDOW[0]}'
             OR pickup_datetime_local >= TIMESTAMP '{REPORTING_WINDOW[1]}' AS outside FROM raw_trips r),
c AS (SELECT COUNT(*) AS n, COUNT(DISTINCT period) AS files, COUNT_IF(outside) AS w,
             COUNT_IF(period = (SELECT MAX(period) FROM r)) AS last_n, COUNT_IF(outside AND period = (SELECT MAX(period) FROM r)) AS last_w FROM r),
s AS (SELECT s.scenario, c.*, s.step >= 1 AS demoted, s.step >= 2 AS stray, s.step >= 3 AS revised,
             n + CASE WHEN s.step >= 2 THEN last_n ELSE 0 END AS total
      FROM c CROSS JOIN (VALUES ('loaded', 0), ('batch demoted', 1), ('stray rows', 2), ('file revised', 3)) s(scenario, step)),
x AS (SELECT scenario, 'row_count_not_empty' AS check_name, 'FAIL' AS severity, 0 AS fail_count, 1 AS total_count FROM s
      UNION ALL SELECT scenario, 'source_schema', 'FAIL', CASE WHEN stray THEN 1 ELSE 0 END, 13 FROM s
      UNION ALL SELECT scenario, 'provenance_completeness', 'FAIL', 0, total FROM s
      UNION ALL SELECT scenario, 'source_system_domain', 'FAIL', 0, total FROM s
      UNION ALL SELECT scenario, 'batch_registered_in_control', 'FAIL',
                       CASE WHEN stray THEN 2 * last_n WHEN demoted THEN last_n ELSE 0 END, total FROM s
      UNION ALL SELECT scenario, 'single_content_version', 'FAIL', CASE WHEN stray THEN 1 ELSE 0 END, files FROM s
      UNION ALL SELECT scenario, 'expected_month_coverage', 'WARN', w + CASE WHEN stray THEN last_w ELSE 0 END, total FROM s
      UNION ALL SELECT scenario, 'bronze_matches_current_files', 'FAIL', CASE WHEN revised THEN 3 WHEN stray THEN 1 ELSE 0 END, files FROM s)
SELECT scenario, check_name, CASE WHEN fail_count = 0 THEN 'PASS' WHEN severity = 'FAIL' OR fail_count * 100.0 / total_count > 0.1
       THEN 'FAIL' ELSE 'WARN' END AS status, CAST(fail_count AS BIGINT) AS fail_count, CAST(total_count AS BIGINT) AS total_count FROM x"""))
def dq_landed(spark, d):
    """The gate over landed trips after the load, and after each of three further states of one run: the last month's batch is
    demoted; its rows lie in Bronze once more under another content and without a column; its file is delivered revised but
    not loaded.  Bronze and the landing folder are read again after each change that writes to them, the log and the stored
    footers for each gate."""
    run = landing.TripLandingRun(spark, d)
    run.deliver()
    run.load()
    state = run.batch_state()
    last = state.agg(F.max_by("batch_id", "source_period").alias("batch_id"), F.max("source_period").alias("period")).first()  # one row

    def demote():
        run.store.append("ingestion_batches", control.batch_events(state.filter(F.col("batch_id") == last["batch_id"]).drop("event_at"),
                                                                   "FAILED"))

    def stray():
        rows = run.store.read_partitioned(run.target).filter(F.col("batch_id") == last["batch_id"])  # no row of the partition written
        run.store.overwrite_partitions(run.target, rows.drop("vendor_id_raw").withColumn("content_sha256", F.lit("stray")),
                                       ["content_sha256"])

    def revise():
        run.redeliver(last["period"], F.col("l_linenumber") > 1)

    gates, kept = [], {}
    written = {demote: (), stray: ("landed_trips",), revise: ("current_contents",)}  # the gate's tables that a change makes old
    for name, change in zip(LANDED_SCENARIOS, (None, *written)):
        if change:
            change()
            kept = {t: kept[t] for t in ("landed_trips", "current_contents") if t not in written[change]}
        kept = checks.landed_gate_tables(run, kept)
        gate = checks.landed_trips_gate().run(kept)
        gates.append(cut_lineage(gate, "landed_gate").withColumn("scenario", F.lit(name)))  # before the next change
    return functools.reduce(DataFrame.unionByName, gates).select("scenario", "check_name", "status", "fail_count", "total_count")


@register("c41_run_log_states", """
WITH r AS (SELECT COUNT(*) AS n FROM (SELECT 1 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                                      GROUP BY l.l_orderkey, l.l_linenumber HAVING COUNT(*) > 1))
SELECT step, CASE WHEN step = 'silver_without_collisions' AND n > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(2 AS BIGINT) AS events, true AS timed
FROM r CROSS JOIN (VALUES ('bronze_trips'), ('silver_trips'), ('silver_without_collisions')) s(step)""")
def c41_run_log(spark, d):
    """The stored run log of three steps over the trips, the last of which stops if any trip is ambiguous."""
    job = Job(spark, d, landing=False)
    job._step("bronze_trips", job.s.raw_trips)
    job._step("silver_trips", job.s.decided)
    strict = StarBuild(spark, d, max_quarantine_pct=0.0, cache={"raw_trips": job.s.raw_trips()})
    try:
        job._step("silver_without_collisions", strict.decided)
    except GuardError:
        pass  # the log holds it
    job.store.append("pipeline_runs", job.run_log())
    log = job.store.read_log("pipeline_runs")
    n = log.groupBy("run_id", "step").agg(F.count(F.lit(1)).cast("long").alias("events"))
    return run_summary(log).join(n, ["run_id", "step"]).select("step", "status", "events", (F.col("seconds") >= 0).alias("timed"))
