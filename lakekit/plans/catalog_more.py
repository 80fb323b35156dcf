"""Remaining inventory queries: JSON/CSV sources, response identity, revised deliveries, guards, gate outcomes,
gate state and DQ dashboard, weather profiling, schema/value comparisons, predicates and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakekit.functions.digest import delimited_text
from lakekit.operators import dedup, dq, fingerprint, profile
from lakekit.plans import checks, landing, oracle
from lakekit.plans.catalog import register, star
from lakekit.plans.catalog_ingest import MONTHS_SQL, _period
from lakekit.plans.catalog_ops import TYPE_MAP_SQL, ZONE_ROW_SQL, _fingerprint_sql
from lakekit.plans.oracle import sround, with_star
from lakekit.plans.tables import Tables
from lakekit.session import scratch_path
from lakekit.sources import control
from lakekit.sources.files import read_csv, read_json_documents

DOC_SCHEMA = ("weather_model string, requested_end_date date, source_system string, "
              "hourly struct<time: array<string>, temperature_2m: array<double>, precipitation: array<double>, "
              "weather_code: array<bigint>>, generationtime_ms double")


# --- S2/S3/S5/C4/C9: documents and snapshots through real files ------------------------------------------------

def _landed_documents(spark, d):
    docs = star(spark, d).weather_documents().withColumn("generationtime_ms", F.lit(1.0))
    path = scratch_path(spark, f"weather-json-{uuid.uuid4().hex}")
    docs.write.partitionBy("requested_start_date", "coordinate_id").json(path)  # one document per folder → one per file
    return read_json_documents(spark, path, DOC_SCHEMA + ", requested_start_date date, coordinate_id string")


EV_DAYS_SQL = f"""SELECT coordinate_id, CAST(date_trunc('hour', ts) AS DATE) AS day, COUNT(DISTINCT date_trunc('hour', ts)) AS hours,
       strftime(MIN(date_trunc('hour', ts)), '%Y-%m-%dT%H:%M') AS first_time FROM {oracle.OBSERVED} GROUP BY 1, 2"""


@register("s2_json_response_documents", f"""WITH e AS ({EV_DAYS_SQL})
SELECT day AS requested_start_date, CAST(hours AS INTEGER) AS hours, first_time, 'events_hourly' AS weather_model
FROM e""")
def s2_json(spark, d):
    docs = _landed_documents(spark, d)
    return docs.select("requested_start_date", F.size("hourly.time").alias("hours"),
                       F.element_at("hourly.time", 1).alias("first_time"), "weather_model")


@register("c9_response_request_metadata", f"""WITH e AS ({EV_DAYS_SQL})
SELECT day AS requested_start_date,
       CAST(to_json({{'coordinate_id': coordinate_id, 'requested_start_date': day, 'requested_end_date': day,
                     'weather_model': 'events_hourly'}}) AS VARCHAR) AS request_parameters,
       'events_hourly' AS weather_model FROM e""")
def c9_request(spark, d):
    docs = _landed_documents(spark, d)
    model = F.coalesce(F.col("weather_model"), F.lit("api_default_unpinned"))
    return docs.select("requested_start_date",
                       F.to_json(F.struct("coordinate_id", "requested_start_date", "requested_end_date",
                                          model.alias("weather_model"))).alias("request_parameters"),
                       model.alias("weather_model"))


@register("c4_response_identity_volatile_field", f"""WITH e AS ({EV_DAYS_SQL})
SELECT day AS requested_start_date, true AS content_changed, false AS version_changed FROM e""")
def c4_identity(spark, d):
    docs = star(spark, d).weather_documents()
    payload = ["coordinate_id", "weather_model", "requested_start_date", "requested_end_date", "hourly",
               "generationtime_ms"]
    a = fingerprint.response_identity(docs.withColumn("generationtime_ms", F.lit(1.0)), ["generationtime_ms"], payload)
    b = fingerprint.response_identity(docs.withColumn("generationtime_ms", F.lit(2.5)), ["generationtime_ms"], payload)
    a = a.select("coordinate_id", "requested_start_date", F.col("content_sha256").alias("ca"), F.col("source_response_version").alias("va"))
    b = b.select("coordinate_id", "requested_start_date", F.col("content_sha256").alias("cb"), F.col("source_response_version").alias("vb"))
    j = a.join(b, ["coordinate_id", "requested_start_date"])
    return j.select("requested_start_date", (F.col("ca") != F.col("cb")).alias("content_changed"),
                    (F.col("va") != F.col("vb")).alias("version_changed"))


def _zone_csv(spark, d):
    path = scratch_path(spark, f"zones-csv-{uuid.uuid4().hex}")
    star(spark, d).raw_zones().select("location_id", "borough", "zone", "service_zone") \
        .coalesce(1).write.option("header", True).csv(path)
    return read_csv(spark, path, "location_id int, borough string, zone string, service_zone string")


@register("s3_csv_zone_snapshot", with_star("SELECT location_id, borough, zone_name, service_zone, zone_classification "
                                            "FROM zones"))
def s3_csv(spark, d):
    from lakekit.operators.star import standardise_zones
    from lakekit.plans.tables import ZONE_RULE
    z = standardise_zones(_zone_csv(spark, d), **ZONE_RULE)
    return z.select("location_id", "borough", "zone_name", "service_zone", "zone_classification")


@register("s5_csv_reread_identity", f"""WITH rows AS (
  SELECT 1 AS g, sha256({ZONE_ROW_SQL}) AS digest
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
), {_fingerprint_sql('rows', 'g')}
SELECT content_sha256, row_count FROM f""")
def s5_reread(spark, d):
    z = _zone_csv(spark, d)
    rows = z.select(F.sha2(delimited_text("location_id", "borough", "zone", "service_zone"), 256).alias("row_digest"))
    return fingerprint.snapshot_fingerprint(rows).select("content_sha256", "row_count")


# --- K9/K8/C7: revised delivery supersedes the old batch -------------------------------------------------------

REVISED_SQL = f"""WITH m AS ({MONTHS_SQL}), latest AS (SELECT max(source_period) AS p FROM m),
revised AS (SELECT strftime(l_shipdate, '%Y-%m') AS source_period, COUNT(*) AS n FROM lineitem
            WHERE strftime(l_shipdate, '%Y-%m') = (SELECT p FROM latest) AND l_returnflag <> 'R' GROUP BY 1)"""


@register("k9_revised_delivery_batch_state", REVISED_SQL + """
SELECT source_period, CASE WHEN source_period = (SELECT p FROM latest) THEN 'SUPERSEDED' ELSE 'SUCCESS' END AS status,
       CAST(n AS BIGINT) AS row_count FROM m
UNION ALL SELECT source_period, 'SUCCESS', CAST(n AS BIGINT) FROM revised""")
def k9_revised(spark, d):
    run = landing.revised_delivery_state(spark, d)
    return run.batch_state().select("source_period", "status", "row_count")


@register("k8_revised_delivery_target_rows", REVISED_SQL + """
SELECT source_period, CAST(n AS BIGINT) AS rows FROM m WHERE source_period <> (SELECT p FROM latest)
UNION ALL SELECT source_period, CAST(n AS BIGINT) FROM revised""")
def k8_revised_rows(spark, d):
    run = landing.revised_delivery_state(spark, d)
    t = run.store.read_partitioned("bronze_lineitem")
    return t.groupBy(_period().alias("source_period")).agg(F.count(F.lit(1)).cast("long").alias("rows"))


@register("c31_batch_version_lookup", f"""WITH m AS ({MONTHS_SQL})
SELECT source_period, CAST(1 AS BIGINT) AS control_row_count, true AS version_resolves FROM m""")
def c31_versions(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    ev = run.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
    g = control.batch_versions(ev).join(run.batch_state().select("batch_id", "source_period"), "batch_id")
    return g.select("source_period", "control_row_count",
                    F.coalesce(F.col("source_file_version").startswith("lineitem_"), F.lit(False))
                    .alias("version_resolves"))


@register("c42_multi_batch_label", f"""
SELECT 'MULTI_BATCH:' || CAST(COUNT(DISTINCT strftime(l_shipdate, '%Y-%m')) AS VARCHAR) AS batch_label FROM lineitem""")
def c42_label(spark, d):
    run = landing.LandingRun(spark, d)
    run.deliver()
    run.load()
    t = run.store.read_partitioned("bronze_lineitem")
    g = t.agg(F.countDistinct("batch_id").alias("n"), F.max("batch_id").alias("one"))
    return g.select(F.when(F.col("n") == 1, F.col("one"))
                    .otherwise(F.concat(F.lit("MULTI_BATCH:"), F.col("n").cast("string"))).alias("batch_label"))


# --- C14/C52/C21/C22/C23: guards as reports ---------------------------------------------------------------------

@register("c14_quarantine_rate_guard", with_star(f""",
c AS (SELECT COUNT(*) AS n FROM clean), q AS (SELECT COUNT(*) AS n FROM quarantine)
SELECT CAST(c.n AS BIGINT) AS clean_rows, CAST(q.n AS BIGINT) AS quarantine_rows,
       {sround('100.0 * CAST(q.n AS DOUBLE) / CAST(c.n + q.n AS DOUBLE)', 4)} AS quarantine_pct,
       {sround('100.0 * CAST(q.n AS DOUBLE) / CAST(c.n + q.n AS DOUBLE)', 4)} > 1.0 AS halted
FROM c CROSS JOIN q"""))
def c14_rate(spark, d):
    s = star(spark, d)
    return dedup.quarantine_rate_frame(s.clean(), s.quarantine(), 1.0)


@register("c52_expected_quarantine_independent", """
WITH g AS (SELECT l.l_orderkey, l.l_linenumber, COUNT(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           GROUP BY 1, 2 HAVING COUNT(*) > 1)
SELECT CAST(COUNT(*) AS BIGINT) AS duplicate_groups, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS expected_quarantine_rows,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows FROM g""")
def c52_expected(spark, d):
    return dedup.expected_quarantine_rows(star(spark, d).raw_trips(), ["l_orderkey", "l_linenumber"])


@register("c21_dimension_key_guard", with_star("""
SELECT 'dim_zone' AS dimension, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(COUNT(*) - COUNT(DISTINCT location_id) AS BIGINT) AS duplicate_keys FROM dim_zone
UNION ALL SELECT 'dim_date', COUNT(*), COUNT(*) - COUNT(DISTINCT full_date) FROM dim_date
UNION ALL SELECT 'dim_hour', COUNT(*), COUNT(*) - COUNT(DISTINCT hour_of_day) FROM dim_hour
UNION ALL SELECT 'dim_weather_classification', COUNT(*),
                 COUNT(*) - COUNT(DISTINCT (weather_code, precipitation_band)) FROM dim_wc"""))
def c21_guard(spark, d):
    s = star(spark, d)

    def rep(name, df, keys):
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return g.agg(F.sum("n").cast("long").alias("rows"), F.sum(F.col("n") - 1).cast("long").alias("duplicate_keys")) \
            .select(F.lit(name).alias("dimension"), "rows", "duplicate_keys")
    return (rep("dim_zone", s.dim_zone(), ["location_id"]).unionByName(rep("dim_date", s.dim_date(), ["full_date"]))
            .unionByName(rep("dim_hour", s.dim_hour(), ["hour_of_day"]))
            .unionByName(rep("dim_weather_classification", s.dim_weather_classification(),
                             ["weather_code", "precipitation_band"])))


@register("c22_required_key_guard", with_star("""
SELECT CAST(COUNT_IF(pickup_date_key IS NULL OR dropoff_date_key IS NULL OR pickup_hour_key IS NULL
                     OR dropoff_hour_key IS NULL) AS BIGINT) AS missing_date_hour_keys,
       CAST(COUNT_IF(weather_match_status = 'matched_unique' AND pickup_weather_classification_key IS NULL) AS BIGINT)
         AS matched_without_class_key,
       CAST(COUNT(*) AS BIGINT) AS fact_rows FROM fact"""))
def c22_guard(spark, d):
    f = star(spark, d).trip_fact()
    return f.agg(
        F.count_if(F.col("pickup_date_key").isNull() | F.col("dropoff_date_key").isNull()
                   | F.col("pickup_hour_key").isNull() | F.col("dropoff_hour_key").isNull()).cast("long")
        .alias("missing_date_hour_keys"),
        F.count_if((F.col("weather_match_status") == "matched_unique")
                   & F.col("pickup_weather_classification_key").isNull()).cast("long").alias("matched_without_class_key"),
        F.count(F.lit(1)).cast("long").alias("fact_rows"))


@register("c23_publish_guard", with_star("""
SELECT CAST((SELECT COUNT(*) FROM (SELECT trip_key FROM fact GROUP BY trip_key HAVING COUNT(*) > 1)) AS BIGINT)
         AS duplicate_trip_keys,
       CAST((SELECT COUNT_IF(source_system IS NULL) FROM clean) AS BIGINT) AS rows_without_lineage"""))
def c23_guard(spark, d):
    s = star(spark, d)
    dup = s.trip_fact().groupBy("trip_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .agg(F.count(F.lit(1)).cast("long").alias("duplicate_trip_keys"))
    lin = s.clean().agg(F.count_if(F.col("source_system").isNull()).cast("long").alias("rows_without_lineage"))
    return dup.crossJoin(lin)  # two one-row aggregates


# --- C39/C40/C50/D2: gate outcomes, gate state, DQ dashboard ---------------------------------------------------

def _all_gate_results(spark, d):
    """Every gate's result rows (a few dozen per gate), each written once as its own small table: the dashboards
    and status views then work on those rows instead of one plan spanning every gate of the star."""
    from lakekit.session import cut_lineage
    s = star(spark, d)
    s.staged_fact()  # before the questions, which read it too
    tables = checks.gate_tables(s)
    return dq.union_results(*[cut_lineage(make().run(tables), f"gate_{name}") for name, make in checks.GATES.items()])


ALL_GATES_SQL = "\nUNION ALL\n".join(
    f"SELECT * FROM ({make().sql(oracle.ANALYTICS_CTES if name == 'analytics' else oracle.STAR)})"
    for name, make in checks.GATES.items())


@register("d2_gate_status_latest_run", f"""WITH r AS ({ALL_GATES_SQL})
SELECT layer, dataset, CASE WHEN COUNT_IF(status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CAST(COUNT(*) AS BIGINT) AS checks_run, CAST(COUNT_IF(status = 'FAIL') AS BIGINT) AS fail_count,
       CAST(COUNT_IF(status = 'WARN') AS BIGINT) AS warn_count, CAST(COUNT_IF(status = 'PASS') AS BIGINT) AS pass_count,
       CAST(COUNT_IF(status = 'INFO') AS BIGINT) AS info_count, 'run_2' AS run_id
FROM r GROUP BY layer, dataset""")
def d2_status(spark, d):
    res = _all_gate_results(spark, d)
    log = dq.with_run(res, "run_1", "2026-01-01 00:00:00").unionByName(dq.with_run(res, "run_2", "2026-01-01 00:00:00"))
    return dq.gate_status(log).select("layer", "dataset", "status", "checks_run", "fail_count", "warn_count",
                                      "pass_count", "info_count", "run_id")


@register("c39_gate_outcomes", f"""WITH r AS ({ALL_GATES_SQL})
SELECT layer, dataset, COUNT_IF(status = 'FAIL') > 0 AS blocked,
       CAST(COUNT_IF(status = 'FAIL') AS BIGINT) AS failed_checks FROM r GROUP BY layer, dataset""")
def c39_outcomes(spark, d):
    res = _all_gate_results(spark, d)
    return res.groupBy("layer", "dataset").agg((F.count_if(F.col("status") == "FAIL") > 0).alias("blocked"),
                                               F.count_if(F.col("status") == "FAIL").cast("long").alias("failed_checks"))


@register("c50_dq_dashboard_checks_by_status", f"""WITH r AS ({ALL_GATES_SQL})
SELECT layer, status, CAST(COUNT(*) AS BIGINT) AS checks, CAST(SUM(fail_count) AS BIGINT) AS failing_rows
FROM r GROUP BY layer, status""")
def c50_dashboard(spark, d):
    res = _all_gate_results(spark, d)
    return res.groupBy("layer", "status").agg(F.count(F.lit(1)).cast("long").alias("checks"),
                                              F.sum("fail_count").cast("long").alias("failing_rows"))


def _two_runs(spark, d):
    """A results log of two runs: the first of every gate, a later one of all but Analytics; with the status of each gate."""
    res = _all_gate_results(spark, d)
    log = dq.with_run(res, "run_1", "2026-01-01 00:00:00").unionByName(
        dq.with_run(res.filter("layer <> 'analytics'"), "run_2", "2026-01-02 00:00:00"))
    return log, dq.gate_status(log)


_CHARTS = {  # chart -> (label, rows, value)
    "datasets_validated": ("'all'", "(SELECT DISTINCT layer, dataset FROM r)", "COUNT(*)"),
    "pass_trend": ("run_id", "(SELECT status, 'run_1' AS run_id FROM r UNION ALL SELECT status, 'run_2' FROM r WHERE layer <> 'analytics')"
                   " WHERE status = 'PASS'", "COUNT(*)"),
    "checks_by_layer": ("layer", "r", "COUNT(*)"), "checks_by_dataset": ("dataset", "r", "COUNT(*)"),
    "failures_by_dataset": ("dataset", "r WHERE status = 'FAIL'", "COUNT(*)"),
    "failures_by_type": ("check_type", "r WHERE status = 'FAIL'", "COUNT(*)"),
    "checks_failed": ("'all'", "r", "COUNT_IF(status = 'FAIL')"), "checks_warned": ("'all'", "r", "COUNT_IF(status = 'WARN')"),
    "checks_passed": ("'all'", "r", "COUNT_IF(status = 'PASS')"),
    "pass_rate_bp": ("'all'", "r", "10000 * COUNT_IF(status = 'PASS') // COUNT_IF(status <> 'INFO')"),
    "latest_run_by_layer": ("layer", "r", "MAX(epoch(CASE WHEN layer = 'analytics' THEN TIMESTAMP '2026-01-01 00:00:00' "
                                          "ELSE TIMESTAMP '2026-01-02 00:00:00' END))"),
}


@register("c50_dq_dashboard_charts", f"WITH r AS ({ALL_GATES_SQL})\n" + "\nUNION ALL ".join(
    f"SELECT '{chart}' AS chart, {label} AS label, CAST({value} AS BIGINT) AS value FROM {rows} GROUP BY 2"
    for chart, (label, rows, value) in _CHARTS.items()))
def c50_charts(spark, d):
    """Every figure of the data-quality dashboard over two runs of the gates."""
    return dq.dashboard_charts(*_two_runs(spark, d))


@register("c50_dq_open_issues", f"""WITH r AS ({ALL_GATES_SQL})
SELECT layer, dataset, check_name, check_type, status, fail_count, total_count FROM r WHERE status IN ('FAIL', 'WARN')""")
def c50_issues(spark, d):
    """Failed and warned checks of each gate's latest run, over two runs of the gates."""
    return dq.open_issues(*_two_runs(spark, d)).drop("details")


@register("c40_upstream_gate_dependency", f"""WITH r AS ({ALL_GATES_SQL}),
s AS (SELECT layer, dataset, COUNT_IF(status = 'FAIL') = 0 AS passed FROM r GROUP BY layer, dataset),
req AS (SELECT * FROM (VALUES ('silver', 'trips'), ('silver', 'zones'), ('silver', 'weather_hourly'),
                              ('gold', 'never_run')) t(layer, dataset))
SELECT req.layer, req.dataset, COALESCE(s.passed, false) AS upstream_passed
FROM req LEFT JOIN s ON req.layer = s.layer AND req.dataset = s.dataset""")
def c40_dependency(spark, d):
    res = _all_gate_results(spark, d)
    st = dq.gate_status(dq.with_run(res, "run_1", "2026-01-01 00:00:00"))
    req = spark.createDataFrame([("silver", "trips"), ("silver", "zones"), ("silver", "weather_hourly"),
                                 ("gold", "never_run")], "layer string, dataset string")
    j = req.join(st.select("layer", "dataset", "status"), ["layer", "dataset"], "left")
    return j.select("layer", "dataset", F.coalesce(F.col("status") == "PASS", F.lit(False)).alias("upstream_passed"))


# --- C48: weather profiling ----------------------------------------------------------------------------------

@register("c48_weather_profile", with_star("""
SELECT CAST(COUNT(*) AS BIGINT) AS hours, CAST(COUNT(*) - COUNT(DISTINCT observation_timestamp_utc) AS BIGINT)
         AS duplicate_times,
       CAST(COUNT_IF(temperature_2m_c IS NULL) AS BIGINT) AS null_temperature,
       CAST(COUNT_IF(precipitation_mm IS NULL) AS BIGINT) AS null_precipitation,
       CAST(COUNT_IF(weather_code IS NULL) AS BIGINT) AS null_code,
       CAST(COUNT(DISTINCT weather_code) AS BIGINT) AS distinct_codes,
       CAST(COUNT_IF(precipitation_mm < 0) AS BIGINT) AS negative_precipitation,
       CAST(date_sub('hour', MIN(observation_timestamp_utc), MAX(observation_timestamp_utc)) + 1 AS BIGINT)
         AS expected_hours
FROM weather"""))
def c48_profile(spark, d):
    from lakekit.functions.timeops import seconds_between
    w = star(spark, d).weather()
    g = w.groupBy("observation_timestamp_utc").agg(F.count(F.lit(1)).alias("__n"))
    dup = g.agg(F.sum(F.col("__n") - 1).cast("long").alias("duplicate_times"))
    one = w.agg(F.count(F.lit(1)).cast("long").alias("hours"),
                F.count_if(F.col("temperature_2m_c").isNull()).cast("long").alias("null_temperature"),
                F.count_if(F.col("precipitation_mm").isNull()).cast("long").alias("null_precipitation"),
                F.count_if(F.col("weather_code").isNull()).cast("long").alias("null_code"),
                F.countDistinct("weather_code").cast("long").alias("distinct_codes"),
                F.count_if(F.col("precipitation_mm") < 0).cast("long").alias("negative_precipitation"),
                (F.floor(seconds_between(F.min("observation_timestamp_utc"), F.max("observation_timestamp_utc"))
                         / 3600) + 1).cast("long").alias("expected_hours"))
    return one.crossJoin(dup)  # two one-row aggregates


# --- J7/J14: schema signature compare, key-matched value drift --------------------------------------------------

@register("j7_signature_compare_documents_benchmark", f"""
WITH a AS (SELECT column_name, {TYPE_MAP_SQL} AS actual_type, CAST(ordinal_position AS INTEGER) AS actual_ordinal
           FROM information_schema.columns WHERE table_name = 'documents'),
e AS (SELECT column_name, {TYPE_MAP_SQL} AS expected_type, CAST(ordinal_position AS INTEGER) AS expected_ordinal
      FROM information_schema.columns WHERE table_name = 'benchmark')
SELECT COALESCE(a.column_name, e.column_name) AS column_name, actual_type, actual_ordinal, expected_type,
       expected_ordinal
FROM a FULL OUTER JOIN e ON a.column_name = e.column_name
WHERE actual_ordinal IS DISTINCT FROM expected_ordinal OR actual_type IS DISTINCT FROM expected_type""")
def j7_compare(spark, d):
    t = Tables(spark, d)
    sig = lambda n: profile.schema_signature_frame(spark, {n: getattr(t, n).schema})
    return profile.signature_mismatches(sig("documents"), sig("benchmark")).select(
        "column_name", "actual_type", "actual_ordinal", "expected_type", "expected_ordinal")


@register("j14_zone_value_drift_bronze_silver", with_star("""
SELECT CAST(COUNT(*) AS BIGINT) AS matched_zones,
       CAST(COUNT_IF(s.borough IS DISTINCT FROM b.borough) AS BIGINT) AS borough_changed,
       CAST(COUNT_IF(s.zone_name IS DISTINCT FROM b.zone) AS BIGINT) AS zone_name_changed,
       CAST(COUNT_IF(s.service_zone IS DISTINCT FROM b.service_zone) AS BIGINT) AS service_zone_changed
FROM zones s JOIN bronze_zones b ON s.location_id = b.location_id"""))
def j14_drift(spark, d):
    s = star(spark, d)
    z, b = s.zones().alias("s"), s.raw_zones().alias("b")
    j = z.join(b, F.col("s.location_id") == F.col("b.location_id"))
    return j.agg(F.count(F.lit(1)).cast("long").alias("matched_zones"),
                 F.count_if(~F.col("s.borough").eqNullSafe(F.col("b.borough"))).cast("long").alias("borough_changed"),
                 F.count_if(~F.col("s.zone_name").eqNullSafe(F.col("b.zone"))).cast("long").alias("zone_name_changed"),
                 F.count_if(~F.col("s.service_zone").eqNullSafe(F.col("b.service_zone"))).cast("long")
                 .alias("service_zone_changed"))


# --- O1: ordered resolution summary ---------------------------------------------------------------------------

@register("o1_zone_resolution_summary", with_star("""
SELECT pickup_zone_match_status, dropoff_zone_match_status, CAST(COUNT(*) AS BIGINT) AS trips
FROM zone_map GROUP BY 1, 2 ORDER BY trips DESC"""))
def o1_summary(spark, d):
    zm = star(spark, d).zone_map()
    return (zm.groupBy("pickup_zone_match_status", "dropoff_zone_match_status")
            .agg(F.count(F.lit(1)).cast("long").alias("trips")).orderBy(F.col("trips").desc()))


# --- P6–P11: predicates ----------------------------------------------------------------------------------------

@register("p6_p11_predicates_on_orders", """
SELECT o_orderstatus,
  CAST(COUNT_IF(o_totalprice BETWEEN 100000 AND 200000) AS BIGINT) AS price_between,
  CAST(COUNT_IF(o_totalprice NOT BETWEEN 100000 AND 200000) AS BIGINT) AS price_not_between,
  CAST(COUNT_IF(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS urgent,
  CAST(COUNT_IF(o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS not_urgent,
  CAST(COUNT_IF(o_orderpriority LIKE '%LOW%') AS BIGINT) AS like_low,
  CAST(COUNT_IF(o_custkey IS NOT DISTINCT FROM o_orderkey) AS BIGINT) AS null_safe_equal,
  CAST(COUNT_IF((o_totalprice > 250000) <> (o_orderpriority = '1-URGENT')) AS BIGINT) AS xor_flag,
  CAST(COUNT_IF(COALESCE(o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00',
                         false)) AS BIGINT) AS in_1997_window,
  CAST(COUNT_IF((o_totalprice > 400000) IS NOT TRUE) AS BIGINT) AS not_true_large
FROM orders GROUP BY o_orderstatus HAVING COUNT(*) > 0""")
def p_predicates(spark, d):
    from lakekit.functions.flags import not_true
    from lakekit.functions.timeops import in_half_open_window
    o = Tables(spark, d).orders
    return o.groupBy("o_orderstatus").agg(
        F.count_if(F.col("o_totalprice").between(100000, 200000)).cast("long").alias("price_between"),
        F.count_if(~F.col("o_totalprice").between(100000, 200000)).cast("long").alias("price_not_between"),
        F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).cast("long").alias("urgent"),
        F.count_if(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).cast("long").alias("not_urgent"),
        F.count_if(F.col("o_orderpriority").like("%LOW%")).cast("long").alias("like_low"),
        F.count_if(F.col("o_custkey").eqNullSafe(F.col("o_orderkey"))).cast("long").alias("null_safe_equal"),
        F.count_if((F.col("o_totalprice") > 250000) != (F.col("o_orderpriority") == "1-URGENT")).cast("long")
        .alias("xor_flag"),
        F.count_if(in_half_open_window("o_orderdate", "1997-01-01 00:00:00", "1998-01-01 00:00:00")).cast("long")
        .alias("in_1997_window"),
        F.count_if(not_true(F.col("o_totalprice") > 400000)).cast("long").alias("not_true_large"),
        F.count(F.lit(1)).alias("__n")).filter("__n > 0").drop("__n")


# --- 2.10: scalar function families ------------------------------------------------------------------------------

@register("f_string_math_functions", f"""
SELECT c_custkey,
  concat(c_name, '#', c_mktsegment) AS f_concat, concat_ws('|', c_name, c_mktsegment) AS f_concat_ws,
  upper(trim(c_mktsegment)) AS f_upper, lower(c_mktsegment) AS f_lower, substr(c_name, 1, 8) AS f_substring,
  regexp_extract(c_name, '#(\\d+)', 1) AS f_regexp, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS f_lpad,
  CAST(length(c_name) AS INTEGER) AS f_length, split(c_name, '#')[-1] AS f_last_part,
  array_to_string(list_sort([c_mktsegment, c_name]), ',') AS f_sorted_join,
  CAST(len(split(c_name, '0')) AS INTEGER) AS f_size, list_contains([1, 2, 3], c_nationkey) AS f_contains,
  {sround('c_acctbal', 1)} AS f_round, abs(c_acctbal) AS f_abs, greatest(c_acctbal, 0.0) AS f_greatest,
  c_acctbal / NULLIF(c_nationkey, 0) AS f_try_divide, COALESCE(NULLIF(c_nationkey, 0), -1) AS f_coalesce_nullif,
  sha256(c_name) AS f_sha2, CAST(c_acctbal AS DECIMAL(12,2)) AS f_decimal,
  CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal = 0 THEN 'zero' ELSE 'positive' END AS f_case
FROM customer""")
def f_strings(spark, d):
    c = Tables(spark, d).customer
    return c.select(
        "c_custkey",
        F.concat("c_name", F.lit("#"), "c_mktsegment").alias("f_concat"),
        F.concat_ws("|", "c_name", "c_mktsegment").alias("f_concat_ws"),
        F.upper(F.trim("c_mktsegment")).alias("f_upper"), F.lower("c_mktsegment").alias("f_lower"),
        F.substring("c_name", 1, 8).alias("f_substring"),
        F.regexp_extract("c_name", r"#(\d+)", 1).alias("f_regexp"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("f_lpad"),
        F.length("c_name").alias("f_length"),
        F.element_at(F.split("c_name", "#"), -1).alias("f_last_part"),
        F.array_join(F.array_sort(F.array("c_mktsegment", "c_name")), ",").alias("f_sorted_join"),
        F.size(F.split("c_name", "0")).alias("f_size"),
        F.array_contains(F.array(F.lit(1), F.lit(2), F.lit(3)), F.col("c_nationkey")).alias("f_contains"),
        F.round("c_acctbal", 1).alias("f_round"), F.abs("c_acctbal").alias("f_abs"),
        F.greatest("c_acctbal", F.lit(0.0)).alias("f_greatest"),
        F.try_divide("c_acctbal", "c_nationkey").alias("f_try_divide"),
        F.coalesce(F.nullif("c_nationkey", F.lit(0)), F.lit(-1)).alias("f_coalesce_nullif"),
        F.sha2("c_name", 256).alias("f_sha2"), F.col("c_acctbal").cast("decimal(12,2)").alias("f_decimal"),
        F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") == 0, "zero").otherwise("positive")
        .alias("f_case"))


@register("f_date_functions", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS f_date_format, CAST(year(o_orderdate) AS INTEGER) AS f_year,
  CAST(quarter(o_orderdate) AS INTEGER) AS f_quarter, CAST(month(o_orderdate) AS INTEGER) AS f_month,
  CAST(day(o_orderdate) AS INTEGER) AS f_day, CAST(isodow(o_orderdate) AS INTEGER) AS f_iso_weekday,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS f_date_add,
  CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS f_datediff,
  strftime(o_orderdate, '%B') AS f_month_name, strftime(o_orderdate, '%A') AS f_day_name,
  CAST(hour(o_orderdate) AS INTEGER) AS f_hour
FROM orders""")
def f_dates(spark, d):
    o = Tables(spark, d).orders
    day = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("f_date_format"),
        F.year("o_orderdate").alias("f_year"), F.quarter("o_orderdate").alias("f_quarter"),
        F.month("o_orderdate").alias("f_month"), F.dayofmonth("o_orderdate").alias("f_day"),
        (F.weekday(day) + 1).alias("f_iso_weekday"), F.date_add(day, 30).alias("f_date_add"),
        F.datediff(day, F.to_date(F.lit("1995-01-01"))).alias("f_datediff"),
        F.date_format("o_orderdate", "MMMM").alias("f_month_name"),
        F.date_format("o_orderdate", "EEEE").alias("f_day_name"), F.hour("o_orderdate").alias("f_hour"))
