"""Landing by ledger, footer drift, fingerprints, converging merges, response landing, guards and non-empty classes."""

import datetime as dt
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakekit.functions.digest import row_digest
from lakekit.operators import dq, fingerprint, merge, metrics, profile, series
from lakekit.operators.guards import write_guarded
from lakekit.operators.resolve import GuardError, resolve_roles
from lakekit.plans import landing
from lakekit.plans.job import Job, run_summary
from lakekit.plans.tables import Tables
from lakekit.plans.trips import StarBuild, WEATHER_MAP_SCHEMA, ZONE_MAP_SCHEMA
from lakekit.session import cut_lineage, scratch_path
from lakekit.sources import files
from lakekit.sources.store import SnapshotStore
from tests.conftest import SF_SMALL


def test_fingerprint_is_a_plain_sum(spark):
    rows = spark.range(0, 3000).select((F.col("id") % 3).alias("file"), row_digest(F.col("id") % 700).alias("row_digest"))
    base = fingerprint.content_fingerprint(rows, ["file"])
    plan = base._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "Window" not in plan
    shuffled = fingerprint.content_fingerprint(rows.orderBy(F.rand(3)).repartition(11), ["file"])
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, shuffled.collect()))
    moved = rows.withColumn("file", F.when(F.col("row_digest") == rows.first()["row_digest"], 1).otherwise(F.col("file")))
    other = fingerprint.content_fingerprint(moved, ["file"])
    assert not {r["content_sha256"] for r in base.collect()} & {r["content_sha256"] for r in other.collect()}  # all three changed


def test_sorted_fingerprint_hashes_the_digests_themselves(spark):
    rows = spark.range(0, 3000).select((F.col("id") % 3).alias("file"), row_digest(F.col("id") % 700).alias("row_digest"))
    got = {r["file"]: (r["content_sha256"], r["row_count"]) for r in fingerprint.sorted_fingerprint(rows.repartition(7), ["file"]).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for file in range(3):
        counts = Counter(r["row_digest"] for r in rows.filter(F.col("file") == file).collect())
        parts = {}
        for digest, n in counts.items():
            parts.setdefault(digest[:3], []).append(f"{digest}x{n}")
        joined = ",".join(sorted(f"{b}:{sha(','.join(sorted(x)))}" for b, x in parts.items()))
        assert got[file] == (sha(joined), 1000)
    # the lanes' sums of these two sets of digests are equal
    lane = lambda *x: "".join(f"{v:016x}" for v in x)
    sets = [("a", lane(1, 5, 7, 9)), ("a", lane(3, 5, 7, 9)), ("b", lane(2, 5, 7, 9)), ("b", lane(2, 5, 7, 9))]
    got = fingerprint.sorted_fingerprint(spark.createDataFrame(sets, "file string, row_digest string"), "file").collect()
    assert len({r["content_sha256"] for r in got}) == 2


@pytest.fixture(scope="module")
def two_months(spark):
    li = Tables(spark, SF_SMALL).lineitem.select(*landing.LINE_COLS).withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    months = [r["period"] for r in li.select("period").distinct().orderBy("period").limit(2).collect()]
    return months, {m: li.filter(F.col("period") == m) for m in months}


def _deliver(run, rows, mode="append"):
    rows.coalesce(1).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(run.landing)


def test_second_run_opens_no_file_and_a_drifted_file_is_refused_until_mended(spark, two_months):
    (m1, m2), rows = two_months
    run = landing.LandingRun(spark, SF_SMALL)
    _deliver(run, rows[m1])
    assert run.load().count() == 1 and len(run.opened) == 1
    assert run.load().count() == 0 and run.opened == []
    _deliver(run, rows[m2].drop("l_tax"))
    assert run.load().count() == 0 and run.opened == []
    assert sorted((r["source_period"], r["status"]) for r in run.batch_state().collect()) == [(m1, "SUCCESS"), (m2, "FAILED")]
    _deliver(run, rows[m2].withColumn("l_new", F.lit(1)), "overwrite")  # complete, with one more column
    assert run.load().count() == 1 and len(run.opened) == 1
    landed = run.store.read_partitioned("bronze_lineitem")
    assert landed.count() == rows[m1].count() + rows[m2].count() and "l_new" not in landed.columns
    assert run.load().count() == 0 and run.opened == []


def test_footer_drift_verdicts(spark, two_months):
    (m1, _), rows = two_months
    run = landing.LandingRun(spark, SF_SMALL)
    for change in (lambda r: r, lambda r: r.drop("l_tax"), lambda r: r.withColumn("l_quantity", F.col("l_quantity").cast("int")),
                   lambda r: r.withColumn("extra", F.lit("x"))):
        _deliver(run, change(rows[m1]))
    footers = files.parquet_footers(files.list_files(spark, run.landing)).cache()
    got = {r["column_name"]: (r["verdict"], r["fails"], r["files_without"], r["types"]) for r in
           profile.drift_verdicts(footers, landing.LINE_SCHEMA).collect()}
    assert got["l_tax"] == ("missing", True, 1, "double") and got["l_quantity"] == ("retyped", True, 0, "double,int")
    assert got["extra"] == ("extra", False, 3, "string") and got["l_shipdate"] == ("ok", False, 0, "timestamp_ntz")
    assert sorted((r["columns_missing"], r["columns_retyped"]) for r in profile.files_off_schema(footers, landing.LINE_SCHEMA).collect()) == [(0, 1), (1, 0)]
    assert files.file_schema_fingerprints(footers).select("schema_fingerprint").distinct().count() == 4
    assert profile.drift_verdicts(footers.limit(0), landing.LINE_SCHEMA).count() == 0


def test_file_profile_counts_every_kind(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 9, None), ("b", 1, "y")], "file string, n int, code string")
    got = {tuple(r) for r in profile.file_profile(rows, "file", {
        "big": F.when(F.col("n") > 5, F.lit("n")), "null": F.when(F.col("code").isNull(), F.lit("code"))}, row_digest("n", "code")).collect()}
    assert got == {("a", "rows", "", 3), ("a", "duplicate_rows", "", 1), ("a", "big", "n", 1), ("a", "null", "code", 1),
                   ("b", "rows", "", 1), ("b", "duplicate_rows", "", 0)}
    assert profile.file_profile(rows.limit(0), "file", {}, row_digest("n")).count() == 0


def test_converge_writes_changed_partitions_only(spark):
    store = SnapshotStore(spark, scratch_path(spark, f"t-converge-{dt.datetime.now().timestamp()}"))
    a = spark.createDataFrame([("p", 1, None), ("p", 2, "x"), ("q", 3, "y"), ("r", 4, "z")], "part string, k int, v string")
    assert merge.converge(store, "t", a, "part") == {"partitions_written": 3, "partitions_dropped": 0, "partitions_unchanged": 0}
    assert merge.converge(store, "t", a.repartition(3), "part")["partitions_written"] == 0
    b = spark.createDataFrame([("p", 1, None), ("p", 2, "x"), ("q", 3, "Y"), ("s", 5, "n")], "part string, k int, v string")
    assert merge.converge(store, "t", b, "part") == {"partitions_written": 2, "partitions_dropped": 1, "partitions_unchanged": 1}
    assert sorted(map(tuple, store.read_partitioned("t").select("part", "k").collect())) == [("p", 1), ("p", 2), ("q", 3), ("s", 5)]
    assert merge.converge(store, "t", a, "part") == {"partitions_written": 2, "partitions_dropped": 1, "partitions_unchanged": 1}


def test_lag_and_rank_over_skewed_ranges(spark):
    rows = [("hot", i, float(i * 7 % 13)) for i in range(300)] + [("cold", 5, 1.0), (None, 1, 2.0), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    df.createOrReplaceTempView("lagged")
    want = sorted(map(str, spark.sql("SELECT k, t, v, LAG(v) OVER (PARTITION BY k ORDER BY t) p FROM lagged").collect()))
    ranked = sorted(map(str, spark.sql("SELECT k, t, v, DENSE_RANK() OVER (ORDER BY v DESC NULLS LAST) r FROM lagged").collect()))
    for n in (1, 3, 40, None):
        got = series.lag_distributed(df, ["k"], ["t"], {"v": "p"}, n).select("k", "t", "v", "p")
        assert sorted(map(str, got.collect())) == want
    for most in (1, 1000):  # beyond the bound the ranks are distributed
        assert sorted(map(str, metrics.dense_rank_by(df, "v", "r", max_values=most).select("k", "t", "v", "r").collect())) == ranked


def test_guarded_write_and_unique_lookup(spark):
    df = spark.range(10).withColumn("x", F.when(F.col("id") < 3, None).otherwise(1))
    out, seen = write_guarded(df, "t_guard", {"rows": F.count(F.lit(1)), "gaps": F.count_if(F.col("x").isNull())}, lambda v: [])
    assert out.count() == 10 and seen == {"rows": 10, "gaps": 3}
    with pytest.raises(GuardError, match="3 gaps"):
        write_guarded(df, "t_guard", {"gaps": F.count_if(F.col("x").isNull())}, lambda v: [f"{v['gaps']} gaps"] if v["gaps"] else [])
    dim = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id int")
    fact = spark.createDataFrame([(1,), (None,)], "loc int")
    with pytest.raises(Exception, match="not unique: 1"):
        resolve_roles(fact, dim, "id", {"pickup": "loc"}).collect()
    assert resolve_roles(fact, dim.distinct(), "id", {"pickup": "loc"}).count() == 2


def test_played_star_fills_every_class(spark):
    s = StarBuild(spark, SF_SMALL)
    weather = {r["pickup_weather_match_status"]: r["count"] for r in s.weather_map().groupBy("pickup_weather_match_status").count().collect()}
    assert set(weather) == {"matched_unique", "ambiguous_match", "no_match", "invalid_pickup_timestamp"}
    for role in ("pickup", "dropoff"):
        seen = {r[0] for r in s.zone_map().select(f"{role}_zone_match_status").distinct().collect()}
        assert seen == {"missing_source_id", "matched_special", "matched_regular", "unmatched_location_id"}
    clean = s.clean().filter("pickup_datetime_local IS NOT NULL")
    assert clean.select(F.hour("pickup_datetime_local")).distinct().count() == 24
    nights = clean.agg(F.count_if(F.expr("pickup_datetime_local >= TIMESTAMP_NTZ'2024-03-10 02:00:00' AND pickup_datetime_local < TIMESTAMP_NTZ'2024-03-10 03:00:00'")),
                       F.count_if(F.expr("pickup_datetime_local >= TIMESTAMP_NTZ'2024-11-03 01:00:00' AND pickup_datetime_local < TIMESTAMP_NTZ'2024-11-03 02:00:00'"))).first()
    assert nights[0] > 0 and nights[1] > 0
    s.materialise()
    flags = s.trip_fact().select("pickup_in_reporting_window_flag").distinct().count()
    assert flags == 2 and s.measured["trip_fact"]["no_date"] == 0
    assert dict(s.zone_map().dtypes) == ZONE_MAP_SCHEMA and dict(s.weather_map().dtypes) == WEATHER_MAP_SCHEMA
    strict = StarBuild(spark, SF_SMALL, max_quarantine_pct=1.0)
    with pytest.raises(GuardError, match="quarantine rate"):
        strict.clean()


def test_fact_carries_the_provenance_of_landed_trips(spark):
    run = landing.TripLandingRun(spark, SF_SMALL)
    run.deliver()
    assert run.load().filter("mismatch").count() == 0
    s = StarBuild(spark, SF_SMALL, landed=run).materialise()
    plain = StarBuild(spark, SF_SMALL)
    fact = s.trip_fact()
    own = [c for c in plain.trip_fact().columns if c not in ("source_system", "source_file", "out_of_source_file_month_flag")]
    assert fact.select(*own).exceptAll(plain.trip_fact().select(*own)).count() == 0 and fact.count() == plain.trip_fact().count()
    assert s.measured["trip_fact"]["late"] > 0 and s.measured["trip_fact"]["no_version"] == 0
    late = fact.filter("out_of_source_file_month_flag")
    assert late.count() == s.measured["trip_fact"]["late"]
    assert late.filter(F.concat(F.lit("trips_"), F.date_format("pickup_datetime_local", "yyyy-MM"), F.lit(".parquet")) == F.col("source_file")).count() == 0
    versions = {(r["batch_id"], r["source_file_version"]) for r in fact.select("batch_id", "source_file_version").distinct().collect()}
    assert versions == {(r["batch_id"], r["source_version_id"]) for r in run.batch_state().collect()}

    # a batch that the log does not hold, and one that it closed twice, stop publication
    for change in (lambda v: v.limit(1), lambda v: v.withColumn("control_row_count", F.lit(2))):
        broken = StarBuild(spark, SF_SMALL, landed=run)
        broken.cache |= {k: s.cache[k] for k in s.cache if k not in ("trip_fact", "batch_versions")}
        broken.measured |= s.measured
        broken.cache["batch_versions"] = change(run.batch_versions())
        with pytest.raises(GuardError, match="exactly one version"):
            broken.materialise()

    # a revised month replaces its trips in the fact, under a new batch and version
    run.redeliver("2024-11", F.col("fare_amount_raw") >= 0)
    assert run.load().count() == 1
    again = StarBuild(spark, SF_SMALL, landed=run).materialise().trip_fact()
    november = again.filter("source_file = 'trips_2024-11.parquet'")
    assert november.filter("fare_amount_usd < 0").count() == 0 and november.count() > 0
    assert fact.filter("source_file = 'trips_2024-11.parquet' AND fare_amount_usd < 0").count() > 0
    new = {r[0] for r in november.select("source_file_version").distinct().collect()}
    assert len(new) == 1 and not new & {v for _, v in versions}
    # the other months keep their trips and batches; what joins them was ambiguous with a withdrawn November row
    before, after = (f.filter("source_file <> 'trips_2024-11.parquet'").select("trip_key", "batch_id") for f in (fact, again))
    assert before.exceptAll(after).count() == 0
    joined = after.exceptAll(before)
    assert joined.join(s.quarantine(), joined["trip_key"] == s.quarantine()["trip_hash"], "left_anti").count() == 0


def test_a_month_in_several_parts_is_one_delivery(spark):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in small}
    run = landing.TripLandingRun(spark, SF_SMALL)
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        run.deliver()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    months = run.delivered_rows().select("period").distinct().count()
    assert files.list_files(spark, run.landing).count() > months  # parts
    assert run.load().filter("mismatch").count() == 0 and len(run.opened) == months
    batches = run.batch_state().filter("status = 'SUCCESS'")
    assert batches.count() == batches.select("source_object").distinct().count() == months
    landed, source = run.store.read_partitioned(run.target), run.delivered_rows()
    own = run.schema.names
    assert landed.count() == source.count() and landed.select(*own).exceptAll(source.select(*own)).count() == 0
    assert run.load().count() == 0 and run.opened == []
    month = batches.agg(F.max("source_period")).first()[0]
    part = cut_lineage(source.filter(F.col("period") == month).select(*own).limit(3), "part")
    part.coalesce(1).write.mode("append").parquet(f"{run.landing}/period={month}")  # one more part: the month is new
    assert run.load().count() == 1 and len(run.opened) == 1
    assert run.store.read_partitioned(run.target).count() == run.delivered_rows().count()
    part.drop("vendor_id_raw").coalesce(1).write.mode("append").parquet(f"{run.landing}/period={month}")
    assert run.load().count() == 0 and run.opened == []  # one part lacks a column: the month is refused
    assert run.batch_state().filter("status = 'FAILED'").count() == 1


def test_a_blocked_run_keeps_its_log_and_gate_results(spark):
    job = Job(spark, SF_SMALL, landing=False)
    with pytest.raises(dq.GateBlocked):
        job.run()
    log = job.store.read_log("pipeline_runs")
    state = {r["step"]: r for r in run_summary(log).collect()}
    assert state["job"]["status"] == "FAILED" and state["bronze_trips"]["status"] == "SUCCESS"
    assert any(k.startswith("gate_bronze") and r["status"] == "FAILED" for k, r in state.items())
    assert not any(k.startswith("silver") for k in state) and all(r["seconds"] >= 0 for r in state.values())
    results = job.store.read_log("data_quality_results")
    assert results.filter("status = 'FAIL'").count() > 0
    assert {r[0] for r in results.select("run_id").distinct().collect()} == {job.run_id}
    assert run_summary(log.limit(0)).count() == 0
    open_step = run_summary(log.filter("status = 'STARTED'")).first()
    assert open_step["status"] == "STARTED" and open_step["ended_at"] is None
