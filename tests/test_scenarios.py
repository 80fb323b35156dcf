"""Incremental-load scenarios on the driver tables (sf0.001): increments equal one combined load, a re-run
finds no new work and changes nothing, a revised month replaces its old version."""

import pytest
from pyspark.sql import functions as F

from lakekit.plans import landing
from lakekit.plans.tables import Tables
from tests.conftest import SF_SMALL

BUSINESS = landing.LINE_COLS + ["content_sha256"]


def _deliver(run, li, periods):
    (li.filter(F.col("period").isin(periods)).repartition("period")
     .write.mode("append").partitionBy("period").parquet(run.landing))


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_three_increments_equal_one_combined_load_and_rerun_is_noop(spark):
    li = Tables(spark, SF_SMALL).lineitem.select(*landing.LINE_COLS) \
        .withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    periods = sorted(r["period"] for r in li.select("period").distinct().collect())  # one row per month
    chunks = [periods[i::3] for i in range(3)]

    inc = landing.LandingRun(spark, SF_SMALL)
    landed = 0
    for chunk in chunks:
        _deliver(inc, li, chunk)
        report = inc.load()
        assert report.count() == len(chunk)  # only the newly arrived months are loaded
        landed += len(chunk)
    combined = landing.LandingRun(spark, SF_SMALL)
    combined.deliver()
    combined.load()

    t_inc = inc.store.read_partitioned("bronze_lineitem").select(*BUSINESS)
    t_all = combined.store.read_partitioned("bronze_lineitem").select(*BUSINESS)
    assert t_all.count() == li.count()
    assert _same_rows(t_inc, t_all)
    state = ["source_period", "status", "row_count", "content_sha256"]
    assert _same_rows(inc.batch_state().select(*state), combined.batch_state().select(*state))
    assert landed == len(periods)

    # a second run over unchanged files: no new work, target and batch state unchanged
    again = combined.load()
    assert again.count() == 0
    assert _same_rows(combined.store.read_partitioned("bronze_lineitem").select(*BUSINESS), t_all)
    assert combined.batch_state().filter("status = 'SUCCESS'").count() == len(periods)


def test_revised_month_supersedes_its_old_version(spark):
    run = landing.revised_delivery_state(spark, SF_SMALL)
    li = Tables(spark, SF_SMALL).lineitem
    latest = li.agg(F.max(F.date_format("l_shipdate", "yyyy-MM")).alias("p")).first()["p"]
    state = run.batch_state().filter(F.col("source_period") == latest)
    statuses = sorted(r["status"] for r in state.collect())
    assert statuses == ["SUCCESS", "SUPERSEDED"]
    kept = li.filter((F.date_format("l_shipdate", "yyyy-MM") == latest) & (F.col("l_returnflag") != "R")).count()
    assert state.filter("status = 'SUCCESS'").first()["row_count"] == kept
    target = run.store.read_partitioned("bronze_lineitem")
    assert target.filter(F.date_format("l_shipdate", "yyyy-MM") == latest).count() == kept
    assert target.count() == li.count() - (li.filter(F.date_format("l_shipdate", "yyyy-MM") == latest).count() - kept)


def test_job_stops_at_a_blocking_gate_and_joins_the_landing_branch(spark):
    import pytest

    from lakekit.operators.dq import GateBlocked
    from lakekit.plans.job import Job
    job = Job(spark, SF_SMALL, workers=4, enforce_gates=True)
    with pytest.raises(GateBlocked):
        job.run()  # the driver data trips the Bronze weather / trip gates
    steps = {(e[1], e[2]) for e in job.events}
    assert ("landing_trips", "SUCCESS") in steps and ("gate_control", "SUCCESS") in steps  # branch finished
    assert not any(name.startswith("silver_") for name, _ in steps)  # nothing downstream of the barrier ran


def _one_month(spark, run):
    li = Tables(spark, SF_SMALL).lineitem.select(*landing.LINE_COLS) \
        .withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
    month = li.agg(F.min("period").alias("p")).first()["p"]
    rows = li.filter(F.col("period") == month)
    return rows, lambda: rows.coalesce(1).write.mode("append").partitionBy("period").parquet(run.landing)


def _control_fails(run):
    from lakekit.plans import checks
    from lakekit.sources import control
    ev = run.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
    res = checks.control_gate().run(checks.control_tables(ev)).collect()
    return {r["check_name"]: r["fail_count"] for r in res if r["fail_count"]}


def test_equal_files_are_one_batch_and_a_reload_of_lost_rows_is_a_new_one(spark):
    run = landing.LandingRun(spark, SF_SMALL)
    rows, deliver = _one_month(spark, run)
    deliver()
    deliver()  # the same rows again under another file name
    n = rows.count()
    report = run.load().collect()
    assert [(r["source_rows"], r["landed_rows"]) for r in report] == [(n, n)]
    repeats = run.store.read_log("duplicate_deliveries").collect()
    assert [(r["row_count"], r["duplicate_of"] is not None) for r in repeats] == [(n, True)]
    assert run.store.read_partitioned("bronze_lineitem").count() == n
    assert _control_fails(run) == {}

    run.store.drop_partitions("bronze_lineitem", "content_sha256",
                              run.store.partition_values("bronze_lineitem", "content_sha256"))
    run.load()  # the target is empty: the content is loaded again
    assert sorted(r["status"] for r in run.batch_state().collect()) == ["SUCCESS", "SUPERSEDED"]
    assert run.store.read_partitioned("bronze_lineitem").count() == n
    assert _control_fails(run) == {}


def test_failed_load_closes_as_failed_and_the_next_run_loads(spark, monkeypatch):
    import pytest

    from lakekit.operators import ingest
    run = landing.LandingRun(spark, SF_SMALL)
    rows, deliver = _one_month(spark, run)
    deliver()

    def broken(report):
        raise ingest.ReconciliationError("planted")

    with monkeypatch.context() as m:
        m.setattr(ingest, "reconcile_guard", broken)
        with pytest.raises(ingest.ReconciliationError):
            run.load()
    assert [r["status"] for r in run.batch_state().collect()] == ["FAILED"]
    run.load()
    assert sorted(r["status"] for r in run.batch_state().collect()) == ["FAILED", "SUCCESS"]
    assert run.store.read_partitioned("bronze_lineitem").count() == rows.count()
    assert _control_fails(run) == {}


def test_quarantine_rate_stops_before_a_trip_row_is_written(spark, monkeypatch):
    from lakekit.operators.resolve import GuardError
    from lakekit.plans import trips

    rows = [(1, 1), (1, 1), (2, 1), (None, 3), (None, 3)]
    raw = spark.createDataFrame([(k, n, *[None] * 9, "s", "f") for k, n in rows], ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in trips.TripLandingRun.schema.fields) + ", source_system string, source_file string")
    star = trips.StarBuild(spark, SF_SMALL, cache={"raw_trips": raw})
    assert sorted(r["collision_count"] for r in star.decided().collect()) == [1, 2, 2, 2, 2]
    assert star.decided().columns[-1] == "collision_count"
    assert star.measured["decided"] == {"rows": 5, "quarantined": 4}
    typed = []
    monkeypatch.setattr(trips, "silver_typed_trips", typed.append)
    with pytest.raises(GuardError, match="decided is not published: quarantine rate 80"):
        trips.StarBuild(spark, SF_SMALL, cache={"raw_trips": raw}, max_quarantine_pct=1.0).decided()
    assert not typed


def test_guards_share_the_silver_they_do_not_plant(spark, monkeypatch):
    import __spark_entry__ as E
    from lakekit.operators import dedup

    calls, own = [], dedup.with_collision_count
    monkeypatch.setattr(dedup, "with_collision_count", lambda *a: calls.append(1) or own(*a))
    got = {r["guard"]: r["stopped"] for r in E.queries()["c21_guards_stop_publication"](spark, SF_SMALL).collect()}
    assert len(got) == 5 and not got["none broken"] and got["repeated zone key"] and got["dates missing"]
    assert len(calls) == 1


def test_trip_lines_are_shuffled_by_their_order_only(spark):
    from lakekit.plans.tables import Tables, raw_trips

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = raw_trips(Tables(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    at = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(o_custkey" in line)
    depth = plan[at].index("Exchange")
    below = [line for line in plan[at + 1:at + 1 + next((i for i, x in enumerate(plan[at + 1:]) if x.find("- ") + 2 <= depth and "- " in x), len(plan))]]
    assert below and not any("l_linenumber" in line for line in below)
