"""Gates over hand-built inputs with planted anomalies (counts worked out by hand from the rows)."""

import datetime as dt

from pyspark.sql import functions as F

from lakekit.plans import checks
from lakekit.plans.trips import bronze_weather_observations

DOC_SCHEMA = ("coordinate_id string, weather_model string, requested_start_date date, requested_end_date date, "
              "hourly struct<time: array<string>, temperature_2m: array<double>, precipitation: array<double>, "
              "weather_code: array<bigint>>, source_system string, "
              "hourly_units struct<time: string, temperature_2m: string, precipitation: string, weather_code: string>")
UNITS = ("iso8601", "°C", "mm", "wmo code")


def _day(d, hours):
    return [f"{d}T{h:02d}:00" for h in hours]


def test_bronze_weather_gate_planted_anomalies(spark):
    full = _day("2024-03-01", range(24))
    docs = [
        # complete, clean day
        ("c1", "m1", dt.date(2024, 3, 1), dt.date(2024, 3, 1), (full, [5.0] * 24, [0.0] * 24, [0] * 24), "tpch_events",
         UNITS),
        # gap 01→03, duplicate 03:00, step back to 02:00, hour outside the window, hot value, negative rain,
        # unlisted code 42, null code
        ("c1", "m1", dt.date(2024, 3, 2), dt.date(2024, 3, 2),
         (_day("2024-03-02", [0, 1, 3, 3, 2]) + ["2024-03-03T05:00"], [1.0, 99.0, 2.0, 2.0, 3.0, 4.0],
          [0.0, -0.5, 0.0, 0.0, 0.0, 0.0], [0, 1, 42, 3, 3, None]), "tpch_events",
         ("iso8601", "°F", "mm", "wmo code")),  # temperature delivered in Fahrenheit
        # short temperature array, no model
        ("c1", None, dt.date(2024, 3, 4), dt.date(2024, 3, 4),
         (_day("2024-03-04", [0, 1]), [1.0], [0.0, 0.0], [0, 0]), "tpch_events", UNITS),
        # null code array, wrong source system
        ("c1", "m1", dt.date(2024, 3, 5), dt.date(2024, 3, 5),
         (_day("2024-03-05", [0]), [1.0], [0.0], None), "other", UNITS),
    ]
    d = spark.createDataFrame(docs, DOC_SCHEMA)
    events = spark.createDataFrame([(dt.datetime(2024, 3, 1) + dt.timedelta(hours=i, minutes=7),) for i in range(33)],
                                   "ts timestamp_ntz").withColumn("coordinate_id", F.lit("c1"))
    res = checks.bronze_weather_gate().run({"bronze_weather": d, "bronze_weather_rows": bronze_weather_observations(d),
                                            "source_events": events})
    got = {r["check_name"]: (r["fail_count"], r["total_count"], r["status"]) for r in res.collect()}
    expected_fail = {
        "bronze_row_count": 0, "observation_count_not_empty": 0, "bronze_response_key_unique": 0,
        "requested_dates": 0, "weather_model_not_null": 1, "hourly_arrays_not_null": 1, "hourly_array_alignment": 2,
        "hourly_volume": 3, "provenance_completeness": 0, "source_system_domain": 1,
        "source_to_bronze_hourly_count": 0, "timestamp_not_null": 0, "temperature_not_null": 1,
        "precipitation_not_null": 0, "weather_code_not_null": 2, "duplicate_timestamps": 1,
        "timestamp_chronological_order": 1, "temperature_range": 1, "precipitation_non_negative": 1,
        "weather_code_domain": 1, "observation_date_window": 1, "hourly_continuity": 4,
        "observation_count_measurement": 0, "hourly_units_expected": 1, "hourly_units_observed": 0,
    }
    assert {k: v[0] for k, v in got.items()} == expected_fail
    assert got["timestamp_not_null"][1] == 33  # observations = positions of the time arrays
    assert got["weather_model_not_null"][2] == "FAIL"  # WARN with a 0 % tolerance
    assert got["observation_count_measurement"][2] == "INFO"


def test_control_gate_planted_lifecycle_anomalies(spark):
    from lakekit.sources import control
    now = dt.datetime.now(dt.timezone.utc)
    t, m = now - dt.timedelta(hours=1), dt.timedelta(minutes=1)

    def ev(batch, content, status, at, rows=None):
        return (batch, "src", content, rows, status, at)

    events = [
        ev("b1", "c1", "DISCOVERED", t), ev("b1", "c1", "STARTED", t + m), ev("b1", "c1", "SUCCESS", t + 2 * m, 10),
        # same content loaded twice
        ev("b2", "c1", "DISCOVERED", t), ev("b2", "c1", "STARTED", t + m), ev("b2", "c1", "SUCCESS", t + 2 * m, 5),
        # stuck for 7 hours
        ev("b3", "c3", "DISCOVERED", now - dt.timedelta(hours=7)), ev("b3", "c3", "STARTED", now - dt.timedelta(hours=7)),
        # SUCCESS without a landed row count
        ev("b4", "c4", "DISCOVERED", t), ev("b4", "c4", "STARTED", t + m), ev("b4", "c4", "SUCCESS", t + 2 * m),
        # completed before started
        ev("b5", "c5", "DISCOVERED", t), ev("b5", "c5", "SUCCESS", t + 5 * m, 3), ev("b5", "c5", "STARTED", t + 10 * m),
        # status outside the domain
        ev("b6", "c6", "DISCOVERED", t), ev("b6", "c6", "DONE", t + m),
        # registered twice
        ev("b7", "c7", "DISCOVERED", t), ev("b7", "c7", "DISCOVERED", t + m),
    ]
    df = spark.createDataFrame(events, "batch_id string, source_system string, content_sha256 string, "
                                       "row_count long, status string, event_at timestamp")
    res = checks.control_gate().run(checks.control_tables(df))
    got = {r["check_name"]: (r["fail_count"], r["total_count"], r["status"], r["details"]) for r in res.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "ingestion_batches_not_empty": 0, "batch_id_unique": 1, "no_duplicate_successful_batches": 1,
        "no_stuck_batches": 1, "batch_lifecycle_consistent": 2, "status_in_allowed_domain": 1,
        "source_systems_registering_batches": 0}
    assert got["no_duplicate_successful_batches"][1] == 6  # content groups
    assert got["no_stuck_batches"][2] == "FAIL"  # WARN at a 0 % tolerance
    assert got["source_systems_registering_batches"][3] == "loaded from: src"
    state = {r["batch_id"]: r for r in control.batch_lifecycle(df).collect()}
    assert state["b5"]["status"] == "STARTED" and state["b4"]["row_count"] is None and state["b1"]["row_count"] == 10


def test_lookups_required_and_optional_keys_share_one_pass(spark):
    fact = spark.createDataFrame(
        [(1, 10, 100), (2, None, 100), (3, 99, None), (4, 10, 555), (5, 10, 100)],
        "id int, date_key int, zone_key int")
    dates = spark.createDataFrame([(10,), (10,), (11,)], "date_key int")  # a repeated key must not fan out
    zones = spark.createDataFrame([(100,)], "zone_key int")
    g = checks.Gate("t", "t")
    g.lookups("required_date", "fact", [("date_key", "dates", "date_key", True)])
    g.lookups("optional_zone", "fact", [("zone_key", "zones", "zone_key", False)])
    g.lookups("any", "fact", [("date_key", "dates", "date_key", True), ("zone_key", "zones", "zone_key", False)])
    g.row_check("odd_ids", "X", "FAIL", 0.0, "fact", "id % 2 = 1")
    got = {r["check_name"]: (r["fail_count"], r["total_count"])
           for r in g.run({"fact": fact, "dates": dates, "zones": zones}).collect()}
    # required: null (id 2) and unmatched (id 3) fail; optional: only the non-null unmatched 555 (id 4)
    assert got == {"required_date": (2, 5), "optional_zone": (1, 5), "any": (3, 5), "odd_ids": (3, 5)}


def test_one_tally_per_key(spark):
    """Uniqueness, coverage, intersection and key-set difference on one key read each table once for the key."""
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (3,), (4,)], "k int")
    none = spark.createDataFrame([], "k int")
    g = checks.Gate("test", "keys")
    specs = {"unique": checks.Unique("a", ["k"]), "groups": checks.Unique("a", ["k"], group_nulls=True),
             "unique_b": checks.Unique("b", ["k"]), "shared": checks.Intersect("a", "b", "k"), "lost": checks.KeyDiff("a", "b", "k"),
             "new": checks.KeyDiff("b", "a", "k"), "unmatched": checks.Unresolved("a", "k", "b", "k"),
             "unmatched_or_null": checks.Unresolved("a", "k", "b", "k", null_fails=True), "to_none": checks.Unresolved("b", "k", "none", "k"),
             "empty": checks.Unique("none", ["k"])}
    for name, spec in specs.items():
        g.compare(name, "TEST", g.scalar(name, spec), "1")
    out = g.run({"a": a, "b": b, "none": none})
    assert {r.check_name: r.fail_count for r in out.collect()} == {
        "unique": 3, "groups": 2, "unique_b": 1, "shared": 2, "lost": 2, "new": 1, "unmatched": 1, "unmatched_or_null": 3,
        "to_none": 4, "empty": 0}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3


def test_dashboard_reads_each_gates_latest_run(spark):
    from lakekit.operators import dq
    cols = ("run_id string, executed_at timestamp, layer string, dataset string, check_name string, check_type string, status string, "
            "fail_count long, total_count long, details string, code_revision string")
    row = lambda run, layer, check, status, kind="RANGE": (
        run, dt.datetime(2026, 1, int(run[1:])), layer, "d", check, kind, status, int(status in ("FAIL", "WARN")), 4, None, None)
    log = spark.createDataFrame([row("r1", "bronze", "a", "FAIL"), row("r1", "gold", "a", "WARN"), row("r1", "gold", "b", "PASS"),
                                 row("r2", "bronze", "a", "PASS"), row("r2", "bronze", "b", "FAIL", "UNIQUE"),
                                 row("r2", "bronze", "c", "INFO")], cols)
    status = dq.gate_status(log)
    got = {(r.chart, r.label): r.value for r in dq.dashboard_charts(log, status).collect()}
    day = lambda k: int(dt.datetime(2026, 1, k, tzinfo=dt.timezone.utc).timestamp())
    latest = {k: got.pop(("latest_run_by_layer", k)) for k in ("bronze", "gold")}
    assert latest["bronze"] - latest["gold"] == day(2) - day(1)
    assert got == {("datasets_validated", "all"): 2, ("pass_trend", "r1"): 1, ("pass_trend", "r2"): 1, ("checks_by_layer", "bronze"): 3,
                   ("checks_by_layer", "gold"): 2, ("checks_by_dataset", "d"): 5, ("failures_by_dataset", "d"): 1,
                   ("failures_by_type", "UNIQUE"): 1, ("checks_failed", "all"): 1, ("checks_warned", "all"): 1,
                   ("checks_passed", "all"): 2, ("pass_rate_bp", "all"): 5000}
    assert {(r.layer, r.check_name) for r in dq.open_issues(log, status).collect()} == {("bronze", "b"), ("gold", "a")}
    empty = dq.dashboard_charts(log.limit(0), dq.gate_status(log.limit(0)))
    assert empty.count() == 0


def test_tally_counts_digests_as_bytes_beside_other_texts(spark):
    digest = "ab" * 32
    same_bytes = "\u00ab" * 16  # another text, 32 bytes long
    left = spark.createDataFrame([(digest,), (digest,), (digest.upper(),), (same_bytes,), ("",), (None,), (None,)], "k string")
    right = spark.createDataFrame([(digest,), ("b" * 63,)], "k string")
    specs = [("u", checks.Unique("left", ["k"])), ("g", checks.Unique("left", ["k"], True)),
             ("i", checks.Intersect("left", "right", "k")), ("d", checks.KeyDiff("left", "right", "k"))]
    got = checks._tally({"left": left, "right": right}, ("k",), specs)
    assert got.first().asDict() == {"u": 3, "g": 2, "i": 1, "d": 4}
    assert "unhex" in got._jdf.queryExecution().optimizedPlan().toString()


def _star_tables(spark, folder):
    """A few orders with lines, places and hours, under the names of the driver tables."""
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(1, "INDIA", 0), (2, "JAPAN", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 1, 50.25), (2, 2, -3.5)], "c_custkey long, c_nationkey int, c_acctbal double"),
        "supplier": ([(1, 2)], "s_suppkey long, s_nationkey int"),
        "orders": ([(k, 1 + k % 2, f"1995-01-0{k}", "1-URGENT") for k in range(1, 6)],
                   "o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string"),
        "lineitem": ([(k, n, 1, 2.0 * n, 100.0, 0.02, f"1995-01-1{k}") for k in range(1, 6) for n in (1, 2)] + [(5, 2, 1, 9.0, 9.0, 0.0, "1995-01-20")],
                     "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double, l_shipdate string"),
        "events": ([(i, f"2024-01-0{1 + i % 3} 0{i}:10:00", "view", 1.5, '{"k": 1}') for i in range(9)],
                   "event_id long, ts string, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        for c in {"o_orderdate", "l_shipdate", "ts"} & set(df.columns):
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_gates_and_questions_read_a_written_fact(spark, tmp_path):
    from lakekit.plans import checks
    from lakekit.plans.trips import StarBuild

    folder = _star_tables(spark, tmp_path)

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    keyed = StarBuild(spark, folder).trip_fact()
    assert "Join" in plan(keyed)
    for stage in (StarBuild.analysis_fact, StarBuild.staged_fact):
        s = StarBuild(spark, folder)
        fact = stage(s)
        assert "Join" not in plan(fact)
        assert fact.exceptAll(keyed.select(*fact.columns)).count() == 0 and fact.count() == keyed.count() == 9
        s.q1_result()
        assert plan(s.analysis_fact()) == plan(fact)  # the questions keyed no second one
    tables = checks.gate_tables(s)
    assert tables["fact"] is s.staged_fact()
    rows = {r["check_name"]: r for r in checks.analytics_gate().run(tables).collect()}
    assert rows["q1_trips_reconcile_to_gold"]["total_count"] == 9 and rows["q1_spot_check_date_hour_zone"]["fail_count"] == 0
