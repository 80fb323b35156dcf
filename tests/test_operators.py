from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakekit.functions.digest import row_digest
from lakekit.operators import dedup, dq, fingerprint, merge, metrics, resolve, setops
from lakekit.operators.series import continuity_report, explode_parallel_arrays
from lakekit.plans import analytics


def test_collision_split_partitions_input_and_handles_hot_key(spark):
    rows = [(1, "a")] * 300 + [(2, "b")] * 2 + [(i, "c") for i in range(3, 103)] + [(None, "n"), (None, "m")]
    df = spark.createDataFrame(rows, "k int, v string")
    clean, quarantine = dedup.collision_split(df, "k")
    assert clean.count() + quarantine.count() == df.count()
    assert clean.count() == 100
    assert quarantine.filter("k = 1").select("collision_count").distinct().first()[0] == 300
    assert quarantine.filter("k IS NULL").count() == 2  # null keys form one group, like COUNT(*) OVER
    assert set(quarantine.select(F.explode("quarantine_reasons")).distinct().toPandas().iloc[:, 0]) == {
        "duplicate_hash_collision"}
    exp = dedup.expected_quarantine_rows(df, "k").first()
    assert exp["expected_quarantine_rows"] == quarantine.count()


def test_quarantine_rate_guard(spark):
    clean = spark.range(99)
    q = spark.range(2)
    with pytest.raises(dedup.QuarantineRateExceeded):
        dedup.quarantine_rate_guard(clean, q, 1.0)
    assert not dedup.quarantine_rate_guard(spark.range(1000), q, 1.0).halted


def test_fingerprint_order_free_and_multiset_exact(spark):
    base = spark.range(0, 5000).select(F.col("id").cast("string").alias("x"))
    d = base.select(F.lit("f").alias("file"), row_digest("x", mode="text").alias("row_digest"))
    a = fingerprint.content_fingerprint(d, ["file"]).first()
    b = fingerprint.content_fingerprint(d.orderBy(F.rand(7)).repartition(7), ["file"]).first()
    c = fingerprint.content_fingerprint(d.unionByName(d.limit(1)), ["file"]).first()
    e = fingerprint.content_fingerprint(d.filter("x <> '17'"), ["file"]).first()
    assert a["content_sha256"] == b["content_sha256"]
    assert len({a["content_sha256"], c["content_sha256"], e["content_sha256"]}) == 3
    assert (a["row_count"], c["row_count"], e["row_count"]) == (5000, 5001, 4999)


def test_merge_snapshot_semantics_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t1"), (3, None, "t1")], "k int, v string, stamp string")
    source = spark.createDataFrame([(1, "a", "s"), (2, "B", "s"), (3, None, "s"), (4, "d", "s")],
                                   "k int, v string, stamp string")
    plan = {r["k"]: r for r in merge.merge_plan(target, source, ["k"], ["v"], delete_unmatched=True).collect()}
    assert plan[1]["_merge_action"] == "unchanged" and plan[1]["stamp"] == "t1"  # lineage kept
    assert plan[2]["_merge_action"] == "update" and plan[2]["v"] == "B" and plan[2]["stamp"] == "s"
    assert plan[3]["_merge_action"] == "unchanged"  # null-safe compare
    assert plan[4]["_merge_action"] == "insert"
    merged = merge.merge_snapshot(target, source, ["k"], ["v"], delete_unmatched=True).drop("_merge_action")
    again = merge.merge_plan(merged, source, ["k"], ["v"], delete_unmatched=True)
    assert {r["_merge_action"] for r in again.collect()} == {"unchanged"}
    mirror = merge.merge_snapshot(target, source.filter("k <> 1"), ["k"], ["v"], delete_unmatched=True)
    assert 1 not in {r["k"] for r in mirror.collect()}
    gated = merge.merge_snapshot(target, source, ["k"], ["v"], enabled=False)
    assert {r["k"]: r["v"] for r in gated.collect()} == {1: "a", 2: "b", 3: None}


def test_snapshot_diff_counts_multiplicity(spark):
    before = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    after = spark.createDataFrame([(1,), (3,)], "k int")
    got = {(r["k"], r["side"], r["copies"]) for r in setops.snapshot_diff(before, after).collect()}
    assert got == {(1, "before_only", 1), (2, "before_only", 1), (3, "after_only", 1)}
    d = setops.key_set_diff(before, after, ["k"]).first()
    assert (d["only_left"], d["only_right"], d["in_both"]) == (1, 1, 1)


def test_resolve_unique_statuses(spark):
    facts = spark.createDataFrame([(1, "2026-03-01 10:15:00"), (2, "2026-03-01 11:59:59"), (3, "2026-03-01 13:00:00"),
                                   (4, None)], "id int, t string").withColumn("t", F.to_timestamp_ntz("t"))
    series = spark.createDataFrame([("k10", "2026-03-01 10:00:00"), ("k11a", "2026-03-01 11:00:00"),
                                    ("k11b", "2026-03-01 11:00:00")], "key string, h string") \
        .withColumn("h", F.to_timestamp_ntz("h"))
    out = {r["id"]: r for r in resolve.resolve_unique(facts, F.col("t"), series, "h", "key", "k", "s").collect()}
    assert (out[1]["s"], out[1]["k"]) == ("matched_unique", "k10")
    assert (out[2]["s"], out[2]["k"]) == ("ambiguous_match", None)
    assert out[3]["s"] == "no_match" and out[4]["s"] == "invalid_pickup_timestamp"


def test_resolve_roles_statuses(spark):
    trips = spark.createDataFrame([(1, 5, None), (2, 264, 999), (3, 5, 265)], "id int, pu int, do int")
    zones = spark.createDataFrame([(5,), (264,), (265,)], "location_id int")
    out = {r["id"]: r for r in resolve.resolve_roles(trips, zones, "location_id", {"pickup": "pu", "dropoff": "do"},
                                                     (264, 265)).collect()}
    assert out[1]["pickup_zone_match_status"] == "matched_regular"
    assert out[1]["dropoff_zone_match_status"] == "missing_source_id"
    assert out[2]["pickup_zone_match_status"] == "matched_special"
    assert out[2]["dropoff_zone_match_status"] == "unmatched_location_id"
    assert out[3]["dropoff_zone_match_status"] == "matched_special"


def test_dense_rank_matches_window(spark):
    df = spark.createDataFrame([(h, v) for h in range(3) for v in [5, 5, 3, None, 9]], "h int, v int")
    ranked = metrics.dense_rank_by(df, "v", "r").collect()
    assert {(r["v"], r["r"]) for r in ranked} == {(9, 1), (5, 2), (3, 3), (None, 4)}
    dist = metrics.global_dense_rank_distributed(df, "v", "r2", num_partitions=3).collect()
    assert {(r["v"], r["r2"]) for r in dist} == {(9, 1), (5, 2), (3, 3), (None, 4)}
    within = metrics.dense_rank_by(df, "v", "rh", descending=False, partition_cols=["h"]).collect()
    assert {(r["v"], r["rh"]) for r in within} == {(None, 1), (3, 2), (5, 3), (9, 4)}


def test_fare_per_mile_fixture(spark):
    """8 trips in 3 zones + one zone key with no dimension row; expected values worked by hand."""
    trips = [  # zone, fare, distance
        (1, "30.00", "3.000"), (1, "35.00", "4.000"),                            # Manhattan
        (2, "25.00", "5.000"), (2, "32.00", "3.000"), (2, "-10.00", "0.000"),    # Queens: negative fare, zero dist
        (3, "12.00", "13.000"), (3, "8.00", "-2.000"),                           # Brooklyn: negative distance
        (99, "20.00", "4.000"),                                                   # zone without a dimension row
    ]
    fact = spark.createDataFrame([(z, 1, Decimal(f), Decimal(d)) for z, f, d in trips],
                                 "pickup_zone_key long, trip_count int, fare_amount_usd decimal(18,2), "
                                 "trip_distance_miles decimal(18,3)")
    fact = fact.withColumn("negative_fare_amount_flag", F.col("fare_amount_usd") < 0) \
        .withColumn("negative_trip_distance_flag", F.col("trip_distance_miles") < 0)
    zones = spark.createDataFrame([(1, "Manhattan"), (2, "Queens"), (3, "Brooklyn")], "zone_key long, borough string")
    got = {r["pickup_borough"]: r for r in analytics.q4_fare_efficiency_by_borough(fact, zones).collect()}
    expected = {"Manhattan": (2, "65.00", "7.000", 9.29, 1), "Queens": (3, "57.00", "8.000", 7.13, 2),
                None: (1, "20.00", "4.000", 5.00, 3), "Brooklyn": (2, "20.00", "13.000", 1.54, 4)}
    assert set(got) == set(expected)
    for b, (n, fare, dist, fpm, rank) in expected.items():
        r = got[b]
        assert r["trip_count"] == n
        assert r["total_fare_amount_usd"] == Decimal(fare)
        assert r["total_trip_distance_miles"] == Decimal(dist)
        assert r["fare_per_mile_usd"] == fpm
        assert r["fare_per_mile_rank"] == rank
    assert sum(r["trip_count"] for r in got.values()) == 8  # reconciles to the fact
    assert sum(1 for b in got if b is None) == 1


def test_run_checks_single_pass_and_gate(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "id int, v string")
    res = dq.run_checks(df, [dq.not_null("v"), dq.unique("id", "id_unique"),
                             dq.domain("v", ["a", "c"], severity="WARN", threshold_pct=50.0),
                             dq.info("rows", "MEASURE", F.count(F.lit(1)))], "silver", "t")
    st = {r["check_name"]: (r["status"], r["fail_count"]) for r in res.collect()}
    assert st == {"v_not_null": ("FAIL", 1), "id_unique": ("FAIL", 1), "v_domain": ("WARN", 1), "rows": ("INFO", 3)}
    with pytest.raises(dq.GateBlocked):
        dq.gate(res)
    log = dq.with_run(res, "r1", "2026-01-01 00:00:00").unionByName(
        dq.with_run(res.filter("status <> 'FAIL'"), "r2", "2026-01-01 00:00:00"))
    gs = dq.gate_status(log).first()
    assert gs["run_id"] == "r2" and gs["status"] == "PASS"  # tie on time broken by run_id desc
    with pytest.raises(dq.GateBlocked):
        dq.assert_upstream_passed(dq.gate_status(log), [("silver", "t"), ("gold", "never")])


def test_explode_parallel_arrays_and_continuity(spark):
    doc = spark.createDataFrame([("c", ["2026-03-08T05:00", "2026-03-08T06:00", "2026-03-08T08:00"], [1.0, 2.0])],
                                "coord string, t array<string>, temp array<double>")
    rows = explode_parallel_arrays(doc, {"t": "t", "temp": "temp"}, keep=["coord"], position="pos").collect()
    assert [r["pos"] for r in rows] == [0, 1, 2] and rows[2]["temp"] is None  # short array pads with null
    s = explode_parallel_arrays(doc, {"t": "t"}, keep=["coord"]).withColumn("u", F.to_timestamp_ntz(
        F.col("t"), F.lit("yyyy-MM-dd'T'HH:mm"))).withColumn("l", F.col("u"))
    rep = continuity_report(s, ["coord"], "u", "l").first()
    assert (rep["rows"], rep["gaps"], rep["duplicate_times"]) == (3, 1, 0)


def test_lag_distributed_matches_window_with_hot_key(spark):
    from pyspark.sql import Window
    from lakekit.operators.series import lag_distributed
    rows = [(1, i % 97, i) for i in range(3000)]  # one key with most rows, repeated timestamps
    rows += [(k, k * 3, 10_000 + k) for k in range(2, 60)] + [(None, 5, 20_000), (None, 1, 20_001), (7, None, 30_000)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    got = lag_distributed(df, ["k"], ["t", "id"], {"t": "prev_t", "id": "prev_id"}, num_partitions=8)
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.select("*", F.lag("t").over(w).alias("prev_t"), F.lag("id").over(w).alias("prev_id"))
    assert got.count() == df.count()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)
    # the hot key really was spread over several range partitions
    assert df.repartitionByRange(8, "k", "t", "id").filter("k = 1").rdd.getNumPartitions() == 8
    spread = df.repartitionByRange(8, "k", "t", "id").select(F.spark_partition_id().alias("p"), "k") \
        .filter("k = 1").select("p").distinct().count()
    assert spread > 1


def test_chunked_file_hash_matches_hashlib(spark, tmp_path):
    import hashlib
    from lakekit.sources.files import file_bytes_chunked_sha256
    small, big = tmp_path / "a.bin", tmp_path / "b.bin"
    small.write_bytes(b"x" * 700)
    data = bytes(range(256)) * 40  # 10240 bytes -> 11 chunks of 1000
    big.write_bytes(data)
    got = {r["path"].rsplit("/", 1)[-1]: r for r in file_bytes_chunked_sha256(spark, str(tmp_path), chunk_bytes=1000).collect()}
    one = hashlib.sha256(hashlib.sha256(b"x" * 700).hexdigest().encode()).hexdigest()  # the same definition for one chunk
    assert got["a.bin"]["sha256"] == one and got["a.bin"]["chunks"] == 1
    tree = "".join(hashlib.sha256(data[i:i + 1000]).hexdigest() for i in range(0, len(data), 1000))
    assert got["b.bin"]["sha256"] == hashlib.sha256(tree.encode()).hexdigest() and got["b.bin"]["chunks"] == 11


def test_merge_matches_null_keys_and_refuses_repeated_source_keys(spark):
    import pytest

    from lakekit.operators import merge
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (None, "m")], "k int, v string")
    got = {r["k"]: (r["v"], r["_merge_action"]) for r in merge.merge_snapshot(target, source, ["k"], ["v"]).collect()}
    assert got == {1: ("b", "update"), None: ("m", "update")}
    with pytest.raises(Exception, match="more than once"):
        merge.merge_counts(merge.merge_plan(target, source.unionByName(source), ["k"], ["v"])).collect()


def test_snapshot_store_current_version_is_the_last_commit(spark, tmp_path):
    from lakekit.sources.store import SnapshotStore
    store = SnapshotStore(spark, f"file://{tmp_path}/tables")
    assert store.current_version("t") is None
    first = store.write("t", spark.range(3))
    second = store.write("t", spark.range(5))
    assert store.current_version("t") == second and sorted(store.versions("t")) == sorted([first, second])
    assert store.read("t").count() == 5 and store.read("t", first).count() == 3


def test_fingerprint_sums_lanes_exactly_without_a_decimal_a_row(spark):
    import hashlib
    d = spark.range(500).select(F.lit("f").alias("file"), F.sha2(F.col("id").cast("string"), 256).alias("row_digest"))
    d = d.unionByName(spark.createDataFrame([("f", "f" * 64)] * 3 + [("g", "0" * 64)], "file string, row_digest string"))
    got = {r["file"]: (r["content_sha256"], r["row_count"]) for r in fingerprint.content_fingerprint(d, ["file"]).collect()}
    for file, rows in (("f", [hashlib.sha256(str(i).encode()).hexdigest() for i in range(500)] + ["f" * 64] * 3), ("g", ["0" * 64])):
        lanes = [sum(int(x[16 * i:16 * i + 16], 16) for x in rows) for i in range(4)]
        assert got[file] == (hashlib.sha256(":".join(map(str, [len(rows), *lanes])).encode()).hexdigest(), len(rows))
    plan = fingerprint.content_fingerprint(d, ["file"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(conv" not in plan and "as decimal(28" not in plan.lower()


def test_converge_writes_a_partition_by_as_few_tasks_as_it_needs(spark, tmp_path):
    from lakekit.sources.store import SnapshotStore
    store = SnapshotStore(spark, str(tmp_path))
    rows = spark.range(600, numPartitions=6).select("id", (F.col("id") % 3).cast("string").alias("part"))
    assert merge.converge(store, "t", rows, "part") == {"partitions_written": 3, "partitions_dropped": 0, "partitions_unchanged": 0}
    assert len(list(tmp_path.glob("t/data/part=*/*.parquet"))) == 3  # not one by each of six tasks
    assert store.read_partitioned("t").groupBy("part").count().filter("count = 200").count() == 3
