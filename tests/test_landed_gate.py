"""The gate over landed trips: counted by origin in one pass, over folders read once a state."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import __spark_entry__  # noqa: F401  (registers the queries)
from lakekit.operators import ingest
from lakekit.plans import checks, landing
from lakekit.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def test_the_landed_gate_reads_rows_once_and_counts_them_by_origin(spark):
    at = lambda day: dt.datetime(2024, day[0], day[1], 8, 30)
    march = [(i, 1, 1, at((3, 5)), at((3, 5)), 4, 5, 1, 1.5, 10.0, 12.0) for i in range(5)]
    march += [(9, 1, None, None, at((3, 6)), None, None, None, None, None, None), (10, 1, 1, at((2, 29)), at((3, 1)), 4, 5, 1, 1.0, 2.0, 3.0)]
    april = [(20 + i, 1, 1, at((4, 2)), at((4, 2)), 4, 5, 1, 1.5, 10.0, 12.0) for i in range(3)]
    run = landing.TripLandingRun(spark, SF_SMALL)
    parts = {"2024-03": (march[:4], march[4:]), "2024-04": (april,)}
    for period, rows in parts.items():
        for part in rows:
            spark.createDataFrame(part, run.schema).coalesce(1).write.mode("append").parquet(f"{run.landing}/period={period}")
    assert run.load().filter("mismatch").count() == 0

    # a month in two parts has the fingerprint of its rows in one, and no row pays for the folder's name
    whole = spark.createDataFrame([("m", *r) for r in march], StructType([StructField("file", StringType()), *run.schema.fields]))
    assert ingest.file_fingerprints(whole, run.schema.names, "file").select("content_sha256", "row_count").first() in \
        run.contents().select("content_sha256", "row_count").collect()
    plan = run.contents()._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Aggregate [")[2].split("\n", 1)[1]  # what rows go through before they are summed up
    assert "substring_index" in plan and "substring_index" not in below and below.count("conv(") == 4

    def got(tables):
        return {r["check_name"]: (r["fail_count"], r["total_count"]) for r in checks.landed_trips_gate().run(tables).collect()}

    clean = {"row_count_not_empty": (0, 1), "source_schema": (0, 13), "provenance_completeness": (0, 10), "source_system_domain": (0, 10),
             "batch_registered_in_control": (0, 10), "single_content_version": (0, 2), "expected_month_coverage": (1, 10),
             "bronze_matches_current_files": (0, 2)}
    tables = checks.landed_gate_tables(run)
    assert sorted(r["rows"] for r in tables["landed_trips"].collect()) == [1, 1, 3, 5]  # March: no pickup, outside, inside; April
    assert got(tables) == clean

    # rows without a batch or of another one, a wrong system, a content that no file has: each counts as often as it lies there
    spoilt = spark.createDataFrame([("trip_files", "trips_2024-03.parquet", None, "c1", None, 7),
                                    ("other", None, "b9", "c1", True, 4)], tables["landed_trips"].schema)
    bad = got(tables | {"landed_trips": tables["landed_trips"].unionByName(spoilt), "file_versions": tables["file_versions"]})
    assert bad == clean | {"provenance_completeness": (11, 21), "source_system_domain": (4, 21), "batch_registered_in_control": (11, 21),
                           "expected_month_coverage": (5, 21), "bronze_matches_current_files": (1, 2)}
    empty = got(tables | {"landed_trips": tables["landed_trips"].limit(0)})
    assert empty["row_count_not_empty"] == (1, 1) and empty["provenance_completeness"] == (0, 0)
    assert empty["bronze_matches_current_files"] == (2, 2)

    # a later gate of the run reads again what changed, and nothing else
    run.redeliver("2024-04", F.col("l_orderkey") > 20)
    rows = tables["landed_trips"]
    again = checks.landed_gate_tables(run, {"landed_trips": rows})
    assert again["landed_trips"] is rows and got(again) == clean | {"bronze_matches_current_files": (2, 2)}


def test_landed_scenarios_read_bronze_and_folder_once_a_state(spark, monkeypatch):
    calls = []
    for name in ("contents", "landed_counts"):
        def counted(self, *a, _name=name, _own=getattr(landing.TripLandingRun, name), **b):
            calls.append(_name)
            return _own(self, *a, **b)
        monkeypatch.setattr(landing.TripLandingRun, name, counted)
    got = {(r["scenario"], r["check_name"]): r["fail_count"] for r in QUERIES["dq_gate_landed_trips_scenarios"](spark, SF_SMALL).collect()}
    assert calls == ["contents", "landed_counts", "contents", "landed_counts", "contents"]  # load; loaded; stray rows; file revised
    assert [got[s, "bronze_matches_current_files"] for s in ("loaded", "batch demoted", "stray rows", "file revised")] == [0, 0, 1, 3]
    assert [got[s, "source_schema"] for s in ("batch demoted", "stray rows")] == [0, 1]
    assert 0 == got["loaded", "batch_registered_in_control"] < got["batch demoted", "batch_registered_in_control"]
    assert 2 * got["batch demoted", "batch_registered_in_control"] == got["stray rows", "batch_registered_in_control"]
