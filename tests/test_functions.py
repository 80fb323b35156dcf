import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakekit.functions import (ambiguous_local_flag, date_key, dq_status, local_to_utc, nonexistent_local_flag,
                               precipitation_band, row_digest, seconds_between, time_of_day_band, truncate_hour,
                               utc_to_local, wmo_condition, zone_classification)

TZ = "America/New_York"


def ntz(s):
    return dt.datetime.fromisoformat(s)


@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York", "Asia/Manila"])
def test_wall_clock_ops_ignore_session_zone(spark, session_tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.sql("SELECT timestamp_ntz'2026-03-08 02:15:30.5' AS t, timestamp_ntz'2026-03-08 01:59:00.9' AS a, "
                       "timestamp_ntz'2026-03-08 03:01:00.1' AS b")
        r = df.select(truncate_hour("t").alias("h"), seconds_between("a", "b").alias("s"),
                      seconds_between("b", "a").alias("neg"), date_key("t").alias("k")).first()
        assert r["h"] == ntz("2026-03-08 02:00:00")
        assert r["s"] == 3719  # truncated toward zero, wall clock
        assert r["neg"] == -3719
        assert r["k"] == 20260308
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dst_gap_and_overlap(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-03-08 02:30:00' AS gap, timestamp_ntz'2026-11-01 01:30:00' AS amb, "
                   "timestamp_ntz'2026-06-01 12:00:00' AS normal")
    r = df.select(local_to_utc("gap", TZ).alias("gu"), nonexistent_local_flag("gap", TZ).alias("g"),
                  ambiguous_local_flag("amb", TZ).alias("a"), local_to_utc("amb", TZ).alias("au"),
                  nonexistent_local_flag("normal", TZ).alias("gn"), ambiguous_local_flag("normal", TZ).alias("an"),
                  utc_to_local(local_to_utc("normal", TZ), TZ).alias("rt")).first()
    assert r["gu"] == ntz("2026-03-08 07:30:00")
    assert r["g"] is True and r["gn"] is False
    assert r["a"] is True and r["an"] is False
    assert r["au"] == ntz("2026-11-01 05:30:00")  # the earlier offset
    assert r["rt"] == ntz("2026-06-01 12:00:00")


def test_row_digest_nulls_do_not_shift(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    for mode in ("json", "text"):
        hashes = [r[0] for r in df.select(row_digest("x", "y", "z", mode=mode)).collect()]
        assert len(set(hashes)) == 2 and all(len(h) == 64 for h in hashes)


def test_wmo_bands_and_hours(spark):
    df = spark.createDataFrame([(0, 0.0, 0), (45, 2.5, 6), (99, 7.5, 12), (17, 7.6, 18), (None, -1.0, 23),
                                (61, None, 5)], "code int, mm double, h int")
    rows = df.select(wmo_condition("code").alias("c"), precipitation_band("mm").alias("b"),
                     time_of_day_band("h").alias("t")).collect()
    assert [r["c"] for r in rows] == ["clear_sky", "fog", "thunderstorm_with_hail", "unknown_code", None, "rain"]
    assert [r["b"] for r in rows] == ["dry", "light", "moderate", "heavy", None, None]
    assert [r["t"] for r in rows] == ["overnight", "morning", "afternoon", "evening", "evening", "overnight"]


def test_zone_classification_ordered_rule(spark):
    df = spark.createDataFrame([(264, "Unknown"), (265, "N/A"), (1, "EWR"), (4, " Manhattan "), (7, "Queens"),
                                (9, "Elsewhere")], "id int, borough string")
    got = [r[0] for r in df.select(zone_classification("id", "borough")).collect()]
    assert got == ["unknown", "outside_nyc", "ewr", "nyc_borough", "nyc_borough", "other_special"]
    ci = [r[0] for r in spark.createDataFrame([(5, "manhattan")], "id int, borough string")
          .select(zone_classification("id", "borough", case_insensitive=True)).collect()]
    assert ci == ["nyc_borough"]


def test_dq_status_rule(spark):
    df = spark.createDataFrame([("INFO", 5, 1.0, None), ("FAIL", 0, 0.0, 0.0), ("FAIL", 1, 0.1, 0.0),
                                ("WARN", 1, 0.05, 0.1), ("WARN", 3, 0.2, 0.1)],
                               "sev string, n long, pct double, thr double")
    got = [r[0] for r in df.select(dq_status("sev", "n", "pct", "thr")).collect()]
    assert got == ["INFO", "PASS", "FAIL", "WARN", "FAIL"]


def test_delimited_text_tells_all_rows_apart(spark):
    from lakekit.functions import delimited_text
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("<null>", "c"), ("\\<null>", "c"), ("a\\", "b|c"), ("a\\|b", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(delimited_text("x", "y").alias("t")).distinct().count() == len(rows)
    assert df.sparkSession.createDataFrame([("a", None)], "x string, y string").select(
        delimited_text("x", "y")).first()[0] == "a|<null>"


def test_seconds_between_is_exact_over_thousands_of_years(spark):
    rows = [("1900-01-01 00:00:00", "9999-12-31 23:59:59.999999", 255611289599), ("2024-03-10 00:00:00.5", "2024-03-10 05:00:00", 17999),
            ("2024-03-10 05:00:00", "2024-03-10 00:00:00.5", -17999), (None, "2024-03-10 05:00:00", None)]
    df = spark.createDataFrame(rows, "a string, b string, s long").selectExpr("CAST(a AS timestamp_ntz) a", "CAST(b AS timestamp_ntz) b", "s")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert df.filter(~seconds_between("a", "b").eqNullSafe(F.col("s"))).count() == 0
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
