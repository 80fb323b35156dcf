"""Driver contract smoke test and a Spark-vs-DuckDB comparison of a representative query set at sf0.001."""

import decimal
import math

import duckdb
import pytest

from tests.conftest import SF_SMALL

QUICK = ["q1_activity_by_time_and_zone", "q2_trip_behavior_by_weather", "q3_mobility_patterns_by_zone",
         "q4_fare_efficiency_by_borough", "dq_gate_silver_trips", "dq_gate_gold", "c2_period_content_fingerprint",
         "k5_mirror_merge_order_status", "c30_trip_fact", "c44_series_continuity", "i1_first_load_batch_state"]


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9)) if not math.isnan(v) else "nan"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "activity_rank_overall" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    from lakekit.plans.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    s = _rows(cols, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert s == _rows(dcols, cur.fetchall())


@pytest.mark.parametrize("session_tz", ["America/New_York", "Asia/Manila"])
def test_registered_queries_ignore_session_zone(spark, session_tz):
    """Wall-clock (NTZ) business times: the same results whatever time zone the cluster's session uses."""
    import __spark_entry__ as E
    names = ["q1_activity_by_time_and_zone", "c44_series_continuity", "dq_gate_silver_weather", "c20_trip_weather_map"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        base = {}
        for n in names:
            df = E.queries()[n](spark, SF_SMALL)
            base[n] = _rows(df.columns, df.collect())
        spark.conf.set("spark.sql.session.timeZone", session_tz)
        for n in names:
            df = E.queries()[n](spark, SF_SMALL)
            assert _rows(df.columns, df.collect()) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
