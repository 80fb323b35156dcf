"""Registry of runnable queries over the driver tables and their SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> DuckDB SQL`` with identical column names.
Queries are grouped by the inventory section they exercise; each builds its inputs lazily from the driver tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakekit.plans import analytics, checks, oracle
from lakekit.plans.trips import StarBuild

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def star(spark: SparkSession, sf_dir: str) -> StarBuild:
    return StarBuild(spark, sf_dir)


# --- analytics (C32–C36) -----------------------------------------------------------------------------------

@register("q1_activity_by_time_and_zone", oracle.Q1)
def q1(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.q1_activity_by_time_and_zone(s.trip_fact(), s.dim_date(), s.dim_hour(), s.dim_zone())


@register("q2_trip_behavior_by_weather", oracle.Q2)
def q2(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.q2_trip_behavior_by_weather(s.trip_fact(), s.weather_fact(), s.dim_weather_classification())


@register("q2_trip_weather_coverage", oracle.COVERAGE)
def coverage(spark, sf_dir):
    return analytics.trip_weather_coverage(star(spark, sf_dir).trip_fact())


@register("q3_mobility_patterns_by_zone", oracle.Q3)
def q3(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.q3_mobility_patterns_by_zone(s.trip_fact(), s.dim_zone())


@register("q4_fare_efficiency_by_borough", oracle.Q4)
def q4(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.q4_fare_efficiency_by_borough(s.trip_fact(), s.dim_zone())


# --- data-quality gates (C38–C45, Appendix A) --------------------------------------------------------------

_FACT_READ = {"analytics": StarBuild.analysis_fact}


def _gate_query(gate_name: str):
    def run(spark, sf_dir):
        s = star(spark, sf_dir)
        tables = checks.gate_tables(s)
        if gate_name in _FACT_READ:  # several reads of the fact: keyed once, not once a read
            tables["fact"] = _FACT_READ[gate_name](s)
        return checks.GATES[gate_name]().run(tables)
    return run


for _g in checks.GATES:
    _ctes = oracle.ANALYTICS_CTES if _g == "analytics" else oracle.STAR
    register(f"dq_gate_{_g}", checks.GATES[_g]().sql(_ctes))(_gate_query(_g))
