"""The four analytical questions and the coverage report, over the trip and weather facts.

Each result is one grouped aggregation over the fact after broadcast dimension lookups (a single shuffle of
map-side partial aggregates); ranks use :func:`lakekit.operators.metrics.dense_rank_by` (distinct values ranked
then joined back), and shares of total use a one-row grand total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.metrics import (dense_rank_by, eligible_count, eligible_sum, safe_ratio, share_of_total)
from lakekit.operators.sizing import broadcast_if_small
from lakekit.operators.star import eligibility
from lakekit.session import cut_lineage

DIST_T = "decimal(38,3)"
MONEY_T = "decimal(38,2)"


def _measures(prefix_total: str = "total_", prefix_count: str = "trips_with_eligible_"):
    e = eligibility()
    return [
        eligible_sum("trip_duration_seconds", e["duration_eligible"]).cast("long").alias(f"{prefix_total}duration_seconds"),
        eligible_count(e["duration_eligible"]).alias(f"{prefix_count}duration"),
        eligible_sum("trip_distance_miles", e["distance_eligible"]).cast(DIST_T).alias(f"{prefix_total}trip_distance_miles"),
        eligible_count(e["distance_eligible"]).alias(f"{prefix_count}distance"),
        eligible_sum("fare_amount_usd", e["fare_eligible"]).cast(MONEY_T).alias(f"{prefix_total}fare_amount_usd"),
        eligible_count(e["fare_eligible"]).alias(f"{prefix_count}fare"),
    ]


def _averages(tot: str = "total_", cnt: str = "trips_with_eligible_"):
    return [
        safe_ratio(f"{tot}duration_seconds", f"{cnt}duration", 2, 60.0).alias("avg_trip_duration_minutes"),
        safe_ratio(f"{tot}trip_distance_miles", f"{cnt}distance", 3).alias("avg_trip_distance_miles"),
        safe_ratio(f"{tot}fare_amount_usd", f"{cnt}fare", 2).alias("avg_fare_amount_usd"),
    ]


def q1_activity_by_time_and_zone(fact: DataFrame, dim_date: DataFrame, dim_hour: DataFrame,
                                 dim_zone: DataFrame) -> DataFrame:
    """Q1: per pickup date × hour × pickup zone: trips, three eligible averages with totals and denominators,
    dense rank overall and within hour.  The zone is left-joined so unresolved activity stays visible."""
    d = broadcast_if_small(dim_date.select("date_key", "full_date", "day_of_week_name", "weekend_flag"), 100_000)
    h = F.broadcast(dim_hour.select("hour_key", "hour_of_day", "time_of_day_band"))  # 24 rows
    z = broadcast_if_small(dim_zone.select("zone_key", "zone_name", "borough", "service_zone", "zone_classification"))
    t = (fact.join(d, fact["pickup_date_key"] == d["date_key"])
         .join(h, fact["pickup_hour_key"] == h["hour_key"])
         .join(z, fact["pickup_zone_key"] == z["zone_key"], "left"))
    g = t.groupBy(
        F.col("full_date").alias("pickup_date"), F.col("day_of_week_name").alias("pickup_day_of_week"),
        F.col("weekend_flag").alias("pickup_is_weekend"), F.col("hour_of_day").alias("pickup_hour"),
        F.col("time_of_day_band").alias("pickup_time_of_day_band"), F.col("zone_name").alias("pickup_zone_name"),
        F.col("borough").alias("pickup_borough"), F.col("service_zone").alias("pickup_service_zone"),
        F.col("zone_classification").alias("pickup_zone_classification"),
    ).agg(F.sum("trip_count").cast("long").alias("trip_count"), *_measures())
    # the aggregate is bounded by dates × hours × zones; written once, so both ranks read it instead of
    # re-scanning and re-aggregating the fact per rank
    g = cut_lineage(g.select("*", *_averages()), "q1_activity")
    g = dense_rank_by(g, "trip_count", "activity_rank_overall")
    g = dense_rank_by(g, "trip_count", "activity_rank_within_hour", partition_cols=["pickup_hour"])
    return g


def q2_trip_behavior_by_weather(trip_fact: DataFrame, weather_fact: DataFrame, classes: DataFrame) -> DataFrame:
    """Q2: per weather condition × precipitation band; denominator = covered hours (from the weather fact, so
    zero-trip classes keep their row); both sides aggregated before the join (no fan-out)."""
    hours = weather_fact.groupBy("weather_classification_key").agg(
        F.count(F.lit(1)).cast("long").alias("covered_hours"),
        F.round(F.sum("temperature_2m_c").cast("double") / F.count("temperature_2m_c"), 2).alias("avg_temperature_c"),
        F.round(F.sum("precipitation_mm"), 2).cast(MONEY_T).alias("total_precipitation_mm"))
    trips = (trip_fact.filter(F.col("pickup_weather_classification_key").isNotNull())
             .groupBy(F.col("pickup_weather_classification_key").alias("weather_classification_key"))
             .agg(F.sum("trip_count").cast("long").alias("trip_count"), *_measures()))
    c = broadcast_if_small(classes.select("weather_classification_key", "weather_condition", "precipitation_band"))
    j = hours.join(c, "weather_classification_key").join(trips, "weather_classification_key", "left")
    ratio = F.coalesce(F.col("trip_count"), F.lit(0)).cast("double") / F.when(F.col("covered_hours") != 0,
                                                                             F.col("covered_hours").cast("double"))
    out = j.select(
        "weather_condition", "precipitation_band", "covered_hours", "avg_temperature_c", "total_precipitation_mm",
        F.coalesce(F.col("trip_count"), F.lit(0)).cast("long").alias("trip_count"),
        F.round(ratio, 2).alias("trips_per_covered_hour"),
        "trips_with_eligible_duration",
        safe_ratio("total_duration_seconds", "trips_with_eligible_duration", 2, 60.0).alias("avg_trip_duration_minutes"),
        "trips_with_eligible_distance",
        safe_ratio("total_trip_distance_miles", "trips_with_eligible_distance", 3).alias("avg_trip_distance_miles"),
        "trips_with_eligible_fare",
        safe_ratio("total_fare_amount_usd", "trips_with_eligible_fare", 2).alias("avg_fare_amount_usd"),
        ratio.alias("__ratio"))
    out = cut_lineage(out, "q2_weather")  # one row per class: rank the written result, not a re-aggregation
    return dense_rank_by(out, "__ratio", "activity_rank_by_trips_per_hour").drop("__ratio")


def trip_weather_coverage(trip_fact: DataFrame) -> DataFrame:
    """Every trip counted once under its weather match status, with its share of all trips."""
    g = trip_fact.groupBy("weather_match_status").agg(F.sum("trip_count").cast("long").alias("trip_count"))
    return share_of_total(g, "trip_count", "pct_of_all_trips", 4)


def q3_mobility_patterns_by_zone(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Q3: per zone (driven by the dimension, zero-activity zones kept): pickups, drop-offs, net arrivals,
    pickup share, pickup-side averages, active days, two ranks.  Each role is aggregated before the join."""
    e = eligibility()
    pickups = fact.groupBy(F.col("pickup_zone_key").alias("zone_key")).agg(
        F.sum("trip_count").cast("long").alias("pickup_count"),
        eligible_sum("trip_duration_seconds", e["duration_eligible"]).cast("long").alias("pickup_total_duration_seconds"),
        eligible_count(e["duration_eligible"]).alias("pickup_trips_eligible_duration"),
        eligible_sum("trip_distance_miles", e["distance_eligible"]).cast(DIST_T).alias("pickup_total_distance_miles"),
        eligible_count(e["distance_eligible"]).alias("pickup_trips_eligible_distance"),
        eligible_sum("fare_amount_usd", e["fare_eligible"]).cast(MONEY_T).alias("pickup_total_fare_usd"),
        eligible_count(e["fare_eligible"]).alias("pickup_trips_eligible_fare"),
        F.countDistinct("pickup_date_key").cast("long").alias("pickup_active_days"))
    dropoffs = fact.groupBy(F.col("dropoff_zone_key").alias("zone_key")).agg(
        F.sum("trip_count").cast("long").alias("dropoff_count"))
    z = dim_zone.select("zone_key", "zone_name", "borough", "service_zone", "zone_classification")
    j = z.join(pickups, "zone_key", "left").join(dropoffs, "zone_key", "left")
    pc = F.coalesce(F.col("pickup_count"), F.lit(0)).cast("long")
    dc = F.coalesce(F.col("dropoff_count"), F.lit(0)).cast("long")
    out = j.select(
        "zone_name", "borough", "service_zone", "zone_classification",
        pc.alias("pickup_count"), dc.alias("dropoff_count"), (dc - pc).alias("net_arrivals"),
        safe_ratio(pc, pc + dc, 4).alias("pickup_share_of_zone_activity"),
        "pickup_total_duration_seconds", "pickup_trips_eligible_duration",
        safe_ratio("pickup_total_duration_seconds", "pickup_trips_eligible_duration", 2, 60.0)
        .alias("avg_trip_duration_minutes"),
        "pickup_total_distance_miles", "pickup_trips_eligible_distance",
        safe_ratio("pickup_total_distance_miles", "pickup_trips_eligible_distance", 3).alias("avg_trip_distance_miles"),
        "pickup_total_fare_usd", "pickup_trips_eligible_fare",
        safe_ratio("pickup_total_fare_usd", "pickup_trips_eligible_fare", 2).alias("avg_fare_amount_usd"),
        "pickup_active_days",
        safe_ratio(pc, "pickup_active_days", 2).alias("avg_pickups_per_active_day"))
    out = cut_lineage(out, "q3_zones")  # one row per zone
    out = dense_rank_by(out, "pickup_count", "pickup_rank")
    return dense_rank_by(out, "dropoff_count", "dropoff_rank")


def q4_fare_efficiency_by_borough(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Q4: fare per mile by pickup borough = Σ eligible fare / Σ eligible positive distance (sum of sums)."""
    e = eligibility()
    z = broadcast_if_small(dim_zone.select("zone_key", "borough"))
    t = fact.join(z, fact["pickup_zone_key"] == z["zone_key"], "left")
    g = t.groupBy(F.col("borough").alias("pickup_borough")).agg(
        F.sum("trip_count").cast("long").alias("trip_count"),
        eligible_sum("fare_amount_usd", e["fare_eligible"]).cast(MONEY_T).alias("total_fare_amount_usd"),
        eligible_sum("trip_distance_miles", e["distance_positive_eligible"]).cast(DIST_T)
        .alias("total_trip_distance_miles"),
        eligible_count(e["fare_eligible"]).alias("__n_fare"),
        eligible_count(e["distance_positive_eligible"]).alias("__n_dist"))
    ratio = safe_ratio("total_fare_amount_usd", "total_trip_distance_miles")
    out = g.select(
        "pickup_borough", "trip_count", "total_fare_amount_usd", "total_trip_distance_miles",
        F.round(ratio, 2).alias("fare_per_mile_usd"),
        safe_ratio("total_fare_amount_usd", "__n_fare", 2).alias("avg_fare_amount_usd"),
        safe_ratio("total_trip_distance_miles", "__n_dist", 3).alias("avg_trip_distance_miles"),
        ratio.alias("__ratio"))
    out = cut_lineage(out, "q4_boroughs")  # one row per borough
    return dense_rank_by(out, "__ratio", "fare_per_mile_rank").drop("__ratio")


def build_reconciliation(published: DataFrame, fact: DataFrame, published_col: str = "trip_count") -> DataFrame:
    """One row of scalars after a build: published total next to the fact total, result rows."""
    p = published.agg(F.sum(published_col).cast("long").alias("analytics_trip_count"),
                      F.count(F.lit(1)).cast("long").alias("result_rows"))
    f = fact.agg(F.sum("trip_count").cast("long").alias("gold_trip_count"))
    return p.crossJoin(f)  # two one-row aggregates


# What each build reports when it is done: build -> measure -> (table, aggregate).  Sums are of counts and money, in decimals.
_GOLD_TRIPS = ("fact", "sum(trip_count)")
BUILD_MEASURES = {
    "weather fact": {"silver_rows": ("weather", "count(1)"), "gold_rows": ("weather_fact", "count(1)"),
                     "unresolved_classification_rows": ("weather_fact", "count_if(weather_classification_key IS NULL)")},
    "trip fact": {"silver_clean_rows": ("clean", "count(1)"), "gold_trip_count": _GOLD_TRIPS,
                  "silver_fare_total": ("clean", "sum(fare_amount_usd)"), "gold_fare_total": ("fact", "sum(fare_amount_usd)"),
                  "null_pickup_zone_keys": ("fact", "count_if(pickup_zone_key IS NULL)"),
                  "weather_no_match_rows": ("fact", "count_if(weather_match_status = 'no_match')")},
    "q1": {"analytics_trip_count": ("q1_result", "sum(trip_count)"), "gold_trip_count": _GOLD_TRIPS,
           "result_rows": ("q1_result", "count(1)"), "rows_with_unresolved_zone": ("q1_result", "count_if(pickup_zone_name IS NULL)")},
    "q2": {"weather_attributed_trips": ("q2_result", "sum(trip_count)"), "gold_trip_count": _GOLD_TRIPS,
           "covered_hours": ("q2_result", "sum(covered_hours)"), "gold_weather_hours": ("weather_fact", "count(1)")},
    "q3": {"analytics_pickups": ("q3_result", "sum(pickup_count)"), "analytics_dropoffs": ("q3_result", "sum(dropoff_count)"),
           "gold_trip_count": _GOLD_TRIPS,
           "zones_with_no_activity": ("q3_result", "count_if(pickup_count = 0 AND dropoff_count = 0)")},
    "q4": {"analytics_trip_count": ("q4_result", "sum(trip_count)"), "gold_trip_count": _GOLD_TRIPS,
           "result_rows": ("q4_result", "count(1)"),
           "rows_with_unresolved_borough": ("q4_result", "count_if(pickup_borough IS NULL)")},
}


def build_reports(tables, measures: dict = BUILD_MEASURES) -> DataFrame:
    """One row per build and measure, ``(build, measure, value)``; each table is aggregated once for all reports that name it.

    Sums over an empty table are null, counts zero.  ``tables``: name to DataFrame.
    """
    asked: dict[str, dict[str, str]] = {}  # table -> aggregate -> column
    for table, sql in {m for report in measures.values() for m in report.values()}:
        asked.setdefault(table, {})[sql] = ""
    one = None
    for t, table in enumerate(sorted(asked)):
        for i, sql in enumerate(sorted(asked[table])):
            asked[table][sql] = f"m{t}_{i}"
        row = tables[table].agg(*[F.expr(sql).cast("decimal(38,2)").alias(name) for sql, name in asked[table].items()])
        one = row if one is None else one.crossJoin(row)  # one-row aggregates
    reports = [F.struct(F.lit(build).alias("build"), F.lit(measure).alias("measure"), F.col(asked[table][sql]).alias("value"))
               for build, report in measures.items() for measure, (table, sql) in report.items()]
    return one.select(F.inline(F.array(*reports)))


# --- spot checks: the top published cell of each question, recomputed from the facts ------------------------
# The target is one row (deterministic full-order top-1), broadcast against the fact on its dimension keys, so
# the recomputation is a filtered scan of the fact with no shuffle of fact rows.

def q1_spot_check(q1: DataFrame, fact: DataFrame, dim_date: DataFrame, dim_hour: DataFrame,
                  dim_zone: DataFrame) -> DataFrame:
    """(published_trips, recomputed_trips) for the busiest date × hour × zone cell of Q1."""
    target = (q1.orderBy(F.col("trip_count").desc(), F.col("pickup_date").asc_nulls_first(),
                         F.col("pickup_hour").asc_nulls_first(), F.col("pickup_zone_name").asc_nulls_first())
              .limit(1).select("pickup_date", "pickup_hour", "pickup_zone_name",
                               F.col("trip_count").alias("published_trips")))
    keys = (target.join(dim_date.select(F.col("full_date").alias("pickup_date"), "date_key"), "pickup_date")
            .join(dim_hour.select(F.col("hour_of_day").alias("pickup_hour"), "hour_key"), "pickup_hour"))
    f = fact.join(F.broadcast(keys), (fact["pickup_date_key"] == keys["date_key"])
                  & (fact["pickup_hour_key"] == keys["hour_key"]))
    z = broadcast_if_small(dim_zone.select("zone_key", "zone_name"), 1_000_000)
    f = f.join(z, f["pickup_zone_key"] == z["zone_key"], "left") \
        .filter(F.col("zone_name").eqNullSafe(F.col("pickup_zone_name")))
    recomputed = f.agg(F.sum("trip_count").cast("long").alias("recomputed_trips"))
    return target.crossJoin(recomputed).select("published_trips", "recomputed_trips")


def q2_spot_check(q2: DataFrame, fact: DataFrame, weather_fact: DataFrame, classes: DataFrame) -> DataFrame:
    """Trips and covered hours of the busiest weather condition × band of Q2, recomputed from both facts
    (zero when no trip carries the class)."""
    target = (q2.orderBy(F.col("trip_count").desc(), F.col("weather_condition").asc_nulls_first(),
                         F.col("precipitation_band").asc_nulls_first())
              .limit(1).select("weather_condition", "precipitation_band",
                               F.col("trip_count").alias("published_trips"), "covered_hours"))
    keys = F.broadcast(target.join(classes.select("weather_condition", "precipitation_band",
                                                  "weather_classification_key"),
                                   ["weather_condition", "precipitation_band"]).select("weather_classification_key"))
    trips = fact.join(keys, fact["pickup_weather_classification_key"] == keys["weather_classification_key"],
                      "left_semi").agg(F.coalesce(F.sum("trip_count"), F.lit(0)).cast("long").alias("recomputed_trips"))
    hours = weather_fact.join(keys, "weather_classification_key", "left_semi") \
        .agg(F.count(F.lit(1)).cast("long").alias("recomputed_hours"))
    return target.crossJoin(trips).crossJoin(hours).select("published_trips", "recomputed_trips", "covered_hours",
                                                           "recomputed_hours")


def q3_spot_check(q3: DataFrame, fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Pickups and average fare (summed fare over eligible trips) of the busiest zone of Q3, recomputed."""
    e = eligibility()
    target = (q3.filter(F.col("pickup_count") > 0)
              .orderBy(F.col("pickup_count").desc(), F.col("zone_name").asc_nulls_first()).limit(1)
              .select("zone_name", F.col("pickup_count").alias("published_pickups"),
                      F.col("avg_fare_amount_usd").alias("published_avg_fare")))
    keys = F.broadcast(target.join(dim_zone.select("zone_name", "zone_key"), "zone_name").select("zone_key"))
    f = fact.join(keys, fact["pickup_zone_key"] == keys["zone_key"], "left_semi")
    recomputed = f.agg(F.sum("trip_count").cast("long").alias("recomputed_pickups"),
                       safe_ratio(eligible_sum("fare_amount_usd", e["fare_eligible"]).cast(MONEY_T),
                                  eligible_count(e["fare_eligible"]), 2).alias("recomputed_avg_fare"))
    return target.crossJoin(recomputed).select("published_pickups", "recomputed_pickups", "published_avg_fare",
                                               "recomputed_avg_fare")
