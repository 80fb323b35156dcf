"""Star-schema builders: date, hour, zone and classification dimensions; weather and trip facts.

Dimensions are tiny and bounded by construction (24 hours, codes × 4 bands, one row per calendar day in the data's
span), so they are the broadcast side of every fact join.  Facts keep their own partitioning: each dimension
lookup is a broadcast hash join, so building a fact never shuffles it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.classify import (PRECIPITATION_BANDS, UNKNOWN_CODE, WMO_CONDITIONS, precipitation_band,
                                        time_of_day_band, zone_classification)
from lakekit.functions.digest import surrogate_key
from lakekit.functions.timeops import date_key
from lakekit.operators.resolve import unique_lookup
from lakekit.operators.sizing import broadcast_if_small


def dim_date(dates: DataFrame, date_col: str = "full_date", fixed_bounds: tuple[str, ...] = ()) -> DataFrame:
    """Contiguous calendar from min to max of ``dates`` ∪ ``fixed_bounds``.

    ``dates`` may be any column set; only the min and max are used (one partial aggregation).  ISO weekday 1–7,
    weekend = 6, 7.
    """
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    for b in fixed_bounds:
        d = F.to_date(F.lit(b))
        bounds = bounds.select(F.least(F.coalesce("lo", d), d).alias("lo"), F.greatest(F.coalesce("hi", d), d).alias("hi"))
    cal = bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    dow = (F.dayofweek("full_date") + 5) % 7 + 1  # ISO: Monday = 1 … Sunday = 7
    return cal.select(
        date_key("full_date").alias("date_key"),
        F.col("full_date"),
        F.year("full_date").alias("calendar_year"),
        F.quarter("full_date").alias("calendar_quarter"),
        F.month("full_date").alias("month_number"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day_of_month"),
        dow.cast("int").alias("day_of_week_number"),
        F.date_format("full_date", "EEEE").alias("day_of_week_name"),
        dow.isin(6, 7).alias("weekend_flag"),
    )


def dim_hour(spark: SparkSession) -> DataFrame:
    """24 rows: key = hour, ``HH:00`` label, four time-of-day bands."""
    h = spark.range(0, 24).select(F.col("id").cast("int").alias("hour_of_day"))
    return h.select(
        F.col("hour_of_day").alias("hour_key"),
        "hour_of_day",
        F.concat(F.lpad(F.col("hour_of_day").cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"),
        time_of_day_band("hour_of_day").alias("time_of_day_band"),
    )


def standardise_zones(zones: DataFrame, location_id="location_id", borough="borough", zone="zone",
                      service_zone="service_zone", sentinels=None, special=None, regular=None,
                      regular_label: str = "nyc_borough", na_value: str = "N/A") -> DataFrame:
    """Trim names; service zone ``N/A`` → ``na`` else lower-case; ordered classification rule."""
    return zones.select(
        F.col(location_id).cast("int").alias("location_id"),
        F.trim(F.col(borough)).alias("borough"),
        F.trim(F.col(zone)).alias("zone_name"),
        F.when(F.col(service_zone) == na_value, F.lit("na")).otherwise(F.lower(F.trim(F.col(service_zone))))
        .alias("service_zone"),
        zone_classification(F.col(location_id), F.col(borough), sentinels, special, regular, regular_label)
        .alias("zone_classification"),
        *[c for c in zones.columns if c not in {location_id, borough, zone, service_zone}],
    )


def dim_zone(zones_clean: DataFrame, sentinels=None, special=None, regular=None,
             regular_label: str = "nyc_borough") -> DataFrame:
    """Zone dimension: ``zone_key = bigint(location_id)`` + case-insensitive classification + lineage."""
    lineage = [c for c in zones_clean.columns
               if c not in {"location_id", "zone_name", "borough", "service_zone", "zone_classification"}]
    return zones_clean.select(
        F.col("location_id").cast("long").alias("zone_key"),
        "location_id", "zone_name", "borough", "service_zone",
        zone_classification(F.col("location_id"), F.col("borough"), sentinels, special, regular, regular_label,
                            case_insensitive=True).alias("zone_classification"),
        *lineage,
    )


def dim_weather_classification(spark: SparkSession, observed_codes: DataFrame | None = None,
                               code_col: str = "weather_code") -> DataFrame:
    """Known WMO codes × precipitation bands (28 × 4 = 112 rows), key = sha256 of (code, band).

    With ``observed_codes``, codes outside the known list become ``unknown_code`` members, so an hour with an
    unlisted code still classifies instead of blocking the weather fact.  The member set is bounded by the code
    domain, not by the data volume.
    """
    known = spark.createDataFrame(WMO_CONDITIONS, "weather_code int, weather_condition string")
    if observed_codes is not None:
        extra = (observed_codes.select(F.col(code_col).cast("int").alias("weather_code")).dropna().distinct()
                 .join(known.select("weather_code"), "weather_code", "left_anti")
                 .withColumn("weather_condition", F.lit(UNKNOWN_CODE)))
        known = known.unionByName(extra)
    bands = spark.createDataFrame([(b,) for b in PRECIPITATION_BANDS], "precipitation_band string")
    return known.crossJoin(F.broadcast(bands)).select(  # 4-row band list: a cross join by definition
        surrogate_key(weather_code="weather_code", precipitation_band="precipitation_band")
        .alias("weather_classification_key"),
        "weather_code", "weather_condition", "precipitation_band")


def weather_fact(hourly: DataFrame, dates: DataFrame, hours: DataFrame, classes: DataFrame) -> DataFrame:
    """Band each hour, resolve date, hour and classification keys (broadcast lookups), keep the Silver grain."""
    banded = hourly.withColumn("precipitation_band", precipitation_band("precipitation_mm"))
    d = broadcast_if_small(dates.select(F.col("full_date").alias("__d"), F.col("date_key").alias("observation_date_key")),
                           100_000)
    h = F.broadcast(hours.select(F.col("hour_of_day").alias("__h"), F.col("hour_key").alias("observation_hour_key")))
    c = broadcast_if_small(classes.select(F.col("weather_code").alias("__c"), F.col("precipitation_band").alias("__b"),
                                   "weather_classification_key"), 100_000)
    out = (banded.join(d, banded["observation_date_local"] == d["__d"], "left")
           .join(h, banded["observation_hour_local"] == h["__h"], "left")
           .join(c, (banded["weather_code"] == c["__c"]) & (banded["precipitation_band"] == c["__b"]), "left")
           .drop("__d", "__h", "__c", "__b"))
    return out


def date_hour_keys(df: DataFrame, roles: dict[str, str], dates: DataFrame, hours: DataFrame) -> DataFrame:
    """``<role>_date_key`` and ``<role>_hour_key`` for each ``role -> NTZ column`` via broadcast dimension joins."""
    out = df
    d = broadcast_if_small(dates.select("full_date", "date_key"), 100_000)
    h = F.broadcast(hours.select("hour_of_day", "hour_key"))
    for role, col in roles.items():
        dd = d.select(F.col("full_date").alias(f"__d_{role}"), F.col("date_key").alias(f"{role}_date_key"))
        hh = h.select(F.col("hour_of_day").alias(f"__h_{role}"), F.col("hour_key").alias(f"{role}_hour_key"))
        out = (out.join(dd, F.to_date(out[col]) == dd[f"__d_{role}"], "left")
               .join(hh, F.hour(out[col]) == hh[f"__h_{role}"], "left")
               .drop(f"__d_{role}", f"__h_{role}"))
    return out


def zone_keys(df: DataFrame, roles: dict[str, str], zones: DataFrame, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """``<role>_zone_key`` for each ``role -> location id column`` (left join on ``location_id``)."""
    z = broadcast_if_small(unique_lookup(zones.select("location_id", "zone_key"), "location_id"), max_broadcast_rows)
    out = df
    for role, col in roles.items():
        zz = z.select(F.col("location_id").alias(f"__z_{role}"), F.col("zone_key").alias(f"{role}_zone_key"))
        out = out.join(zz, out[col] == zz[f"__z_{role}"], "left").drop(f"__z_{role}")
    return out


def eligibility(prefix: str = "") -> dict[str, Column]:
    """Measure eligibility on fact flags: a row ineligible for one measure still counts as a trip."""
    p = prefix
    dur = F.col(f"{p}trip_duration_seconds")
    return {
        "duration_eligible": F.coalesce(~F.col(f"{p}dropoff_before_pickup_flag") & (dur > 0) & (dur <= 86400),
                                        F.lit(False)),
        "distance_eligible": ~F.col(f"{p}negative_trip_distance_flag"),
        "fare_eligible": ~F.col(f"{p}negative_fare_amount_flag"),
        "distance_positive_eligible": F.coalesce(~F.col(f"{p}negative_trip_distance_flag")
                                                 & (F.col(f"{p}trip_distance_miles") > 0), F.lit(False)),
    }
