"""The trip / zone / weather star built from the driver tables with the library operators.

Silver (typed, flagged, de-duplicated) → Integration (narrow key maps with match status) → Gold (dimensions and
two facts).  Every step is a lazy DataFrame; callers decide what to materialise (``StarBuild.materialise``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.classify import wmo_condition
from lakekit.functions.digest import row_digest
from lakekit.functions.flags import trip_quality_flags, two_valued, with_flags
from lakekit.functions.timeops import local_to_utc, seconds_between, utc_to_local
from lakekit.operators import dedup, guards, resolve, star
from lakekit.operators.series import explode_parallel_arrays
from lakekit.operators.sizing import broadcast_if_small
from lakekit.plans.landing import TripLandingRun
from lakekit.plans.tables import (LOCAL_TZ, REPORTING_WINDOW, SENTINEL_IDS, ZONE_RULE, Tables, raw_trips, raw_zones,
                                  weather_documents)

TRIP_IDENTITY = ["l_orderkey", "l_linenumber"]

# what a trip landed from files also carries
LINEAGE = ["batch_id", "content_sha256"]

# what the questions, their spot checks and their gate read of the trip fact: no digest of a trip, no text but the class key and
# the match status
ANALYSIS_COLUMNS = ["pickup_date_key", "pickup_hour_key", "pickup_zone_key", "dropoff_zone_key", "pickup_weather_classification_key",
                    "weather_match_status", "pickup_datetime_local", "trip_count", "trip_duration_seconds", "trip_distance_miles",
                    "fare_amount_usd", "dropoff_before_pickup_flag", "negative_trip_distance_flag", "negative_fare_amount_flag"]

# declared columns of the two key maps; a rebuild keeps them whatever the inputs' types
ZONE_MAP_SCHEMA = {"trip_hash": "string", "pickup_location_id": "int", "dropoff_location_id": "int",
                   "pickup_zone_match_status": "string", "dropoff_zone_match_status": "string"}
WEATHER_MAP_SCHEMA = {"trip_hash": "string", "pickup_timestamp_utc": "timestamp_ntz", "pickup_weather_observation_key": "string",
                      "pickup_weather_match_status": "string"}


def declared(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """``df`` with exactly the declared columns, in their order and types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in schema.items()])


def silver_typed_trips(raw: DataFrame) -> DataFrame:
    """Identity hash over raw, uncast identity columns; typed projection; wall-clock duration."""
    return raw.select(
        row_digest(*TRIP_IDENTITY, mode="text").alias("trip_hash"),
        "l_orderkey", "l_linenumber",
        F.col("vendor_id_raw").cast("int").alias("vendor_id"),
        F.col("pickup_datetime_raw").alias("pickup_datetime_local"),
        F.col("dropoff_datetime_raw").alias("dropoff_datetime_local"),
        seconds_between("pickup_datetime_raw", "dropoff_datetime_raw").alias("trip_duration_seconds"),
        F.col("pickup_location_raw").cast("int").alias("pickup_location_id"),
        F.col("dropoff_location_raw").cast("int").alias("dropoff_location_id"),
        F.col("passenger_count_raw").cast("int").alias("passenger_count"),
        F.col("trip_distance_raw").cast("decimal(18,3)").alias("trip_distance_miles"),
        F.col("fare_amount_raw").cast("decimal(18,2)").alias("fare_amount_usd"),
        F.col("total_amount_raw").cast("decimal(18,2)").alias("total_amount_usd"),
        "source_system", "source_file", *[c for c in [*LINEAGE, "collision_count"] if c in raw.columns],
    )


def silver_trips(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): flags on every row, ambiguous identity groups quarantined with no survivor."""
    flagged = with_flags(silver_typed_trips(raw), trip_quality_flags())
    return dedup.collision_split(flagged, TRIP_IDENTITY)


def silver_zones(raw: DataFrame) -> DataFrame:
    return star.standardise_zones(raw, **ZONE_RULE)


WEATHER_RESPONSE_KEY = ["coordinate_id", "weather_model", "requested_start_date", "requested_end_date"]


def bronze_weather_observations(docs: DataFrame) -> DataFrame:
    """Bronze responses flattened by position of the time array; sibling values and the previous timestamp are
    read from the same document by index (null when a sibling is short or missing).

    Each output row only reads its own document, so the order / continuity checks need no window and no
    shuffle.  ``observation_key`` renders the series key with explicit null tokens, so null timestamps still
    collide as duplicates.
    """
    rows = docs.select(*WEATHER_RESPONSE_KEY, "hourly", F.posexplode("hourly.time").alias("pos", "observation_time"))
    fmt = F.lit("yyyy-MM-dd'T'HH:mm")
    pos = F.col("pos")
    return rows.select(
        *WEATHER_RESPONSE_KEY, "pos", "observation_time",
        F.get("hourly.temperature_2m", pos).alias("temperature_2m"),
        F.get("hourly.precipitation", pos).alias("precipitation"),
        F.get("hourly.weather_code", pos).alias("weather_code"),
        F.to_timestamp_ntz("observation_time", fmt).alias("observation_ts"),
        F.to_timestamp_ntz(F.when(pos > 0, F.get("hourly.time", pos - 1)), fmt).alias("previous_ts"),
        F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("<null>"))
                           for c in ("coordinate_id", "weather_model", "observation_time")]).alias("observation_key"),
    )


def silver_weather(docs: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Zip the parallel hourly arrays by position and explode; key = hash(coordinate, UTC hour, model)."""
    rows = explode_parallel_arrays(
        docs, {"hourly_time": "hourly.time", "hourly_temperature_2m": "hourly.temperature_2m",
               "hourly_precipitation": "hourly.precipitation", "hourly_weather_code": "hourly.weather_code"},
        keep=["coordinate_id", "weather_model", "source_system"])
    utc = F.to_timestamp_ntz(F.col("hourly_time"), F.lit("yyyy-MM-dd'T'HH:mm"))
    local = utc_to_local(utc, tz)
    return rows.select(
        row_digest(F.col("coordinate_id"), utc, F.col("weather_model"), mode="text").alias("weather_observation_key"),
        "coordinate_id",
        utc.alias("observation_timestamp_utc"),
        "weather_model",
        local.alias("observation_timestamp_local"),
        F.to_date(local).alias("observation_date_local"),
        F.hour(local).alias("observation_hour_local"),
        F.col("hourly_temperature_2m").cast("decimal(8,3)").alias("temperature_2m_c"),
        F.col("hourly_precipitation").cast("decimal(10,3)").alias("precipitation_mm"),
        F.col("hourly_weather_code").cast("int").alias("weather_code"),
        wmo_condition(F.col("hourly_weather_code")).alias("weather_condition_category"),
        "source_system",
    )


def trip_zone_map(clean: DataFrame, zones: DataFrame) -> DataFrame:
    m = resolve.resolve_roles(clean.select("trip_hash", "pickup_location_id", "dropoff_location_id"), zones,
                              "location_id", {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
                              SENTINEL_IDS)
    return m.select("trip_hash", "pickup_location_id", "dropoff_location_id",
                    "pickup_zone_match_status", "dropoff_zone_match_status")


def trip_weather_map(clean: DataFrame, weather: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    base = clean.select("trip_hash", "pickup_datetime_local")
    m = resolve.resolve_unique(base, local_to_utc("pickup_datetime_local", tz), weather,
                               "observation_timestamp_utc", "weather_observation_key",
                               key_out="pickup_weather_observation_key", status_out="pickup_weather_match_status",
                               time_out="pickup_timestamp_utc")
    return m.select("trip_hash", "pickup_timestamp_utc", "pickup_weather_observation_key",
                    "pickup_weather_match_status")


def trip_fact(clean: DataFrame, zones: DataFrame, weather: DataFrame, zone_dim: DataFrame,
              weather_fact: DataFrame, dates: DataFrame, hours: DataFrame, tz: str = LOCAL_TZ,
              window: tuple[str, str] | None = None, versions: DataFrame | None = None) -> DataFrame:
    """Trip fact: zone and weather resolution, role-playing zone keys, the pickup hour's weather class,
    date/hour keys, 9 flags, ``trip_count = 1``.

    With ``versions`` (``control.batch_versions``) trips landed from files also carry their batch, its file version and how
    often the log closed it; a batch that the log does not know leaves the version null.

    The resolution is computed inline with the same operators that build the narrow key maps: every lookup side
    (zones, the per-hour series profile, the weather classes, dates, hours) is bounded by a dimension or a time
    span and is broadcast, so the trip rows are never shuffled here — no trip-sized join on the trip hash.
    """
    base = resolve.resolve_roles(clean, zones, "location_id",
                                 {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}, SENTINEL_IDS)
    base = resolve.resolve_unique(base, local_to_utc("pickup_datetime_local", tz), weather,
                                  "observation_timestamp_utc", "weather_observation_key",
                                  key_out="pickup_weather_observation_key",
                                  status_out="pickup_weather_match_status", time_out="pickup_timestamp_utc")
    wf = broadcast_if_small(weather_fact.select(F.col("weather_observation_key").alias("__wk"),
                                                "weather_classification_key"), 5_000_000)
    base = base.join(wf, base["pickup_weather_observation_key"] == wf["__wk"], "left").drop("__wk")
    base = star.zone_keys(base, {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}, zone_dim)
    base = star.date_hour_keys(base, {"pickup": "pickup_datetime_local", "dropoff": "dropoff_datetime_local"},
                               dates, hours)
    lineage = []
    if versions is not None:
        base = base.join(broadcast_if_small(versions, 1_000_000), "batch_id", "left")  # one row per file
        lineage = ["batch_id", "source_file_version", "control_row_count"]
    period = F.nullif(F.regexp_extract("source_file", r"(\d{4}-\d{2})", 1), F.lit(""))
    lo, hi = window or ("1900-01-01 00:00:00", "9999-01-01 00:00:00")
    return base.select(
        F.col("trip_hash").alias("trip_key"),
        "pickup_date_key", "dropoff_date_key", "pickup_hour_key", "dropoff_hour_key",
        "pickup_zone_key", "dropoff_zone_key",
        F.col("weather_classification_key").alias("pickup_weather_classification_key"),
        "vendor_id", "pickup_datetime_local", "dropoff_datetime_local", "pickup_timestamp_utc",
        local_to_utc("dropoff_datetime_local", tz).alias("dropoff_timestamp_utc"),
        "pickup_location_id", "dropoff_location_id",
        F.col("passenger_count").cast("decimal(10,2)").alias("passenger_count"),
        "trip_distance_miles", "fare_amount_usd", "total_amount_usd", "trip_duration_seconds",
        F.lit(1).alias("trip_count"),
        two_valued((F.col("pickup_datetime_local") >= F.to_timestamp_ntz(F.lit(lo)))
                   & (F.col("pickup_datetime_local") < F.to_timestamp_ntz(F.lit(hi))))
        .alias("pickup_in_reporting_window_flag"),
        two_valued(F.date_format("pickup_datetime_local", "yyyy-MM") != period).alias("out_of_source_file_month_flag"),
        two_valued(F.col("dropoff_before_pickup_flag")).alias("dropoff_before_pickup_flag"),
        two_valued(F.col("negative_distance_flag")).alias("negative_trip_distance_flag"),
        two_valued(F.col("negative_fare_flag")).alias("negative_fare_amount_flag"),
        two_valued(F.col("total_amount_usd") < 0).alias("negative_total_amount_flag"),
        two_valued((F.col("trip_distance_miles") == 0) & (F.col("fare_amount_usd") > 20))
        .alias("zero_distance_high_fare_flag"),
        two_valued(F.col("passenger_count") == 0).alias("passenger_count_zero_flag"),
        two_valued(F.col("passenger_count") > 8).alias("passenger_count_over_8_flag"),
        "pickup_zone_match_status", "dropoff_zone_match_status",
        F.col("pickup_weather_match_status").alias("weather_match_status"),
        "source_system", "source_file", *lineage,
    )


@dataclass
class StarBuild:
    """All layers of the driver-table star.

    Tables the reference persists are materialised on first use with a reliable checkpoint (shared checkpoint
    folder): the Silver trip decision (clean ∪ quarantine in one frame, so both read one computation), the zone
    and weather Silver tables and the dimensions.  The small ones then have exact sizes for broadcast decisions,
    and nothing upstream is recomputed per consumer.  The trip fact stays lazy unless ``materialise`` is called.

    Guards are measured by the jobs that write: the quarantine rate with the trip decision (``max_quarantine_pct``; the
    played identity repeats by construction, so no rate halts unless asked), unresolved keys and the grain with the facts.
    """
    spark: SparkSession
    sf_dir: str
    tz: str = LOCAL_TZ
    cache: dict = field(default_factory=dict)
    max_quarantine_pct: float = 100.0
    measured: dict = field(default_factory=dict)
    landed: TripLandingRun | None = None  # trips from the Bronze table that this run landed, with their provenance

    def __post_init__(self):
        self.t = Tables(self.spark, self.sf_dir)

    def _get(self, name, build):
        if name not in self.cache:
            self.cache[name] = build()
        return self.cache[name]

    def _table(self, name, build):
        from lakekit.session import STAGED_CODEC, cut_lineage
        return self._get(name, lambda: cut_lineage(build(), name, STAGED_CODEC))

    def _guarded(self, name, build, measures, broken):
        """A table that is published only if what its write measured breaks no rule."""
        def make():
            out, self.measured[name] = guards.write_guarded(build(), name, measures, broken)
            return out
        return self._get(name, make)

    # Bronze: the landed trip rows are a persisted table, as in the reference
    def raw_trips(self):
        if self.landed:
            return self._get("raw_trips", self.landed.landed_trips)
        return self._table("raw_trips", lambda: raw_trips(self.t))

    def raw_zones(self):
        return self._get("raw_zones", lambda: raw_zones(self.t))

    def weather_documents(self):
        # Bronze responses are a persisted table: the hourly aggregation of the source runs once
        return self._table("weather_documents", lambda: weather_documents(self.t))

    # Silver
    def decided(self):
        def too_many(v):
            rate = dedup.QuarantineRate(v["rows"] - v["quarantined"], v["quarantined"], self.max_quarantine_pct)
            return [f"quarantine rate {rate.pct:.3f}% exceeds {rate.max_pct}%"] if rate.halted else []

        def collisions():  # from the identities alone: too high a rate stops the build before a trip row is written
            n = F.col("collision_count")
            groups = self.raw_trips().groupBy(*TRIP_IDENTITY).agg(F.count(F.lit(1)).alias("collision_count"))
            return guards.write_guarded(groups, "decided", {"rows": F.sum(n), "quarantined": F.sum(F.when(n > 1, n))},
                                        too_many, keep=n > 1)[0]

        def build():  # counted on the raw rows: hash and flags are added after the shuffle
            counted = silver_typed_trips(dedup.with_collision_count(self.raw_trips(), TRIP_IDENTITY, collisions()))
            rows = with_flags(counted, trip_quality_flags())
            return rows.select(*[c for c in rows.columns if c != "collision_count"], "collision_count")

        return self._guarded("decided", build,
            {"rows": F.count(F.lit(1)), "quarantined": F.count_if(F.col("collision_count") > 1)}, too_many)

    def clean(self):
        return self.decided().filter(F.col("collision_count") == 1).drop("collision_count")

    def quarantine(self):
        return (self.decided().filter(F.col("collision_count") > 1)
                .withColumn("quarantine_reasons", F.array(F.lit(dedup.DUPLICATE_REASON))))

    def zones(self):
        return self._table("zones", lambda: silver_zones(self.raw_zones()))

    def weather(self):
        return self._table("weather", lambda: silver_weather(self.weather_documents(), self.tz))

    # Integration (narrow key maps)
    def zone_map(self):
        return self._table("zone_map", lambda: declared(trip_zone_map(self.clean(), self.zones()), ZONE_MAP_SCHEMA))

    def weather_map(self):
        return self._table("weather_map", lambda: declared(trip_weather_map(self.clean(), self.weather(), self.tz), WEATHER_MAP_SCHEMA))

    # Gold
    def dim_date(self):
        def build():
            c = self.clean()
            dates = c.select(F.to_date("pickup_datetime_local").alias("full_date")).unionByName(
                c.select(F.to_date("dropoff_datetime_local").alias("full_date"))).unionByName(
                self.weather().select(F.col("observation_date_local").alias("full_date")))
            return star.dim_date(dates)
        return self._table("dim_date", build)

    def dim_hour(self):
        return self._get("dim_hour", lambda: star.dim_hour(self.spark))

    def dim_zone(self):
        return self._table("dim_zone", lambda: star.dim_zone(self.zones(), **ZONE_RULE))

    def dim_weather_classification(self):
        return self._table("dim_wc", lambda: star.dim_weather_classification(self.spark, self.weather()))

    def weather_fact(self):
        return self._guarded("weather_fact", lambda: star.weather_fact(
            self.weather(), self.dim_date(), self.dim_hour(), self.dim_weather_classification()),
            {"rows": F.count(F.lit(1)), "no_date": guards.missing("observation_date_key"), "no_hour": guards.missing("observation_hour_key"),
             "no_class": guards.missing("weather_classification_key")},
            guards.none_of(no_date="hours without a date key", no_hour="hours without an hour key",
                           no_class="hours without a weather classification"))

    def trip_fact(self):
        return self._get("trip_fact", lambda: trip_fact(self.clean(), self.zones(), self.weather(),
                                                        self.dim_zone(), self.weather_fact(), self.dim_date(),
                                                        self.dim_hour(), self.tz, REPORTING_WINDOW, self.batch_versions()))

    def staged_fact(self):
        """The whole fact, written once for readers of all its columns.  No guard stops it: the gates report what is wrong."""
        if "trip_fact" not in self.measured:
            self.cache["trip_fact"] = self._table("staged_fact", self.trip_fact)
        return self.cache["trip_fact"]

    def analysis_fact(self):
        """The fact for readers that aggregate it more than once: :data:`ANALYSIS_COLUMNS`, keyed and written in one pass
        (the whole fact where it is written already)."""
        if "trip_fact" in self.measured or "staged_fact" in self.cache:
            return self.trip_fact()
        return self._table("analysis_fact", lambda: self.trip_fact().select(*ANALYSIS_COLUMNS))

    def batch_versions(self):
        return self._get("batch_versions", lambda: self.landed.batch_versions() if self.landed else None)

    # Published analytical results (tables, as in the reference; the analytics gate reads these)
    def q1_result(self):
        from lakekit.plans import analytics
        return self._table("q1_result", lambda: analytics.q1_activity_by_time_and_zone(
            self.analysis_fact(), self.dim_date(), self.dim_hour(), self.dim_zone()))

    def q2_result(self):
        from lakekit.plans import analytics
        return self._table("q2_result", lambda: analytics.q2_trip_behavior_by_weather(
            self.analysis_fact(), self.weather_fact(), self.dim_weather_classification()))

    def q2_coverage(self):
        from lakekit.plans import analytics
        return self._table("q2_coverage", lambda: analytics.trip_weather_coverage(self.analysis_fact()))

    def q3_result(self):
        from lakekit.plans import analytics
        return self._table("q3_result", lambda: analytics.q3_mobility_patterns_by_zone(self.analysis_fact(), self.dim_zone()))

    def q4_result(self):
        from lakekit.plans import analytics
        return self._table("q4_result", lambda: analytics.q4_fare_efficiency_by_borough(self.analysis_fact(),
                                                                                        self.dim_zone()))

    def materialise(self):
        """Write the trip fact too (the analytics all read it), guarded: every key resolved, the grain that of the clean trips."""
        self.decided()  # measures the clean rows

        def broken(v):
            clean = self.measured["decided"]["rows"] - self.measured["decided"]["quarantined"]
            faults = guards.none_of(no_date="trips without date keys", no_hour="trips without hour keys",
                                    no_class="matched trips without a weather classification",
                                    **({"no_version": "trips whose batch has not exactly one version"} if self.landed else {}))(v)
            return faults + ([f"{v['rows']} fact rows for {clean} clean trips"] if v["rows"] != clean else [])

        def unresolved(key):  # a time that is there has its keys; trips without a time are kept without
            return F.count_if((F.col("pickup_datetime_local").isNotNull() & F.col(f"pickup_{key}_key").isNull())
                              | (F.col("dropoff_datetime_local").isNotNull() & F.col(f"dropoff_{key}_key").isNull()))

        fact = self.trip_fact()
        lineage = {"no_version": F.count_if(F.col("source_file_version").isNull() | ~F.col("control_row_count").eqNullSafe(1)),
                   "late": F.count_if("out_of_source_file_month_flag")} if self.landed else {}
        self.cache["trip_fact"], self.measured["trip_fact"] = guards.write_guarded(fact, "trip_fact", {
            "rows": F.count(F.lit(1)),
            "no_date": unresolved("date"), "no_hour": unresolved("hour"),
            "no_class": F.count_if((F.col("weather_match_status") == resolve.MATCHED_UNIQUE)
                                   & F.col("pickup_weather_classification_key").isNull()), **lineage}, broken)
        return self
