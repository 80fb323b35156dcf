"""Driver tables and how they play the roles of the trip / zone / weather sources.

Role mapping (one place, so every query and its SQL oracle agree):

* trip row = one ``lineitem`` row joined to its ``orders`` row; the customer gives the pickup location and the
  supplier the drop-off location (role-playing zone dimension).
* pickup wall-clock time (TIMESTAMP_NTZ) = ``o_orderdate`` folded onto days around the two clock changes of 2024, at a
  second of the day that the keys give; drop-off = one minute later for each day from ``o_orderdate`` to ``l_shipdate``
  (so it may precede the pickup).  Every 97th order has no pickup time.
* trip identity = ``(l_orderkey, l_linenumber)``; repeated pairs are ambiguous duplicates.
* fare = ``c_acctbal`` (a signed money measure, so the negative-fare eligibility rule is exercised),
  distance = ``l_quantity``, total = ``l_extendedprice``, passengers = ``round(l_tax * 100)`` (0 means missing),
  vendor = first digit of ``o_orderpriority``.
* pickup location = the customer's nation, drop-off location = the supplier's; some customers and some
  lines have none or one that the zone snapshot does not list.
* zone snapshot = ``nation`` ⋈ ``region``: location id = nation key, zone = nation name, borough = service zone =
  region name.  Nation keys 23 and 24 play the two sentinel locations.
* hourly observation series = ``events`` per UTC hour: temperature = mean event value, precipitation = 0.5 mm per
  ``error`` event, weather code = the ``k`` reported in ``props`` by the hour's last event.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.classify import HOURLY_UNITS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

LOCAL_TZ = "America/New_York"
# the months that the star reports on
REPORTING_WINDOW = ("2024-03-01 00:00:00", "2024-12-01 00:00:00")

# Zone classification rule for the driver zone snapshot (ordered: sentinel ids, special boroughs, regular boroughs).
ZONE_RULE = {
    "sentinels": {23: "unknown", 24: "outside_area"},
    "special": {"MIDDLE EAST": "special_area"},
    "regular": ["AFRICA", "AMERICA", "ASIA", "EUROPE"],
    "regular_label": "regular_area",
}
SENTINEL_IDS = tuple(ZONE_RULE["sentinels"].keys())


# Tables whose size grows with the scale factor (the dimension-like ones stay tiny).
GROWING_TABLES = {"lineitem", "orders", "customer", "part", "events", "documents", "embeddings", "pages",
                  "conversations", "labels"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if name in GROWING_TABLES:
        df = ensure_scan_parallelism(df)
    return df


def ensure_scan_parallelism(df: DataFrame, floor: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster's parallelism (a single-row-group file).

    On a real lake the input is many files and this is a no-op; it never adds a shuffle there.  The round-robin
    repartition is retry-safe (Spark sorts before it by default).
    """
    floor = floor or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < floor:
        return df.repartition(floor)
    return df


class Tables:
    """Lazy accessors for the driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")


def played_pickup() -> Column:
    """Pickup time of a lineitem ⋈ orders row (see above)."""
    k = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date"))
    half = F.floor(k / 2).cast("int")
    day = F.when(k % 2 == 0, F.date_add(F.lit("2024-02-28").cast("date"), half % 18)).otherwise(
        F.date_add(F.lit("2024-10-29").cast("date"), half % 19))
    second = (F.col("o_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 86400
    clock = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second.cast("decimal(18,6)"))
    return F.when(F.col("o_orderkey") % 97 != 0, day.cast("timestamp_ntz") + clock)


def played_dropoff() -> Column:
    minutes = F.datediff("l_shipdate", "o_orderdate")
    return played_pickup() + F.make_dt_interval(F.lit(0), F.lit(0), minutes)


def raw_trips(t: Tables) -> DataFrame:
    """Trip rows as received (Bronze-shaped): raw values, untouched, plus the landed file's name."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
                           "l_shipdate", F.col("_metadata.file_name").alias("source_file"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    # the customer joins the orders, a quarter of the lines, so the lines are shuffled once
    o = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
         .join(s, F.col("l_suppkey") == s["s_suppkey"], "left"))
    return j.select(
        "l_orderkey", "l_linenumber",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("vendor_id_raw"),
        played_pickup().alias("pickup_datetime_raw"),
        played_dropoff().alias("dropoff_datetime_raw"),
        F.when(F.col("o_custkey") % 83 == 0, None).when(F.col("o_custkey") % 79 == 0, 99).otherwise(F.col("c_nationkey"))
        .alias("pickup_location_raw"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 53 == 0, None).when((F.col("l_orderkey") + F.col("l_linenumber")) % 59 == 0, 98).otherwise(F.col("s_nationkey"))
        .alias("dropoff_location_raw"),
        F.round(F.col("l_tax") * 100).cast("long").alias("passenger_count_raw"),
        F.col("l_quantity").alias("trip_distance_raw"),
        F.col("c_acctbal").alias("fare_amount_raw"),
        F.col("l_extendedprice").alias("total_amount_raw"),
        F.lit("tpch_lineitem").alias("source_system"),
        "source_file",
    )


def raw_zones(t: Tables) -> DataFrame:
    """Zone snapshot rows (Bronze-shaped) from ``nation`` ⋈ ``region``."""
    from lakekit.operators.sizing import broadcast_if_small
    n, r = t.nation, t.region
    r = broadcast_if_small(r.select("r_regionkey", "r_name"), 100_000)  # region names: a size-checked lookup
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("service_zone"),
        F.lit("tpch_nation").alias("source_system"),
    )


def observed_events(t: Tables) -> DataFrame:
    """``events`` in the played season, with the place that observed them."""
    season = F.expr("CASE WHEN day(ts) < 16 THEN INTERVAL '60' DAY ELSE INTERVAL '290' DAY END")
    e = t.events
    places = F.when(F.day("ts") == 5, F.array(F.lit("events_city"), F.lit("events_airport"))).otherwise(F.array(F.lit("events_city")))
    return e.withColumn("coordinate_id", F.explode(places)).withColumn("ts", F.col("ts") + season)


def event_hours(t: Tables) -> DataFrame:
    """Hourly observation aggregates (one row per place and UTC hour)."""
    e = observed_events(t).select("coordinate_id", "event_id", "ts", "event_type", "value",
                        F.get_json_object("props", "$.k").cast("int").alias("k"))
    hour = e["ts"] - F.make_dt_interval(F.lit(0), F.lit(0), F.minute("ts"), F.extract(F.lit("SECOND"), F.col("ts")))
    return (e.groupBy("coordinate_id", hour.alias("hour_utc"))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(F.col("value").cast("decimal(12,2)")).alias("value_sum"),
                 F.count_if(F.col("event_type") == "error").alias("n_error"),
                 F.max_by("k", F.struct("ts", "event_id")).alias("code"))
            .select("coordinate_id", "hour_utc",
                    F.round(F.col("value_sum").cast("double") / F.col("n_events"), 3).alias("temperature"),
                    (F.col("n_error") * F.lit(0.5)).cast("double").alias("precipitation"),
                    F.col("code").cast("long").alias("weather_code")))


def weather_documents(t: Tables) -> DataFrame:
    """One response document per place and UTC day with the hourly series as parallel arrays (time, temperature,
    precipitation, code) and the units they are expressed in, like an hourly weather API response.  Arrays hold
    at most 24 entries."""
    h = event_hours(t).withColumn("day", F.to_date("hour_utc"))
    docs = h.groupBy("coordinate_id", "day").agg(F.array_sort(F.collect_list(F.struct(
        F.translate(F.substring(F.col("hour_utc").cast("string"), 1, 16), " ", "T").alias("time"), "temperature", "precipitation",
        "weather_code"))).alias("rows"))
    return docs.select(
        "coordinate_id",
        F.lit("events_hourly").alias("weather_model"),
        F.col("day").alias("requested_start_date"),
        F.col("day").alias("requested_end_date"),
        F.struct(F.col("rows.time").alias("time"), F.col("rows.temperature").alias("temperature_2m"),
                 F.col("rows.precipitation").alias("precipitation"),
                 F.col("rows.weather_code").alias("weather_code")).alias("hourly"),
        F.struct(*[F.lit(v).alias(k) for k, v in HOURLY_UNITS.items()]).alias("hourly_units"),
        F.lit("tpch_events").alias("source_system"),
    )
