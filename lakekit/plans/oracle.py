"""Independent SQL (DuckDB dialect) for the driver-table star, used as the correctness oracle.

Written as the reference writes its pipeline: one SQL chain with window functions and ``UNION ALL`` — the shape
the Spark side deliberately does *not* use (it aggregates before joining and runs checks in one pass), so the two
sides agree only if the semantics agree.  Doubles are divided after exact decimal sums on both sides.
"""

from __future__ import annotations

from lakekit.functions.classify import HOURLY_UNITS, PRECIPITATION_BANDS, WMO_CONDITIONS
from lakekit.plans.tables import REPORTING_WINDOW, ZONE_RULE

TZ = "America/New_York"


def _wmo_case(col: str) -> str:
    by_label: dict[str, list[int]] = {}
    for k, label in WMO_CONDITIONS:
        by_label.setdefault(label, []).append(k)
    whens = " ".join(f"WHEN {col} IN ({', '.join(map(str, ks))}) THEN '{label}'" for label, ks in by_label.items())
    return f"CASE WHEN {col} IS NULL THEN NULL {whens} ELSE 'unknown_code' END"


def _zone_case(loc: str, borough: str, upper: bool) -> str:
    b = f"upper(trim({borough}))" if upper else f"trim({borough})"
    parts = [f"WHEN {loc} = {k} THEN '{v}'" for k, v in ZONE_RULE["sentinels"].items()]
    parts += [f"WHEN {b} = '{k.upper() if upper else k}' THEN '{v}'" for k, v in ZONE_RULE["special"].items()]
    regular = ", ".join(f"'{r.upper() if upper else r}'" for r in ZONE_RULE["regular"])
    parts.append(f"WHEN {b} IN ({regular}) THEN '{ZONE_RULE['regular_label']}'")
    return "CASE " + " ".join(parts) + " ELSE 'other_special' END"


UNITS_STRUCT = ", ".join(f"'{k}': '{v}'" for k, v in HOURLY_UNITS.items())
WMO_VALUES = ", ".join(f"({k}, '{v}')" for k, v in WMO_CONDITIONS)
BAND_VALUES = ", ".join(f"('{b}')" for b in PRECIPITATION_BANDS)
SENTINELS = ", ".join(str(k) for k in ZONE_RULE["sentinels"])


def utc(ts: str) -> str:
    """UTC of a local time; of the two instants of the hour that autumn repeats, the earlier one."""
    u = f"timezone('UTC', timezone('{TZ}', {ts}))"
    return f"CASE WHEN {local(f'({u} - INTERVAL 1 HOUR)')} = {ts} THEN {u} - INTERVAL 1 HOUR ELSE {u} END"


def local(ts: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {ts}))"


def sround(expr: str, digits: int) -> str:
    """Spark's ROUND on a double: half-up on the shortest decimal text of the value (not on its binary value)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


# How the driver tables play trips and observations (see tables.py), in SQL
_DAY = "date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE))"
PICKUP = (f"CASE WHEN o.o_orderkey % 97 <> 0 THEN CAST(CASE WHEN {_DAY} % 2 = 0 THEN DATE '2024-02-28' + CAST({_DAY} // 2 % 18 AS INTEGER) "
          f"ELSE DATE '2024-10-29' + CAST({_DAY} // 2 % 19 AS INTEGER) END AS TIMESTAMP) "
          "+ to_seconds((o.o_orderkey * 7919 + l.l_linenumber * 104729) % 86400) END")
DROPOFF = f"({PICKUP}) + to_minutes(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)))"
_PLAYED = "* REPLACE (ts + CASE WHEN day(ts) < 16 THEN INTERVAL 60 DAY ELSE INTERVAL 290 DAY END AS ts)"
OBSERVED = (f"(SELECT 'events_city' AS coordinate_id, {_PLAYED} FROM events "
            f"UNION ALL SELECT 'events_airport', {_PLAYED} FROM events WHERE day(ts) = 5)")

# The whole star as CTEs; unused ones are pruned by the engine.
STAR = f"""
raw_trips AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS vendor_id,
         {PICKUP} AS pickup_datetime_local,
         {DROPOFF} AS dropoff_datetime_local,
         CASE WHEN o.o_custkey % 83 = 0 THEN NULL WHEN o.o_custkey % 79 = 0 THEN 99 ELSE c.c_nationkey END AS pickup_location_id,
         CASE WHEN (l.l_orderkey + l.l_linenumber) % 53 = 0 THEN NULL WHEN (l.l_orderkey + l.l_linenumber) % 59 = 0 THEN 98 ELSE s.s_nationkey END AS dropoff_location_id,
         CAST(round(l.l_tax * 100) AS INTEGER) AS passenger_count,
         CAST(l.l_quantity AS DECIMAL(18,3)) AS trip_distance_miles,
         CAST(c.c_acctbal AS DECIMAL(18,2)) AS fare_amount_usd,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_amount_usd,
         l.l_quantity AS trip_distance_raw, c.c_acctbal AS fare_amount_raw, l.l_extendedprice AS total_amount_raw,
         'tpch_lineitem' AS source_system, 'lineitem.parquet' AS source_file  -- one file per driver table
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
typed AS (
  SELECT *,
    sha256(concat_ws('|', coalesce(CAST(l_orderkey AS VARCHAR), '<null>'),
                          coalesce(CAST(l_linenumber AS VARCHAR), '<null>'))) AS trip_hash,
    date_sub('second', pickup_datetime_local, dropoff_datetime_local) AS trip_duration_seconds
  FROM raw_trips
),
decided AS (
  SELECT *,
    COUNT(*) OVER (PARTITION BY trip_hash) AS collision_count,
    COALESCE(fare_amount_usd < 0, false) AS negative_fare_flag,
    COALESCE(trip_distance_miles < 0, false) AS negative_distance_flag,
    COALESCE(dropoff_datetime_local < pickup_datetime_local, false) AS dropoff_before_pickup_flag,
    COALESCE(trip_duration_seconds <= 0 OR trip_duration_seconds > 86400, false) AS implausible_duration_flag,
    COALESCE(passenger_count < 0 OR passenger_count > 8, false) AS implausible_passenger_count_flag,
    (passenger_count IS NULL OR passenger_count = 0) AS passenger_count_missing_flag
  FROM typed
),
clean AS (SELECT * EXCLUDE (collision_count) FROM decided WHERE collision_count = 1),
quarantine AS (SELECT *, ['duplicate_hash_collision'] AS quarantine_reasons FROM decided WHERE collision_count > 1),
quarantine_keys AS (SELECT trip_hash AS trip_key FROM quarantine),
bronze_trips AS (
  SELECT l_orderkey, l_linenumber, vendor_id AS vendor_id_raw, pickup_datetime_local AS pickup_datetime_raw,
         dropoff_datetime_local AS dropoff_datetime_raw, pickup_location_id AS pickup_location_raw,
         dropoff_location_id AS dropoff_location_raw, CAST(passenger_count AS BIGINT) AS passenger_count_raw,
         trip_distance_raw, fare_amount_raw, total_amount_raw, source_system
  FROM raw_trips
),
bronze_collisions AS (SELECT trip_hash, COUNT(*) AS n FROM typed GROUP BY trip_hash HAVING COUNT(*) > 1),
bronze_zones AS (
  SELECT n.n_nationkey AS location_id, r.r_name AS borough, n.n_name AS zone, r.r_name AS service_zone,
         'tpch_nation' AS source_system
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
zones AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, trim(r.r_name) AS borough, trim(n.n_name) AS zone_name,
         CASE WHEN r.r_name = 'N/A' THEN 'na' ELSE lower(trim(r.r_name)) END AS service_zone,
         {_zone_case('n.n_nationkey', 'r.r_name', False)} AS zone_classification,
         'tpch_nation' AS source_system
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_zone AS (
  SELECT CAST(location_id AS BIGINT) AS zone_key, location_id, zone_name, borough, service_zone,
         {_zone_case('location_id', 'borough', True)} AS zone_classification
  FROM zones
),
ev AS (
  SELECT coordinate_id, event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         date_trunc('hour', ts) AS hour_utc
  FROM {OBSERVED}
),
ev_hours AS (
  SELECT coordinate_id, hour_utc,
         {sround('CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*)', 3)} AS temperature,
         CAST(count_if(event_type = 'error') * 0.5 AS DOUBLE) AS precipitation,
         CAST(arg_max(k, (ts, event_id)) AS BIGINT) AS weather_code
  FROM ev GROUP BY coordinate_id, hour_utc
),
bronze_weather AS (
  SELECT coordinate_id, 'events_hourly' AS weather_model,
         CAST(hour_utc AS DATE) AS requested_start_date, CAST(hour_utc AS DATE) AS requested_end_date,
         {{'time': list(strftime(hour_utc, '%Y-%m-%dT%H:%M') ORDER BY hour_utc),
          'temperature_2m': list(temperature ORDER BY hour_utc),
          'precipitation': list(precipitation ORDER BY hour_utc),
          'weather_code': list(weather_code ORDER BY hour_utc)}} AS hourly,
         {{{UNITS_STRUCT}}} AS hourly_units,
         'tpch_events' AS source_system
  FROM ev_hours GROUP BY coordinate_id, CAST(hour_utc AS DATE)
),
bronze_weather_obs AS (
  SELECT coordinate_id, 'events_hourly' AS weather_model,
         CAST(hour_utc AS DATE) AS requested_start_date, CAST(hour_utc AS DATE) AS requested_end_date,
         strftime(hour_utc, '%Y-%m-%dT%H:%M') AS observation_time, temperature AS temperature_2m, precipitation,
         weather_code, hour_utc AS observation_ts,
         ROW_NUMBER() OVER (PARTITION BY coordinate_id, CAST(hour_utc AS DATE) ORDER BY hour_utc) - 1 AS pos
  FROM ev_hours
),
bronze_weather_rows AS (
  SELECT *,
         LAG(observation_ts) OVER (PARTITION BY coordinate_id, weather_model, requested_start_date,
                                                requested_end_date ORDER BY pos) AS previous_ts,
         concat_ws('|', coalesce(coordinate_id, '<null>'), coalesce(weather_model, '<null>'),
                   coalesce(observation_time, '<null>')) AS observation_key
  FROM bronze_weather_obs
),
source_events AS (SELECT coordinate_id, ts FROM {OBSERVED}),
weather AS (
  SELECT sha256(concat_ws('|', coordinate_id, CAST(hour_utc AS VARCHAR), 'events_hourly')) AS weather_observation_key,
         coordinate_id,
         hour_utc AS observation_timestamp_utc,
         'events_hourly' AS weather_model,
         {local('hour_utc')} AS observation_timestamp_local,
         CAST({local('hour_utc')} AS DATE) AS observation_date_local,
         CAST(hour({local('hour_utc')}) AS INTEGER) AS observation_hour_local,
         CAST(temperature AS DECIMAL(8,3)) AS temperature_2m_c,
         CAST(precipitation AS DECIMAL(10,3)) AS precipitation_mm,
         CAST(weather_code AS INTEGER) AS weather_code,
         {_wmo_case('weather_code')} AS weather_condition_category,
         'tpch_events' AS source_system
  FROM ev_hours
),
weather_ordered AS (
  SELECT observation_timestamp_utc, observation_timestamp_local,
         LAG(observation_timestamp_utc) OVER s AS prev_utc, LAG(observation_timestamp_local) OVER s AS prev_local,
         date_diff('second', LAG(observation_timestamp_utc) OVER s, observation_timestamp_utc) AS step_seconds
  FROM weather WINDOW s AS (PARTITION BY coordinate_id, weather_model ORDER BY observation_timestamp_utc)
),
weather_local_dates AS (
  SELECT coordinate_id, weather_model, observation_date_local AS local_date,
         COUNT(DISTINCT observation_hour_local) AS distinct_hours
  FROM weather GROUP BY coordinate_id, weather_model, observation_date_local
),
weather_interior_dates AS (
  SELECT h.* FROM weather_local_dates h
  JOIN (SELECT coordinate_id, weather_model, MIN(local_date) AS lo, MAX(local_date) AS hi
        FROM weather_local_dates GROUP BY coordinate_id, weather_model) b
    ON h.coordinate_id = b.coordinate_id AND h.weather_model = b.weather_model
  WHERE h.local_date > b.lo AND h.local_date < b.hi
),
source_nation AS (SELECT n_nationkey FROM nation),
trip_file_reconciliation AS (
  SELECT * FROM (
    SELECT 'lineitem.parquet' AS source_object, COUNT(*) AS source_rows,
           CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS source_fare_total
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  ) s FULL OUTER JOIN (
    SELECT source_file AS source_object, COUNT(*) AS bronze_rows,
           CAST(SUM(CAST(fare_amount_raw AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS bronze_fare_total
    FROM raw_trips GROUP BY source_file
  ) b USING (source_object)
),
known_codes AS (SELECT * FROM (VALUES {WMO_VALUES}) AS t(weather_code, weather_condition)),
all_codes AS (
  SELECT weather_code, weather_condition FROM known_codes
  UNION ALL
  SELECT DISTINCT weather_code, 'unknown_code' FROM weather
  WHERE weather_code IS NOT NULL AND weather_code NOT IN (SELECT weather_code FROM known_codes)
),
bands AS (SELECT * FROM (VALUES {BAND_VALUES}) AS t(precipitation_band)),
dim_wc AS (
  SELECT sha256(to_json({{'weather_code': weather_code, 'precipitation_band': precipitation_band}}))
           AS weather_classification_key,
         weather_code, weather_condition, precipitation_band
  FROM all_codes CROSS JOIN bands
),
date_bounds AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT CAST(pickup_datetime_local AS DATE) AS d FROM clean
    UNION ALL SELECT CAST(dropoff_datetime_local AS DATE) FROM clean
    UNION ALL SELECT observation_date_local FROM weather)
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS INTEGER) AS calendar_year, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
         CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%B') AS month_name,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week_number,
         strftime(d, '%A') AS day_of_week_name, isodow(d) IN (6, 7) AS weekend_flag
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM date_bounds)
),
dim_hour AS (
  SELECT CAST(h AS INTEGER) AS hour_key, CAST(h AS INTEGER) AS hour_of_day,
         lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label,
         CASE WHEN h BETWEEN 0 AND 5 THEN 'overnight' WHEN h BETWEEN 6 AND 11 THEN 'morning'
              WHEN h BETWEEN 12 AND 17 THEN 'afternoon' ELSE 'evening' END AS time_of_day_band
  FROM range(0, 24) t(h)
),
wfact AS (
  SELECT w.*,
         CASE WHEN w.precipitation_mm IS NULL OR w.precipitation_mm < 0 THEN NULL
              WHEN w.precipitation_mm = 0 THEN 'dry' WHEN w.precipitation_mm <= 2.5 THEN 'light'
              WHEN w.precipitation_mm <= 7.5 THEN 'moderate' ELSE 'heavy' END AS precipitation_band
  FROM weather w
),
weather_fact AS (
  SELECT f.*, d.date_key AS observation_date_key, h.hour_key AS observation_hour_key, c.weather_classification_key
  FROM wfact f
  LEFT JOIN dim_date d ON f.observation_date_local = d.full_date
  LEFT JOIN dim_hour h ON f.observation_hour_local = h.hour_of_day
  LEFT JOIN dim_wc c ON f.weather_code = c.weather_code AND f.precipitation_band = c.precipitation_band
),
wprof AS (
  SELECT observation_timestamp_utc AS hr, COUNT(weather_observation_key) AS n,
         MAX(weather_observation_key) AS k
  FROM weather GROUP BY observation_timestamp_utc
),
zone_map AS (
  SELECT t.trip_hash, t.pickup_location_id, t.dropoff_location_id,
    CASE WHEN t.pickup_location_id IS NULL THEN 'missing_source_id'
         WHEN t.pickup_location_id IN ({SENTINELS}) AND pz.location_id IS NOT NULL THEN 'matched_special'
         WHEN pz.location_id IS NOT NULL THEN 'matched_regular' ELSE 'unmatched_location_id' END
      AS pickup_zone_match_status,
    CASE WHEN t.dropoff_location_id IS NULL THEN 'missing_source_id'
         WHEN t.dropoff_location_id IN ({SENTINELS}) AND dz.location_id IS NOT NULL THEN 'matched_special'
         WHEN dz.location_id IS NOT NULL THEN 'matched_regular' ELSE 'unmatched_location_id' END
      AS dropoff_zone_match_status
  FROM clean t
  LEFT JOIN zones pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON t.dropoff_location_id = dz.location_id
),
trip_utc AS (
  SELECT trip_hash, pickup_datetime_local, {utc('pickup_datetime_local')} AS pickup_timestamp_utc FROM clean
),
weather_map AS (
  SELECT t.trip_hash, t.pickup_timestamp_utc,
    CASE WHEN coalesce(p.n, 0) = 1 THEN p.k END AS pickup_weather_observation_key,
    CASE WHEN t.pickup_datetime_local IS NULL OR t.pickup_timestamp_utc IS NULL THEN 'invalid_pickup_timestamp'
         WHEN coalesce(p.n, 0) = 0 THEN 'no_match'
         WHEN p.n = 1 THEN 'matched_unique' ELSE 'ambiguous_match' END AS pickup_weather_match_status
  FROM trip_utc t LEFT JOIN wprof p ON date_trunc('hour', t.pickup_timestamp_utc) = p.hr
),
fact AS (
  SELECT t.trip_hash AS trip_key,
    pd.date_key AS pickup_date_key, dd.date_key AS dropoff_date_key,
    ph.hour_key AS pickup_hour_key, dh.hour_key AS dropoff_hour_key,
    pzk.zone_key AS pickup_zone_key, dzk.zone_key AS dropoff_zone_key,
    wf.weather_classification_key AS pickup_weather_classification_key,
    t.vendor_id, t.pickup_datetime_local, t.dropoff_datetime_local, wm.pickup_timestamp_utc,
    {utc('t.dropoff_datetime_local')} AS dropoff_timestamp_utc,
    t.pickup_location_id, t.dropoff_location_id,
    CAST(t.passenger_count AS DECIMAL(10,2)) AS passenger_count,
    t.trip_distance_miles, t.fare_amount_usd, t.total_amount_usd, t.trip_duration_seconds,
    1 AS trip_count,
    COALESCE(t.pickup_datetime_local >= TIMESTAMP '{REPORTING_WINDOW[0]}'
             AND t.pickup_datetime_local < TIMESTAMP '{REPORTING_WINDOW[1]}', false) AS pickup_in_reporting_window_flag,
    COALESCE(strftime(t.pickup_datetime_local, '%Y-%m')
             <> NULLIF(regexp_extract(t.source_file, '([0-9]{{4}}-[0-9]{{2}})', 1), ''), false)
      AS out_of_source_file_month_flag,
    t.dropoff_before_pickup_flag,
    t.negative_distance_flag AS negative_trip_distance_flag,
    t.negative_fare_flag AS negative_fare_amount_flag,
    COALESCE(t.total_amount_usd < 0, false) AS negative_total_amount_flag,
    COALESCE(t.trip_distance_miles = 0 AND t.fare_amount_usd > 20, false) AS zero_distance_high_fare_flag,
    COALESCE(t.passenger_count = 0, false) AS passenger_count_zero_flag,
    COALESCE(t.passenger_count > 8, false) AS passenger_count_over_8_flag,
    zm.pickup_zone_match_status, zm.dropoff_zone_match_status,
    wm.pickup_weather_match_status AS weather_match_status,
    t.source_system, t.source_file
  FROM clean t
  JOIN zone_map zm ON zm.trip_hash = t.trip_hash
  JOIN weather_map wm ON wm.trip_hash = t.trip_hash
  LEFT JOIN weather_fact wf ON wm.pickup_weather_observation_key = wf.weather_observation_key
  LEFT JOIN dim_zone pzk ON t.pickup_location_id = pzk.location_id
  LEFT JOIN dim_zone dzk ON t.dropoff_location_id = dzk.location_id
  LEFT JOIN dim_date pd ON CAST(t.pickup_datetime_local AS DATE) = pd.full_date
  LEFT JOIN dim_date dd ON CAST(t.dropoff_datetime_local AS DATE) = dd.full_date
  LEFT JOIN dim_hour ph ON hour(t.pickup_datetime_local) = ph.hour_of_day
  LEFT JOIN dim_hour dh ON hour(t.dropoff_datetime_local) = dh.hour_of_day
),
elig AS (
  SELECT *,
    COALESCE(NOT dropoff_before_pickup_flag AND trip_duration_seconds > 0 AND trip_duration_seconds <= 86400, false)
      AS duration_eligible,
    NOT negative_trip_distance_flag AS distance_eligible,
    NOT negative_fare_amount_flag AS fare_eligible,
    COALESCE(NOT negative_trip_distance_flag AND trip_distance_miles > 0, false) AS distance_positive_eligible
  FROM fact
)"""


def with_star(select: str) -> str:
    return "WITH " + STAR + "\n" + select


def ratio(num: str, den: str, digits: int | None = None, scale: float | None = None) -> str:
    r = f"CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE)"
    if scale:
        r = f"{r} / {scale}"
    return sround(r, digits) if digits is not None else r


MEASURES = """
    CAST(SUM(CASE WHEN duration_eligible THEN trip_duration_seconds END) AS BIGINT) AS total_duration_seconds,
    CAST(COUNT_IF(duration_eligible) AS BIGINT) AS trips_with_eligible_duration,
    CAST(SUM(CASE WHEN distance_eligible THEN trip_distance_miles END) AS DECIMAL(38,3)) AS total_trip_distance_miles,
    CAST(COUNT_IF(distance_eligible) AS BIGINT) AS trips_with_eligible_distance,
    CAST(SUM(CASE WHEN fare_eligible THEN fare_amount_usd END) AS DECIMAL(38,2)) AS total_fare_amount_usd,
    CAST(COUNT_IF(fare_eligible) AS BIGINT) AS trips_with_eligible_fare"""

AVERAGES = f"""
    {ratio('total_duration_seconds', 'trips_with_eligible_duration', 2, 60.0)} AS avg_trip_duration_minutes,
    {ratio('total_trip_distance_miles', 'trips_with_eligible_distance', 3)} AS avg_trip_distance_miles,
    {ratio('total_fare_amount_usd', 'trips_with_eligible_fare', 2)} AS avg_fare_amount_usd"""

Q1_AGG = f"""
  SELECT d.full_date AS pickup_date, d.day_of_week_name AS pickup_day_of_week, d.weekend_flag AS pickup_is_weekend,
         h.hour_of_day AS pickup_hour, h.time_of_day_band AS pickup_time_of_day_band,
         z.zone_name AS pickup_zone_name, z.borough AS pickup_borough, z.service_zone AS pickup_service_zone,
         z.zone_classification AS pickup_zone_classification,
         CAST(SUM(t.trip_count) AS BIGINT) AS trip_count, {MEASURES}
  FROM elig t
  JOIN dim_date d ON t.pickup_date_key = d.date_key
  JOIN dim_hour h ON t.pickup_hour_key = h.hour_key
  LEFT JOIN dim_zone z ON t.pickup_zone_key = z.zone_key
  GROUP BY ALL
"""

Q1 = with_star(f""",
q1 AS ({Q1_AGG})
SELECT *, {AVERAGES},
  CAST(DENSE_RANK() OVER (ORDER BY trip_count DESC) AS BIGINT) AS activity_rank_overall,
  CAST(DENSE_RANK() OVER (PARTITION BY pickup_hour ORDER BY trip_count DESC) AS BIGINT) AS activity_rank_within_hour
FROM q1""")

Q2 = with_star(f""",
covered AS (
  SELECT weather_classification_key, CAST(COUNT(*) AS BIGINT) AS covered_hours,
         {sround('CAST(SUM(temperature_2m_c) AS DOUBLE) / COUNT(temperature_2m_c)', 2)} AS avg_temperature_c,
         CAST(round(SUM(precipitation_mm), 2) AS DECIMAL(38,2)) AS total_precipitation_mm
  FROM weather_fact GROUP BY weather_classification_key
),
trips AS (
  SELECT pickup_weather_classification_key AS weather_classification_key,
         CAST(SUM(trip_count) AS BIGINT) AS trip_count, {MEASURES}
  FROM elig WHERE pickup_weather_classification_key IS NOT NULL
  GROUP BY pickup_weather_classification_key
)
SELECT c.weather_condition, c.precipitation_band, h.covered_hours, h.avg_temperature_c, h.total_precipitation_mm,
  CAST(COALESCE(t.trip_count, 0) AS BIGINT) AS trip_count,
  {sround('CAST(COALESCE(t.trip_count, 0) AS DOUBLE) / CAST(NULLIF(h.covered_hours, 0) AS DOUBLE)', 2)}
    AS trips_per_covered_hour,
  t.trips_with_eligible_duration,
  {ratio('t.total_duration_seconds', 't.trips_with_eligible_duration', 2, 60.0)} AS avg_trip_duration_minutes,
  t.trips_with_eligible_distance,
  {ratio('t.total_trip_distance_miles', 't.trips_with_eligible_distance', 3)} AS avg_trip_distance_miles,
  t.trips_with_eligible_fare,
  {ratio('t.total_fare_amount_usd', 't.trips_with_eligible_fare', 2)} AS avg_fare_amount_usd,
  CAST(DENSE_RANK() OVER (ORDER BY CAST(COALESCE(t.trip_count, 0) AS DOUBLE)
                                   / CAST(NULLIF(h.covered_hours, 0) AS DOUBLE) DESC NULLS LAST) AS BIGINT)
    AS activity_rank_by_trips_per_hour
FROM covered h
JOIN dim_wc c ON h.weather_classification_key = c.weather_classification_key
LEFT JOIN trips t ON h.weather_classification_key = t.weather_classification_key""")

COVERAGE = with_star(f"""
SELECT weather_match_status, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       {sround('100.0 * CAST(SUM(trip_count) AS DOUBLE) / CAST(SUM(SUM(trip_count)) OVER () AS DOUBLE)', 4)}
         AS pct_of_all_trips
FROM fact GROUP BY weather_match_status""")

Q3 = with_star(f""",
pickups AS (
  SELECT pickup_zone_key AS zone_key, CAST(SUM(trip_count) AS BIGINT) AS pickup_count,
    CAST(SUM(CASE WHEN duration_eligible THEN trip_duration_seconds END) AS BIGINT) AS pickup_total_duration_seconds,
    CAST(COUNT_IF(duration_eligible) AS BIGINT) AS pickup_trips_eligible_duration,
    CAST(SUM(CASE WHEN distance_eligible THEN trip_distance_miles END) AS DECIMAL(38,3)) AS pickup_total_distance_miles,
    CAST(COUNT_IF(distance_eligible) AS BIGINT) AS pickup_trips_eligible_distance,
    CAST(SUM(CASE WHEN fare_eligible THEN fare_amount_usd END) AS DECIMAL(38,2)) AS pickup_total_fare_usd,
    CAST(COUNT_IF(fare_eligible) AS BIGINT) AS pickup_trips_eligible_fare,
    CAST(COUNT(DISTINCT pickup_date_key) AS BIGINT) AS pickup_active_days
  FROM elig GROUP BY pickup_zone_key
),
dropoffs AS (
  SELECT dropoff_zone_key AS zone_key, CAST(SUM(trip_count) AS BIGINT) AS dropoff_count
  FROM fact GROUP BY dropoff_zone_key
),
q3 AS (
  SELECT z.zone_name, z.borough, z.service_zone, z.zone_classification,
    CAST(COALESCE(p.pickup_count, 0) AS BIGINT) AS pickup_count,
    CAST(COALESCE(d.dropoff_count, 0) AS BIGINT) AS dropoff_count,
    p.pickup_total_duration_seconds, p.pickup_trips_eligible_duration,
    p.pickup_total_distance_miles, p.pickup_trips_eligible_distance,
    p.pickup_total_fare_usd, p.pickup_trips_eligible_fare, p.pickup_active_days
  FROM dim_zone z
  LEFT JOIN pickups p ON z.zone_key = p.zone_key
  LEFT JOIN dropoffs d ON z.zone_key = d.zone_key
)
SELECT zone_name, borough, service_zone, zone_classification, pickup_count, dropoff_count,
  dropoff_count - pickup_count AS net_arrivals,
  {ratio('pickup_count', 'pickup_count + dropoff_count', 4)} AS pickup_share_of_zone_activity,
  pickup_total_duration_seconds, pickup_trips_eligible_duration,
  {ratio('pickup_total_duration_seconds', 'pickup_trips_eligible_duration', 2, 60.0)} AS avg_trip_duration_minutes,
  pickup_total_distance_miles, pickup_trips_eligible_distance,
  {ratio('pickup_total_distance_miles', 'pickup_trips_eligible_distance', 3)} AS avg_trip_distance_miles,
  pickup_total_fare_usd, pickup_trips_eligible_fare,
  {ratio('pickup_total_fare_usd', 'pickup_trips_eligible_fare', 2)} AS avg_fare_amount_usd,
  pickup_active_days,
  {ratio('pickup_count', 'pickup_active_days', 2)} AS avg_pickups_per_active_day,
  CAST(DENSE_RANK() OVER (ORDER BY pickup_count DESC) AS BIGINT) AS pickup_rank,
  CAST(DENSE_RANK() OVER (ORDER BY dropoff_count DESC) AS BIGINT) AS dropoff_rank
FROM q3""")

Q4 = with_star(f""",
q4 AS (
  SELECT z.borough AS pickup_borough, CAST(SUM(t.trip_count) AS BIGINT) AS trip_count,
    CAST(SUM(CASE WHEN fare_eligible THEN fare_amount_usd END) AS DECIMAL(38,2)) AS total_fare_amount_usd,
    CAST(SUM(CASE WHEN distance_positive_eligible THEN trip_distance_miles END) AS DECIMAL(38,3))
      AS total_trip_distance_miles,
    COUNT_IF(fare_eligible) AS n_fare, COUNT_IF(distance_positive_eligible) AS n_dist
  FROM elig t LEFT JOIN dim_zone z ON t.pickup_zone_key = z.zone_key
  GROUP BY z.borough
)
SELECT pickup_borough, trip_count, total_fare_amount_usd, total_trip_distance_miles,
  {ratio('total_fare_amount_usd', 'total_trip_distance_miles', 2)} AS fare_per_mile_usd,
  {ratio('total_fare_amount_usd', 'n_fare', 2)} AS avg_fare_amount_usd,
  {ratio('total_trip_distance_miles', 'n_dist', 3)} AS avg_trip_distance_miles,
  CAST(DENSE_RANK() OVER (ORDER BY {ratio('total_fare_amount_usd', 'total_trip_distance_miles')} DESC NULLS LAST)
       AS BIGINT) AS fare_per_mile_rank
FROM q4""")


def as_cte(name: str, query: str) -> str:
    """Turn one of the star queries above into a named CTE (nested WITH over the star CTEs)."""
    rest = query[len("WITH " + STAR):].lstrip()
    if rest.startswith(","):
        return f"{name} AS (WITH {rest[1:].lstrip()})"
    return f"{name} AS ({rest})"


SPOT_CTES = f"""
q1_target AS (
  SELECT pickup_date, pickup_hour, pickup_zone_name, trip_count AS published_trips FROM q1_result
  ORDER BY trip_count DESC, pickup_date NULLS FIRST, pickup_hour NULLS FIRST, pickup_zone_name NULLS FIRST LIMIT 1),
q1_spot AS (
  SELECT t.published_trips,
         (SELECT CAST(SUM(f.trip_count) AS BIGINT) FROM fact f
          JOIN dim_date d ON f.pickup_date_key = d.date_key
          JOIN dim_hour h ON f.pickup_hour_key = h.hour_key
          LEFT JOIN dim_zone z ON f.pickup_zone_key = z.zone_key
          WHERE d.full_date = t.pickup_date AND h.hour_of_day = t.pickup_hour
            AND z.zone_name IS NOT DISTINCT FROM t.pickup_zone_name) AS recomputed_trips
  FROM q1_target t),
q2_target AS (
  SELECT weather_condition, precipitation_band, trip_count AS published_trips, covered_hours FROM q2_result
  ORDER BY trip_count DESC, weather_condition NULLS FIRST, precipitation_band NULLS FIRST LIMIT 1),
q2_keys AS (
  SELECT c.weather_classification_key FROM q2_target t
  JOIN dim_wc c ON c.weather_condition = t.weather_condition AND c.precipitation_band = t.precipitation_band),
q2_spot AS (
  SELECT t.published_trips,
         CAST(COALESCE((SELECT SUM(trip_count) FROM fact
                        WHERE pickup_weather_classification_key IN (SELECT * FROM q2_keys)), 0) AS BIGINT)
           AS recomputed_trips,
         t.covered_hours,
         (SELECT CAST(COUNT(*) AS BIGINT) FROM weather_fact
          WHERE weather_classification_key IN (SELECT * FROM q2_keys)) AS recomputed_hours
  FROM q2_target t),
q3_target AS (
  SELECT zone_name, pickup_count AS published_pickups, avg_fare_amount_usd AS published_avg_fare FROM q3_result
  WHERE pickup_count > 0 ORDER BY pickup_count DESC, zone_name NULLS FIRST LIMIT 1),
q3_spot AS (
  SELECT t.published_pickups, r.recomputed_pickups, t.published_avg_fare, r.recomputed_avg_fare
  FROM q3_target t CROSS JOIN (
    SELECT CAST(SUM(f.trip_count) AS BIGINT) AS recomputed_pickups,
           {sround("CAST(CAST(SUM(CASE WHEN NOT f.negative_fare_amount_flag THEN f.fare_amount_usd END) "
                   "AS DECIMAL(38,2)) AS DOUBLE) / CAST(NULLIF(COUNT_IF(NOT f.negative_fare_amount_flag), 0) AS DOUBLE)",
                   2)} AS recomputed_avg_fare
    FROM fact f JOIN dim_zone z ON f.pickup_zone_key = z.zone_key
    WHERE z.zone_name = (SELECT zone_name FROM q3_target)) r),
q1_by_class AS (
  SELECT pickup_zone_classification, CAST(SUM(trip_count) AS BIGINT) AS n FROM q1_result
  GROUP BY pickup_zone_classification)"""

ANALYTICS_CTES = STAR + ",\n" + ",\n".join(
    [as_cte("q1_result", Q1), as_cte("q2_result", Q2), as_cte("q3_result", Q3), as_cte("q2_coverage", COVERAGE),
     as_cte("q4_result", Q4)]) \
    + "," + SPOT_CTES
