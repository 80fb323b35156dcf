"""Searched-CASE mappings (WMO condition, precipitation band, time-of-day band, zone class, DQ status)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# WMO weather code -> condition label (28 codes, 15 labels). Unlisted non-null code -> "unknown_code".
WMO_CONDITIONS = [
    (0, "clear_sky"), (1, "mainly_clear"), (2, "partly_cloudy"), (3, "overcast"),
    (45, "fog"), (48, "fog"),
    (51, "drizzle"), (53, "drizzle"), (55, "drizzle"),
    (56, "freezing_drizzle"), (57, "freezing_drizzle"),
    (61, "rain"), (63, "rain"), (65, "rain"),
    (66, "freezing_rain"), (67, "freezing_rain"),
    (71, "snow"), (73, "snow"), (75, "snow"),
    (77, "snow_grains"),
    (80, "rain_showers"), (81, "rain_showers"), (82, "rain_showers"),
    (85, "snow_showers"), (86, "snow_showers"),
    (95, "thunderstorm"),
    (96, "thunderstorm_with_hail"), (99, "thunderstorm_with_hail"),
]
UNKNOWN_CODE = "unknown_code"
# Precipitation bands in order; thresholds in mm: 0 -> dry, <=2.5 light, <=7.5 moderate, else heavy.
PRECIPITATION_BANDS = ["dry", "light", "moderate", "heavy"]
LIGHT_MAX_MM = 2.5
MODERATE_MAX_MM = 7.5
# Hour-of-day bands: 0-5 overnight, 6-11 morning, 12-17 afternoon, 18-23 evening.
TIME_OF_DAY_BANDS = [(0, 5, "overnight"), (6, 11, "morning"), (12, 17, "afternoon"), (18, 23, "evening")]
# Taxi-zone classification: 264 unknown, 265 outside_nyc, borough EWR -> ewr, five boroughs -> nyc_borough.
ZONE_SENTINELS = {264: "unknown", 265: "outside_nyc"}
ZONE_SPECIAL_BOROUGHS = {"EWR": "ewr"}
ZONE_REGULAR_BOROUGHS = ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island"]
ZONE_REGULAR_LABEL = "nyc_borough"
ZONE_OTHER_LABEL = "other_special"
# Plausible air temperature in degrees C: Bronze -50..60; Silver -90..60 (a null value also fails in Silver).
BRONZE_TEMPERATURE_RANGE_C = (-50, 60)
SILVER_TEMPERATURE_RANGE_C = (-90, 60)
# Units of the hourly weather measures as the response declares them (time, temperature, precipitation, code).
HOURLY_UNITS = {"time": "iso8601", "temperature_2m": "°C", "precipitation": "mm", "weather_code": "wmo code"}
# DQ statuses and severities.
DQ_STATUSES = ["PASS", "WARN", "FAIL", "INFO"]
# ---------------------------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wmo_condition(code) -> Column:
    """WMO code → condition label; null stays null, an unlisted code becomes ``unknown_code``."""
    c = _c(code)
    by_label: dict[str, list[int]] = {}
    for k, label in WMO_CONDITIONS:
        by_label.setdefault(label, []).append(k)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for label, codes in by_label.items():
        expr = expr.when(c.isin(codes), F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN_CODE))


def precipitation_band(mm) -> Column:
    """null/negative → null; 0 dry; ≤2.5 light; ≤7.5 moderate; else heavy."""
    m = _c(mm)
    return (F.when(m.isNull() | (m < 0), F.lit(None).cast("string"))
            .when(m == 0, F.lit("dry"))
            .when(m <= F.lit(LIGHT_MAX_MM), F.lit("light"))
            .when(m <= F.lit(MODERATE_MAX_MM), F.lit("moderate"))
            .otherwise(F.lit("heavy")))


def time_of_day_band(hour) -> Column:
    h = _c(hour)
    expr = None
    for lo, hi, label in TIME_OF_DAY_BANDS[:-1]:
        expr = (F.when if expr is None else expr.when)(h.between(lo, hi), F.lit(label))
    return expr.otherwise(F.lit(TIME_OF_DAY_BANDS[-1][2]))


def zone_classification(location_id, borough, sentinels=None, special=None, regular=None,
                        regular_label: str = ZONE_REGULAR_LABEL, other_label: str = ZONE_OTHER_LABEL,
                        case_insensitive: bool = False) -> Column:
    """Ordered rule: sentinel ids, then special borough values, then regular boroughs, else ``other_label``."""
    sentinels = ZONE_SENTINELS if sentinels is None else sentinels
    special = ZONE_SPECIAL_BOROUGHS if special is None else special
    regular = ZONE_REGULAR_BOROUGHS if regular is None else regular
    loc, b = _c(location_id), F.trim(_c(borough))
    if case_insensitive:
        b = F.upper(b)
        special = {k.upper(): v for k, v in special.items()}
        regular = [r.upper() for r in regular]
    expr = None
    for k, label in sentinels.items():
        expr = (F.when if expr is None else expr.when)(loc == F.lit(k), F.lit(label))
    for k, label in special.items():
        expr = (F.when if expr is None else expr.when)(b == F.lit(k), F.lit(label))
    expr = (F.when if expr is None else expr.when)(b.isin(regular), F.lit(regular_label))
    return expr.otherwise(F.lit(other_label))


def dq_status(severity, fail_count, fail_pct, threshold_pct, fail_on_empty_warn: bool = False,
              total_count=None) -> Column:
    """INFO→INFO; 0 failures→PASS; FAIL severity→FAIL; WARN above tolerance→FAIL; else WARN.

    ``fail_on_empty_warn`` adds the stricter variant's rule: a WARN check over an empty total fails.
    """
    sev, n, pct, thr = _c(severity), _c(fail_count), _c(fail_pct), _c(threshold_pct)
    expr = F.when(sev == "INFO", F.lit("INFO"))
    if fail_on_empty_warn and total_count is not None:
        expr = expr.when((sev == "WARN") & (_c(total_count) == 0), F.lit("FAIL"))
    return (expr.when(n == 0, F.lit("PASS"))
            .when(sev == "FAIL", F.lit("FAIL"))
            .when((sev == "WARN") & (pct > F.coalesce(thr, F.lit(0.0))), F.lit("FAIL"))
            .otherwise(F.lit("WARN")))
