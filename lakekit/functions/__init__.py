"""Column-expression helpers: every function returns a built-in Spark ``Column`` (no Python UDF)."""

from lakekit.functions.classify import (dq_status, precipitation_band, time_of_day_band, wmo_condition,
                                        zone_classification)
from lakekit.functions.digest import (delimited_text, json_text, row_digest, surrogate_key, version_id)
from lakekit.functions.flags import not_true, trip_quality_flags, two_valued, with_flags
from lakekit.functions.timeops import (ambiguous_local_flag, date_key, in_half_open_window, local_to_utc,
                                       nonexistent_local_flag, ntz_literal, seconds_between, truncate_hour,
                                       utc_to_local, yyyymm)

__all__ = [
    "dq_status", "precipitation_band", "time_of_day_band", "wmo_condition", "zone_classification",
    "delimited_text", "json_text", "row_digest", "surrogate_key", "version_id",
    "not_true", "trip_quality_flags", "two_valued", "with_flags",
    "ambiguous_local_flag", "date_key", "in_half_open_window", "local_to_utc", "nonexistent_local_flag",
    "ntz_literal", "seconds_between", "truncate_hour", "utc_to_local", "yyyymm",
]
