"""Dimension resolution with an explicit match status, match-cardinality resolution, and join guards.

Every resolution is a LEFT join: an unresolved row survives with a status instead of vanishing.  Guards prove the
right side's key is unique *before* joining (one grouped count of the small side) instead of recounting the fact
after every join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.timeops import truncate_hour
from lakekit.operators.sizing import broadcast_if_small

MISSING_SOURCE_ID = "missing_source_id"
MATCHED_SPECIAL = "matched_special"
MATCHED_REGULAR = "matched_regular"
UNMATCHED = "unmatched_location_id"

INVALID_TIME = "invalid_pickup_timestamp"
NO_MATCH = "no_match"
MATCHED_UNIQUE = "matched_unique"
AMBIGUOUS = "ambiguous_match"


class GuardError(RuntimeError):
    pass


def match_status(source_id: Column, matched: Column, sentinel_ids) -> Column:
    """missing_source_id / matched_special / matched_regular / unmatched_location_id."""
    return (F.when(source_id.isNull(), F.lit(MISSING_SOURCE_ID))
            .when(source_id.isin(list(sentinel_ids)) & matched, F.lit(MATCHED_SPECIAL))
            .when(matched, F.lit(MATCHED_REGULAR))
            .otherwise(F.lit(UNMATCHED)))


def unique_lookup(df: DataFrame, key: str) -> DataFrame:
    """``df`` without null keys, grouped by ``key``; a key that occurs more than once raises when the plan runs."""
    rest = [c for c in df.columns if c != key]
    g = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    once = F.when(F.col("__n") == 1, F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("lookup key is not unique: "), F.col(key).cast("string"))).cast(df.schema[key].dataType))
    return g.select(once.alias(key), *rest)


def resolve_roles(fact: DataFrame, dim: DataFrame, dim_key: str, roles: dict[str, str], sentinel_ids=(),
                  carry: dict[str, str] | None = None, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Role-playing resolution: for each ``role -> fact column`` left-join the same dimension once and add
    ``<role>_zone_match_status`` (plus optional carried dim columns renamed ``<role>_<name>``).

    A key that the dimension holds more than once raises: it would change the fact's grain.
    """
    carry = carry or {}
    keys = unique_lookup(dim.select(F.col(dim_key).alias("__k"), *[F.col(src).alias(f"__c_{dst}") for dst, src in carry.items()]), "__k")
    keys = broadcast_if_small(keys, max_broadcast_rows)
    out = fact
    for role, fact_col in roles.items():
        r = keys.select(F.col("__k").alias(f"__k_{role}"),
                        *[F.col(f"__c_{dst}").alias(f"{role}_{dst}") for dst in carry])
        out = out.join(r, out[fact_col] == r[f"__k_{role}"], "left")
        out = out.withColumn(f"{role}_zone_match_status",
                             match_status(F.col(fact_col), F.col(f"__k_{role}").isNotNull(), sentinel_ids))
        out = out.drop(f"__k_{role}")
    return out


def hourly_series_profile(series: DataFrame, time_col: str, key_col: str) -> DataFrame:
    """Per series hour: how many series rows share it and the max key (the key is only used when n = 1)."""
    return (series.groupBy(F.col(time_col).alias("__hour"))
            .agg(F.count(F.col(key_col)).alias("__match_count"), F.max(key_col).alias("__match_key")))


def resolve_unique(fact: DataFrame, fact_time: Column, series: DataFrame, series_time_col: str, series_key_col: str,
                   key_out: str, status_out: str, time_out: str | None = None,
                   max_broadcast_rows: int = 5_000_000) -> DataFrame:
    """Match each fact row to the series row(s) of its hour and classify by match cardinality.

    0 → no_match, 1 → matched_unique (+ key), >1 → ambiguous_match (no key), null time → invalid_pickup_timestamp.
    The series is aggregated per hour first (count, max key): the match count depends only on the hour, so this
    equals the fact-side ``GROUP BY`` after a row join but never shuffles or fans out the fact.  The per-hour
    profile is bounded by the series' time span and is broadcast when a bounded count proves it small.
    """
    prof = broadcast_if_small(hourly_series_profile(series, series_time_col, series_key_col), max_broadcast_rows)
    t = fact_time
    with_t = fact.withColumn(time_out or "__fact_time", t)
    tcol = F.col(time_out or "__fact_time")
    joined = with_t.join(prof, truncate_hour(tcol) == prof["__hour"], "left")
    n = F.coalesce(F.col("__match_count"), F.lit(0))
    out = (joined
           .withColumn(key_out, F.when(n == 1, F.col("__match_key")))
           .withColumn(status_out, F.when(tcol.isNull(), F.lit(INVALID_TIME))
                       .when(n == 0, F.lit(NO_MATCH))
                       .when(n == 1, F.lit(MATCHED_UNIQUE))
                       .otherwise(F.lit(AMBIGUOUS)))
           .drop("__hour", "__match_count", "__match_key"))
    if time_out is None:
        out = out.drop("__fact_time")
    return out
