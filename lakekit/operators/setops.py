"""Key-set and snapshot comparisons: ``EXCEPT`` both ways as one full outer join, ``INTERSECT``, multiset diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_set_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``(only_left, only_right, in_both)`` over the distinct key sets (one shuffle join, not four)."""
    lk = left.select(*keys).distinct().withColumn("__l", F.lit(True))
    rk = right.select(*keys).distinct().withColumn("__r", F.lit(True))
    j = lk.join(rk, keys, "full_outer")
    return j.agg(F.count_if(F.col("__r").isNull()).cast("long").alias("only_left"),
                 F.count_if(F.col("__l").isNull()).cast("long").alias("only_right"),
                 F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).cast("long").alias("in_both"))


def keys_only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``SELECT keys FROM left EXCEPT SELECT keys FROM right`` (distinct)."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def common_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``INTERSECT`` of the key sets (distinct)."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_semi")


def snapshot_diff(before: DataFrame, after: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows whose multiplicity differs between two snapshots: ``(cols…, side, copies)`` where ``side`` is
    ``before_only`` or ``after_only``.  Counts per distinct row instead of ``exceptAll`` twice: one shuffle."""
    cols = cols or before.columns
    b = before.groupBy(*cols).agg(F.count(F.lit(1)).alias("__b"))
    a = after.groupBy(*cols).agg(F.count(F.lit(1)).alias("__a"))
    cond = None
    for c in cols:
        e = b[c].eqNullSafe(a[c])
        cond = e if cond is None else cond & e
    j = b.join(a, cond, "full_outer")
    nb, na = F.coalesce(F.col("__b"), F.lit(0)), F.coalesce(F.col("__a"), F.lit(0))
    out = j.select(*[F.coalesce(b[c], a[c]).alias(c) for c in cols], (nb - na).alias("__d"))
    return (out.filter(F.col("__d") != 0)
            .select(*cols, F.when(F.col("__d") > 0, "before_only").otherwise("after_only").alias("side"),
                    F.abs(F.col("__d")).cast("long").alias("copies")))
