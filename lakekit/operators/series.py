"""Time-series operators: parallel-array explode, alignment, continuity, order and DST-bound checks.

The arrays of one document are bounded by the request window (24 per day), so exploding them is a narrow,
per-row generator; continuity checks use ``LAG`` over range-partitioned series (a long or hot series spans
several tasks), and per-date hour counts are a grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.timeops import seconds_between
from lakekit.operators.sizing import range_count


def explode_parallel_arrays(df: DataFrame, arrays: dict[str, str], keep=(), position: str | None = None) -> DataFrame:
    """Zip N parallel arrays by position and explode into one row per position.

    ``arrays`` maps output column → array column path (or an array Column).  A shorter array pads with null (gate
    alignment first); ``position`` optionally names a 0-based position column (``posexplode``).
    """
    zipped = F.arrays_zip(*[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in arrays.items()])
    if position:
        ex = df.select(*keep, F.posexplode(zipped).alias(position, "__row"))
    else:
        ex = df.select(*keep, F.explode(zipped).alias("__row"))
    return ex.select(*keep, *([position] if position else []),
                     *[F.col(f"__row.{dst}").alias(dst) for dst in arrays])


def array_alignment(df: DataFrame, arrays: list[str], keys=()) -> DataFrame:
    """Per document: sizes of each array and whether they all agree (null arrays count as misaligned)."""
    sizes = [F.size(F.col(a)).alias(f"size_{i}") for i, a in enumerate(arrays)]
    out = df.select(*keys, *sizes)
    cond = F.lit(True)
    for i in range(1, len(arrays)):
        cond = cond & (F.col(f"size_{i}") == F.col("size_0"))
    return out.withColumn("aligned", F.coalesce(cond & (F.col("size_0") >= 0), F.lit(False)))


def expected_hours(start_date, end_date) -> Column:
    """(end + 1 day − start) × 24."""
    return (F.datediff(F.date_add(F.col(end_date), 1), F.col(start_date)) * 24).cast("long")


def lag_distributed(df: DataFrame, keys, order, values: dict[str, str], num_partitions: int | None = None) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY keys ORDER BY order)`` for every ``value -> out`` pair, safe when one key
    holds a large share of the rows.

    The rows are range-partitioned on (keys, order), so a hot key is spread over several contiguous partitions
    instead of one task; the partition id is stored with the rows (written once to the shared checkpoint folder,
    so a retried task cannot move rows between partitions).  LAG is taken inside each (partition, key) slice,
    and the first row of a slice takes the key's last row of the nearest earlier partition that has one, carried over
    partitions without rows.  The number of ranges follows the data's size.  ``order`` must make rows unique within a
    key (e.g. end with an id).
    """
    from lakekit.session import cut_lineage
    keys, order = list(keys), list(order)
    n = num_partitions or range_count(df)
    ranged = cut_lineage(df.repartitionByRange(n, *keys, *order).withColumn("__pid", F.spark_partition_id()),
                         "lag_ranges")
    w = Window.partitionBy("__pid", *keys).orderBy(*order)
    sliced = ranged.withColumn("__first", F.row_number().over(w) == 1)
    for v, out in values.items():
        sliced = sliced.withColumn(out, F.lag(v).over(w))
    last = ranged.groupBy("__pid", *keys).agg(
        F.max_by(F.struct(*[F.col(v).alias(v) for v in values]), F.struct(*order)).alias("__last"))
    along = Window.partitionBy(*keys).orderBy("__pid")  # a key's slices: one row a range at most
    last = last.withColumn("__last", F.lag("__last").over(along))
    last = last.select(F.col("__pid").alias("__own_pid"), *[F.col(k).alias(f"__lk_{k}") for k in keys], "__last")
    cond = sliced["__pid"] == last["__own_pid"]
    for k in keys:
        cond = cond & sliced[k].eqNullSafe(last[f"__lk_{k}"])
    j = sliced.join(last, cond, "left")
    return j.select(*[c for c in df.columns],
                    *[F.when(F.col("__first"), F.col(f"__last.{v}")).otherwise(F.col(out)).alias(out)
                      for v, out in values.items()])


def continuity_report(df: DataFrame, series_keys, utc_col: str, local_col: str, step_seconds: int = 3600) -> DataFrame:
    """One row per series: rows, gaps (step ≠ 1 h), duplicate times, local order violations, first/last time.

    The previous observation comes from :func:`lag_distributed`, so a long series is not sorted in one task.
    """
    keys = list(series_keys)
    lagged = lag_distributed(df.select(*keys, utc_col, local_col), keys, [utc_col, local_col],
                             {utc_col: "__prev_utc", local_col: "__prev_local"})
    step = seconds_between(F.col("__prev_utc"), F.col(utc_col))
    marked = lagged.select(*keys, utc_col, local_col,
                           step.alias("__step"), (F.col(local_col) < F.col("__prev_local")).alias("__back"))
    return marked.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.count_if(F.col("__step").isNotNull() & (F.col("__step") != step_seconds)).cast("long").alias("gaps"),
        F.count_if(F.col("__step") == 0).cast("long").alias("duplicate_times"),
        F.count_if(F.coalesce(F.col("__back"), F.lit(False))).cast("long").alias("local_order_violations"),
        F.min(utc_col).alias("first_utc"), F.max(utc_col).alias("last_utc"))


def local_hours_per_date(df: DataFrame, series_keys, local_col: str, interior_only: bool = True) -> DataFrame:
    """Distinct local hours and rows per local date; DST days have 23 (spring) or 24 distinct / 25 rows (fall).

    With ``interior_only`` the first and last local date of each series (partial days) are dropped.
    """
    d = df.select(*series_keys, F.to_date(local_col).alias("local_date"), F.hour(local_col).alias("local_hour"))
    per = d.groupBy(*series_keys, "local_date").agg(
        F.countDistinct("local_hour").cast("long").alias("distinct_hours"),
        F.count(F.lit(1)).cast("long").alias("rows"))
    if interior_only:
        bounds = d.groupBy(*series_keys).agg(F.min("local_date").alias("__lo"), F.max("local_date").alias("__hi"))
        per = (per.join(bounds, list(series_keys))
               .filter((F.col("local_date") > F.col("__lo")) & (F.col("local_date") < F.col("__hi")))
               .drop("__lo", "__hi"))
    return per.withColumn("within_dst_bounds", F.col("distinct_hours").between(23, 25))
