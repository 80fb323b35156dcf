"""Sum-of-sums metrics with explicit eligibility, shares of total and scalable ranks.

An average is always *summed eligible measure / count of eligible rows*, never an average of averages; a row
that is ineligible for one measure still counts as a trip.  Ranks over a whole result never route every row
through one task: the distinct values of the measure are ranked and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.sizing import broadcast_if_small, range_count, row_count_at_most
from lakekit.session import cut_lineage


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def eligible_sum(x, eligible) -> Column:
    """``SUM(CASE WHEN eligible THEN x END)``."""
    return F.sum(F.when(_c(eligible), _c(x)))


def eligible_count(eligible) -> Column:
    """``COUNT_IF(eligible)`` as bigint."""
    return F.count_if(F.coalesce(_c(eligible), F.lit(False))).cast("long")


def safe_ratio(num, den, digits: int | None = None, scale: float = 1.0) -> Column:
    """``ROUND(num / NULLIF(den, 0) / scale, digits)`` in double arithmetic (null when den is 0 or null)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    r = F.when(d != 0, n / d)
    if scale != 1.0:
        r = r / F.lit(float(scale))
    return F.round(r, digits) if digits is not None else r


def share_of_total(df: DataFrame, col: str, out: str, digits: int = 4, percent: bool = True) -> DataFrame:
    """``ROUND(100 * x / SUM(x) OVER (), digits)`` as a one-row grand total joined back (no single-partition
    window)."""
    total = df.agg(F.sum(col).alias("__grand_total"))
    factor = 100.0 if percent else 1.0
    return (df.crossJoin(F.broadcast(total))  # one row by construction
              .withColumn(out, F.round(F.lit(factor) * F.col(col).cast("double")
                                       / F.col("__grand_total").cast("double"), digits))
              .drop("__grand_total"))


def dense_rank_by(df: DataFrame, order_col: str, out: str, descending: bool = True,
                  partition_cols: tuple[str, ...] | list[str] = (), max_broadcast_rows: int | None = None,
                  max_values: int = 1_000_000) -> DataFrame:
    """``DENSE_RANK() OVER ([PARTITION BY p] ORDER BY order_col [DESC])`` without a single-partition sort of
    ``df``: rank the *distinct* (partition, value) pairs, then join the rank back on them (null-safe).

    Descending order puts nulls last and ascending puts them first, as Spark SQL does.  The distinct set is the
    number of different measure values, far below the row count for aggregated outputs.  A global rank over more than
    ``max_values`` of them (a bounded count) is taken by :func:`global_dense_rank_distributed`.
    """
    parts = list(partition_cols)
    keys = parts + [order_col]
    distinct = df.select(*keys).distinct()
    if not parts and row_count_at_most(distinct, max_values) is None:
        return global_dense_rank_distributed(df, order_col, out, descending)
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    w = Window.partitionBy(*parts).orderBy(order) if parts else Window.orderBy(order)
    ranked = distinct.withColumn(out, F.dense_rank().over(w).cast("long"))
    if max_broadcast_rows:
        ranked = broadcast_if_small(ranked, max_broadcast_rows)
    # otherwise AQE picks a broadcast from the measured size of the (small) ranked distinct set
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(ranked[k])
        cond = c if cond is None else cond & c
    return df.join(ranked, cond, "left").select(df["*"], ranked[out])


def global_dense_rank_distributed(df: DataFrame, order_col: str, out: str, descending: bool = True,
                                  num_partitions: int | None = None) -> DataFrame:
    """Dense rank over the whole frame for very many distinct values, fully distributed.

    Distinct values are range-partitioned and sorted within partitions; a value's rank is the number of distinct
    values in earlier partitions plus its position in its own partition.  The per-partition counts table has one
    row per partition, so it is the only thing broadcast.  The positioned values are materialised once so the
    counts and the positions read the same range partitioning.
    """
    n = num_partitions or range_count(df)
    key = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
    distinct = df.select(order_col).distinct()
    positioned = (distinct.repartitionByRange(n, key).sortWithinPartitions(key)
                  .withColumn("__mid", F.monotonically_increasing_id())
                  .withColumn("__pid", F.shiftright(F.col("__mid"), 33))
                  .withColumn("__pos", F.col("__mid") - F.shiftleft(F.col("__pid"), 33) + 1)
                  .drop("__mid"))
    # written once to the shared checkpoint folder: the sampled range bounds and positions must not be
    # recomputed differently for the counts and the rank lookup if an executor is lost
    positioned = cut_lineage(positioned, "rank_positions")
    counts = positioned.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__offset", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                               F.lit(0)))
    ranked = (positioned.join(F.broadcast(offsets.select("__pid", "__offset")), "__pid")
              .select(order_col, (F.col("__offset") + F.col("__pos")).cast("long").alias(out)))
    return df.join(ranked, df[order_col].eqNullSafe(ranked[order_col]), "left").select(df["*"], ranked[out])
