"""Running totals over globally ordered rows, in DataFrame functions only.

Rows are dealt into ranges of (group, order) and written with their range's number; the ranges' sums are added up along
each group, and a window inside (range, group) gives the rest.  No task sees more than a range, also where one group
holds most rows, and a retried task cannot move rows between ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import input_partitions
from lakekit.session import cut_lineage


def running_total(rows: DataFrame, group: list[str], order: list[str], amount, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` (a column of whole numbers) over the rows of the same group that come before.

    ``rows`` should be a written table (it is read twice); ``order`` must tell its rows apart, nulls come first.  A part
    of a group in one range is as large as a range; the table of the ranges' sums has one row a range and group in it.
    """
    part, own, sums = f"__{name}_part", f"__{name}_own", f"__{name}_sums"
    keys = [F.col(c) for c in [*group, *order]]
    dealt = rows.withColumn(own, amount.cast("long")).repartitionByRange(input_partitions(rows), *keys)
    staged = cut_lineage(dealt.withColumn(part, F.spark_partition_id()), name)
    along = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = staged.groupBy(part, *group).agg(F.sum(own).alias(sums))
    parts = cut_lineage(parts.withColumn(sums, F.coalesce(F.sum(sums).over(along), F.lit(0))), f"{name}-ranges")
    inside = Window.partitionBy(part, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = staged.withColumn(own, F.coalesce(F.sum(own).over(inside), F.lit(0)))
    same = counted[part] == parts[part]
    for c in group:
        same = same & counted[c].eqNullSafe(parts[c])
    return counted.join(parts, same).select(*[counted[c] for c in rows.columns], (counted[own] + parts[sums]).alias(name))
