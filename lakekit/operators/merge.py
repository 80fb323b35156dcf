"""Keyed snapshot merge without a table format: insert new keys, update only on a null-safe change of chosen
columns, optionally delete target keys missing from the source (mirror), optionally gated by a run-level flag.

The merge is one full outer join on the keys; every output row carries ``_merge_action`` (``insert``,
``update``, ``unchanged``, ``keep`` for target-only rows kept, and — in the plan only — ``delete``).  Unchanged
rows keep their target values, including lineage stamps, so a re-run that changes nothing produces the same
snapshot and :func:`merge_counts` reports zero changes (the caller can then skip the write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.digest import row_digest
from lakekit.operators.fingerprint import content_fingerprint
from lakekit.session import cut_lineage

ACTIONS = ["insert", "update", "unchanged", "keep", "delete"]


def merge_plan(target: DataFrame, source: DataFrame, keys: list[str], compare_cols: list[str],
               update_cols: list[str] | None = None, delete_unmatched: bool = False,
               enabled: bool = True) -> DataFrame:
    """Every key of either side with its action and the resulting row (columns of ``target``).

    Keys match null-safely.  A key that the source holds more than once raises when the plan runs (it would multiply
    target rows); the grouping that finds it is on the join's own keys.
    """
    cols = target.columns
    update_cols = update_cols if update_cols is not None else [c for c in cols if c not in keys]
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols], F.lit(True).alias("__in_t"))
    carried = [c for c in cols if c in source.columns and c not in keys]
    once = F.when(F.col("__n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit("merge source holds a key more than once")).cast("boolean"))
    s = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in carried])
         .select(*[F.col(c).alias(f"__s_{c}") for c in [*keys, *carried]], once.alias("__in_s")))
    cond = None
    for k in keys:
        c = F.col(f"__t_{k}").eqNullSafe(F.col(f"__s_{k}"))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("__in_t").isNotNull(), F.col("__in_s").isNotNull()
    same = F.lit(True)
    for c in compare_cols:
        same = same & F.col(f"__t_{c}").eqNullSafe(F.col(f"__s_{c}"))
    enabled_c = F.lit(bool(enabled))
    action = (F.when(in_t & in_s & ~same & enabled_c, F.lit("update"))
              .when(in_t & in_s, F.lit("unchanged"))
              .when(in_s & enabled_c, F.lit("insert"))
              .when(in_s, F.lit("skipped"))
              .when(F.lit(bool(delete_unmatched)) & enabled_c, F.lit("delete"))
              .otherwise(F.lit("keep")))
    j = j.withColumn("_merge_action", action)
    out = []
    for c in cols:
        from_source = F.col("_merge_action").isin("insert") | (
            (F.col("_merge_action") == "update") & F.lit(c in update_cols))
        if c in keys:
            v = F.coalesce(F.col(f"__t_{c}"), F.col(f"__s_{c}"))
        elif c in source.columns:
            v = F.when(from_source, F.col(f"__s_{c}")).otherwise(F.col(f"__t_{c}"))
        else:
            v = F.col(f"__t_{c}")
        out.append(v.alias(c))
    return j.select(*out, "_merge_action")


def merge_snapshot(target: DataFrame, source: DataFrame, keys: list[str], compare_cols: list[str],
                   update_cols: list[str] | None = None, delete_unmatched: bool = False,
                   enabled: bool = True) -> DataFrame:
    """The merged snapshot (deleted and skipped keys removed) with ``_merge_action``."""
    plan = merge_plan(target, source, keys, compare_cols, update_cols, delete_unmatched, enabled)
    return plan.filter(~F.col("_merge_action").isin("delete", "skipped"))


def merge_counts(plan: DataFrame) -> DataFrame:
    """One row per action with its key count (the caller skips the write when only unchanged/keep occur)."""
    return plan.groupBy("_merge_action").agg(F.count(F.lit(1)).cast("long").alias("keys"))


def converge(store, name: str, source: DataFrame, partition_col: str, digest_cols: list[str] | None = None) -> dict[str, int]:
    """Make the stored table equal to ``source`` (update all, insert new, delete what is gone), writing changed partitions only.

    The content fingerprint of each partition of ``source`` (sums, one small shuffle) is compared with the stored one from the
    table's digest log; partitions that differ or are new are overwritten, those that ``source`` no longer has are dropped.
    An equal source writes nothing, neither rows nor digests.  Digests are logged after the rows, so a run that dies
    in between writes its partitions again.  ``source`` is read twice; ``partition_col`` must not be null.  Returns counts.
    """
    cols = digest_cols or source.columns
    digests = source.select(F.col(partition_col).cast("string").alias("part"), row_digest(*cols).alias("row_digest"))
    new = cut_lineage(content_fingerprint(digests, ["part"]), f"{name}-digests")
    held = store.partition_values(name, partition_col)
    log = store.read_log(f"{name}_digests", "part string, content_sha256 string, row_count long, at timestamp")
    present = source.sparkSession.createDataFrame([(v,) for v in held], "held string")
    old = log.groupBy("part").agg(F.max_by("content_sha256", "at").alias("old")).join(present, F.col("part") == F.col("held"))
    changed = cut_lineage(new.join(old.select("part", "old"), "part", "left").filter(~F.col("content_sha256").eqNullSafe(F.col("old"))), "changed")
    gone = [r["held"] for r in present.join(new, F.col("held") == F.col("part"), "left_anti").collect()]  # folder names
    n = changed.count()
    if n:
        rows = source.join(changed.select(F.col("part").alias("__part")), F.col(partition_col).cast("string") == F.col("__part"), "left_semi")
        # dealt by partition, a large one over several tasks: not every task writes a file of every partition
        store.overwrite_partitions(name, rows.hint("rebalance", partition_col), [partition_col])
        store.append(f"{name}_digests", changed.select("part", "content_sha256", "row_count", F.current_timestamp().alias("at")))
    store.drop_partitions(name, partition_col, gone)
    return {"partitions_written": n, "partitions_dropped": len(gone), "partitions_unchanged": new.count() - n}
