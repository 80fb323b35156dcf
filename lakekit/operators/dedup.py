"""Collision quarantine with no survivor, quarantine-rate guard and independent expected-quarantine count.

A group of rows sharing an identity hash is ambiguous: no row is trusted, all go to quarantine with a reason.
The collision size is computed as a grouped count (map-side partial aggregation, so a hot key is pre-aggregated
before the shuffle) and joined back, instead of a window that would route a hot key's rows into one task.
Only keys seen more than once are joined back; AQE broadcasts that set when it is small and splits skewed
partitions when it is not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DUPLICATE_REASON = "duplicate_hash_collision"


def collision_counts(df: DataFrame, key) -> DataFrame:
    """``(key…, collision_count)`` for keys that occur more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("collision_count"))
              .filter(F.col("collision_count") > 1))


def with_collision_count(df: DataFrame, key, dups: DataFrame | None = None) -> DataFrame:
    """Every row with ``collision_count`` = size of its key group (1 for singletons); null keys count as one
    group, like ``COUNT(*) OVER (PARTITION BY key)``.

    ``key`` may be the identity hash or, cheaper to shuffle, the identity columns it is computed from (the same
    groups, since the hash is a function of exactly those columns).  ``dups``: ``collision_counts`` of ``df`` where they
    are written already; their exact size then decides how they are joined.
    """
    keys = [key] if isinstance(key, str) else list(key)
    dups = collision_counts(df, keys) if dups is None else dups
    dups = dups.select(*[F.col(k).alias(f"__dup_{k}") for k in keys], "collision_count")
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(dups[f"__dup_{k}"])
        cond = c if cond is None else cond & c
    joined = df.join(dups, cond, "left").drop(*[f"__dup_{k}" for k in keys])
    return joined.withColumn("collision_count", F.coalesce(F.col("collision_count"), F.lit(1)).cast("long"))


def collision_split(df: DataFrame, key, reason: str = DUPLICATE_REASON) -> tuple[DataFrame, DataFrame]:
    """Split into (clean, quarantine). Clean rows are unique on ``key`` and drop the count; quarantine rows keep
    ``collision_count`` and get ``quarantine_reasons = [reason]``."""
    decided = with_collision_count(df, key)
    clean = decided.filter(F.col("collision_count") == 1).drop("collision_count")
    quarantine = (decided.filter(F.col("collision_count") > 1)
                  .withColumn("quarantine_reasons", F.array(F.lit(reason))))
    return clean, quarantine


def expected_quarantine_rows(df: DataFrame, key) -> DataFrame:
    """Independent recomputation: one row ``(duplicate_groups, expected_quarantine_rows, excess_rows)``."""
    return (collision_counts(df, key)
            .agg(F.count(F.lit(1)).cast("long").alias("duplicate_groups"),
                 F.coalesce(F.sum("collision_count"), F.lit(0)).cast("long").alias("expected_quarantine_rows"),
                 F.coalesce(F.sum(F.col("collision_count") - 1), F.lit(0)).cast("long").alias("excess_rows")))


@dataclass
class QuarantineRate:
    clean_rows: int
    quarantine_rows: int
    max_pct: float

    @property
    def pct(self) -> float:
        total = self.clean_rows + self.quarantine_rows
        return 0.0 if total == 0 else 100.0 * self.quarantine_rows / total

    @property
    def halted(self) -> bool:
        return self.pct > self.max_pct


class QuarantineRateExceeded(RuntimeError):
    pass


def quarantine_rate_guard(clean: DataFrame, quarantine: DataFrame, max_pct: float = 1.0,
                          raise_on_exceed: bool = True) -> QuarantineRate:
    """Halt when more than ``max_pct`` % of rows were quarantined (write the quarantine table first)."""
    counts = (clean.select(F.lit(0).alias("q")).unionByName(quarantine.select(F.lit(1).alias("q")))
              .agg(F.count_if(F.col("q") == 0).alias("c"), F.count_if(F.col("q") == 1).alias("q")).first())
    rate = QuarantineRate(int(counts["c"]), int(counts["q"]), max_pct)
    if rate.halted and raise_on_exceed:
        raise QuarantineRateExceeded(f"quarantine rate {rate.pct:.3f}% exceeds {max_pct}%")
    return rate


def quarantine_rate_frame(clean: DataFrame, quarantine: DataFrame, max_pct: float = 1.0) -> DataFrame:
    """The same guard as a one-row DataFrame ``(clean_rows, quarantine_rows, quarantine_pct, halted)``."""
    c = clean.agg(F.count(F.lit(1)).cast("long").alias("clean_rows"))
    q = quarantine.agg(F.count(F.lit(1)).cast("long").alias("quarantine_rows"))
    both = c.crossJoin(q)  # two one-row aggregates
    pct = F.when((F.col("clean_rows") + F.col("quarantine_rows")) == 0, F.lit(0.0)).otherwise(
        F.round(F.lit(100.0) * F.col("quarantine_rows") / (F.col("clean_rows") + F.col("quarantine_rows")), 4))
    return both.withColumn("quarantine_pct", pct).withColumn("halted", F.col("quarantine_pct") > F.lit(max_pct))
