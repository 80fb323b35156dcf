"""Order-free, multiset-exact content fingerprints of groups of rows (files, snapshots, responses).

A row's SHA-256 digest is cut into four lanes of 64 bits.  A group's fingerprint is SHA-256 over its row count and the
exact sum of each lane: addition commutes, so order, splits and partition counts do not matter, and a repeated row adds
its lanes once more.  Everything is a plain ``sum``: partially aggregated before the shuffle, one row per group and
task, no list and no bucket count, so a file or snapshot of any size (one hot file included) is never in one task.

``sorted_fingerprint`` is the stronger form: SHA-256 over the sorted multiset of the digests themselves, so no two
multisets share it unless SHA-256 collides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.digest import version_id

LANES = 4
LANE_HEX = 16
QUARTERS = 4


def _lane(digest_col: str, i: int) -> Column:
    """64 bits of a hex digest, as a signed long; bytes are cut without a walk over the characters before them."""
    text = F.substring(F.col(digest_col).cast("binary"), LANE_HEX * i + 1, LANE_HEX).cast("string")
    return F.conv(text, 16, -10).cast("long")


def content_fingerprint(df: DataFrame, group_cols, digest_col: str = "row_digest", out: str = "content_sha256",
                        count_out: str = "row_count", regroup: dict[str, Column] | None = None) -> DataFrame:
    """``(group…, content_sha256, row_count)`` for every group of ``df``; the digests are SHA-256 in hex.

    A lane's sum is put together from the sums of its 16-bit quarters: they stay in plain longs up to 10^14 rows a group, so
    no row costs a decimal.  ``regroup`` names what a group column becomes once the rows are summed up (a part file's
    folder): it costs a group what it would else cost a row.
    """
    g = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    rows = df.select(*g, *[_lane(digest_col, i).alias(f"__lane{i}") for i in range(LANES)])
    quarters = {f"__lane{i}_{q}": F.shiftright(f"__lane{i}", 16 * (QUARTERS - 1 - q)).bitwiseAND(0xFFFF)
                for i in range(LANES) for q in range(QUARTERS)}
    sums = rows.groupBy(*g).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(q).alias(name) for name, q in quarters.items()])
    if regroup:
        sums = sums.withColumns(regroup).groupBy(*g).agg(*[F.sum(c).alias(c) for c in ("__n", *quarters)])

    def half_sum(i: int, q: int) -> str:
        return f"(CAST(__lane{i}_{q} AS DECIMAL(19,0)) * 65536BD + CAST(__lane{i}_{q + 1} AS DECIMAL(19,0)))"

    lanes = [F.expr(f"{half_sum(i, 0)} * 4294967296BD + {half_sum(i, 2)}") for i in range(LANES)]
    text = F.concat_ws(":", F.col("__n").cast("string"), *[lane.cast("string") for lane in lanes])
    return sums.select(*g, F.sha2(text, 256).alias(out), F.col("__n").cast("long").alias(count_out))


def _sorted_join(c: Column, sep: str) -> Column:
    return F.array_join(F.array_sort(F.collect_list(c)), sep)


def sorted_fingerprint(df: DataFrame, group_cols, digest_col: str = "row_digest", prefix_len: int = 3,
                       out: str = "content_sha256", count_out: str = "row_count", sep: str = ",") -> DataFrame:
    """``(group…, content_sha256, row_count)`` for every group of ``df``, over its sorted digests.

    Equal rows collapse into one digest with its count before the shuffle; the digests are sorted and hashed by group and
    prefix (``16^prefix_len`` parts a group: widen it for groups of billions of rows), then the parts' hashes by group.
    """
    g = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    d = df.groupBy(*g, F.col(digest_col).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    entry = F.concat(F.col("__d"), F.lit("x"), F.col("__n").cast("string"))
    b = d.groupBy(*g, F.substring("__d", 1, prefix_len).alias("__b")).agg(
        F.sha2(_sorted_join(entry, sep), 256).alias("__bh"), F.sum("__n").alias("__n"))
    part = F.concat(F.col("__b"), F.lit(":"), F.col("__bh"))
    return b.groupBy(*g).agg(F.sha2(_sorted_join(part, sep), 256).alias(out), F.sum("__n").cast("long").alias(count_out))


def snapshot_fingerprint(df: DataFrame, digest_col: str = "row_digest", prefix: str = "v_", n: int = 12) -> DataFrame:
    """One row ``(content_sha256, row_count, version_id)`` for a whole snapshot (e.g. a zone lookup file)."""
    fp = content_fingerprint(df.withColumn("__all", F.lit(1)), ["__all"], digest_col).drop("__all")
    return fp.withColumn("version_id", version_id(prefix, "content_sha256", n))


def response_identity(doc: DataFrame, volatile_cols: list[str], payload_cols: list[str] | None = None) -> DataFrame:
    """Two identities per response document: ``content_sha256`` over the whole payload and
    ``source_response_version`` over the payload without the volatile fields (e.g. generation time)."""
    cols = payload_cols or doc.columns
    stable = [c for c in cols if c not in volatile_cols]
    whole = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    version = F.sha2(F.to_json(F.struct(*stable), {"ignoreNullFields": "false"}), 256)
    return doc.withColumn("content_sha256", whole).withColumn("source_response_version", version)


def source_period(file_name_col, pattern: str = r"(\d{4}-\d{2})") -> Column:
    """Period parsed from a file name (``YYYY-MM``); no match → null."""
    c = F.col(file_name_col) if isinstance(file_name_col, str) else file_name_col
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
