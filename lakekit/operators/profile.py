"""Source profiling, schema signatures and drift, and join-coverage reports — each a single grouped pass.

Per-file profiles group one scan by the file column (never one job per file), null rates are one aggregation
over all columns, and the coverage report is one left join against the distinct dimension keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def null_rates(df: DataFrame, label: str | None = None, digits: int = 4) -> DataFrame:
    """One row per column: ``(dataset, column_name, ordinal, null_count, total_count, null_pct)``."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__total"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                        F.col(f"__n{i}").cast("long").alias("null_count")) for i, c in enumerate(cols)]
    rows = one.select(F.col("__total").cast("long").alias("total_count"), F.inline(F.array(*structs)))
    pct = F.when(F.col("total_count") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("null_count").cast("double") * 100.0 / F.col("total_count").cast("double"), digits))
    return rows.select(F.lit(label).cast("string").alias("dataset"), "column_name", "ordinal", "null_count",
                       "total_count", pct.alias("null_pct"))


def value_frequency(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` per distinct value (partial aggregation; output is the domain size)."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).cast("long").alias("count"))


def schema_signature(schema: StructType, dataset: str | None = None) -> list[tuple]:
    """``(dataset, column_name, data_type, ordinal)`` rows from a schema (driver-side metadata, no data read)."""
    return [(dataset, f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(schema.fields)]


def schema_signature_frame(spark: SparkSession, schemas: dict[str, StructType]) -> DataFrame:
    rows = [r for name, s in schemas.items() for r in schema_signature(s, name)]
    return spark.createDataFrame(rows, "dataset string, column_name string, data_type string, ordinal int")


def schema_fingerprint(schema: StructType) -> str:
    """SHA-256 of the ordered ``name:type`` signature (column metadata only)."""
    text = "|".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields)
    return hashlib.sha256(text.encode()).hexdigest()


def signature_mismatches(actual: DataFrame, expected: DataFrame, compare_types: bool = True) -> DataFrame:
    """Full outer join of two ``(column_name, data_type, ordinal)`` signatures; rows that differ."""
    keys = ["column_name"]
    a = actual.select("column_name", F.col("data_type").alias("actual_type"), F.col("ordinal").alias("actual_ordinal"))
    e = expected.select("column_name", F.col("data_type").alias("expected_type"),
                        F.col("ordinal").alias("expected_ordinal"))
    j = a.join(e, keys, "full_outer")
    bad = ~F.col("actual_ordinal").eqNullSafe(F.col("expected_ordinal"))
    if compare_types:
        bad = bad | ~F.col("actual_type").eqNullSafe(F.col("expected_type"))
    return j.filter(bad)


def schema_drift(signatures: DataFrame) -> DataFrame:
    """Columns whose type or presence differs across datasets: ``(column_name, dataset, data_type|MISSING)``.

    ``signatures`` is ``(dataset, column_name, data_type, ordinal)`` for every dataset (e.g. every landed file).
    Empty result = no drift.  Missing columns are filled by a cross product of the (small) metadata sets.
    """
    datasets = signatures.select("dataset").distinct()
    total = datasets.agg(F.count(F.lit(1)).alias("__total"))  # one row
    per_column = signatures.groupBy("column_name").agg(F.countDistinct("data_type").alias("__types"), F.countDistinct("dataset").alias("__in"))
    drifting = per_column.crossJoin(F.broadcast(total)).filter("__types > 1 OR __in < __total").select("column_name")
    grid = drifting.crossJoin(datasets)  # the result's own rows: drifting columns only
    j = grid.join(signatures.select("dataset", "column_name", "data_type"), ["dataset", "column_name"], "left")
    return j.withColumn("data_type", F.coalesce("data_type", F.lit("MISSING"))).select("dataset", "column_name", "data_type")


def drift_verdicts(footers: DataFrame, declared: StructType) -> DataFrame:
    """One row per column that files or the declared schema have, with a verdict over all files of a folder.

    ``footers`` is :func:`files.parquet_footers`.  A declared column that files lack is ``missing`` and one that files hold in
    another type ``retyped`` (both fail); a column that is not declared is ``extra`` (reported); else ``ok``.  Grouped
    counts are compared with the file count, no grid of files and columns is made; a folder without files has no rows.
    """
    spark = footers.sparkSession
    wanted = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in declared.fields],
                                   "column_name string, declared_type string")
    files = footers.agg(F.countDistinct("raw_uri").alias("files"))  # one row
    held = footers.join(F.broadcast(wanted), "column_name", "left").groupBy("column_name").agg(
        F.count(F.lit(1)).alias("files_with"),
        F.count_if(F.col("data_type") != F.col("declared_type")).alias("files_retyped"),
        F.array_join(F.array_sort(F.collect_set("data_type")), ",").alias("types"))
    j = held.join(wanted, "column_name", "full_outer").crossJoin(F.broadcast(files)).filter("files > 0")
    with_it, retyped = F.coalesce("files_with", F.lit(0)), F.coalesce("files_retyped", F.lit(0))
    verdict = (F.when(F.col("declared_type").isNull(), "extra").when(with_it < F.col("files"), "missing")
               .when(retyped > 0, "retyped").otherwise("ok"))
    return j.select("column_name", "declared_type", "types", with_it.cast("long").alias("files_with"),
                    (F.col("files") - with_it).cast("long").alias("files_without"), retyped.cast("long").alias("files_retyped"),
                    verdict.alias("verdict"), verdict.isin("missing", "retyped").alias("fails"))


def files_off_schema(footers: DataFrame, declared: StructType) -> DataFrame:
    """``(raw_uri, columns_missing, columns_retyped)`` of the files that lack a declared column or hold it in another type."""
    spark = footers.sparkSession
    wanted = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in declared.fields],
                                   "column_name string, declared_type string")
    per_file = footers.join(F.broadcast(wanted), "column_name", "left").groupBy("raw_uri").agg(
        (F.lit(len(declared.fields)) - F.count("declared_type")).cast("long").alias("columns_missing"),
        F.count_if(F.col("data_type") != F.col("declared_type")).cast("long").alias("columns_retyped"))
    return per_file.filter("columns_missing > 0 OR columns_retyped > 0")


def file_profile(rows: DataFrame, file_col: str, findings: dict[str, Column], digest: Column) -> DataFrame:
    """All kinds of per-file counts in one pass: ``(file, kind, value, rows)``.

    ``findings`` maps a kind to a string column whose non-null values are counted per file (a month, an unlisted code, the
    name of a broken range or of a null column, ...).  Every row becomes its (file, kind, value) counts and one grouped sum
    adds them up, so there is a single shuffle of the rows' findings; exact repeats are counted on the rows' digests
    in the same sum.  Kinds ``rows`` and ``duplicate_rows`` (copies beyond the first) are always there.
    """
    own = [F.struct(F.lit(k).alias("kind"), v.cast("string").alias("value")) for k, v in findings.items()]
    row = F.struct(F.lit("__row").alias("kind"), digest.alias("value"))
    exploded = rows.select(F.col(file_col).alias("__file"), F.explode(F.array(row, *own)).alias("f")).filter("f.value IS NOT NULL")
    counts = exploded.groupBy("__file", "f.kind", "f.value").agg(F.count(F.lit(1)).alias("n"))
    is_row = F.col("kind") == "__row"
    totals = F.array(F.struct(F.lit("rows").alias("kind"), F.lit("").alias("value"), F.col("n").alias("n")),
                     F.struct(F.lit("duplicate_rows").alias("kind"), F.lit("").alias("value"), (F.col("n") - 1).alias("n")))
    shown = counts.select("__file", F.explode(F.when(is_row, totals).otherwise(
        F.array(F.struct("kind", "value", "n")))).alias("f"))
    return shown.groupBy(F.col("__file").alias(file_col), "f.kind", "f.value").agg(F.sum("f.n").cast("long").alias("rows"))


def per_group_profile(df: DataFrame, group_col: str, date_col: str | None = None,
                      period_col: str | None = None) -> DataFrame:
    """Per file / period: rows, min and max of the date column, rows outside the group's period."""
    aggs = [F.count(F.lit(1)).cast("long").alias("rows")]
    if date_col:
        aggs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
        if period_col:
            aggs.append(F.count_if(F.date_format(date_col, "yyyy-MM") != F.col(period_col)).cast("long")
                        .alias("rows_outside_period"))
    g = [group_col] + ([period_col] if period_col and period_col != group_col else [])
    return df.groupBy(*g).agg(*aggs)


def join_coverage(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """One report row: matched / missing key / unmatched key / fan-out (dimension keys that repeat) and totals.

    The buckets partition the fact rows (matched + missing + unmatched = total).
    """
    dk = dim.groupBy(F.col(dim_key).alias("__k")).agg(F.count(F.lit(1)).alias("__dup"))
    j = fact.select(F.col(fk).alias("__fk")).join(dk, F.col("__fk") == F.col("__k"), "left")
    return j.agg(
        F.count(F.lit(1)).cast("long").alias("total_rows"),
        F.count_if(F.col("__k").isNotNull()).cast("long").alias("matched"),
        F.count_if(F.col("__fk").isNull()).cast("long").alias("missing_key"),
        F.count_if(F.col("__fk").isNotNull() & F.col("__k").isNull()).cast("long").alias("unmatched_key"),
        F.count_if(F.col("__dup") > 1).cast("long").alias("fan_out_rows"))


def time_coverage(fact: DataFrame, ts: str, series: DataFrame, series_ts: str) -> DataFrame:
    """Where unmatched fact times fall relative to the series: before its first hour, after its last, inside a
    hole, or matched.  One broadcast of the series bounds (one row) and one left join on the hour."""
    from lakekit.functions.timeops import truncate_hour
    bounds = series.agg(F.min(series_ts).alias("__lo"), F.max(series_ts).alias("__hi"))
    hours = series.select(F.col(series_ts).alias("__h")).distinct()
    f = fact.select(truncate_hour(F.col(ts)).alias("__t")).crossJoin(F.broadcast(bounds))  # one-row bounds
    j = f.join(hours, F.col("__t") == F.col("__h"), "left")
    bucket = (F.when(F.col("__t").isNull(), "invalid_time")
              .when(F.col("__h").isNotNull(), "matched")
              .when(F.col("__lo").isNull() | (F.col("__t") < F.col("__lo")), "before_coverage")
              .when(F.col("__t") > F.col("__hi"), "after_coverage")
              .otherwise("hole_in_coverage"))
    return j.groupBy(bucket.alias("coverage_bucket")).agg(F.count(F.lit(1)).cast("long").alias("rows"))
