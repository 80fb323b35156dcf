"""Data-quality checks, single-pass check runner, blocking gates and the latest-run gate state.

A check is ``(name, type, severity, fail count, total count, tolerance, details)``.  All row-level checks over one
table are evaluated in **one** aggregation (a conditional count per check) and unpivoted into result rows, instead
of one scan per check.  Relational checks (foreign keys, key-set equality, reconciliation against another table)
are one join or one pair of one-row aggregates each, and produce result rows of the same shape.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.classify import dq_status

RESULT_COLUMNS = ["layer", "dataset", "check_name", "check_type", "severity", "status", "fail_count", "total_count",
                  "fail_pct", "threshold_pct", "details"]


@dataclass
class Check:
    """One check. Exactly one of ``fail`` (row predicate) or ``fail_agg`` (aggregate expression) is given."""
    name: str
    check_type: str
    severity: str
    fail: Column | None = None
    fail_agg: Column | None = None
    total_agg: Column | None = None
    threshold_pct: float | None = 0.0
    details: Column | str | None = None

    def fail_expr(self) -> Column:
        if self.fail_agg is not None:
            return self.fail_agg
        return F.count_if(F.coalesce(self.fail, F.lit(False)))

    def total_expr(self) -> Column:
        return self.total_agg if self.total_agg is not None else F.count(F.lit(1))

    def details_expr(self) -> Column:
        if self.details is None:
            return F.lit(None).cast("string")
        if isinstance(self.details, str):
            return F.lit(self.details)
        return self.details.cast("string")


def info(name: str, check_type: str, measure: Column, total: Column | None = None, details=None) -> Check:
    """A measurement (INFO) check: the count is reported, never blocks."""
    return Check(name, check_type, "INFO", fail_agg=measure, total_agg=total, threshold_pct=None, details=details)


def not_null(col: str, severity: str = "FAIL", check_type: str = "NOT_NULL", name: str | None = None) -> Check:
    return Check(name or f"{col}_not_null", check_type, severity, fail=F.col(col).isNull())


def unique(cols, name: str, severity: str = "FAIL", check_type: str = "UNIQUE") -> Check:
    """``COUNT(*) − COUNT(DISTINCT key)``: counts duplicate rows (null keys count as rows, not as distinct keys)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return Check(name, check_type, severity,
                 fail_agg=F.count(F.lit(1)) - F.countDistinct(*[F.col(c) for c in cols]))


def domain(col: str, allowed, name: str | None = None, severity: str = "FAIL", check_type: str = "DOMAIN",
           null_fails: bool = True, threshold_pct: float | None = 0.0) -> Check:
    """Value outside ``allowed``; with ``null_fails`` a null is a failure too (a plain ``NOT IN`` ignores it)."""
    c = F.col(col)
    pred = ~c.isin(list(allowed))
    if null_fails:
        pred = c.isNull() | pred
    return Check(name or f"{col}_domain", check_type, severity, fail=pred, threshold_pct=threshold_pct)


def _finalise(rows: DataFrame, layer: str, dataset: str, fail_on_empty_warn: bool = False) -> DataFrame:
    pct = F.when(F.col("total_count") == 0, F.lit(0.0)).otherwise(
        F.col("fail_count").cast("double") * F.lit(100.0) / F.col("total_count").cast("double"))
    return (rows.withColumn("fail_pct", pct)
            .withColumn("status", dq_status("severity", "fail_count", "fail_pct", "threshold_pct",
                                            fail_on_empty_warn, "total_count"))
            .select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "check_name", "check_type",
                    "severity", "status", "fail_count", "total_count", "fail_pct", "threshold_pct", "details"))


def run_checks(df: DataFrame, checks: list[Check], layer: str, dataset: str,
               fail_on_empty_warn: bool = False) -> DataFrame:
    """Evaluate all ``checks`` over ``df`` in one aggregation and return one result row per check."""
    exprs = []
    for i, c in enumerate(checks):
        exprs += [c.fail_expr().cast("long").alias(f"__f{i}"), c.total_expr().cast("long").alias(f"__t{i}"),
                  c.details_expr().alias(f"__d{i}")]
    one = df.agg(*exprs)
    structs = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.check_type).alias("check_type"),
                        F.lit(c.severity).alias("severity"),
                        F.lit(c.threshold_pct).cast("double").alias("threshold_pct"),
                        F.col(f"__f{i}").alias("fail_count"), F.col(f"__t{i}").alias("total_count"),
                        F.col(f"__d{i}").alias("details"))
               for i, c in enumerate(checks)]
    return _finalise(one.select(F.inline(F.array(*structs))), layer, dataset, fail_on_empty_warn)


def scalar_check(one_row: DataFrame, name: str, check_type: str, severity: str, fail: Column, total: Column,
                 layer: str, dataset: str, threshold_pct: float | None = 0.0, details: Column | str | None = None) -> DataFrame:
    """A check over a one-row frame of scalars (e.g. two tables' totals cross-joined)."""
    d = F.lit(details) if isinstance(details, str) else (details if details is not None else F.lit(None))
    rows = one_row.select(F.lit(name).alias("check_name"), F.lit(check_type).alias("check_type"),
                          F.lit(severity).alias("severity"), F.lit(threshold_pct).cast("double").alias("threshold_pct"),
                          fail.cast("long").alias("fail_count"), total.cast("long").alias("total_count"),
                          d.cast("string").alias("details"))
    return _finalise(rows, layer, dataset)


def foreign_key_check(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str, name: str, layer: str, dataset: str,
                      severity: str = "FAIL", check_type: str = "REFERENTIAL", only_non_null: bool = True) -> DataFrame:
    """Left join on the distinct key set, count rows whose key does not resolve (null keys skipped by default)."""
    keys = dim.select(F.col(dim_key).alias("__k")).distinct()
    j = fact.select(F.col(fk).alias("__fk")).join(keys, F.col("__fk") == F.col("__k"), "left")
    miss = F.col("__k").isNull()
    if only_non_null:
        miss = miss & F.col("__fk").isNotNull()
    one = j.agg(F.count_if(miss).alias("__f"), F.count(F.lit(1)).alias("__t"))
    return scalar_check(one, name, check_type, severity, F.col("__f"), F.col("__t"), layer, dataset)


def key_set_equality_check(left: DataFrame, right: DataFrame, key: str, name: str, layer: str, dataset: str,
                           severity: str = "FAIL", check_type: str = "RECONCILIATION") -> DataFrame:
    """Keys present on exactly one side (``EXCEPT`` both ways) via one full outer join on distinct keys."""
    lk = left.select(F.col(key).alias("__l")).distinct()
    rk = right.select(F.col(key).alias("__r")).distinct()
    j = lk.join(rk, F.col("__l") == F.col("__r"), "full_outer")
    one = j.agg(F.count_if(F.col("__r").isNull()).alias("__lo"), F.count_if(F.col("__l").isNull()).alias("__ro"),
                F.count(F.lit(1)).alias("__t"))
    return scalar_check(one, name, check_type, severity, F.col("__lo") + F.col("__ro"), F.col("__t"), layer, dataset,
                        details=F.concat(F.lit("only_left="), F.col("__lo").cast("string"), F.lit(" only_right="),
                                         F.col("__ro").cast("string")))


def union_results(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class GateBlocked(RuntimeError):
    pass


def gate(results: DataFrame, what: str = "gate") -> DataFrame:
    """Raise when any check FAILed; return the (small, one row per check) results otherwise."""
    failed = results.filter(F.col("status") == "FAIL").select("check_name").collect()
    if failed:
        names = ", ".join(sorted(r["check_name"] for r in failed))
        raise GateBlocked(f"{what} BLOCKED: {len(failed)} failed checks: {names}")
    return results


def with_run(results: DataFrame, run_id: str, executed_at: str | None = None, code_revision: str | None = None) -> DataFrame:
    """Stamp result rows for the append-only results log."""
    ts = F.to_timestamp(F.lit(executed_at)) if executed_at else F.current_timestamp()
    return results.select(F.lit(run_id).alias("run_id"), ts.alias("executed_at"), "*",
                          F.lit(code_revision).cast("string").alias("code_revision"))


def gate_status(log: DataFrame) -> DataFrame:
    """Latest run per (layer, dataset) with deterministic tie-break (``executed_at`` desc, ``run_id`` desc) and
    its status counts.  A gate that never ran has no row (callers treat missing as not passed)."""
    # latest run as an aggregate (max of (executed_at, run_id); nulls order first, so they lose), partially
    # aggregated per gate before the shuffle instead of a window over the whole history of a gate
    latest = (log.groupBy("layer", "dataset").agg(F.max(F.struct("executed_at", "run_id")).alias("__latest"))
              .select("layer", "dataset", "__latest.executed_at", "__latest.run_id"))
    j = latest.join(log.drop("executed_at"), ["layer", "dataset", "run_id"])
    return j.groupBy("layer", "dataset", "executed_at", "run_id").agg(
        F.when(F.count_if(F.col("status") == "FAIL") > 0, "FAIL").otherwise("PASS").alias("status"),
        F.count(F.lit(1)).cast("long").alias("checks_run"),
        F.count_if(F.col("status") == "FAIL").cast("long").alias("fail_count"),
        F.count_if(F.col("status") == "WARN").cast("long").alias("warn_count"),
        F.count_if(F.col("status") == "PASS").cast("long").alias("pass_count"),
        F.count_if(F.col("status") == "INFO").cast("long").alias("info_count"),
        F.max("code_revision").alias("code_revision"))


def latest_results(log: DataFrame, status: DataFrame) -> DataFrame:
    """Result rows of each gate's latest run, as ``status`` (:func:`gate_status`) names it."""
    return log.join(status.select("layer", "dataset", "run_id"), ["layer", "dataset", "run_id"], "left_semi")


def open_issues(log: DataFrame, status: DataFrame) -> DataFrame:
    """Failed and warned checks of each gate's latest run."""
    return latest_results(log, status).filter(F.col("status").isin("FAIL", "WARN")).select(
        "layer", "dataset", "check_name", "check_type", "status", "fail_count", "total_count", "details")


def dashboard_charts(log: DataFrame, status: DataFrame) -> DataFrame:
    """The data-quality dashboard's figures, ``(chart, label, value)``: per chart one row a bar, point or figure.

    Gates whose latest run is older count with that run; ``pass_trend`` has every run of the log.  ``pass_rate_bp`` is passed
    checks of all that can pass or not (without INFO), in hundredths of a percent, null without any.
    """
    n = F.count(F.lit(1)).cast("long")

    def chart(name: str, df: DataFrame, label, value) -> DataFrame:
        rows = df.groupBy(F.col(label).alias("label")) if label else df.groupBy(F.lit("all").alias("label"))
        return rows.agg(value.cast("long").alias("value")).select(F.lit(name).alias("chart"), "label", "value")

    failed = latest_results(log, status).filter("status = 'FAIL'")
    rated = F.sum("checks_run") - F.sum("info_count")
    rate = F.floor(10000 * F.sum("pass_count") / F.when(rated > 0, rated))
    return union_results(
        chart("datasets_validated", status, None, n),
        chart("pass_trend", log.filter("status = 'PASS'"), "run_id", n),
        chart("checks_by_layer", status, "layer", F.sum("checks_run")),
        chart("checks_by_dataset", status, "dataset", F.sum("checks_run")),
        chart("failures_by_dataset", failed, "dataset", n),
        chart("failures_by_type", failed, "check_type", n),
        chart("checks_failed", status, None, F.sum("fail_count")),
        chart("checks_warned", status, None, F.sum("warn_count")),
        chart("checks_passed", status, None, F.sum("pass_count")),
        chart("pass_rate_bp", status, None, rate),
        chart("latest_run_by_layer", status, "layer", F.unix_seconds(F.max("executed_at"))))


def assert_upstream_passed(status: DataFrame, required: list[tuple[str, str]]) -> None:
    """Gate dependency: each ``(layer, dataset)`` must have a latest run with status PASS (never-run ≠ pass)."""
    rows = {(r["layer"], r["dataset"]): r["status"] for r in status.select("layer", "dataset", "status").collect()}
    bad = [f"{l}.{d}={rows.get((l, d), 'NEVER_RUN')}" for l, d in required if rows.get((l, d)) != "PASS"]
    if bad:
        raise GateBlocked("upstream gates not passed: " + ", ".join(bad))


def sorted_set_string(col, sep: str = ",") -> Column:
    """``array_join(sort_array(collect_set(col)))`` — for low-cardinality measurement details only."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.sort_array(F.collect_set(c.cast("string"))), sep)
