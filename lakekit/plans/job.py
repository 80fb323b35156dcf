"""The full job as a dependency-ordered sequence of steps; independent steps are submitted concurrently.

Spark runs jobs submitted from several driver threads at the same time, so layers that do not depend on each
other (the three Silver sources, the dimensions, the four analytical questions, the gates of one layer) share the
cluster instead of queueing.  A gate is a barrier: if it finds a FAIL, the job stops before anything downstream
reads the data.  Every step appends STARTED / SUCCESS / FAILED events to the run log.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators import dq
from lakekit.plans import checks
from lakekit.plans.trips import StarBuild
from lakekit.session import scratch_path
from lakekit.sources.store import SnapshotStore


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


RUN_EVENT_SCHEMA = "run_id string, step string, status string, epoch double"


def run_summary(log: DataFrame) -> DataFrame:
    """One row per run and step of the run log: ``(run_id, step, status, started_at, ended_at, seconds)``.

    The status is the last event's, an end before a start of the same moment; a step without an end is STARTED, with no
    ``ended_at``.  A grouped aggregate; an empty log has no rows.
    """
    last = F.struct("event_at", F.col("status") != "STARTED")
    ended = F.max(F.when(F.col("status") != "STARTED", F.col("event_at")))
    g = log.groupBy("run_id", "step").agg(F.max_by("status", last).alias("status"),
                                          F.min(F.when(F.col("status") == "STARTED", F.col("event_at"))).alias("started_at"),
                                          ended.alias("ended_at"))
    return g.withColumn("seconds", F.col("ended_at").cast("double") - F.col("started_at").cast("double"))


class Job:
    def __init__(self, spark: SparkSession, sf_dir: str, workers: int = 4, enforce_gates: bool = True,
                 root: str | None = None, landing: bool = True):
        self.spark = spark
        self.s = StarBuild(spark, sf_dir)
        self.workers = workers
        self.enforce = enforce_gates
        self.run_id = uuid.uuid4().hex
        self.store = SnapshotStore(spark, root or scratch_path(spark, f"job-{self.run_id}"))
        self.times: dict[str, float] = {}
        self.results: list[DataFrame] = []
        self.events: list[tuple] = []
        self.setup_times: dict[str, float] = {}
        # incremental landing of the monthly trip files with the control log (the reference's Bronze load task);
        # the files themselves are produced by a simulated source delivery before the job starts
        self.landing = None
        if landing:
            from lakekit.plans.landing import LandingRun
            self.landing = LandingRun(spark, sf_dir, root=scratch_path(spark, f"job-{self.run_id}-landing"))

    def _event(self, step: str, status: str) -> None:
        self.events.append((self.run_id, step, status, time.time()))

    def _step(self, name: str, fn):
        self._event(name, "STARTED")
        t0 = time.perf_counter()
        try:
            out = fn()
        except Exception:
            self._event(name, "FAILED")
            raise
        self.times[name] = round(time.perf_counter() - t0, 3)
        self._event(name, "SUCCESS")
        return out

    def _parallel(self, steps: dict):
        with ThreadPoolExecutor(max_workers=min(self.workers, len(steps))) as pool:
            futures = {name: pool.submit(self._step, name, fn) for name, fn in steps.items()}
            return {name: f.result() for name, f in futures.items()}

    def _gates(self, names: list[str]) -> None:
        tables = checks.gate_tables(self.s)

        def one(n):
            if n == "control":
                from lakekit.sources import control
                ev = self.landing.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
                res = checks.control_gate().run(checks.control_tables(ev))
            else:
                res = checks.GATES[n]().run(tables)
            rows = res.collect()  # one row per check
            out = self.spark.createDataFrame(rows, res.schema)
            self.results.append(out)
            if self.enforce and any(r["status"] == "FAIL" for r in rows):
                raise dq.GateBlocked(f"gate {n} blocked: "
                                     + ", ".join(r["check_name"] for r in rows if r["status"] == "FAIL"))
            return out
        self._parallel({f"gate_{n}": (lambda n=n: one(n)) for n in names})

    def run(self) -> "Job":
        """Every step in order; the run log and the gates' results are stored however the run ends."""
        self._event("job", "STARTED")
        try:
            self._all_steps()
        except Exception:
            self._event("job", "FAILED")
            raise
        else:
            self._event("job", "SUCCESS")
        finally:
            self.store.append("pipeline_runs", self.run_log())
            if self.results:
                self.store.append("data_quality_results", dq.with_run(self.gate_results(), self.run_id))
        return self

    def _all_steps(self) -> None:
        branch = None
        if self.landing is not None:
            t0 = time.perf_counter()
            self.landing.deliver()  # source side, not part of the job
            self.setup_times["simulated_source_delivery"] = round(time.perf_counter() - t0, 3)
        t_all = time.perf_counter()
        branch_pool = ThreadPoolExecutor(max_workers=1)
        try:
            if self.landing is not None:
                # the landed trip files and their control log feed nothing in the star below, so that branch
                # (load, then the control gate) runs beside the layers and is joined before the job ends
                branch = branch_pool.submit(lambda: (self._step("landing_trips", self.landing.load),
                                                     self._gates(["control"])))
            self._layers()
            if branch is not None:
                branch.result()
        finally:
            branch_pool.shutdown(wait=True)  # a blocked gate still waits for the branch's running jobs
        self.total = round(time.perf_counter() - t_all, 3)

    def _layers(self) -> None:
        s = self.s
        self._parallel({"bronze_trips": s.raw_trips, "bronze_zones": lambda: _run(s.raw_zones()),
                        "weather_documents": s.weather_documents})
        self._gates(["bronze_trips", "bronze_zones", "bronze_weather"])
        self._parallel({"silver_trips": s.decided, "silver_zones": s.zones, "silver_weather": s.weather})
        self._gates(["silver_trips", "silver_zones", "silver_weather"])
        self._parallel({"trip_zone_map": s.zone_map, "trip_weather_map": s.weather_map})
        self._gates(["integration"])
        self._parallel({"dim_date": s.dim_date, "dim_zone": s.dim_zone,
                        "dim_weather_classification": s.dim_weather_classification})
        self._step("fact_weather_hourly", s.weather_fact)
        self._step("fact_taxi_trip", s.materialise)
        self._gates(["gold"])
        self._parallel({  # each published as a table, read again by the analytics gate
            "q1_activity_by_time_and_zone": s.q1_result,
            "q2_trip_behavior_by_weather": s.q2_result,
            "q2_coverage": s.q2_coverage,
            "q3_mobility_patterns_by_zone": s.q3_result,
            "q4_fare_efficiency_by_borough": s.q4_result,
        })
        self._gates(["analytics"])

    def run_log(self) -> DataFrame:
        return self.spark.createDataFrame(self.events, RUN_EVENT_SCHEMA).withColumn(
            "event_at", F.timestamp_seconds("epoch")).drop("epoch")

    def gate_results(self) -> DataFrame:
        return dq.union_results(*self.results)
