"""The incremental trip-file load over the driver tables.

``lineitem`` is landed as one Parquet file per ship month (a monthly delivery whose folder name carries
``YYYY-MM``), then loaded with the library's content-hash protocol: fingerprint → discover → register → land
(partition per content hash) → reconcile → close.  All state lives under a run folder in the shared checkpoint
folder: the landing files, the control log and the Bronze target.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from lakekit.functions.digest import version_id
from lakekit.operators import ingest
from lakekit.plans.tables import Tables, raw_trips
from lakekit.session import cut_lineage, scratch_path
from lakekit.sources import control
from lakekit.operators import profile
from lakekit.sources import files
from lakekit.sources.store import SnapshotStore

SOURCE_SYSTEM = "tpch_lineitem"
PERIOD_PATTERN = r"period=(\d{4}-\d{2})"
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
# the columns a delivery must hold, as the source declares them
LINE_SCHEMA = StructType([StructField(n, t) for n, t in zip(
    LINE_COLS, [LongType(), LongType(), LongType(), IntegerType(), *[DoubleType()] * 4, StringType(), StringType(), TimestampNTZType()])])
REPORT_SCHEMA = "batch_id string, source_rows long, landed_rows long, mismatch boolean"


# trip rows as a monthly delivery declares them (the Bronze columns but for what landing adds)
TRIP_SCHEMA = StructType([StructField(n, t) for n, t in {
    "l_orderkey": LongType(), "l_linenumber": IntegerType(), "vendor_id_raw": IntegerType(),
    "pickup_datetime_raw": TimestampNTZType(), "dropoff_datetime_raw": TimestampNTZType(),
    "pickup_location_raw": IntegerType(), "dropoff_location_raw": IntegerType(), "passenger_count_raw": LongType(),
    "trip_distance_raw": DoubleType(), "fare_amount_raw": DoubleType(), "total_amount_raw": DoubleType()}.items()])


def _folder() -> Column:
    """The folder of a file; a cut of bytes, as rows pay for it."""
    name = F.octet_length(F.substring_index("raw_uri", "/", -1))
    return F.substring(F.col("raw_uri").cast("binary"), F.lit(1), F.octet_length("raw_uri") - name - 1).cast("string")


class LandingRun:
    """One landing folder + control log + target, under a fresh run folder."""

    object_name = "lineitem"
    source_system = SOURCE_SYSTEM
    target = "bronze_lineitem"
    schema = LINE_SCHEMA

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = root or scratch_path(spark, f"landing-{uuid.uuid4().hex}")
        self.landing = f"{self.root}/landing/{self.object_name}"
        self.store = SnapshotStore(spark, f"{self.root}/tables")

    def deliver(self) -> None:
        """Write the monthly delivery files (derived from the whole ``lineitem`` table)."""
        li = Tables(self.spark, self.sf_dir).lineitem.select(*LINE_COLS)
        (li.withColumn("period", F.date_format("l_shipdate", "yyyy-MM"))
         .repartition("period").write.partitionBy("period").parquet(self.landing))

    def redeliver(self, period: str, keep) -> None:
        """Deliver a revised version of one month's file (same object, new content): rows matching ``keep``."""
        li = Tables(self.spark, self.sf_dir).lineitem.select(*LINE_COLS)
        rows = li.withColumn("period", F.date_format("l_shipdate", "yyyy-MM")).filter(
            (F.col("period") == period) & keep)
        (rows.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("period").parquet(self.landing))

    def unseen(self) -> DataFrame:
        """Listed files that the ledger does not know or whose content is not held; the listing opens no file."""
        held = self.batch_state().filter((F.col("status") == "SUCCESS") & (F.col("source_system") == self.source_system)) \
            .select("content_sha256").join(self.target_contents(), "content_sha256", "left_semi")
        ledger = self.store.read_log("file_ledger", ingest.LEDGER_SCHEMA)
        return ingest.unseen_files(self.listing(), ledger, held)

    def listing(self) -> DataFrame:
        """What lies in the landing folder, by its listing."""
        return files.list_files(self.spark, self.landing)

    def scan(self, paths: list[str]) -> DataFrame:
        """Rows of these files under the declared schema."""
        return files.read_parquet_files(self.spark, paths, self.schema)

    def delivered_rows(self) -> DataFrame:
        """Rows of the whole landing folder under the declared schema."""
        return files.scan_parquet_folder(self.spark, self.landing, self.schema)

    def contents(self, paths: list[str] | None = None) -> DataFrame:
        """Content hash and row count of the landed objects at these paths, or of the whole landing folder, read for it."""
        rows = self.delivered_rows() if paths is None else self.scan(paths)
        return ingest.file_fingerprints(rows, self.schema.names, "raw_uri")

    def footer_facts(self, listed: DataFrame) -> DataFrame:
        """``(raw_uri, schema_fingerprint, columns_missing, columns_retyped)`` of listed files; the last two are null for a
        file that fits the declared schema."""
        footers = cut_lineage(files.parquet_footers(listed), "footers")
        off = profile.files_off_schema(footers, self.schema)
        return files.file_schema_fingerprints(footers).join(off, "raw_uri", "left")

    def batch_state(self) -> DataFrame:
        ev = self.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA)
        return control.latest_state(ev)

    def target_contents(self) -> DataFrame:
        held = self.store.partition_values(self.target, "content_sha256")
        return self.spark.createDataFrame([(c,) for c in held], "content_sha256 string")

    def drop_unheld(self) -> None:
        """Drop target contents that no live batch holds: replaced ones, and what a run that died left behind.

        The driver sees the names of the folders to delete, as the file system does."""
        live = self.batch_state().filter("status = 'SUCCESS'").select("content_sha256")
        unheld = self.target_contents().join(live, "content_sha256", "left_anti")
        self.store.drop_partitions(self.target, "content_sha256", [r["content_sha256"] for r in unheld.collect()])

    def described(self, listed: DataFrame) -> DataFrame:
        """Listed files with their period, object name and source, as a batch names them."""
        return (listed.withColumn("source_period", F.regexp_extract("raw_uri", PERIOD_PATTERN, 1))
                .withColumn("source_object", F.concat(F.lit(f"{self.object_name}_"), F.col("source_period"), F.lit(".parquet")))
                .withColumn("source_system", F.lit(self.source_system)))

    def fingerprinted(self, listed: DataFrame) -> DataFrame:
        """Content hash, row count, version and a fresh batch id of the files that a run opened."""
        return (self.described(listed).join(self.contents(self.opened).drop("source_period"), "raw_uri")
                .withColumn("source_version_id", version_id(f"{self.object_name}_", "content_sha256"))
                .withColumn("batch_id", control.batch_id_for("source_system", "content_sha256")))

    def load(self) -> DataFrame:
        """One incremental run; returns the reconciliation report (one row per new batch).

        The landing folder is listed and compared with the ledger; only unseen files are opened, once to hash and once to
        land them.  Files whose footer lacks a declared column or holds it in another type are closed as FAILED and not
        read; extra columns are left out.  New content lands first; then its batches close and the batches they replace
        are superseded in one append; only then are replaced rows dropped.  A run that dies leaves the old rows in place,
        and the next one repeats what was not closed.  A failed run closes its batches as FAILED.  Files that repeat
        another's content are not registered as batches but listed in the ``duplicate_deliveries`` log.  One load at a
        time per target.
        """
        unseen = cut_lineage(self.unseen(), "unseen_files")
        listed = cut_lineage(unseen.join(self.footer_facts(unseen), "raw_uri"), "listed")
        rejected = cut_lineage(self.described(listed.filter("columns_missing IS NOT NULL")).withColumn(
            "batch_id", F.concat(F.lit("batch_rejected_"), F.expr("uuid()"))), "rejected")
        for status in ("DISCOVERED", "FAILED"):
            self.store.append("ingestion_batches", control.batch_events(rejected, status, target_table=self.target))
        listed = listed.filter("columns_missing IS NULL").drop("columns_missing", "columns_retyped")
        self.opened = [r["raw_uri"] for r in listed.select("raw_uri").collect()]  # names only; Spark's file index holds them too
        if not self.opened:
            return self.spark.createDataFrame([], REPORT_SCHEMA)
        rows = self.scan(self.opened)
        # the new-file list is materialised once per run: it must not be re-derived after the run's own events
        contents = cut_lineage(self.fingerprinted(listed), "contents")
        fresh = ingest.discover_new(contents, self.batch_state(), self.target_contents(), self.source_system)
        found = cut_lineage(ingest.one_file_per_content(fresh, "raw_uri"), "new_files")
        new = found.filter("not duplicate_content")
        self.store.append("duplicate_deliveries", found.filter("duplicate_content").select(
            "source_object", "raw_uri", "content_sha256", "row_count", "duplicate_of"))
        replaced = cut_lineage(control.supersede(self.batch_state(), new), "superseded")
        for status in ("DISCOVERED", "STARTED"):
            self.store.append("ingestion_batches", control.batch_events(new, status, target_table=self.target))
        try:
            landed = ingest.land(rows, new, "raw_uri")
            self.store.overwrite_partitions(self.target, landed, ["content_sha256"])
            own = self.store.read_partitioned(self.target, landed.schema).join(
                new.select("content_sha256", "batch_id"), ["content_sha256", "batch_id"], "left_semi")
            report = cut_lineage(ingest.reconcile(new, ingest.landed_counts(own)), "reconcile_report")
            ingest.reconcile_guard(report)
        except Exception:
            self.store.append("ingestion_batches", control.batch_events(new, "FAILED", target_table=self.target))
            raise
        counts = report.select("batch_id", F.col("landed_rows").alias("row_count"))
        closed = control.close_with_counts(new.withColumn("target_table", F.lit(self.target)), counts)
        self.store.append("ingestion_batches", closed.unionByName(replaced))
        self.store.append("file_ledger", contents.select("raw_uri", "file_size", "file_modified_time", "content_sha256"))
        self.drop_unheld()
        return report


class TripLandingRun(LandingRun):
    """The landing protocol over monthly trip deliveries, whose Bronze table the star can be built from.

    A month is one object in a folder of its own, in as many part files as its size needs.  The folder is what is listed,
    hashed, registered and landed; its size is its parts' sum and its time that of the last one, so a changed part makes
    the whole month new."""

    object_name = "trips"
    source_system = "trip_files"
    target = "bronze_trips"
    schema = TRIP_SCHEMA

    def deliver(self) -> None:
        """Write the trips (``tables.raw_trips``) as one delivery per month of the drop-off, so a trip over a month's end comes
        late for its pickup; trips without times come with March.  A month beyond Spark's advisory partition size is written
        by several tasks."""
        month = F.coalesce(F.date_format("dropoff_datetime_raw", "yyyy-MM"), F.lit("2024-03"))
        (raw_trips(Tables(self.spark, self.sf_dir)).select(*self.schema.names, month.alias("period"))
         .hint("rebalance", "period").write.partitionBy("period").parquet(self.landing))

    def redeliver(self, period: str, keep) -> None:
        """Deliver a revised version of one month, read from its folder: its rows matching ``keep``."""
        rows = cut_lineage(self.spark.read.schema(self.schema).parquet(f"{self.landing}/period={period}").filter(keep), "revised")
        rows.write.mode("overwrite").parquet(f"{self.landing}/period={period}")

    def listing(self) -> DataFrame:
        return super().listing().groupBy(_folder().alias("raw_uri")).agg(
            F.sum("file_size").alias("file_size"), F.max("file_modified_time").alias("file_modified_time"))

    def scan(self, paths: list[str]) -> DataFrame:
        return super().scan(paths).withColumn("raw_uri", _folder())

    def delivered_rows(self) -> DataFrame:
        return super().delivered_rows().withColumn("raw_uri", _folder())

    def contents(self, paths: list[str] | None = None) -> DataFrame:
        parts = super().delivered_rows() if paths is None else super().scan(paths)
        return ingest.file_fingerprints(parts, self.schema.names, "raw_uri", landed_object=_folder())

    def footer_facts(self, listed: DataFrame) -> DataFrame:
        """Of listed folders: a column that one part lacks or holds in another type is off for the folder, and parts of
        several schemas have a fingerprint of their own."""
        parts = super().listing().withColumn("folder", _folder()).join(
            listed.select(F.col("raw_uri").alias("folder")), "folder", "left_semi")
        schemas = F.array_sort(F.collect_set("schema_fingerprint"))
        return super().footer_facts(parts).groupBy(_folder().alias("raw_uri")).agg(
            F.when(F.size(schemas) == 1, schemas[0]).otherwise(F.sha2(F.array_join(schemas, "|"), 256)).alias("schema_fingerprint"),
            F.max("columns_missing").alias("columns_missing"), F.max("columns_retyped").alias("columns_retyped"))

    def _landed(self) -> tuple[DataFrame, list]:
        """Bronze trip rows of live batches, and the columns that say which object, batch and content they came from."""
        rows = self.store.read_partitioned(self.target, StructType(
            [*self.schema.fields, *[StructField(c, StringType()) for c in ("raw_uri", "batch_id", "content_sha256")]]))
        file = F.concat(F.lit(f"{self.object_name}_"), F.regexp_extract("raw_uri", PERIOD_PATTERN, 1), F.lit(".parquet"))
        return rows, [F.lit(self.source_system).alias("source_system"), file.alias("source_file"), "batch_id", "content_sha256"]

    def landed_trips(self) -> DataFrame:
        """Bronze trip rows of live batches, with the object, batch and content they came from."""
        rows, origin = self._landed()
        return rows.select(*self.schema.names, *origin)

    def landed_counts(self, **by: Column) -> DataFrame:
        """How many rows :meth:`landed_trips` has of each object, batch, content and value of ``by``, ``rows``: one pass, in
        which no row pays for its object's name."""
        rows, origin = self._landed()
        n = rows.select("raw_uri", "batch_id", "content_sha256", *[c.alias(k) for k, c in by.items()])
        n = n.groupBy(*n.columns).agg(F.count(F.lit(1)).alias("rows"))
        return n.select(*origin, *by, "rows")

    def batch_versions(self) -> DataFrame:
        return control.batch_versions(self.store.read_log("ingestion_batches", control.BATCH_EVENT_SCHEMA))


def first_load_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest batch state after delivering and loading every monthly file once."""
    run = LandingRun(spark, sf_dir)
    run.deliver()
    run.load()
    return run.batch_state()


def rerun_state(spark: SparkSession, sf_dir: str) -> tuple[LandingRun, DataFrame, DataFrame]:
    """Deliver, load, load again: returns (run, first report, second report); the second run finds no new work."""
    run = LandingRun(spark, sf_dir)
    run.deliver()
    first = run.load()
    second = run.load()
    return run, first, second


def streamed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the monthly files through the Structured Streaming path and return the target table."""
    from lakekit.streaming.landing_stream import stream_landing_folder
    run = LandingRun(spark, sf_dir)
    run.deliver()
    schema = spark.read.parquet(run.landing).drop("period").schema
    target = f"{run.root}/tables/bronze_lineitem_stream"
    stream_landing_folder(spark, run.landing, schema, LINE_COLS, target, f"{run.root}/stream_checkpoint",
                          PERIOD_PATTERN, max_files_per_trigger=16)
    return spark.read.parquet(target)


def revised_delivery_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all months, then re-deliver the latest month without its returned lines and load again.

    Expected: the old batch of that month is SUPERSEDED, the revised one is SUCCESS with the smaller count, and
    the target holds only the revised rows for that month.
    """
    run = LandingRun(spark, sf_dir)
    run.deliver()
    run.load()
    latest = (Tables(spark, sf_dir).lineitem.agg(F.max(F.date_format("l_shipdate", "yyyy-MM")).alias("p"))
              .first()["p"])  # one scalar
    run.redeliver(latest, F.col("l_returnflag") != "R")
    run.load()
    return run
