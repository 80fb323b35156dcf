"""Landing-folder scans with per-file metadata, document/CSV readers, byte hashes and schema fingerprints.

All scans are plain ``spark.read`` with an explicit schema where one is known; per-file facts come from the hidden
``_metadata`` column, so a folder is one scan grouped by file — never one job per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

def with_file_metadata(df: DataFrame) -> DataFrame:
    """Tag each row with its file's name, path, size and modification time."""
    return df.select("*", F.col("_metadata.file_name").alias("source_object"),
                     F.col("_metadata.file_path").alias("raw_uri"),
                     F.col("_metadata.file_size").alias("file_size"),
                     F.col("_metadata.file_modification_time").alias("file_modified_time"))


def scan_parquet_folder(spark: SparkSession, folder: str, schema: StructType | None = None,
                        glob: str | None = None) -> DataFrame:
    """Every Parquet file of a landing folder (no file name hard-coded), rows tagged with file metadata.

    With ``schema``, a missing column reads as null and an extra one is ignored (drift is checked separately).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return with_file_metadata(reader.parquet(folder))


def read_json_documents(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Multi-line JSON documents (one object per file), nested structs and arrays kept."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return with_file_metadata(reader.json(path))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with header; an explicit schema avoids the inference pass."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return with_file_metadata(reader.csv(path))


def per_file_totals(df: DataFrame, measure: str | None = None, scale: int = 2, file_col: str = "raw_uri") -> DataFrame:
    """Independent per-file re-read totals: ``(file, rows[, measure_total])`` with the measure summed as an exact
    decimal.  Grouped by the full path: bare file names can repeat across partition folders."""
    aggs = [F.count(F.lit(1)).cast("long").alias("rows")]
    if measure:
        aggs.append(F.sum(F.col(measure).cast(f"decimal(18,{scale})")).cast(f"decimal(38,{scale})")
                    .alias(f"{measure}_total"))
    return df.groupBy(file_col).agg(*aggs)


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """``(raw_uri, source_object, file_size, file_modified_time)`` of a folder's files, from the listing: no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return listed.select(F.col("_metadata.file_path").alias("raw_uri"), F.col("_metadata.file_name").alias("source_object"),
                         F.col("_metadata.file_size").alias("file_size"),
                         F.col("_metadata.file_modification_time").alias("file_modified_time"))


def read_parquet_files(spark: SparkSession, paths: list[str], schema: StructType | str) -> DataFrame:
    """Rows of named Parquet files under a declared schema, tagged with file metadata; no other file is listed or opened."""
    return with_file_metadata(spark.read.schema(schema).parquet(*paths))


FOOTER_SCHEMA = "raw_uri string, n_rows long, ordinal int, column_name string, data_type string"


def parquet_footers(files: DataFrame) -> DataFrame:
    """One row per file and column, ``(raw_uri, n_rows, ordinal, column_name, data_type)``, read from the files' footers.

    Each task opens the footers of its share of ``files`` (column ``raw_uri``); no row group is read and the driver sees
    no file.  Types have Spark's names.
    """
    spark = files.sparkSession
    spread = files.select("raw_uri").repartition(spark.sparkContext.defaultParallelism, "raw_uri")

    def read(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type
        for pdf in batches:
            out = []
            for uri in pdf["raw_uri"]:
                filesystem, inner = _local_or_uri(uri)
                with filesystem.open_input_file(inner) as f:
                    footer = pq.ParquetFile(f)
                    out += [(uri, footer.metadata.num_rows, i + 1, field.name,
                             from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString())
                            for i, field in enumerate(footer.schema_arrow)]
            yield pd.DataFrame(out, columns=["raw_uri", "n_rows", "ordinal", "column_name", "data_type"])

    return spread.mapInPandas(read, FOOTER_SCHEMA)


def file_schema_fingerprints(footers: DataFrame) -> DataFrame:
    """``(raw_uri, schema_fingerprint)``: SHA-256 of a file's ``name:type`` list in order (one short list a file)."""
    fields = F.array_sort(F.collect_list(F.struct("ordinal", F.concat_ws(":", "column_name", "data_type").alias("field"))))
    return footers.groupBy("raw_uri").agg(F.sha2(F.array_join(F.transform(fields, lambda x: x["field"]), "|"), 256)
                                          .alias("schema_fingerprint"))


def _local_or_uri(path: str) -> tuple[object, str]:
    """(pyarrow filesystem, path inside it) for a Hadoop-style URI as Spark reports it."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    uri = "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path
    return fs.FileSystem.from_uri(uri)


def file_bytes_chunked_sha256(spark: SparkSession, path: str, glob: str | None = None,
                              chunk_bytes: int = 64 << 20) -> DataFrame:
    """Content hash of each file's raw bytes for files of any size: ``(path, length, sha256, chunks)``.

    Files are listed without reading them, split into byte ranges of ``chunk_bytes``, and every range is read and
    hashed by its own task (``mapInPandas``); a file's hash is SHA-256 over its chunk hashes in order, for files of
    one chunk as for any other.  Equal bytes give equal hashes for the same chunk size, a fixed part of the definition.
    """
    from pyspark.sql.types import StructType as _ST
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length")  # content is not read when not selected
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("length") / F.lit(chunk_bytes)).cast("long"))
    chunks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("idx"))
    chunks = chunks.repartition("path", "idx")

    def hash_ranges(batches):
        import hashlib

        import pandas as pd
        for pdf in batches:
            out = []
            for p, idx in zip(pdf["path"], pdf["idx"]):
                filesystem, inner = _local_or_uri(p)
                with filesystem.open_input_file(inner) as f:
                    f.seek(int(idx) * chunk_bytes)
                    out.append(hashlib.sha256(f.read(chunk_bytes)).hexdigest())
            yield pd.DataFrame({"path": pdf["path"], "idx": pdf["idx"], "chunk_sha256": out})

    hashed = chunks.mapInPandas(hash_ranges, _ST.fromDDL("path string, idx long, chunk_sha256 string"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "chunk_sha256"))), lambda x: x["chunk_sha256"])
    per_file = hashed.groupBy("path").agg(ordered.alias("__h"))
    return per_file.join(files, "path").select(
        "path", "length",
        F.sha2(F.array_join("__h", ""), 256).alias("sha256"),
        F.size("__h").cast("long").alias("chunks"))
