"""Token counts from a digest cache.

The key of a stored count is the SHA-256 of the normalised content and the version digest of the tokenizer (its file
and the library that reads it).  Texts are joined with the cache by key; only distinct texts without an entry are
encoded, and their counts are appended to the cache for the next run.

Normalisation must not change a count; byte-level BPE counts every byte, so it only turns null into the empty text
(no bytes, no tokens).  Repeated rows and equal texts share one entry; an empty table gives an empty result and leaves
the cache as it is; further columns, whatever their names, are ignored; null ids are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, id_and_text
from lakekit.llm.tokens import counter

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"


def tokenizer_version(path: str) -> str:
    import tokenizers
    with open(path, "rb") as f:
        return hashlib.sha256(tokenizers.__version__.encode() + b"\0" + f.read()).hexdigest()


def read_cache(spark, path: str) -> DataFrame:
    """The stored counts; empty if nothing was stored there yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def encode_misses(texts: DataFrame, cache: DataFrame, tokenizer_path: str, version: str) -> DataFrame:
    """One counted row per distinct digest of ``texts`` (digest, text) that ``cache`` lacks.

    Copies are merged before the shuffle, so a group of copies, however large, sends one text per task.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path).counts
        for batch in batches:
            for part in byte_slices(batch, "text"):
                yield pa.record_batch([part.column("digest"), pa.array(count(part.column("text").to_pylist()), pa.int64())],
                                      ["digest", "n_tokens"])

    known = cache.filter(F.col("tokenizer") == version).select("digest").distinct()
    todo = texts.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    sizes = todo.select("digest", "text").mapInArrow(encode, "digest string, n_tokens long")
    return sizes.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens per row of ``docs``; appends what it encodes to the cache at ``cache_path``."""
    spark, version = docs.sparkSession, tokenizer_version(tokenizer_path)
    keyed = id_and_text(docs, id_col, text_col).select("id", "text", F.octet_length("text").cast("long").alias("n_bytes"),
                                                       F.sha2("text", 256).alias("digest"))
    misses = encode_misses(keyed.select("digest", "text"), read_cache(spark, cache_path), tokenizer_path, version)
    misses.write.mode("append").parquet(cache_path)
    stored = (read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))  # two runs may have stored the same digest
    return (keyed.select("id", "n_bytes", "digest").join(stored, "digest")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens"))
