"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each word shingle is hashed once; the high bits of the hash name its bin and the least hash of each bin stays.  Empty
bins borrow the value of an occupied bin by optimal densification: bin i tries the bins of its own pseudo-random order,
which is the same for all documents, and takes the first occupied one.  Of each bin's value the low-order 8 bits are
stored, packed into hexadecimal; the likeness of two fingerprints is the share of equal bins, corrected for the 1 in 256
that agree by chance.

Defined results: null is the empty text; texts of fewer words than a shingle are one shingle of all their words, texts
without words one shingle of none, so equal texts have equal fingerprints and likeness 1; repeated rows get a row each;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import input_partitions

BINS = 128
BITS = 8
SHINGLE_WORDS = 5
FIRST_TRIES = 24
BLANKS = " \t\n\x0b\x0c\r"


def _occupied(lo: Column, hi: Column, b: Column) -> Column:
    """Whether bin ``b`` is set in the two 64-bit maps."""
    return F.when(b < 64, F.getbit(lo, b)).otherwise(F.getbit(hi, b - 64)) == 1


def _below(lo: Column, hi: Column, b: Column) -> Column:
    """Occupied bins before bin ``b``."""
    under = lambda n: F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), n))  # noqa: E731  the n lowest bits
    first = F.bit_count(lo.bitwiseAND(under(F.least(b, F.lit(63)))))
    low = F.when(b < 64, first).otherwise(F.bit_count(lo))
    return low + F.when(b <= 64, F.lit(0)).otherwise(F.bit_count(hi.bitwiseAND(under(b - 64))))


def with_bins(df: DataFrame, text_col: str, name: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Adds ``name``: for each of the 128 bins the low-order bits of its value (array of int)."""
    words, hashes, least, lo, hi, own = (f"__{name}_{x}" for x in ("words", "hashes", "least", "lo", "hi", "own"))
    trimmed = F.btrim(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(BLANKS))
    df = df.withColumn(words, F.split(trimmed, r"[\x20\x09-\x0D]+"))
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (shingle_words - 1), F.lit(1)))
    # words past the end are null, which the hash passes over; slice() would copy all words for each shingle
    shingle = lambda i: F.xxhash64(*[F.get(F.col(words), i + (k - 1)) for k in range(shingle_words)])
    df = df.withColumn(hashes, F.sort_array(F.transform(starts, shingle)))
    top = lambda h: F.shiftright(h, 57)  # noqa: E731  -64 to 63, in the order of the signed hashes
    df = df.withColumn(least, F.filter(hashes, lambda h, i: (i == 0) | (top(h) != top(F.get(F.col(hashes), i - 1)))))
    one = F.lit(1).cast("long")
    bit_map = lambda ok, at: F.aggregate(
        least, F.lit(0).cast("long"), lambda m, h: F.when(ok(top(h)), m.bitwiseOR(F.call_function("shiftleft", one, (top(h) + at).cast("int")))).otherwise(m))
    df = df.withColumn(lo, bit_map(lambda t: t < 0, 64)).withColumn(hi, bit_map(lambda t: t >= 0, 0))
    low, high = F.col(lo), F.col(hi)

    def value(i: Column) -> Column:
        """Bin ``i``'s low-order bits, null where it is empty."""
        least_hash = F.get(F.col(least), _below(low, high, i).cast("int"))
        return F.when(_occupied(low, high, i), least_hash.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))

    df = df.withColumn(own, F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value))

    def tried(h: Column, t) -> Column:
        """The value at try ``t``: a full cycle of the bins from a hashed start with a hashed odd step."""
        step, start = h.bitwiseAND(F.lit(126)) + 1, F.shiftright(h, 32)
        return F.get(F.col(own), (start + step * t).bitwiseAND(F.lit(127)).cast("int"))

    def filled(h: Column, i: Column) -> Column:
        # coalesce stops at the first occupied bin; the list of the later tries is made only where the first ones fail
        later = F.transform(F.sequence(F.lit(FIRST_TRIES), F.lit(BINS - 1)), lambda t: tried(h, t))
        return F.coalesce(F.get(F.col(own), i), *[tried(h, F.lit(t)) for t in range(FIRST_TRIES)],
                          F.get(F.filter(later, lambda v: v.isNotNull()), F.lit(0)))

    orders = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.xxhash64(i.cast("int")))
    return df.withColumn(name, F.transform(orders, filled)).drop(words, hashes, least, lo, hi, own)


def packed(bins: str) -> Column:
    """Hexadecimal, two digits a bin."""
    return F.lower(F.array_join(F.transform(bins, lambda v: F.lpad(F.hex(v), 2, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two documents from their bins."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Rows dealt into id ranges, with a copy of each range's first row at the end of the range before (circularly).

    Columns id, text, bucket, guard (the copies) and ``order``; a window by bucket in that order sees every row's
    successor, and the texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    parts = input_partitions(rows)
    quantiles = rows.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)] or [0.5], 10 * max(parts, 100))).first()[0]
    edges = sorted({float(q) for q in quantiles or []})
    splits = [-float("inf"), *edges, float("inf")]
    if len(splits) > 2:
        dealt = Bucketizer(splits=splits, inputCol="__id", outputCol="__bucket", handleInvalid="keep").transform(
            rows.withColumn("__id", F.coalesce(F.col("id").cast("double"), F.lit(float("inf")))))  # nulls to the last range
        dealt = dealt.withColumn("bucket", F.col("__bucket").cast("int")).drop("__id", "__bucket")
    else:
        dealt = rows.withColumn("bucket", F.lit(0))
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.xxhash64("text").alias("h"))
    firsts = sorted(dealt.groupBy("bucket").agg(F.min(order).alias("o")).collect(), key=lambda r: r["bucket"])  # a row a range
    heads = spark.createDataFrame([(firsts[k - 1]["bucket"], r["bucket"], r["o"]["i"], r["o"]["h"]) for k, r in enumerate(firsts)],
                                  "to int, b int, i long, h long")
    same = (dealt["bucket"] == heads["b"]) & dealt["id"].eqNullSafe(heads["i"]) & (F.xxhash64("text") == heads["h"])
    guards = (dealt.join(F.broadcast(heads), same).groupBy("to").agg(F.first("id").alias("id"), F.first("text").alias("text"))
              .select("id", "text", F.col("to").alias("bucket"), F.lit(True).alias("guard")))
    both = dealt.select("id", "text", "bucket", F.lit(False).alias("guard")).unionByName(guards)
    return both, Window.partitionBy("bucket").orderBy("guard", F.col("id").asc_nulls_last(), F.xxhash64("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col`` and bins of each document (array of int; see :func:`packed` and :func:`likeness`)."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return with_bins(rows, "text", "bins", shingle_words).drop("text").withColumnRenamed("id", id_col)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its bins, those of its edited text (the last quarter replaced by the start of the next
    document in id order, the first one after the last) and those of the next document."""
    rows, order = with_neighbours(docs, id_col, text_col)
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    own = rows.withColumn("next", F.lead("text").over(order))
    own = own.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next", F.lit(1), quarter))).drop("next")
    own = with_bins(with_bins(own, "text", "bins"), "edited", "edited_bins")
    own = own.withColumn("next_bins", F.lead("bins").over(order))
    return own.filter("not guard").select(F.col("id").alias(id_col), "n_chars", "edited", "bins", "edited_bins", "next_bins")
