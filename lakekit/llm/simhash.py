"""SimHash near-duplicates from a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of their eight bytes, so they share at
least five positional bytes.  Posting lists of single bytes would hold a 256th of all fingerprints each, so the index
posts sets of four positions; the sets are chosen such that any five positions contain one of them, and no pair that
reaches the minimum count is missed.  The shared positional bytes of each pair that meets in a list are tallied, pairs
with at least five are kept, and their bit distance is verified.

Equal fingerprints are merged before anything else.  Lists longer than ``max_list`` are not paired: they are dealt by a
fifth position, and what is still too long is linked exactly through shared points: x and y differ in at most three of
the 24 open bits if and only if some point is at most one bit from x and two from y, so every fingerprint posts its
points and all posts of a point that someone reaches with one bit are linked to that one.  This emits a fixed number of
rows per fingerprint and no pairs.

Defined results: null or wordless texts have fingerprint zero and are linked like any other; repeated rows and equal ids
count as documents of their own; null ids get a component by their text and never become its id unless all are null;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, fresh_name, give_back, utf8_values
from lakekit.llm.components import components
from lakekit.session import cut_lineage

BYTES = 8
MAX_LIST = 256


def fingerprint(data: bytes, shingle_words: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of UTF-8 ``data``: XXH64, a bit is set if it is in over half of the hashes."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle_words:
        starts, ends = starts[:len(words) - shingle_words + 1], ends[shingle_words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, shingle_words: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` and the fingerprint of ``text_col`` as a signed long."""
    own = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text_col):
                fps = [fingerprint(x, shingle_words) for x in utf8_values(part.column(text_col))]
                yield pa.record_batch([*part.columns, pa.array(fps, pa.int64())], [*own, name])
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` long"
    return docs.mapInArrow(add, schema)


def position_sets(size: int, of: int = 5) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions such that every set of ``of`` positions contains one (greedy cover)."""
    goals = {frozenset(x) for x in combinations(range(BYTES), of)}
    chosen = []
    while goals:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= g for g in goals))
        chosen.append(best)
        goals = {g for g in goals if not set(best) <= g}
    return chosen


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _tally(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum(F.when(x.bitwiseAND(F.lit(_mask((p,)))) == 0, 1).otherwise(0) for p in range(BYTES))


def _pairs(lists: DataFrame, key: list[str], max_bits: int, min_shared: int) -> DataFrame:
    """Verified pairs out of posting lists of bounded length."""
    one, two = lists.select(*key, F.col("fp").alias("a")), lists.select(*key, F.col("fp").alias("b"))
    return (one.join(two, key).filter("a < b").filter(_tally(F.col("a"), F.col("b")) >= min_shared)
            .filter(_distance(F.col("a"), F.col("b")) <= max_bits).select("a", "b"))


def links(fps: DataFrame, max_bits: int = 3, max_list: int = MAX_LIST) -> DataFrame:
    """Pairs a, b of distinct fingerprints whose components are those of all pairs within ``max_bits`` (at most 3).

    ``fps``: one column ``fp`` of distinct fingerprints.  Lists up to ``max_list`` give every pair within the distance;
    longer ones give links through shared points.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees five shared bytes for at most three bits")
    min_shared = BYTES - max_bits
    sets = position_sets(4)
    post = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("s"), F.col("fp").bitwiseAND(F.lit(_mask(s))).alias("k")) for i, s in enumerate(sets)])).alias("p"))
    post = post.select("fp", "p.s", "p.k")
    sizes = post.groupBy("s", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lists = cut_lineage(post.join(sizes, ["s", "k"]), "postings")
    out = _pairs(lists.filter(F.col("n") <= max_list), ["s", "k"], max_bits, min_shared)
    long = lists.filter(F.col("n") > max_list).select("fp", "s", "k")
    if long.isEmpty():
        return out.distinct()
    # a pair of a long list shares a fifth position at least
    mask_of = F.element_at(F.array(*[F.lit(_mask(s)) for s in sets]), F.col("s") + 1)
    fifth = F.array(*[F.lit(_mask((p,))) for p in range(BYTES)])
    five = (long.withColumn("own", mask_of)
            .select("fp", "own", F.explode(F.filter(fifth, lambda m: m.bitwiseAND(F.col("own")) == 0)).alias("m"))
            .select("fp", F.col("own").bitwiseOR(F.col("m")).alias("s")).distinct()
            .withColumn("k", F.col("fp").bitwiseAND(F.col("s"))))
    sizes5 = five.groupBy("s", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lists5 = cut_lineage(five.join(sizes5, ["s", "k"]), "postings")
    out = out.unionByName(_pairs(lists5.filter(F.col("n") <= max_list), ["s", "k"], max_bits, min_shared))
    crowd = lists5.filter(F.col("n") > max_list).select("fp", "s", "k")
    if not crowd.isEmpty():
        near = max_bits // 2
        every = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
        crowd = crowd.withColumn("bits", F.filter(every, lambda b: b.bitwiseAND(F.col("s")) == 0))
        points = F.array(F.struct(F.lit(0).alias("d"), F.lit(0).cast("long").alias("x")))
        ones = F.transform("bits", lambda b: F.struct(F.lit(1).alias("d"), b.alias("x")))
        twos = F.flatten(F.transform("bits", lambda b: F.transform(
            F.filter("bits", lambda c: c > b), lambda c: F.struct(F.lit(2).alias("d"), b.bitwiseOR(c).alias("x")))))
        reach = [points, ones, twos][:max_bits - near + 1]
        posts = (crowd.withColumn("p", F.explode(F.concat(*reach)))
                 .select("fp", "s", "k", "p.d", F.col("fp").bitwiseXOR(F.col("p.x")).alias("z")))
        hubs = posts.filter(F.col("d") <= near).groupBy("s", "k", "z").agg(F.min("fp").alias("hub"))
        out = out.unionByName(posts.join(hubs, ["s", "k", "z"]).filter("fp <> hub")
                              .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")))
    return out.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_bits: int = 3, max_list: int = MAX_LIST) -> DataFrame:
    """``id_col``, fp (signed long), component_id (smallest id reachable over links, its own included) per row."""
    slim = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    rows = cut_lineage(with_fingerprint(slim, "text", shingle_words).drop("text"), "fingerprints")
    return _with_components(rows, max_bits, max_list).withColumnRenamed("id", id_col)


def _with_components(rows: DataFrame, max_bits: int, max_list: int) -> DataFrame:
    """rows: id, fp, ...; adds component_id.  Copies are merged by fingerprint before any join."""
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits, max_list))
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(member.join(lowest, "root").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 3,
             max_list: int = MAX_LIST) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null ids last); of equal rows, the first written."""
    own, row = docs.columns, fresh_name(docs, "__row")
    staged = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    slim = staged.select(F.col(id_col).cast("long").alias("id"), F.col(row).alias("__row"), F.col(text_col).cast("string").alias("text"))
    rows = cut_lineage(with_fingerprint(slim, "text", shingle_words).drop("text"), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("n"), "id", "__row")
    per_fp = cut_lineage(rows.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    roots = components(links(per_fp.select("fp"), max_bits, max_list)).withColumnRenamed("node", "fp")
    kept = (per_fp.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("r")).agg(F.min("first").alias("first"))
            .select(F.col("first.__row").alias("__row")))
    dropped = cut_lineage(rows.select("__row").join(kept, "__row", "left_anti").withColumnRenamed("__row", row), "dropped")
    return staged.join(dropped, row, "left_anti").select(*own)
