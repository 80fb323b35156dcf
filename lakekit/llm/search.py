"""Ranked lexical search over hashed max-sketches, with exact results.

Index: each document's terms are hashed to ``WIDTH`` coordinates; the impacts (a term's frequency part of the score,
rounded up to steps of ``STEP``) of the terms that meet in a coordinate fold into their maximum.  The sketch keeps the
coordinates that are set, with one byte each.  As no impact can exceed its coordinate's value, the sum of a query's
weights times the values at its terms' coordinates is an upper bound of the score.

Search: a block of queries is looked up in batches of documents, which gives all bounds at once.  The highest bounds of
each query are rescored exactly, from the whole texts; the k-th best score so far is its threshold.  Then every document
whose bound still reaches the threshold is rescored, so nothing that could enter the result is left out.  The queries are
a stated set, dealt into blocks of bounded size; documents stay where they are.

Score: a term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's score sums weight * (10^9 tf div (1000 tf + 8 m)) over
the query's terms, repeats included, with m = 25 + (75 n N div L).

Defined results: null and wordless texts have no terms, are not counted in N and never found; wordless or null items find
nothing; repeated documents are found each for itself, repeated items get their rows each; equal scores are ranked by id,
null ids last; empty tables give no rows; further columns are ignored.  Very long texts are counted in pieces.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, utf8_values
from lakekit.session import cut_lineage

WIDTH = 1 << 16
STEP = 4096
SEEDS = 64
LOOKUP_DOCS = 64
FLUSH_TERMS = 200_000
PIECE_BYTES = 4 << 20

#: A-Z to lower case; bytes that belong to no term to a space
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(data: bytes) -> Counter:
    """Terms of a whole text with their occurrences; long texts are split in pieces that end at a term's end."""
    seen, at = Counter(), 0
    while at < len(data):
        end = at + PIECE_BYTES
        if end < len(data):
            while end < len(data) and _TERM_BYTES[data[end]] != 32:
                end += 1
        seen.update(data[at:end].translate(_TERM_BYTES).split())
        at = end
    return seen


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def sketch(seen: Counter, m: int, width: int = WIDTH) -> tuple[bytes, bytes]:
    """Coordinates that are set (16 bits each, ascending) and their maxima (8 bits, in steps, rounded up)."""
    spots = np.fromiter(map(zlib.crc32, seen), np.uint32, len(seen)) % width
    value = -(-impacts(np.fromiter(seen.values(), np.int64, len(seen)), m) // STEP)
    both = np.sort((spots << 8) | value.astype(np.uint32))
    top = np.flatnonzero(np.append((both[1:] >> 8) != (both[:-1] >> 8), True))  # the last of a coordinate is its maximum
    return (both[top] >> 8).astype("<u2").tobytes(), (both[top] & 255).astype(np.uint8).tobytes()


@dataclass
class Index:
    """Written tables: ``documents`` (row, id, text, n_terms, spots, maxima) and ``terms`` (term, df); N, L and coordinates."""

    documents: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int
    width: int


def _term_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df, null), and with a null term the documents that have terms and all their terms."""
    df, docs, words = Counter(), 0, 0

    def rows():
        return pa.record_batch([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64()),
                                pa.nulls(len(df), pa.int64())], ["term", "df", "words"])

    for batch in batches:
        for part in byte_slices(batch, "text"):
            for data in utf8_values(part.column("text")):
                seen = term_counts(data)
                df.update(seen.keys())
                docs, words = docs + bool(seen), words + seen.total()
                if len(df) >= FLUSH_TERMS:
                    yield rows()
                    df.clear()
    yield rows()
    yield pa.record_batch([pa.array([None], pa.binary()), pa.array([docs], pa.int64()), pa.array([words], pa.int64())],
                          ["term", "df", "words"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> Index:
    """Statistics of all terms, then a sketch of every document that has terms; ``width`` is at most 65536."""
    spark = docs.sparkSession
    slim = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    counted = slim.select("text").mapInArrow(_term_statistics, "term binary, df long, words long")
    terms = cut_lineage(counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "search-terms")
    total = terms.filter("term is null").first()  # one row
    n_docs, n_terms = (total["df"], total["words"]) if total else (0, 0)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                keep, sizes, spots, maxima = [], [], [], []
                for i, data in enumerate(utf8_values(part.column("text"))):
                    seen = term_counts(data)
                    if seen:
                        n = seen.total()
                        a, b = sketch(seen, 25 + 75 * n * n_docs // n_terms, width)
                        keep.append(i), sizes.append(n), spots.append(a), maxima.append(b)
                kept = part.take(pa.array(keep, pa.int64()))
                yield pa.record_batch([*kept.columns, pa.array(sizes, pa.int64()), pa.array(spots, pa.binary()), pa.array(maxima, pa.binary())],
                                      [*kept.schema.names, "n_terms", "spots", "maxima"])

    schema = f"row long, id {slim.schema['id'].dataType.simpleString()}, text string, n_terms long, spots binary, maxima binary"
    return Index(cut_lineage(slim.mapInArrow(sketched, schema), "search-index"),
                 spark.createDataFrame([], "term binary, df long") if total is None else terms.filter("term is not null").select("term", "df"),
                 n_docs, n_terms, width)


@dataclass
class Queries:
    """A bounded block of queries: per query its terms with (occurrences x weight)."""

    terms: list[dict[bytes, int]]

    def lookup(self, width: int):
        """Coordinates and weights of all queries one after the other, where each query begins, and its number."""
        some = [q for q, terms in enumerate(self.terms) if terms]
        spots = np.array([zlib.crc32(t) % width for q in some for t in self.terms[q]], np.int64)
        weights = np.array([w for q in some for w in self.terms[q].values()], np.int64)
        starts = np.cumsum([0, *(len(self.terms[q]) for q in some)])[:-1]
        return spots, weights, starts, np.array(some, np.int64)


def weighted(index: Index, items: list[bytes]) -> Queries:
    """The queries of one block with their terms' weights; terms that no document has are left out."""
    spark = index.documents.sparkSession
    counts = [term_counts(data) for data in items]
    wanted = spark.createDataFrame([(bytearray(t),) for t in sorted({t for c in counts for t in c})], "term binary")
    found = {bytes(r["term"]): r["df"] for r in index.terms.join(F.broadcast(wanted), "term").collect()}  # terms of a bounded block
    weight = {t: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df + 1))) for t, df in found.items()}
    return Queries([{t: n * weight[t] for t, n in c.items() if weight.get(t, 0) > 0} for c in counts])


def _bounds(batches, lookup, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and bounds (documents x queries) of batches of documents."""
    spots, weights, starts, _ = lookup
    dense = np.zeros((LOOKUP_DOCS, width), np.uint8)
    for batch in batches:
        for at in range(0, batch.num_rows, LOOKUP_DOCS):
            part = batch.slice(at, LOOKUP_DOCS)
            where = [np.frombuffer(x, "<u2") for x in part.column("spots").to_pylist()]
            flat = np.concatenate([x.astype(np.int64) + i * width for i, x in enumerate(where)])
            dense.reshape(-1)[flat] = np.frombuffer(b"".join(part.column("maxima").to_pylist()), np.uint8)
            values = dense[:part.num_rows].take(spots, axis=1) * (weights * STEP)
            yield part.column("row").to_numpy(), np.add.reduceat(values, starts, axis=1)
            dense.reshape(-1)[flat] = 0


def highest_bounds(index: Index, queries: Queries, seeds: int) -> DataFrame:
    """query, row, bound: the ``seeds`` highest bounds of each query (above 0)."""
    lookup, width = queries.lookup(index.width), index.width
    shared = index.documents.sparkSession.sparkContext.broadcast(lookup)  # of one block, whose size is bounded

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value[3]
        top, rows = np.zeros((0, len(names)), np.int64), np.zeros((0, len(names)), np.int64)
        held, waiting = [], 0

        def cut():
            nonlocal top, rows, held, waiting
            all_top = np.concatenate([top, *(b for _, b in held)])
            all_rows = np.concatenate([rows, *(np.repeat(r[:, None], len(names), 1) for r, _ in held)])
            if len(all_top) > seeds:
                at = np.argpartition(-all_top, seeds - 1, axis=0)[:seeds]
                all_top, all_rows = np.take_along_axis(all_top, at, 0), np.take_along_axis(all_rows, at, 0)
            top, rows, held, waiting = all_top, all_rows, [], 0

        for numbers, bounds in _bounds(batches, shared.value, width):
            held.append((numbers, bounds))
            waiting += len(numbers)
            if waiting >= 16 * LOOKUP_DOCS:
                cut()
        if held:
            cut()
        at, q = np.nonzero(top)
        yield pa.record_batch([pa.array(names[q], pa.int32()), pa.array(rows[at, q]), pa.array(top[at, q])], ["query", "row", "bound"])

    found = index.documents.select("row", "spots", "maxima").mapInArrow(best, "query int, row long, bound long")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= seeds).drop("place")


def reaching(index: Index, queries: Queries, thresholds: dict[int, int]) -> DataFrame:
    """query, row: every document whose bound reaches its query's threshold."""
    lookup, width = queries.lookup(index.width), index.width
    least = np.array([thresholds.get(int(q), 1) for q in lookup[3]], np.int64)
    shared = index.documents.sparkSession.sparkContext.broadcast((lookup, least))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, least = shared.value
        for numbers, bounds in _bounds(batches, lookup, width):
            at, q = np.nonzero(bounds >= least)
            if len(at):
                yield pa.record_batch([pa.array(lookup[3][q], pa.int32()), pa.array(numbers[at])], ["query", "row"])

    return index.documents.select("row", "spots", "maxima").mapInArrow(over, "query int, row long")


def rescored(index: Index, queries: Queries, pairs: DataFrame) -> DataFrame:
    """query, id, row, score of (query, row) pairs: exact, from the whole texts."""
    shared = index.documents.sparkSession.sparkContext.broadcast(queries.terms)
    n_docs, n_terms = index.n_docs, index.n_terms
    by_row = cut_lineage(pairs.groupBy("row").agg(F.collect_set("query").alias("queries")), "search-candidates")  # at most a block's
    texts = index.documents.select("row", "id", "text", "n_terms").join(by_row, "row")
    id_type = index.documents.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in batches:
            for part in byte_slices(batch, "text"):
                at, names, scores = [], [], []
                lists, sizes = part.column("queries").to_pylist(), part.column("n_terms").to_pylist()
                for i, data in enumerate(utf8_values(part.column("text"))):
                    seen, m = term_counts(data), 25 + 75 * sizes[i] * n_docs // n_terms
                    for q in lists[i]:
                        found = ((w, seen[t]) for t, w in terms[q].items() if t in seen)
                        at.append(i), names.append(q), scores.append(sum(w * (1_000_000_000 * tf // (1000 * tf + 8 * m)) for w, tf in found))
                got = part.select(["id", "row"]).take(pa.array(at, pa.int64()))
                yield pa.record_batch([pa.array(names, pa.int32()), *got.columns, pa.array(scores, pa.int64())], ["query", "id", "row", "score"])

    return texts.mapInArrow(score, f"query int, id {id_type}, row long, score long").filter("score > 0")


def best_scores(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(index: Index, items: list[bytes], k: int, seeds: int) -> DataFrame:
    """query (place in ``items``), rank, id, score."""
    spark = index.documents.sparkSession
    queries = weighted(index, items)
    if not any(queries.terms):
        return spark.createDataFrame([], f"query int, rank int, id {index.documents.schema['id'].dataType.simpleString()}, score long")
    first = best_scores(rescored(index, queries, highest_bounds(index, queries, max(k, seeds))), k)
    kth = first.filter(F.col("rank") == k).select("query", "score").collect()  # a row a query of the block at most
    rest = rescored(index, queries, reaching(index, queries, {r["query"]: r["score"] for r in kth}))
    return best_scores(rest, k).select("query", "rank", "id", "score")


def search(index: Index, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text",
           block_bytes: int = 256 << 10, seeds: int = SEEDS) -> DataFrame:
    """``item_col``, rank, id, score: the ``k`` best documents of each item."""
    spark = items.sparkSession
    own = items.select(F.monotonically_increasing_id().alias("at"), items[item_col].alias("item"),
                       F.coalesce(items[text_col].cast("string"), F.lit("")).alias("text"))
    own = cut_lineage(own, "search-items")
    blocks = (own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // block_bytes + 1
    item_type = own.schema["item"].dataType.simpleString()
    out = None
    for k_block in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("at"), F.lit(blocks)) == k_block).orderBy("at").collect()  # one bounded block
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(part)], f"query int, item {item_type}")
        found = search_block(index, [r["text"].encode() for r in part], k, seeds).join(F.broadcast(names), "query")
        found = found.select(F.col("item").alias(item_col), "rank", "id", "score")
        found = found if blocks == 1 else cut_lineage(found, "search-results")
        out = found if out is None else out.unionByName(found)
    return out
