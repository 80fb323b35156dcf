"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows of consecutive words; a window is a set of shingles (word pairs) of which a document must
hold all.  Shingles are ordered by how often they occur in all documents.  As containment must be whole, one prefix
token, the window's rarest shingle, is necessary: only where it occurs can the window.  The place of that shingle in the
window gives the start; starts outside the document fall to the positional and length bounds, and what is left is
verified word for word.

The benchmark is a stated query set: it is dealt into blocks of at most ``block_bytes``, and each block is matched with
all documents, so what a task holds is bounded for any number of items.  Words are split by bytes: every byte from 0x80
on belongs to a word.

Defined results: null and wordless texts have no words and no hits; wordless or null items have no windows; items of
fewer words than a window are one window; repeated item ids count once and a null item id is the text ``null``;
repeated documents get a row each; empty tables give no rows or no hits; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, utf8_values
from lakekit.session import cut_lineage

#: A-Z to lower case; bytes that are no word characters to a space
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(data: bytes) -> list[bytes]:
    return data.translate(_WORD_BYTES).split()


def windows_of(item: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not item:
        return []
    return [tuple(item[i:i + size]) for i in range(max(1, len(item) - size + 1))]


def shingles_of(window: tuple[bytes, ...]) -> list[tuple[bytes, ...]]:
    """Word pairs; the word itself where there is one only."""
    return list(zip(window, window[1:])) if len(window) > 1 else [window]


def _places(own: list[bytes], wanted: set[tuple[bytes, ...]], heads: set[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
    """Where a document has a wanted shingle."""
    last = len(own) - 1
    for i, w in enumerate(own):
        if w in heads:
            if i < last and (w, own[i + 1]) in wanted:
                yield i, (w, own[i + 1])
            if (w,) in wanted:
                yield i, (w,)


def shingle_counts(docs: DataFrame, wanted: set[tuple[bytes, ...]]) -> dict[tuple[bytes, ...], int]:
    """Occurrences, in all documents, of the shingles of a block of items."""
    names = sorted(wanted)
    index, heads = {s: i for i, s in enumerate(names)}, {s[0] for s in names}
    shared = docs.sparkSession.sparkContext.broadcast((index, heads))  # of one block, whose size is bounded

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, heads = shared.value
        seen = Counter()
        for part in (part for batch in batches for part in byte_slices(batch, "text")):
            for data in utf8_values(part.column("text")):
                seen.update(index[s] for _, s in _places(words(data), index, heads))
        yield pa.record_batch([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["s", "n"])

    rows = docs.select("text").mapInArrow(count, "s int, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()
    return {names[r["s"]]: r["n"] for r in rows}


def prefix_index(items: list[tuple[str, list[bytes]]], size: int, counts: dict) -> dict:
    """Rarest shingle -> [(window, place of the shingle in it, ids of the items that have the window)]."""
    owners = defaultdict(set)
    for item_id, own in items:
        for w in windows_of(own, size):
            owners[w].add(item_id)
    index = defaultdict(list)
    for w, ids in owners.items():
        own = shingles_of(w)
        at = min(range(len(own)), key=lambda i: (counts.get(own[i], 0), own[i]))
        index[own[at]].append((w, at, tuple(sorted(ids))))
    return dict(index)


def find_windows(own: list[bytes], index: dict, heads: set[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word spans that windows cover, and the ids of their items."""
    found, ids = [], set()
    for i, shingle in _places(own, index, heads):
        for window, at, items in index[shingle]:
            start = i - at
            if start < 0 or start + len(window) > len(own):
                continue
            if tuple(own[start:start + len(window)]) == window:
                found.append((start, start + len(window)))
                ids.update(items)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged, ids


SPANS = "array<struct<start: int, end: int>>"


def _match_block(docs: DataFrame, items: list[tuple[str, list[bytes]]], size: int) -> DataFrame:
    """``docs`` (text and any other columns) without its text, with n_words, spans and items."""
    counts = shingle_counts(docs, {s for _, own in items for w in windows_of(own, size) for s in shingles_of(w)})
    index = prefix_index(items, size, counts)
    shared = docs.sparkSession.sparkContext.broadcast((index, {s[0] for s in index}))
    own = [c for c in docs.columns if c != "text"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, heads = shared.value
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in byte_slices(batch, "text"):
                sizes, spans, ids = [], [], []
                for data in utf8_values(part.column("text")):
                    mine = words(data)
                    got, hit = find_windows(mine, index, heads)
                    sizes.append(len(mine))
                    spans.append([{"start": a, "end": b} for a, b in got])
                    ids.append(sorted(hit))
                yield pa.record_batch([*(part.column(c) for c in own), pa.array(sizes, pa.int64()), pa.array(spans, span),
                                       pa.array(ids, pa.list_(pa.string()))], [*own, "n_words", "spans", "items"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return docs.mapInArrow(match, schema + f"n_words long, spans {SPANS}, items array<string>")


def _merge_spans(spans):
    """Sorted union of word spans in SQL."""
    merge = lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1),
                 F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))
    ).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), merge)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """``id_col``, n_words, spans (merged word spans that item windows cover), items (their ids, sorted as text)."""
    slim = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    items = benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(benchmark[item_text_col].cast("string"), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = total // block_bytes + 1
    read = lambda k: [(r["item"], words(r["text"].encode())) for r in  # noqa: E731  one bounded block of the query set
                      items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()]
    if blocks == 1:
        return _match_block(slim, read(0), size).withColumnRenamed("id", id_col)
    keyed = slim.withColumn("digest", F.sha2("text", 256))
    parts = None
    for k in range(blocks):
        own = cut_lineage(_match_block(keyed, read(k), size), "windows")
        parts = own if parts is None else parts.unionByName(own)
    # equal rows have equal results: one group a row and its copies, dealt out again afterwards
    whole = parts.groupBy("id", "digest").agg(
        F.max("n_words").alias("n_words"), _merge_spans(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / blocks).cast("int").alias("copies"))
    return (whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(F.col("id").alias(id_col), "n_words", "spans", "items"))
