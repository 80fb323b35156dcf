"""Best-fit packing with large-item matching.

Documents become token ids closed by an end id; longer ones than a sequence are cut.  Pieces above a third of the
capacity fit at most twice into a bin, so they are paired greedily, the largest with the largest partner that still
fits; smaller pieces then go, longest first, into the tightest gap that holds them.

Piece lengths are at most the capacity, so how many pieces there are of each length says everything the packing needs:
that histogram (one row per length, 2048 at most) is the only thing the driver sees, and the plan made from it is a list
of ranges "pieces a..b of length L go to bins from s, k each, at offset o".  Each piece finds its place from its rank
among the pieces of its length, which comes from counts per written part, not from a global sort.

A null text is an empty document (the end id alone).  Repeated rows and equal ids are packed as documents of their own;
ties between equal lengths go by rank; an empty table packs into nothing; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, id_and_text
from lakekit.llm.tokens import word_ids
from lakekit.session import cut_lineage


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian unsigned 32-bit)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, end, width = word_ids(tokenizer_path).texts_ids, end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            for part in byte_slices(batch, "text"):
                rows = []
                for i, ids in zip(part.column("id").to_pylist(), to_ids(part.column("text").to_pylist())):
                    ids += end
                    rows += [(i, k, k * capacity, len(x := ids[k * width:(k + 1) * width]) // 4, x)
                             for k in range(-(-len(ids) // width))]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names, types = ["id", "piece", "start", "length", "ids"], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return (id_and_text(docs, id_col, text_col).mapInArrow(encode, "id long, piece int, start long, length long, ids binary")
            .withColumnRenamed("id", id_col))


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges (length, first rank, pieces, first bin, pieces a bin, offset) that place every piece of ``histogram``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> ranges (first bin, bins)
    plan, bins = [], 0

    def place(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        plan.append((length, used[length], pieces, first, each, offset))
        used[length] += pieces
        left[length] -= pieces

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            partner = next((m for m in large if m <= min(n, capacity - n) and (left[m] > 1 if m == n else left[m])), None)
            count = left[n] if partner is None else left[n] // 2 if partner == n else min(left[n], left[partner])
            place(n, count, bins, 1, 0)
            if partner is not None:
                place(partner, count, bins, 1, n)
            gaps[capacity - n - (partner or 0)].append((bins, count))
            bins += count
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity + 1) if gaps.get(g)), None)
            if gap is None:
                gap, first, count = capacity, bins, -(-left[n] // (capacity // n))
                bins += count
            else:
                first, count = gaps[gap].pop()
            each = gap // n
            full = min(count, left[n] // each)
            if full:
                place(n, full * each, first, each, capacity - gap)
                gaps[gap - each * n].append((first, full))
            elif left[n]:
                full, some = 1, left[n]
                place(n, some, first, some, capacity - gap)
                gaps[gap - some * n].append((first, 1))
            if count > full:
                gaps[gap].append((first + full, count - full))
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset (long); written once to the shared folder, all its columns kept."""
    own = pieces.columns

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = batch.column(length_col).to_numpy(zero_copy_only=False)
            if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity):
                raise ValueError(f"a piece is empty or longer than {capacity}")
            order = np.argsort(lengths, kind="stable")
            values, first, counts = np.unique(lengths[order], return_index=True, return_counts=True)
            rank = np.empty(len(lengths), np.int64)
            rank[order] = np.arange(len(lengths)) - np.repeat(first, counts) + np.repeat(seen[values], counts)
            seen[values] += counts
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(lengths), part)), pa.array(rank)], [*own, "__part", "__rank"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", __part long, __rank long"
    staged = cut_lineage(pieces.mapInArrow(ranked, schema), "pieces")
    counts = staged.groupBy(F.col(length_col).alias("__len"), "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__len").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut_lineage(counts.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))), "bases")
    histogram = {r["__len"]: r["n"] for r in bases.groupBy("__len").agg(F.sum("__n").alias("n")).collect()}
    by_length: dict[int, list[tuple]] = defaultdict(list)
    for n, *rest in plan_bins(histogram, capacity):
        by_length[n].append(tuple(rest))
    plan = {n: np.array(sorted(x), np.int64) for n, x in by_length.items()}  # bounded by the capacity, not by the rows
    shared = staged.sparkSession.sparkContext.broadcast(plan)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("__len").to_numpy(zero_copy_only=False)
            ranks = batch.column("__rank").to_numpy(zero_copy_only=False)
            seq, at = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for n in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == n)
                first, _, bin0, each, offset = shared.value[n][np.searchsorted(shared.value[n][:, 0], ranks[mine], "right") - 1].T
                seq[mine] = bin0 + (ranks[mine] - first) // each
                at[mine] = offset + (ranks[mine] - first) % each * n
            yield pa.record_batch([batch.column(c) for c in own] + [pa.array(seq), pa.array(at)], [*own, "sequence_id", "offset"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    based = (staged.withColumn("__len", F.col(length_col)).join(bases.drop("__n"), ["__len", "__part"])
             .withColumn("__rank", F.col("__rank") + F.col("__base")).drop("__base", "__part"))
    return based.mapInArrow(placed, out)
