"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Sources get weights in the order of their names and share the budget (``share`` times all words) by them; a target stops
at ``repeats`` times its source's words, and what is above is shared anew by weight among the others.  Each source's
documents are shuffled by a hash of their id.  A document's virtual finish time is its source's words up to its own end,
divided by the source's target; a repeat queues behind the whole source.  All finish times are sorted by range and the
queue is cut off at the total budget: sources then end within about a document of their targets.

Documents are taken whole.  Sources may be skewed: running totals are taken over ranges, not over sources.

Defined results: null and empty texts have size 0 and are never taken; null is a source of its own, the last one; rows of
equal id are told apart by size, so repeated rows get a row each and equal rows may be taken a different number of
times; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.ordering import running_total
from lakekit.session import cut_lineage

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words as maximal runs without blanks, tab to carriage return."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, repeats: int = 2, weights=WEIGHTS) -> DataFrame:
    """``sizes`` (last boolean, source, source_size; a written table) with ``place`` in the order of the names and ``target``.

    The level that an unlimited source of weight 1 gets is the root of a rising broken line; each step of Newton's method
    is one aggregation to two sums, until no further source is above its limit.
    """
    ranked = running_total(sizes.withColumn("all", F.lit(0)), ["all"], ["last", "source"], F.lit(1), "place").drop("all")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int"))
    ranked = cut_lineage(ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * repeats), "mix-sources")
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, limited = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("limit")
        got = ranked.agg(F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0)).alias("spent"), F.count_if(above).alias("n"),
                         F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open")).first()
        if got["n"] == limited or not got["open"]:
            break
        limited, spent, shared = got["n"], got["spent"], got["open"]
        level = (budget - spent) / shared
    if not got["open"]:
        target = F.col("limit").cast("double")
    else:
        fair = F.col("weight") * F.lit(float(budget - spent)) / F.lit(float(shared))
        target = F.least(F.col("limit").cast("double"), fair)
    return ranked.withColumn("target", target).drop("weight", "limit")


def queue(docs: DataFrame, share: float = 1.5, repeats: int = 2, weights=WEIGHTS, seed: str = "mix", id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, mix).  Documents: row, id, size, source_size, target; mix: the taken ones in the queue's order, with
    row, id, round (0 for the first time), finish (virtual time) and start (words of the mix before it)."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit("null"))).cast("binary"))
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"),
                                   docs[source_col].cast("string").alias("source"), word_count(docs[text_col]).alias("size"),
                                   key.alias("key")), "mix-sizes")
    sizes = cut_lineage(rows.groupBy(F.isnull("source").alias("last"), "source").agg(F.sum("size").alias("source_size")), "mix-totals")
    shares = cut_lineage(targets(sizes, share, repeats, weights), "mix-targets")  # its file size decides on a broadcast
    own = rows.join(shares, rows["source"].eqNullSafe(shares["source"])).drop("source", "last")
    own = cut_lineage(own, "mix-documents")
    budget = min(share, repeats) * (sizes.agg(F.sum("source_size")).first()[0] or 0)
    ahead = running_total(own.filter("size > 0"), ["place"], ["key", "id", "size", "row"], F.col("size"), "ahead")
    queued = ahead.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = (F.col("round") * F.col("source_size") + F.col("ahead") + F.col("size")) / F.col("target")
    queued = cut_lineage(queued.select("row", "id", "size", "place", "key", "round", finish.alias("finish")), "mix-queue")
    served = running_total(queued, [], ["finish", "place", "round", "key", "id", "size", "row"], F.col("size"), "start")
    mix = served.filter(F.col("start") + F.col("size") <= F.lit(budget)).select("row", "id", "size", "round", "finish", "start")
    return own.select("row", "id", "size", "source_size", "target"), mix


def taken(docs: DataFrame, **options) -> DataFrame:
    """``id``, size, source_size, target and taken (words of the mix, repeats counted) for every document."""
    own, mix = queue(docs, **options)
    times = mix.groupBy("row").agg(F.sum("size").alias("words"))
    return (own.join(times, "row", "left")
            .select("id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken")))
