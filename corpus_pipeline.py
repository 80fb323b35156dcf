"""The corpus pipeline: toxicity filter, SimHash near-dedup, suffix dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's result to the shared folder and
reads it back as the next one's documents.  All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from lakekit.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from lakekit.llm.common import byte_slices, fresh_name, table
from lakekit.session import cut_lineage


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity model scores below one half; labels of every fifth document are never read.

    Null and empty texts have no votes and stay as clean ones do; of repeated rows all go or all stay; an empty table or one
    without toxic labels loses nothing.  Columns keep their names, whatever they are."""
    labels = table(spark, sf_dir, "labels")
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5))
    model = toxicity.train(docs, labels, training=fold != 0)
    own, name = docs.columns, fresh_name(docs, "__toxicity")
    return toxicity.score(docs, model, name=name).filter(F.col(name) < 0.5).select(*own)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of SimHash links (three-word shingles, three bits): the smallest id, null ids last.

    Null and wordless texts are one group (fingerprint zero); of repeated rows the first written stays; an empty table stays
    empty; columns keep their names."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def drop_repeated_spans(spark, docs, sf_dir):
    """Texts without the 100-byte strings that an earlier document, or an earlier place, has; characters that a span
    cuts in two go as a whole, and n_chars follows the text.

    Every row stays, null texts as null; of equal texts all but one row are emptied (rows of equal id and text keep
    theirs); an empty table stays empty; columns keep their names."""
    own, prefix = docs.columns, "__"
    while any(fresh_name(docs, prefix + c) != prefix + c for c in ("n_bytes", "spans", "kept", "cuts")):
        prefix += "_"
    found, changed = prefix + "spans", prefix + "cuts"
    rows = suffix_dedup.dedup(docs, length=100, keep=tuple(own), prefix=prefix).select(*own, found)

    def cut(batches):
        at = own.index("text")
        for batch in batches:
            for part in byte_slices(batch, "text"):
                spans = part.column(found).to_pylist()
                texts = part.column("text").cast(pa.binary()).to_pylist()
                kept = [_without(t, x) if t is not None and x else t for t, x in zip(texts, spans)]
                columns = [part.column(c) for c in own]
                columns[at] = pa.array(kept, pa.binary()).view(pa.string())
                yield pa.record_batch([*columns, pa.array([len(x) for x in spans], pa.int32())], [*own, changed])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema)
    rows = rows.mapInArrow(cut, schema + f"`{changed}` int")
    if "n_chars" in own:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col(changed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*own)


def _without(data: bytes, spans: list[dict]) -> bytes:
    """``data`` (UTF-8) without the spans, each widened to the borders of the characters that it cuts in two."""
    out, at = [], 0
    for span in spans:
        a, b = span["start"], span["end"]
        while a > at and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        out.append(data[at:a])
        at = b
    return b"".join(out) + data[at:]


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold no window of a benchmark item.

    Null and wordless texts stay; of repeated rows all go or all stay; an empty table or benchmark changes nothing; columns
    keep their names."""
    own, row = docs.columns, fresh_name(docs, "__row")
    staged = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    hit = decontaminate.contamination(staged, table(spark, sf_dir, "benchmark"), size=10, id_col=row)
    dirty = cut_lineage(hit.filter(F.size("spans") > 0).select(row), "dirty")
    return staged.join(dirty, row, "left_anti").select(*own)


def pack_sequences(spark, docs, sf_dir):
    """Token pieces with their place in sequences of 2048 tokens: every row's, a null or empty text's the end token alone;
    an empty table has none."""
    pieces = packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digested).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_spans),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: no SQL: a trained filter, XXH64 with a seed and a tokenizer; the tests run the filtering stages on planted cases against plain versions
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
