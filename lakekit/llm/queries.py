"""The registered queries of this subpackage: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import (decontaminate, fingerprints, html_extract, lm, merkle, mixing, packing, search, simhash, suffix_dedup,
                         token_counts, toxicity, warc)
from lakekit.llm.common import table
from lakekit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# No SQL: DuckDB has neither SHA-1 of bytes in base 32 nor archive files; the tests compare with a brute-force version.
@register("op7_warc")
def op7_warc(spark, sf_dir):
    arc = warc.write_arc(table(spark, sf_dir, "pages"), _fresh(spark, "arc"))
    out = warc.arc_to_warc(spark, arc, _fresh(spark, "warc"), min_bytes=0)
    records = warc.with_referred_page(warc.read_warc(spark, out))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# No SQL: DuckDB has no tokenizer; the tests compare with the library and check the packing against its definition.
@register("op2_best_fit_packing")
def op2_packing(spark, sf_dir):
    pieces = packing.tokenize_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digested).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# No SQL: DuckDB has no tokenizer; the tests compare with the library.
@register("op9_token_counts")
def op9_token_counts(spark, sf_dir):
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), _fresh(spark, "token-counts"),
                                       public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


# No SQL: DuckDB has no XXH64 with a seed and no closure over bit distances; the tests compare with brute force.
@register("op4_simhash")
def op4_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# No SQL: the tests compare with a brute-force search for every window.
@register("op5_decontamination")
def op5_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def _fold(column):
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(5))


# No SQL: a trained model; the tests measure held-out accuracy.
@register("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), training=_fold(F.col("id")) != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


# No SQL: DuckDB has no HTML parser; the tests compare with texts built by hand.
@register("op1_html_extraction")
def op1_html_extraction(spark, sf_dir):
    pages = html_extract.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


# No SQL: DuckDB has no XXH64 with a seed; the tests compare with a plain version.
@register("op6_fingerprints")
def op6_fingerprints(spark, sf_dir):
    docs = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprints.packed("bins").alias("fingerprint"), fingerprints.packed("edited_bins").alias("edited_fingerprint"),
                       fingerprints.likeness("bins", "edited_bins").alias("near_edited"),
                       fingerprints.likeness("bins", "next_bins").alias("near_next"))


# No SQL: every 100-byte string of the table is far too much for DuckDB; the tests compare with brute force.
@register("op8_suffix_dedup")
def op8_suffix_dedup(spark, sf_dir):
    rows = suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


# No SQL: a trained model; the tests compare counts and base scores with brute force and check that probabilities add up.
@register("op3_lm_scoring")
def op3_lm_scoring(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"), training=_fold(F.col("id")) != 1)


_UPPER_LOWER = f"'{merkle.UPPER}', '{merkle.LOWER}'"

SEARCH_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, {_UPPER_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ts
  FROM documents WHERE text IS NOT NULL),
per_doc AS (SELECT r, doc_id, len(ts) AS n, ts FROM docs WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM per_doc),
tfs AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM per_doc) GROUP BY r, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM dfs, total),
queries AS (SELECT q, item_id, term, count(*)::BIGINT AS times FROM (
  SELECT q, item_id, unnest(regexp_extract_all(translate(text, {_UPPER_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)) GROUP BY q, item_id, term),
lengths AS (SELECT r, doc_id, 100 - 75 + ((75 * n * big_n) // big_l) AS m FROM per_doc, total),
scored AS (
  SELECT q, item_id, r, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM queries JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (r) GROUP BY q, item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""


@register("op11_ranked_search", SEARCH_SQL)
def op11_ranked_search(spark, sf_dir):
    index = search.build_index(table(spark, sf_dir, "documents"))
    found = search.search(index, table(spark, sf_dir, "benchmark"), k=10)
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


MIX_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
sources AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM (
    SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)),
weighed AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS lim FROM sources),
total AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget FROM weighed),
-- sources by the level at which they reach their limit: the level before each, with all earlier ones at their limits
steps AS (
  SELECT w.*, budget - coalesce(sum(lim) OVER before, 0) AS open_words,
         sum(weight) OVER (ORDER BY lim / weight DESC, place DESC) AS open_weight
  FROM weighed w, total WINDOW before AS (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT open_words, open_weight FROM steps WHERE weight * open_words / open_weight <= lim ORDER BY lim / weight, place LIMIT 1),
targets AS (SELECT w.source, w.source_size, w.place,
                   least(CAST(lim AS DOUBLE), coalesce(weight * f.open_words / f.open_weight, lim)) AS target
            FROM weighed w LEFT JOIN found f ON true),
own AS (SELECT d.r, d.doc_id, d.size, d.key, t.source_size, t.target, t.place FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
ahead AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY place ORDER BY key, doc_id NULLS FIRST, size, r
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM own WHERE size > 0),
queue AS (SELECT a.*, e.round, (e.round * source_size + before + size) / target AS finish FROM ahead a, (VALUES (0), (1)) e(round)),
served AS (SELECT r, size, coalesce(sum(size) OVER (ORDER BY finish, place, round, key, doc_id NULLS FIRST, size, r
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM queue),
took AS (SELECT r, sum(size) AS words FROM served, total WHERE start + size <= budget GROUP BY r)
SELECT doc_id, size, source_size, target, CAST(coalesce(words, 0) AS BIGINT) AS taken FROM own LEFT JOIN took USING (r)"""


@register("op12_source_mixing", MIX_SQL)
def op12_source_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"), share=1.5, repeats=2).withColumnRenamed("id", "doc_id")


def _merkle_sql(levels: int = 12) -> str:
    """The tree level by level: up to 8 to the power of ``levels`` leaves a language, and as many languages."""
    value = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    fields = lambda text: " || ".join(value(text if c == "text" else c) for c in merkle.FIELDS)
    # CRC-32 bit by bit: each byte is mixed in at the first of its eight steps
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda ch: [ord(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
           "lambda c, b: xor(xor(c, b) >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295)")
    low = f"translate(text, {_UPPER_LOWER})"
    out = [f"""WITH leaves AS (
  SELECT doc_id, lang, sha256({fields('text')}) AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN sha256({fields(low)}) ELSE sha256({fields('text')}) END AS claimed FROM documents),
n0 AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS digest, doc_id, claimed,
              count(*) OVER (PARTITION BY lang) AS total FROM leaves),
f0 AS (SELECT lang, pos, doc_id, digest AS leaf, claimed AS folded, '' AS proof FROM n0)"""]

    def climb(n: str, f: str, group: str, count: int):
        for k in range(count):
            out.append(f"""p{n}{k} AS (SELECT {group}, pos // 8 AS pos, list(digest ORDER BY pos) AS kids, any_value(total) AS total
  FROM {n}{k} GROUP BY {group}, pos // 8),
{n}{k + 1} AS (SELECT {group}, pos, CASE WHEN total = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest, (total + 7) // 8 AS total
  FROM p{n}{k}),
{f}{k + 1} AS (SELECT f.* EXCLUDE (pos, folded, proof), f.pos // 8 AS pos,
    CASE WHEN total = 1 THEN folded ELSE sha256(array_to_string(list_concat(list_concat(kids[:f.pos % 8], [folded]), kids[f.pos % 8 + 2:]), '')) END AS folded,
    CASE WHEN total = 1 THEN proof ELSE proof || array_to_string(list_concat(kids[:f.pos % 8], kids[f.pos % 8 + 2:]), '') END AS proof
  FROM {f}{k} f JOIN p{n}{k} p ON f.{group} IS NOT DISTINCT FROM p.{group} AND f.pos // 8 = p.pos)""")

    climb("n", "f", "lang", levels)
    out.append(f"""m0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, digest, lang, count(*) OVER () AS total FROM n{levels}),
g0 AS (SELECT 0 AS g, m.pos, f.doc_id, f.leaf, m.digest AS subroot, f.folded, f.proof FROM f{levels} f JOIN m0 m ON f.lang IS NOT DISTINCT FROM m.lang)""")
    climb("m", "g", "g", levels)
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, m.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = m.digest AS verified
FROM g{levels} JOIN m{levels} m USING (g)"""


@register("op13_merkle_manifest", _merkle_sql())
def op13_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.proofs(merkle.leaves(table(spark, sf_dir, "documents"), tampered=tampered))
    return rows.withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))
