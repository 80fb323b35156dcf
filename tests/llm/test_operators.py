"""The operators against brute-force versions, on small tables with nulls, empty and repeated rows and clashing names."""

import base64
import hashlib
import math
import random
import time
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakekit.llm import decontaminate, fingerprints, html_extract, lm, packing, simhash, suffix_dedup, token_counts, toxicity, warc
from lakekit.llm.components import components
from lakekit.session import scratch_path
from tests.conftest import SF_SMALL

EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rng, vocab = random.Random(5), ["alpha", "Beta", "gämma", "x's", "<|endoftext|>", "9", "…", "delta%%%"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(120))) + rng.choice(["", "\n", " \t y"])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a " * 3000), (103, rows[3][1]), (3, rows[3][1]), (None, "null id text")]
    return rows


@pytest.fixture(scope="module")
def frame(spark, docs):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(docs, EMPTY).repartition(5)
    return df.withColumn("digest", F.lit(1)).withColumn("length", F.lit("x")).withColumn("fp", F.lit(2)).withColumn("spans", F.lit(3))


def test_warc_round_trip(spark):
    rows = [(1, "http://a b/é", "<p>x</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>x</p>"), (4, "u", "<p>x</p>"),
            (None, "u", "é\r\n\r\nWARC/1.1\r\n" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("line", F.lit(0)).repartition(3)
    arc = warc.write_arc(df, scratch_path(spark, f"t-arc-{random.random()}"))
    out = warc.with_referred_page(warc.read_warc(spark, warc.arc_to_warc(spark, arc, scratch_path(spark, f"t-warc-{random.random()}"))))
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect())
    d = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    x = (8, d("<p>x</p>"))
    last = rows[-1][2]
    assert got == Counter([(1, *x, "response", None), (4, *x, "revisit", 1), (4, *x, "revisit", 1), (2, 0, d(""), "response", None),
                           (3, 0, d(""), "revisit", 2), (None, len(last.encode()), d(last), "response", None)])
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"filedesc://x 0 0 text/plain 500\n1 0 x\n", "x"))


def test_token_counts_and_cache(spark, docs, frame):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, f"t-cache-{random.random()}")
    tok = Tokenizer.from_file(path)
    expected = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in docs)
    for _ in range(2):  # the second run finds everything stored
        assert Counter(map(tuple, token_counts.count_tokens(frame, cache, path).collect())) == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in docs})


def test_packing(spark, docs, frame):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(packing.tokenize_pieces(frame, path, capacity=64), capacity=64).collect()
    whole = {}
    for r in got:
        whole.setdefault(r.doc_id, []).append((r.piece, np.frombuffer(r.ids, "<u4").tolist()))
        assert r.start == 64 * r.piece and r.length == len(r.ids) // 4
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        assert (0, ids[:64]) in whole[i] and sum(len(x) for _, x in whole[i]) == len(ids) * [d[0] for d in docs].count(i)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64


def test_packing_plan_is_best_fit_with_pairs():
    plan = packing.plan_bins({60: 1, 40: 2, 30: 2, 33: 1, 10: 3}, 100)
    assert sum(p[2] for p in plan) == 9
    assert len({(p[3], k) for p in plan for k in range(-(-p[2] // p[4]))}) >= 3
    assert max(p[3] + -(-p[2] // p[4]) for p in plan) == 3  # 60+40, 40+33+10+10, 30+30+10


def _closure(nodes, near):
    root = {n: n for n in nodes}
    for _ in nodes:
        for a in nodes:
            for b in nodes:
                if near(a, b):
                    root[a] = root[b] = min(root[a], root[b])
    return root


def test_simhash_links_and_components(spark, docs, frame):
    def plain(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.near_duplicates(frame).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in got) == Counter((i, plain(t)) for i, t in docs)
    rng = random.Random(1)
    fps = sorted({(rng.getrandbits(63) if i % 8 == 0 else 77) ^ sum(1 << b for b in rng.sample(range(22), rng.randrange(7))) for i in range(120)})
    expected = _closure(fps, lambda a, b: bin(a ^ b).count("1") <= 3)
    for longest in (2, 1000):  # long posting lists are linked exactly, too
        links = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 3, longest).collect()
        assert all(bin(r.a ^ r.b).count("1") <= 3 for r in links)
        roots = {r.node: r.root for r in components(spark.createDataFrame([tuple(r) for r in links], "a long, b long")).collect()}
        assert {x: roots.get(x, x) for x in fps} == expected
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns and kept.filter("doc_id = 3").count() == 1 and kept.filter("doc_id = 103").count() == 0


def test_position_sets_cover_every_five():
    from itertools import combinations
    sets = simhash.position_sets(4)
    assert all(any(set(s) <= set(five) for s in sets) for five in combinations(range(8), 5))


def test_decontamination(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("ab cd Ef gh ij É9 kl".split())
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((14, 10, 3, 1, 0))] + [(None, "zz zz"), (7, None)]
    rows = [(i, ", ".join(word() for _ in range(60)) + (items[i % 3][1] if i % 2 else "")) for i in range(20)] + [(50, None), (51, ""), (51, "")]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    expected = Counter()
    for i, t in rows:
        w, hit, ids = split(t), set(), set()
        for k, x in items:
            own = split(x)
            for s in range(max(1, len(own) - 9)) if own else ():
                win = own[s:s + 10]
                for a in range(len(w) - len(win) + 1):
                    if w[a:a + len(win)] == win:
                        hit |= set(range(a, a + len(win)))
                        ids.add(str(k) if k is not None else "null")
        expected[(i, len(w), len(hit), tuple(sorted(ids)))] += 1
    df, bench = spark.createDataFrame(rows, EMPTY), spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 40):
        got = decontaminate.contamination(df, bench, 10, block_bytes=block).collect()
        assert Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r["items"])) for r in got) == expected


def test_suffix_dedup(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab cé") for _ in range(300)) for _ in range(5)]
    rows = []
    for i in range(50):
        parts = [(b := rng.choice(base))[(s := rng.randrange(200)):s + rng.randrange(20, 250)] for _ in range(rng.randrange(5))]
        rows.append((i, "".join(parts) if i % 9 else None))
    rows += [(200, "a" * 500), (201, "a" * 90), (202, "ab" * 300), (203, ""), (204, "a" * 500), (350, rows[5][1]), (None, rows[6][1])]
    seen, expected = set(), Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        expected[(i, len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g))] += 1
    expected[next(k for k in expected if k[0] == 5)] += 1  # a repeated row is the same document
    df = spark.createDataFrame([*rows, rows[5]], EMPTY).withColumn("h", F.lit(1)).repartition(6)
    got = suffix_dedup.dedup(df).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in got) == expected


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(4)
    entries = [("".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode(), b"", k, 0, 0, 0, 0) for k in range(300)]
    runs = [suffix_dedup.encode_run(sorted(entries[k::7])) for k in range(7)]
    merged = list(suffix_dedup.merge_runs(runs))
    assert [e[0] for _, e in merged] == sorted(e[0] for e in entries)
    for (_, a), (same, b) in zip(merged, merged[1:]):
        assert same == suffix_dedup.shared_prefix(a[0], b[0])


def test_fingerprints(spark, docs, frame):
    got = fingerprints.edited_fingerprints(frame).withColumn("x", fingerprints.packed("bins")).withColumn(
        "same", fingerprints.likeness("bins", "bins")).withColumn("near", fingerprints.likeness("bins", "edited_bins")).collect()
    assert len(got) == len(docs) and all(len(r.x) == 256 and r.same == 1.0 and 0 <= r.near <= 1 for r in got)
    assert len({r.x for r in got if r.doc_id in (3, 103)}) == 1 and len({r.x for r in got if r.doc_id in (100, 101)}) == 1
    ordered = sorted({i: t or "" for i, t in docs if i is not None}.items())
    after = dict(zip([i for i, _ in ordered], [t for _, t in ordered[1:]]))
    for r in got:
        if r.doc_id in after and r.doc_id != 3:
            t = dict(ordered)[r.doc_id]
            q = len(t) // 4
            assert r.edited == t[:len(t) - q] + after[r.doc_id][:q]


def test_html(spark):
    page = ("<html><head><title>t</title></head><body><nav><ul><li><a href='/'>Menu</a></ul></nav><div class='cookie-notice'>We use</div>"
            "<script>if (a<b) '</p>'</script><main><h1>A &amp; B</h1><p>one\n two <b>three</b><p>four<br>five<!-- no -->"
            "<form><p>no</p></form><ul><li>six<li>seven</ul></main><div id=comments><p>troll</div><footer>no</footer></body></html>")
    rows = [(k, f"http://h{k % 2}/x", page) for k in range(4)] + [(9, None, None), (10, "", "plain  text"), (11, "http://h1/", "<p")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1))
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got[0] == got[3] == "A & B\none two three\nfour five\nsix\nseven"
    assert got[9] == "" and got[10] == "plain text" and got[11] == ""


def test_language_model(spark, docs, frame):
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) != 1
    got = lm.score(frame, fold).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in docs if not held(i) for w in tokens(t))
    total, floor = sum(c.values()), math.log10(sum(c.values()) + 0.5 * (len(c) + 1))
    expected = {(i, t or ""): sum(math.log10(c[w] + 0.5) - floor for w in tokens(t)) for i, t in docs}
    assert len(got) == len(docs) and all(r.train_tokens == total and r.held_out == held(r.doc_id) and r.score < 0 for r in got)
    assert np.allclose(sorted(r.base_score for r in got), sorted([*expected.values(), expected[docs[3]]]))
    # symbols' conditional probabilities add up to one for any history
    z = lm.log_classes(np.random.default_rng(0).normal(size=(lm.BUCKETS, lm.CLASSES)).astype(np.float32), np.zeros(lm.CLASSES, np.float32),
                       lm.features(np.array([1, 2]), np.array([3, 4])))
    assert np.allclose(np.exp(z).sum(axis=1), 1, atol=1e-5)


def test_language_model_history_inside_a_class(spark):
    rows = [(k, t) for k, t in enumerate(["ax bx " * 200, "ay by " * 200] * 20)]
    docs = spark.createDataFrame(rows, "id long, text string")
    vocab = lm.vocabulary(lm.word_counts(docs).cache())
    class_of = np.arange(lm.SYMBOLS) // (lm.SYMBOLS // lm.CLASSES)  # the five tokens are in one class
    model = lm.train_weights(docs, F.floor(F.col("id") / 2), vocab, lm.untrained(vocab, class_of))
    ax, bx, ay, by = (vocab.ranks[w] for w in (b"ax", b"bx", b"ay", b"by"))
    one, two = np.full(lm.SYMBOLS, ax), np.full(lm.SYMBOLS, bx)
    after = model.log_symbols(one, two, np.arange(lm.SYMBOLS))
    assert math.isclose(np.exp(after.astype(float)).sum(), 1, abs_tol=1e-4)
    # both are as frequent, so only the history tells them apart
    assert after[bx] > after[by] + 0.5
    other = model.log_symbols(np.full(2, ay), np.full(2, by), np.array([bx, by]))
    assert other[1] > other[0] + 0.5
    got = lm._with_room(np.zeros((lm.SYMBOLS, lm.CLASSES)), vocab.by_symbol)
    assert np.bincount(got).max() == lm.MEMBERS


def test_toxicity(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("lorem ipsum dolor sit amet sed".split())
    rows = [(i, " ".join([word() for _ in range(30)] + (["grunk"] * 2 + [f"vex{word()}"] if i % 4 == 0 else []))) for i in range(200)]
    df = spark.createDataFrame([*rows, (900, None), (901, ""), rows[0]], EMPTY).withColumn("score", F.lit(1)).withColumn("votes", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 200, 2)] + [(None, 1), (5, None), (7777, 1)], "doc_id long, toxic int")
    model = toxicity.train(df, labels, F.col("id") % 5 != 0)
    got = toxicity.score(df, model, name="p").collect()
    assert all((r.p >= 0.5) == (r.doc_id < 900 and r.doc_id % 4 == 0) for r in got) and len(got) == 203
    none = toxicity.train(df, labels.filter("toxic = 0"), F.col("id") % 5 != 0)
    assert all(r.p < 0.5 for r in toxicity.score(df, none, name="p").collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], EMPTY)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert simhash.near_duplicates(none).count() == 0 and suffix_dedup.dedup(none).count() == 0
    assert packing.pack(packing.tokenize_pieces(none, public_tokenizers.path("word_bpe_49k.json"))).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0 and fingerprints.edited_fingerprints(none).count() == 0
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert lm.score(none, F.col("id") > 0).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.filter("length > 2048 or offset + length > 2048").count() == 0
    assert out.select("doc_id").distinct().count() > 150


def _extracted(spark, *htmls, url="http://h/"):
    df = spark.createDataFrame([(k, url, h) for k, h in enumerate(htmls)], "page_id long, url string, html string")
    return [r.text for r in sorted(html_extract.extract(df).collect(), key=lambda r: r.page_id)]


def test_html_keeps_blocks_beside_the_winning_container(spark):
    intro, body, other = "intro " * 50, "body " * 200, "other " * 800
    split = f"<body><ul><li><a href='/'>Start here</a></ul><article><h1>Head</h1><p>{intro}</p><section><p>{body}</p></section></article></body>"
    plain = f"<body><article><p>{other}</p><section><p>{'short ' * 16}</p></section></article></body>"
    figure = f"<body><article><p>{body}</p><figure><img src=x><figcaption>Caption</figcaption></figure><p><math><mi>E</mi></math> is</p></article></body>"
    got = _extracted(spark, split, split, split, plain, figure)
    assert got[0] == "\n".join(x.strip() for x in ("Head", intro, body))
    assert got[3] == f"{other.strip()}\n{('short ' * 16).strip()}"
    assert got[4] == f"{body.strip()}\nCaption\nE is"


def test_html_votes_of_the_host_decide(spark):
    """Equal markup: the text beside the winning container stays on the host whose pages have their own text there, and leaves
    on the host that repeats it; repeated boxes on the winning path leave, copies of a page do not repeat it."""
    body = [f"own{k} " * 60 for k in range(6)]
    page = lambda k, note: f"<body><article><p>{body[k]}</p></article><div class=x><p>{note}</p></div></body>"
    box = "all rights of this text belong to its owners " * 4
    rows = [(k, "http://fresh/", page(k, f"more of {k} " * 9 if k else box)) for k in range(5)]
    rows += [(10 + k, "http://stale/", page(k, box)) for k in range(5)]
    rows += [(20 + k, "http://twin/", page(0, box)) for k in range(5)]
    rows += [(30 + k, "http://plain/", f"<body><div><p>{box}</p></div><div><p>{body[k]}</p><p>{box}</p></div></body>") for k in range(5)]
    rows += [(40 + k, "http://few/", page(k, box)) for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    tidy = lambda *x: "\n".join(" ".join(t.split()) for t in x)
    assert all(got[k] == tidy(body[k], f"more of {k} " * 9 if k else box) for k in range(5))
    assert all(got[10 + k] == tidy(body[k]) for k in range(5))
    assert all(got[20 + k] == tidy(body[0], box) for k in range(5))
    assert all(got[30 + k] == tidy(body[k], box) for k in range(5))
    assert all(got[40 + k] == tidy(body[k], box) for k in range(2))


def test_html_nesting_takes_linear_time():
    for html in ("<div>x" * 100_000, "<div class=ad>x" * 50_000 + "<p>y", "<ul><li>x" * 50_000, "<p>x</div>" * 100_000):
        start = time.perf_counter()
        page = html_extract.blocks(html)
        assert html_extract.best_path(page) and time.perf_counter() - start < 10 and page.blocks


def test_html_noise_names_are_whole_and_wrappers_stay(spark):
    body = ("text " * 60).strip()
    for wrapper in ("class='layout has-sidebar'", "class='header-fixed wrapper'", "class='side-by-side'", "class='sidebar'", "id=header"):
        assert _extracted(spark, f"<body><div {wrapper}><article><p>{body}</p></article></div></body>") == [body]
        assert _extracted(spark, f"<body><div {wrapper}><div><p>{body}</p></div><div class='ad'>buy</div></div></body>") == [body]
        assert _extracted(spark, f"<body><form {wrapper}><main><p>{body}</p></main></form></body>") == [body]
    talk = "<div id=comments><article class=comment-body><p>" + "talk " * 200 + "</p></article></div>"
    assert _extracted(spark, f"<body><article><p>{body}</p></article>{talk}<div class='site-footer'><p>{body * 3}</p></div></body>") == [body]
    assert _extracted(spark, f"<body><div><p>{body}</p></div>{talk}<aside><article><p>teaser</p></article></aside></body>") == [body]


def test_toxicity_votes_follow_the_lexicon(spark):
    rng = random.Random(8)
    text = lambda: [f"word{rng.randrange(40)}" for _ in range(25)]
    rare = ["".join(rng.choice("bdgkmprstvz") for _ in range(8)) for _ in range(60)]
    rows = [(i, " ".join(text() + ([rare[i // 5 % 60]] if i % 5 == 0 else []))) for i in range(3000)]
    df = spark.createDataFrame(rows, EMPTY).repartition(4)
    labels = df.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    model = toxicity.train(df, labels, F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) != 0)
    assert len(model.marks) >= 50  # some share a beginning
    got = {r.doc_id: r.p >= 0.5 for r in toxicity.score(df, model, name="p").collect()}
    assert got == {i: i % 5 == 0 for i, _ in rows}  # each of 60 words marks 10 rows; some of them have no label


def test_suffix_dedup_frequent_anchors_meet_by_digest(spark):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    footer, page = noise(60), noise(260)
    rows = [(i, noise(150) + footer + noise(150) + (page[i % 7 * 20:] if i % 3 == 0 else "")) for i in range(120)]
    rows += [(200, "a" * 400), (201, "ba" * 150 + "a" * 300), (202, rows[3][1]), (203, "a" * 400)]
    seen, expected = set(), {}
    for i, t in rows:
        b, gone = t.encode(), bytearray(len(t))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        expected[i] = bytes(x for x, g in zip(b, gone) if not g)
    df = spark.createDataFrame([*rows, rows[5]], EMPTY).repartition(6)  # a repeated row is the same document
    texts = df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text")
    _, often = suffix_dedup._repeated_anchors(texts, 4, 100, 30)
    assert len(often) and set(often.tolist()) & set(suffix_dedup.gram_hashes(footer.encode(), suffix_dedup.K).tolist())
    for hot in (1, 30, suffix_dedup.HOT):
        assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup(df, hot=hot).collect()} == expected


def test_pipeline_spans_cut_whole_characters_only(spark):
    import corpus_pipeline
    rng = random.Random(10)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = noise(120)
    # the bytes of \u00e9 and \u00e8 share their first, those of \u00e9 and \u0129 their last
    rows = [(1, "x" + shared + "\u00e9 first", 0), (2, "\ufffd own " + shared + "\u00e8 end \ufffd", 0), (3, "\ufffd", 1), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_spans(spark, docs, None).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\ufffd own  end \ufffd", 12), 3: ("\ufffd", 1), 4: (None, None)}
    assert corpus_pipeline._without("a\u00e9b\u00e9c".encode(), [{"start": 2, "end": 5}]) == b"ac"


def test_suffix_dedup_sorts_contexts_some_ranges_at_a_time(spark):
    rng = random.Random(11)
    phrases = ["".join(rng.choice("abcdefgh ") for _ in range(260)) for _ in range(12)]
    rows = [(i, i * 7 - 50, " ".join(rng.sample(phrases, 4)) + f" {i}") for i in range(30)]
    texts = spark.createDataFrame(rows, "id long, h long, text string").coalesce(1)

    def starts(at_once):
        marks = suffix_dedup.repeated_starts(texts, 4, at_once=at_once).collect()
        return {r.id: {p for first, last in struct.iter_unpack("<ii", r.marks) for p in range(first, last + 1)} for r in marks}

    seen, expected = set(), {}
    for i, _, text in rows:
        own = [text[k:k + 100] for k in range(len(text) - 99)]
        for k, x in enumerate(own):
            if x in seen or x in own[:k]:
                expected.setdefault(i, set()).add(k)
        seen.update(own)
    assert starts(1) == starts(1 << 20) == expected


def test_language_model_reads_words_as_bytes_split_does():
    texts = [None, "", " a  B\x0bÉ\x1cx\xa0y\n", "\x85z  ", "\t", "new A b"]
    vocab = lm.Vocabulary({b"a": 0, b"": 1, b"b": 2}, np.array([0, 1, 2, 0]), np.zeros(4), 9, 3, np.zeros(lm.SYMBOLS), np.ones(lm.SYMBOLS))
    flat = [w for t in texts for w in [*(t or "").encode().lower().split(), b""]]
    for kind in (pa.string(), pa.large_string()):
        rare, ranks, symbols, starts = vocab.texts(pa.array(["cut off", *texts], kind)[1:])
        assert ranks.tolist() == [vocab.ranks.get(w, -1) for w in flat] and rare == [w for w in flat if w not in vocab.ranks]
        assert symbols.tolist() == [vocab.ranks.get(w, lm._group(w)) for w in flat]
        assert starts.tolist() == [0, 1, 2, 6, 8, 9]
