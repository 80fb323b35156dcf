"""Ranked search, source mixing and the Merkle manifest against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakekit.llm import merkle, mixing, search
from lakekit.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans(merkle.UPPER, merkle.LOWER)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocab = ["Alpha", "beta", "gämma", "ÉTÉ", "x's", "9", "delta-e", "…", "zéta"] + [f"w{i}" for i in range(60)]
    out = []
    for i in range(150):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randrange(40)))
        out.append((i, rng.choice(["b", "a", "ä", None, "hot", "hot", "hot"]), rng.choice(["en", "en", "de", None]), len(text), text))
    out += [(200, "a", "en", None, None), (201, None, None, 0, ""), (202, "b", "xx", 9, "lone Leaf"), (5, *out[5][1:]), (5, *out[5][1:]),
            (None, "a", "de", 4, "NULL"), (203, "only", "en", 12, "word " * 30 + "\x0b\x1fend"), (204, "void", "en", 3, " \t\n")]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("row", "id", "tree", "pos", "digest", "total", "size", "key", "place", "target", "query", "term", "rank"):
        df = df.withColumn(name, F.lit("?"))
    return df


def terms_of(text):
    return [t.translate(LOW) for t in TERM.findall(text or "")]


def brute_search(rows, items, k):
    docs = [(r[0], Counter(terms_of(r[4]))) for r in rows]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in docs:
            m = 100 - 75 + 75 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms_of(text) if t in c)
            if score > 0:
                found.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found)[:k])]
    return Counter(out)


ITEMS = [(1, "alpha w1 W2 w3 w3 étÉ"), (2, None), (3, "…;"), (4, "unknown words"), (5, "w5 x 9 9 delta"), (5, "w5 x 9 9 delta"), (None, "null zéta")]


@pytest.mark.parametrize("block_bytes,seeds,width", [(1 << 20, 64, 1 << 16), (100, 1, 1 << 16), (1 << 20, 3, 16)])
def test_ranked_search(spark, rows, frame, block_bytes, seeds, width):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("query", F.lit("x")).withColumn("item", F.lit(1))
    index = search.build_index(frame, width=width)
    got = search.search(index, items, k=4, block_bytes=block_bytes, seeds=seeds)
    assert Counter(map(tuple, got.collect())) == brute_search(rows, ITEMS, 4)


def test_search_sketch_bounds_and_pieces(monkeypatch):
    text = " ".join(f"t{i % 97}" for i in range(5000)).encode()
    whole = search.term_counts(text)
    monkeypatch.setattr(search, "PIECE_BYTES", 7)
    assert search.term_counts(text) == whole == Counter(text.split())
    spots, maxima = search.sketch(whole, 100, 8)
    assert len(spots) == 2 * len(maxima) <= 16
    held = dict(zip(range(8), maxima))
    for t, n in whole.items():
        assert held[zlib.crc32(t) % 8] * search.STEP >= 10 ** 9 * n // (1000 * n + 800)


def test_search_long_text_and_empty(spark):
    docs = spark.createDataFrame([(1, "common " * 200_000 + "rare"), (2, "common rare"), (3, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "rare common")], "item_id long, text string")
    got = [(r.rank, r.id) for r in search.search(search.build_index(docs), items).collect()]
    assert sorted(got) == [(1, 2), (2, 1)]
    assert search.search(search.build_index(docs.limit(0)), items).collect() == []
    assert search.search(search.build_index(docs), items.limit(0)).collect() == []


def brute_mix(rows, share, repeats):
    sizes = [len(re.findall("[^\x20\x09-\x0d]+", r[4] or "")) for r in rows]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for r, n in zip(rows, sizes) if r[1] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    budget, fixed = Fraction(share) * sum(sizes), {}
    while True:
        free = [s for s in sources if s not in fixed]
        level = (budget - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > repeats * total[s]]
        if not over:
            break
        fixed |= {s: repeats * total[s] for s in over}
    target = {s: fixed[s] if s in fixed else weight[s] * level for s in sources}
    queue = []
    for place, s in enumerate(sources):
        own = sorted((hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, n, i)
                     for i, (r, n) in enumerate(zip(rows, sizes)) if r[1] == s and n)
        for turn in range(repeats):
            at = turn * total[s]
            for key, known, d, n, i in own:
                at += n
                queue.append((Fraction(at) / target[s], place, turn, key, known, d, n, i))
    taken, used = Counter(), 0
    for *_, n, i in sorted(queue):
        used += n
        if used > min(budget, repeats * sum(sizes)):
            break
        taken[i] += n
    return sizes, total, target, taken


@pytest.mark.parametrize("share,repeats", [(1.5, 2), (0.25, 2), (3.0, 2), (1.9, 3)])
def test_mixing(rows, frame, share, repeats):
    sizes, total, target, taken = brute_mix(rows, share, repeats)
    got = mixing.taken(frame, share=share, repeats=repeats)
    found = Counter((r.id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect())
    assert found == Counter((r[0], n, total[r[1]], round(float(target[r[1]]), 6), taken[i]) for i, (r, n) in enumerate(zip(rows, sizes)))
    per_source = Counter()
    for i, r in enumerate(rows):
        per_source[r[1]] += taken[i]
        assert taken[i] <= repeats * sizes[i]
    for s, n in per_source.items():
        assert abs(n - target[s]) <= 2 * max(sizes)
    if repeats == 3:  # reruns agree, however the rows are dealt
        assert Counter(map(tuple, mixing.taken(frame.repartition(3), share=share, repeats=repeats).collect())) == Counter(map(tuple, got.collect()))


def test_mixing_edge_tables(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (None, None, None)], "doc_id long, text string, source string")
    assert sorted((r.size, r.source_size, r.target, r.taken) for r in mixing.taken(df).collect()) == [(0, 0, 0.0, 0)] * 3
    assert mixing.taken(df.limit(0)).collect() == []
    plan = mixing.taken(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """Row by row: a whole tree with each leaf's siblings, then the whole tree anew with the leaf replaced."""
    def leaf(r, text):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], r[3], text)))

    def tree(nodes):
        levels = [nodes]
        while len(nodes) > 1:
            nodes = [sha(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
            levels.append(nodes)
        return levels

    def siblings(levels, at):
        out = []
        for nodes in levels[:-1]:
            first = at // 8 * 8
            out += nodes[first:at] + nodes[at + 1:first + 8]
            at //= 8
        return out

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4]), i) for i, r in enumerate(rows) if r[2] == x)) for x in langs}
    trees = {x: tree([n[2] for n in own[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = Counter()
    for g, x in enumerate(langs):
        for at, (_, _, digest, i) in enumerate(own[x]):
            r = rows[i]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            claimed = leaf(r, r[4].translate(LOW) if bad and r[4] is not None else r[4])
            nodes = [n[2] for n in own[x]]
            nodes[at] = claimed
            subroots = [trees[y][-1][0] for y in langs]
            subroots[g] = tree(nodes)[-1][0]
            proof = siblings(trees[x], at) + siblings(top, g)
            out[(r[0], digest, trees[x][-1][0], top[-1][0], sha(*proof), tree(subroots)[-1][0])] += 1
    return out


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(rows, frame, levels):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.proofs(merkle.leaves(frame, tampered=tampered), levels=levels)
    assert Counter(map(tuple, got.collect())) == brute_manifest(rows)


def test_manifest_many_groups_one_leaf_and_empty(spark):
    many = [(i, "s", f"l{i % 70}", 1, "A") for i in range(140)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    for rows in (many, many[:1], []):
        df = spark.createDataFrame(rows, SCHEMA)
        got = merkle.proofs(merkle.leaves(df, tampered=tampered), levels=1).collect()
        assert Counter(map(tuple, got)) == (brute_manifest(rows) if rows else Counter())


def test_parent_resumes_from_the_matching_state():
    kids = [sha(str(i)) for i in range(5)]
    parent = merkle.Parent("".join(kids).encode())
    assert parent.digest.decode() == sha(*kids) and len(parent.states) == 5
    for slot in range(5):
        other = kids[:slot] + [sha("new")] + kids[slot + 1:]
        assert parent.resumed(slot, sha("new").encode()).decode() == sha(*other)
        assert parent.siblings(slot).decode() == "".join(kids[:slot] + kids[slot + 1:])


@pytest.mark.parametrize("name,count", [("op11_ranked_search", None), ("op12_source_mixing", "documents"), ("op13_merkle_manifest", "documents")])
def test_queries_cover_whole_tables(spark, name, count):
    got = QUERIES[name](spark, SF_SMALL)
    n = got.count()
    assert n == spark.read.parquet(f"{SF_SMALL}/{count}.parquet").count() if count else n > 0
