"""The pipeline's stages on planted cases, with columns named as the stages' own helpers."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lakekit.llm import simhash

OWN = ["__toxicity", "__row", "__spans", "__cuts", "__kept", "__n_bytes"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, say(60)) for i in range(80)] + [(200 + i, say(30) + " vile slur " + say(20)) for i in range(30)]
    rows += [(300, rows[0][1]), (301, rows[1][1] + " tail"), (302, say(40) + " " + " ".join(rows[2][1].split()[5:45])), (303, None),
             (304, ""), (3, rows[3][1])]
    item = say(14)
    rows += [(305, say(20) + " " + item + " " + say(10))]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(OWN):
        docs = docs.withColumn(name, F.lit(f"own{k}"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 0, int(200 <= i < 230)) for i in range(80)] + [(i, 0, 1) for i in range(200, 230)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, item, folder, spark.read.parquet(f"{folder}/documents.parquet")


def ids(df):
    got = df.select("doc_id", *OWN).collect()
    assert all(list(r)[1:] == [f"own{k}" for k in range(len(OWN))] for r in got)  # their values are the input's
    return Counter(r["doc_id"] for r in got)


def test_toxic_documents_go(spark, corpus):
    rows, _, folder, docs = corpus
    assert ids(P.drop_toxic(spark, docs, folder)) == Counter(i for i, t in rows if "slur" not in (t or ""))


def test_one_of_each_near_group_stays(spark, corpus):
    rows, _, folder, docs = corpus
    fps = [simhash.fingerprint((t or "").encode(), 3) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2 ** 64 - 1)).count("1") <= 3:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert ids(P.drop_near_duplicates(spark, docs, folder)) == Counter(min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in set(root))


def test_repeated_spans_leave_the_texts(spark, corpus):
    rows, _, folder, docs = corpus
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    seen, want = {}, []
    for k in order:
        own, i = (rows[k][1] or "").encode(), rows[k][0]
        gone = bytearray(len(own))
        for p in range(len(own) - 99):
            if seen.setdefault(own[p:p + 100], (i, p)) < (i, p):
                gone[p:p + 100] = b"\1" * 100
        want.append((i, bytes(b for b, g in zip(own, gone) if not g).decode()))
    out = P.drop_repeated_spans(spark, docs, folder)
    assert ids(out) == Counter(i for i, _ in rows)
    got = out.select("doc_id", "text", "n_chars").collect()
    assert Counter((r.doc_id, r.text or "") for r in got) == Counter(want)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)


def test_contaminated_documents_go(spark, corpus):
    rows, item, folder, docs = corpus
    words = item.split()
    bad = {i for i, t in rows if any(re.search(r"\b" + " ".join(words[k:k + 10]) + r"\b", t or "") for k in range(5))}
    assert bad == {305}
    assert ids(P.drop_contaminated(spark, docs, folder)) == Counter(i for i, _ in rows if i not in bad)


def test_empty_tables_pass_every_stage(spark, corpus):
    _, _, folder, docs = corpus
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_run_keeps_what_the_stages_keep(spark, corpus):
    rows, _, folder, docs = corpus
    out = P.run(spark, folder).collect()
    left = docs
    for name, stage in P.STAGES[:-1]:
        left = stage(spark, left, folder)
    assert {r.doc_id for r in out} == {r.doc_id for r in left.collect()}
    assert not {r.doc_id for r in out} & ({305, 300} | set(range(200, 230)))
    fill = Counter()
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
