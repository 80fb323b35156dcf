"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. Voters.  Words and word beginnings whose presence, or frequency, marks toxic rows are counted over all labelled rows.
   How many rows a mark needs follows from how many would reach it by chance; every toxic row then names its best two
   marks, and all that are named vote.  Pattern voters tell how many marks a text has, also for its length, and masked
   words.  A text's votes are the sorted list of the voters that fire on it; their number follows the lexicon.
2. Label model.  The counts of all vote sets, over all documents, feed an expectation maximisation that estimates how
   often each voter fires on toxic and on clean texts, and, as voters are correlated, on a tree of the strongest
   dependencies (each voter conditioned on one other).  Vote sets of labelled training rows are clamped to their labels.
   The sets stay in Spark: a round is a job over them that sums weights by voter pair; the driver sees those sums only.
3. Classifier.  A logistic regression on the votes is fitted to the posterior labels of all vote sets; it gives the score.

Only labels of rows that ``training`` admits are read.  Defined results: null and empty texts have no votes and get the
score of an empty vote set; labels without a document, or null, are ignored and repeated ones count once (the larger);
without any toxic label there are no voters and every score is the smoothed base rate, below one half; repeated rows are
scored alike; an empty table gives an empty result; other columns are never read for a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, give_back
from lakekit.session import cut_lineage

PATTERNS = ("two marks", "many marks", "very many marks", "masked word")
#: marks a word from which a text has many
DENSITY = 0.007
WORD = re.compile(r"\w+")
MASKED = re.compile(r"[*@#$](?<=\w.)[*@#$]+\w")
MIN_PRECISION = 0.9
#: rows that a mark needs at least, and the share of marks that may be there by chance at a number of rows
MIN_ROWS, CHANCE = 3, 0.1
#: words that a task remembers to have no mark (others are looked up again)
MEMO_WORDS = 100_000
#: distinct features that a task counts before it hands them on, and bytes of text that it decodes at a time
FLUSH_FEATURES, SLICE = 250_000, 1 << 20


@dataclass
class Model:
    """``marks``: words as they are, beginnings with a closing ``-``; with a ``%`` those that only vote if frequent."""

    marks: list[str]
    bias: float = -1.1
    weights: list[float] = field(default_factory=list)
    #: of the label model, by voter: rate of firing on toxic and on clean texts, and the voter it is conditioned on
    rates: list[tuple[float, float]] = field(default_factory=list)
    parents: list[int | None] = field(default_factory=list)

    def score(self, votes: list[int]) -> float:
        z = self.bias + sum(self.weights[i] for i in votes)
        return 1 / (1 + math.exp(-max(-500.0, z)))


def _voter(marks: list[str]):
    """A function from text to the sorted list of its votes."""
    bases: dict[str, list[tuple[int, bool]]] = {}
    for i, m in enumerate(marks):
        bases.setdefault(m.rstrip("%"), []).append((i, m.endswith("%")))
    lengths = sorted({len(b) - 1 for b in bases if b.endswith("-")})
    plain: set[str] = set()  # words that are no hit
    n = len(marks)

    def found(word: str) -> tuple[str, ...]:
        own = (word,) if word in bases else ()
        return own + tuple(b for k in lengths if k <= len(word) and (b := word[:k] + "-") in bases)

    def vote(text: str | None) -> list[int]:
        if not text:
            return []
        last = [n + 3] if MASKED.search(text) else []
        words = WORD.findall(text.lower())
        seen, hits = Counter(), 0
        count = Counter(words)
        for w in count.keys() - plain:
            if own := found(w):
                hits += count[w]
                for b in own:
                    seen[b] += count[w]
            elif len(plain) < MEMO_WORDS:
                plain.add(w)
        if not hits:
            return last
        dense = DENSITY * len(words)
        votes = sorted(i for b, k in seen.items() for i, often in bases[b] if k > (dense if often else 0))
        return votes + [n + j for j, on in enumerate((hits >= 2, hits > dense, hits > 2 * dense)) if on] + last
    return vote


def vote_sets(docs: DataFrame, marks: list[str]) -> DataFrame:
    """votes, n, y: the distinct vote sets of ``docs`` (text, y), how many rows have them and the sum of ``y``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vote = _voter(marks)
        for batch in batches:
            seen: dict[tuple[int, ...], list[int]] = {}
            for part in byte_slices(batch, "text", SLICE):
                for text, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                    own = seen.setdefault(tuple(vote(text)), [0, 0])
                    own[0] += 1
                    own[1] += y
            n, y = zip(*seen.values()) if seen else ((), ())
            yield pa.record_batch([pa.array([list(v) for v in seen], pa.list_(pa.int32())), pa.array(n, pa.int64()), pa.array(y, pa.int64())],
                                  ["votes", "n", "y"])
        del vote
        give_back()

    rows = docs.select("text", "y").mapInArrow(add, "votes array<int>, n long, y long")
    return rows.groupBy("votes").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))


@lru_cache(1 << 15)
def _beginnings(word: str) -> tuple[str, ...]:
    return tuple(word[:n] + "-" for n in range(3, min(8, len(word))))


def _features(text: str | None) -> set[str]:
    """Words, their beginnings (closed by ``-``) and, closed by ``%``, those of them that are frequent in the text."""
    words = WORD.findall((text or "").lower())
    count = Counter(words)
    own = set(count).union(*map(_beginnings, count))
    least = DENSITY * len(words)
    if least < 1:
        return own | {f + "%" for f in own}
    seen = Counter(count)
    for w, k in count.items():
        for b in _beginnings(w):
            seen[b] += k
    return own | {f + "%" for f, k in seen.items() if k > least}


def labelled_rows(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """text, y of the labelled training rows."""
    own = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("y"))
    own = own.filter("id is not null and y is not null").filter(training).groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    # the same plan at every size: a broadcast of small labels would say nothing of large ones
    return cut_lineage(texts.filter(training).join(own.hint("merge"), "id").select("text", "y"), "labelled")


def mine_marks(rows: DataFrame, toxic_share: float) -> list[str]:
    """Words and word beginnings of high precision that some toxic row of ``rows`` (text, y) names as one of its best two."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def rows_of() -> Iterator[pa.RecordBatch]:
            keys = chain(toxic, (x for x in clean if x not in toxic))
            while own := list(islice(keys, 50_000)):
                yield pa.record_batch([pa.array(own), pa.array([toxic[x] for x in own], pa.int64()),
                                       pa.array([clean[x] for x in own], pa.int64())], ["feature", "toxic", "clean"])

        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                for text, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                    (toxic if y else clean).update(_features(text))
                if len(toxic) + len(clean) > FLUSH_FEATURES:  # the sums are added up in Spark
                    yield from rows_of()
                    toxic.clear()
                    clean.clear()
        _beginnings.cache_clear()
        yield from rows_of()
        toxic.clear()
        clean.clear()
        give_back()

    counts = rows.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = cut_lineage(counts.filter(F.col("toxic") + F.col("clean") >= MIN_ROWS), "features")
    n, right = F.col("toxic") + F.col("clean"), F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))
    # marks of a kind by the number of rows that have them: how many are good, and how many would be by chance
    kind = F.regexp_extract("feature", "[-%]*$", 0)
    levels = counts.groupBy(kind.alias("kind"), n.alias("n")).agg(
        F.count(F.lit(1)).alias("features"), F.count(F.when(right, 1)).alias("good")).filter("good > 0").collect()
    least = dict.fromkeys(("", "-", "%", "-%"), MIN_ROWS)
    for r in levels:
        if r["features"] * toxic_share ** math.ceil(MIN_PRECISION * r["n"]) > CHANCE * r["good"]:
            least[r["kind"]] = max(least[r["kind"]], r["n"] + 1)
    enough = F.lit(False)
    for k, rows_needed in least.items():
        enough = enough | ((kind == k) & (F.col("toxic") >= rows_needed))
    good = counts.filter(right & enough)
    value = {r["feature"]: r["toxic"] - 5 * r["clean"] for r in good.collect()}  # as many as the lexicon has marks
    if not value:
        return []
    shared = rows.sparkSession.sparkContext.broadcast(value)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, named = shared.value, set()
        rank = lambda f: (value[f], "%" not in f, "-" not in f, len(f), f)
        base = lambda f: f.rstrip("%").rstrip("-")
        texts = (t for batch in batches for part in byte_slices(batch, "text", SLICE) for t in part.column("text").to_pylist())
        for text in texts:
            own = sorted((f for f in _features(text) if f in value), key=rank, reverse=True)
            # so that one voter's miss does not decide, the best one that is no part of the first, too
            named.update(own[:1])
            named.update([f for f in own[1:] if not base(f).startswith(base(own[0])) and not base(own[0]).startswith(base(f))][:1])
        _beginnings.cache_clear()  # a worker lives on after its task
        yield pa.record_batch([pa.array(sorted(named), pa.string())], ["feature"])
        give_back()

    return sorted(r["feature"] for r in rows.filter("y = 1").mapInArrow(name, "feature string").distinct().collect())


def _pair_sums(sets: DataFrame, v: int, weigh) -> list[np.ndarray]:
    """Sums over the vote sets by pair of voters, of two weights that ``weigh`` gives for (bits, n, ones, zeros).

    bits: sets x (voters and a last column of ones); the result is two symmetric matrices over these columns.
    """
    size = v + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size, size))
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                votes = part.column("votes").to_pylist()
                bits = np.zeros((len(votes), size), np.uint8)
                bits[:, v] = 1
                bits[np.repeat(np.arange(len(votes)), [len(x) for x in votes]), [i for x in votes for i in x]] = 1
                dense = bits.astype(float)
                for m, w in enumerate(weigh(bits, *(part.column(c).to_numpy().astype(float) for c in ("n", "ones", "zeros")))):
                    sums[m] += (dense * w[:, None]).T @ dense
        at = np.flatnonzero(np.triu(np.ones((size, size), bool)).ravel() & (sums != 0).any(axis=0).ravel())
        for k in range(0, len(at), 100_000):
            own = at[k:k + 100_000]
            yield pa.record_batch([pa.array(own), *(pa.array(s.ravel()[own]) for s in sums)], ["cell", "a", "b"])

    got = sets.mapInArrow(add, "cell long, a double, b double").groupBy("cell").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
    out = []
    for c in ("a", "b"):
        m = np.zeros(size * size)
        m[got.column("cell").to_numpy()] = got.column(c).to_numpy()
        m = m.reshape(size, size)
        out.append(m + np.triu(m, 1).T)
    return out


def _tree(sums: list[np.ndarray], least: float = 1e-3) -> list[int | None]:
    """For each voter the one it depends on most given the label: a maximum spanning forest of conditional mutual
    information, directed from lower to higher voters; ``sums`` by pair, of toxic and of clean rows."""
    v = len(sums[0]) - 1
    total = sums[0][v, v] + sums[1][v, v]
    info = np.zeros((v, v))
    for s in sums:
        n = s[v, v] + 1e-9
        p, both = s[:v, v] / n, s[:v, :v] / n
        for a in (0, 1):
            for b in (0, 1):
                pa_, pb = (p if a else 1 - p), (p if b else 1 - p)
                joint = both if a and b else p[:, None] - both if a else p[None, :] - both if b else 1 - p[:, None] - p[None, :] + both
                joint = np.clip(joint, 1e-12, None)
                info += n / total * joint * np.log(joint / np.clip(pa_[:, None] * pb[None, :], 1e-12, None))
    parents: list[int | None] = [None] * v
    if not v:
        return parents
    best, link, out = info[0].copy(), np.zeros(v, np.int64), np.zeros(v, bool)
    best[0], out[0] = -np.inf, True
    for _ in range(v - 1):
        j = int(best.argmax())
        parents[j] = int(link[j]) if best[j] > least else None
        best[j], out[j] = -np.inf, True
        nearer = ~out & (info[j] > best)
        best[nearer], link[nearer] = info[j][nearer], j
    return parents


def _posterior(parents: list[int | None], sums: list[np.ndarray]):
    """A function from bits to the probability of label 1, for the rates that ``sums`` by pair hold."""
    v = len(parents)
    table, up = np.zeros((v, 2, 2)), np.array([v if p is None else p for p in parents], np.int64)
    for i, p in enumerate(up):
        rates = []
        for s in sums:
            one = (s[i, p] + 0.05) / (s[p, p] + 0.5)  # column v is 1 in every set
            none = (s[i, i] - s[i, p] + 0.05) / (s[v, v] - s[p, p] + 0.5)
            rates.append((max(none, 1e-12), one))
        for value in (0, 1):
            r1, r0 = rates[0][value], rates[1][value]
            table[i, value] = np.log((1 - r1) / (1 - r0)), np.log(r1 / r0)
    start = np.log((sums[0][v, v] + 1) / (sums[1][v, v] + 1))

    def posterior(bits: np.ndarray) -> np.ndarray:
        logit = start + table[np.arange(v)[None, :], bits[:, up], bits[:, :v]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior


def fit_label_model(sets: DataFrame, v: int, rounds: int = 10, anchor: float = 25.0):
    """A function from (bits, n, ones, zeros) to the posterior probability of label 1; rates by voter; parents.

    sets: votes, n (documents), ones, zeros (labelled training rows, whose label is known); a labelled row counts as
    ``anchor`` others, so that the two classes stay those of the labels.
    """
    known = sets.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).first()
    prior = (anchor * known["ones"] + 0.5) / (anchor * (known["ones"] + known["zeros"]) + 1)

    def start(bits, n, ones, zeros):
        q = (anchor * ones + 0.1) / (anchor * (ones + zeros) + 0.2)
        return np.where(ones + zeros == 0, np.where(bits[:, :v].any(axis=1), 0.5, prior), q)

    def split(q):
        def weigh(bits, n, ones, zeros):
            free, p = np.clip(n - ones - zeros, 0, None), q(bits, n, ones, zeros)
            return anchor * ones + free * p, anchor * zeros + free * (1 - p)
        return weigh

    q, parents = start, None
    for _ in range(rounds):
        sums = _pair_sums(sets, v, split(q))
        parents = parents if parents is not None else _tree(sums)
        posterior = _posterior(parents, sums)
        q = lambda bits, n, ones, zeros, posterior=posterior: posterior(bits)
    sums = _pair_sums(sets, v, split(q))
    weigh = split(q)

    def target(bits, n, ones, zeros):
        w1, w0 = weigh(bits, n, ones, zeros)
        return w1 / np.clip(w1 + w0, 1e-9, None)

    rates = [((s[:v, v] + 0.05) / (s[v, v] + 0.5)).tolist() for s in sums]
    return target, list(zip(*rates)), parents


def fit_logistic(sets: DataFrame, v: int, target, ridge: float = 1.0, rounds: int = 60):
    """Bias and weights of a logistic regression on weighted soft labels (Newton steps, ridge on the weights)."""
    beta, penal = np.zeros(v + 1), np.diag([ridge] * v + [1e-6])
    for _ in range(rounds):
        def weigh(bits, n, ones, zeros, beta=beta.copy()):
            p = 1 / (1 + np.exp(-np.clip(bits @ beta, -30, 30)))
            return n * (target(bits, n, ones, zeros) - p), n * np.clip(p * (1 - p), 1e-6, None)

        grad, hess = _pair_sums(sets, v, weigh)
        step = np.linalg.solve(hess + penal, grad[:, v] - penal @ beta)
        beta += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return float(beta[v]), beta[:v].tolist()


def train(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """``training``: a condition on the column ``id`` that admits a label."""
    rows = labelled_rows(docs, labels, training, id_col, text_col, label_col).withColumn("y", (F.col("y") > 0).cast("int"))
    by_label = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    marks = mine_marks(rows, by_label[1] / sum(by_label.values())) if by_label.get(1) else []
    if not marks:
        rate = (by_label.get(1, 0) + 0.5) / (sum(by_label.values()) + 2)
        return Model([], float(np.log(rate / (1 - rate))))
    every = vote_sets(docs.select(docs[text_col].cast("string").alias("text"), F.lit(0).alias("y")), marks)
    known = vote_sets(rows, marks)
    none = F.lit(0).cast("long")
    both = every.select("votes", "n", none.alias("ones"), none.alias("zeros")).unionByName(
        known.select("votes", none.alias("n"), F.col("y").alias("ones"), (F.col("n") - F.col("y")).alias("zeros")))
    sets = cut_lineage(both.groupBy("votes").agg(*[F.sum(c).alias(c) for c in ("n", "ones", "zeros")]), "votes")
    v = len(marks) + len(PATTERNS)
    target, rates, parents = fit_label_model(sets, v)
    bias, weights = fit_logistic(sets, v, target)
    return Model(marks, bias, weights, rates, parents)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and its score (0 to 1)."""
    docs = docs.drop(name)
    own = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        vote = _voter(model.marks) if model.marks else lambda text: []
        for batch in batches:
            for part in byte_slices(batch, text_col, SLICE):
                scores = [model.score(vote(t)) for t in part.column(text_col).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(scores, pa.float64())], [*own, name])
        del vote
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"
    return docs.mapInArrow(add, schema)
