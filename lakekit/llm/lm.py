"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

A text is its words (ASCII letters in lower case) and one end token.  The model gives
P(word | history) = P(class | history) P(symbol | class, history) P(word | symbol):

* a symbol is one of the ``HEAD`` most frequent training words or one of ``TAIL`` hash groups of all other words;
* classes are clusters of symbols that follow similar symbols (k-means on hashed left neighbours, counted over all
  training tokens), of at most ``MEMBERS`` symbols;
* P(class | history) is a softmax over hashed features: the previous symbol, the one before it (a skip feature) and both
  (an n-gram); its weights are trained by distributed gradient updates: each task takes mini-batch steps over its share
  of the training texts from the shared weights, and the results are averaged, by how often a feature was seen, in Spark;
* P(symbol | class, history) is a softmax over the members of the class, on the same features hashed with the class, and
  trained by the same updates; its bias is the logarithm of the members' smoothed counts;
* P(word | symbol) is a smoothed count over all training tokens; half a count per symbol or word, and one word more per
  group, leave room for unseen words.

Counts of all words come from Spark and are never collected: the most frequent ones, a bounded number, are broadcast, the
others meet the texts again by a join of each slice's distinct words.  Model tables have fixed sizes.

Defined results: null and empty texts are the end token alone; repeated rows are scored (and, if in the training part,
learned) each; without training texts every count is zero and the model is uniform over what it has; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, plan_bytes, utf8_values
from lakekit.session import cut_lineage

HEAD, TAIL = 4096, 64
#: classes and the greatest number of symbols in one; near the root of the symbols, so both softmaxes are short
CLASSES, MEMBERS = 64, 72
#: words whose counts are broadcast (a fixed bound)
KNOWN = 1 << 16
BUCKETS, BLOCK = 1 << 14, 1 << 10
SYMBOLS, NEIGHBOURS = HEAD + TAIL, 64
ROUNDS, BATCH, RATE = 2, 8192, 0.3
#: tokens whose softmax stays in a core's cache
CACHED = 1 << 10
#: of the plan's size, what one training task reads at least
TASK_BYTES = 8 << 20
END = b""  # no word is empty
#: texts of a group that meets the counts of its rare words
GROUP_BYTES = 8 << 20


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a string column (null as empty) in their order, as bytes, and how many each text has; no end tokens."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    there = pc.greater(pc.binary_length(flat), 0)  # white space at a border leaves an empty piece
    upto = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    flat = flat.filter(there)
    return flat.view(pa.large_binary() if pa.types.is_large_string(flat.type) else pa.binary()), np.diff(upto[offsets])


def _values(col: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls; ``to_pylist`` makes an Arrow scalar of each."""
    offsets = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_binary(col.type) else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].tolist()
    data = (col.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [data[a:b] for a, b in zip(offsets, offsets[1:])]


def _group(word: bytes) -> int:
    return HEAD + zlib.crc32(word) % TAIL


def _history(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before and the one before that; SYMBOLS at the start of a text."""
    one, two = np.roll(symbols, 1), np.roll(symbols, 2)
    one[starts] = two[starts] = SYMBOLS
    second = starts[starts + 1 < len(symbols)] + 1
    two[second[~np.isin(second, starts)]] = SYMBOLS
    return one, two


def _hashed(x: np.ndarray, salt: int) -> np.ndarray:
    h = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def features(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    return [_hashed(one, 1 << 40), _hashed(two, 2 << 40), _hashed(one.astype(np.int64) * (SYMBOLS + 1) + two, 3 << 40)]


def member_features(feats: list[np.ndarray], classes: np.ndarray) -> list[np.ndarray]:
    """The features of a softmax inside a class: each with the class."""
    return [_hashed(f * CLASSES + classes, (4 + k) << 40) for k, f in enumerate(feats)]


def logits(weights: np.ndarray, bias: np.ndarray, feats: list[np.ndarray], out: np.ndarray | None = None) -> np.ndarray:
    """By token and class (or member), the greatest of a token moved to zero."""
    z = weights.take(feats[0], axis=0, out=out, mode="clip")  # buckets are never out of range; the default mode copies ``out``
    z += weights.take(feats[1], axis=0)
    z += weights.take(feats[2], axis=0)
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def log_classes(weights: np.ndarray, bias: np.ndarray, feats: list[np.ndarray]) -> np.ndarray:
    z = logits(weights, bias, feats)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def log_chosen(weights: np.ndarray, bias: np.ndarray, feats: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """``log_classes`` of one class (or member) of each token."""
    z = logits(weights, bias, feats)
    own = z[np.arange(len(z)), chosen]
    return own - np.log(np.exp(z, out=z).sum(axis=1))


@dataclass
class Vocabulary:
    """Bounded tables: the most frequent words' ranks, their symbols and counts' log10; counts and distinct words by symbol."""

    ranks: dict[bytes, int]
    symbol_of: np.ndarray
    logs: np.ndarray
    total: int
    distinct: int
    by_symbol: np.ndarray
    words_in: np.ndarray

    @cached_property
    def known(self) -> pa.Array:
        return pa.array(list(self.ranks), pa.binary())

    def texts(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Of all tokens of a string column the ranks (-1: not among the most frequent) and symbols, starts of the texts; first
        the words of rank -1."""
        flat, sizes = words(texts)
        stops = np.cumsum(sizes + 1)
        is_end = np.zeros(int(stops[-1]) if len(stops) else 0, bool)
        is_end[stops - 1] = True
        ranks = np.empty(len(is_end), np.int64)
        ranks[~is_end] = pc.index_in(flat, self.known.cast(flat.type)).fill_null(-1).to_numpy()
        ranks[is_end] = self.ranks.get(END, -1)
        symbols = self.symbol_of[ranks]
        rare = np.empty(int((ranks < 0).sum()), object)
        rare[is_end[ranks < 0]] = END
        rare[~is_end[ranks < 0]] = _values(flat.take(pa.array(np.flatnonzero(ranks[~is_end] < 0))))
        symbols[ranks < 0] = [_group(w) for w in rare]
        return rare.tolist(), ranks, symbols, stops - sizes - 1


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary), n over ``docs`` (text), the end token among them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for part in byte_slices(batch, "text"):
                for data in utf8_values(part.column("text")):
                    seen.update([*data.lower().split(), END])
                if len(seen) > 300_000:
                    yield from rows(seen)
                    seen = Counter()
        yield from rows(seen)

    def rows(seen: Counter) -> Iterator[pa.RecordBatch]:
        keys = list(seen)
        for k in range(0, len(keys), 50_000):
            own = keys[k:k + 50_000]
            yield pa.record_batch([pa.array(own, pa.binary()), pa.array([seen[w] for w in own], pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a written table of word counts."""
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN).collect()
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    known = {bytes(r["word"]): r["n"] for r in top}
    head = list(known)[:HEAD]
    # the tail groups' totals: all words but the head, by the same hash in SQL
    rest = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in head], "word binary")), "word", "left_anti")
    tail = rest.groupBy(F.pmod(F.crc32("word"), F.lit(TAIL)).alias("g")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    by_symbol, words_in = np.zeros(SYMBOLS), np.ones(SYMBOLS)
    by_symbol[:len(head)] = [known[w] for w in head]
    words_in[HEAD:] = 0
    for r in tail:
        by_symbol[HEAD + r["g"]], words_in[HEAD + r["g"]] = r["n"], r["v"]
    # the last place is what a rank of -1 reads
    symbol_of = np.array([*range(len(head)), *[_group(w) for w in list(known)[HEAD:]], 0], np.int64)
    logs = np.array([*[np.log10(n + 0.5) for n in known.values()], 0.0])
    return Vocabulary({w: i for i, w in enumerate(known)}, symbol_of, logs, total["n"] or 0, total["v"], by_symbol, words_in)


def classes_of(docs: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Class by symbol: k-means on how often each hashed neighbour precedes it, beyond what its frequency explains."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SYMBOLS * NEIGHBOURS, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                _, _, symbols, starts = shared.value.texts(part.column("text"))
                one, _ = _history(symbols, starts)
                seen += np.bincount(symbols * NEIGHBOURS + _hashed(one, 1 << 40) % NEIGHBOURS, minlength=len(seen))
        at = np.flatnonzero(seen)
        for k in range(0, len(at), 100_000):
            yield pa.record_batch([pa.array(at[k:k + 100_000]), pa.array(seen[at[k:k + 100_000]])], ["cell", "n"])

    cells = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.full((SYMBOLS, NEIGHBOURS), 0.1)
    for r in cells:
        table.flat[r["cell"]] += r["n"]
    share, base = table / table.sum(axis=1, keepdims=True), table.sum(axis=0) / table.sum()
    points = np.log(share + base / 10) - np.log(base * 1.1)
    points /= np.linalg.norm(points, axis=1, keepdims=True) + 1e-9
    weight = np.sqrt(vocab.by_symbol + 1)
    centres = points[np.argsort(-vocab.by_symbol, kind="stable")[:CLASSES]].copy()
    for _ in range(15):
        own = (points @ centres.T).argmax(axis=1)
        for c in range(CLASSES):
            if (own == c).any():
                centres[c] = (points[own == c] * weight[own == c, None]).sum(axis=0)
                centres[c] /= np.linalg.norm(centres[c]) + 1e-9
    return _with_room(points @ centres.T, vocab.by_symbol)


def _with_room(likeness: np.ndarray, by_symbol: np.ndarray) -> np.ndarray:
    """Each symbol's likest class that has room, frequent symbols first."""
    own, room = np.zeros(SYMBOLS, np.int64), np.full(CLASSES, MEMBERS)
    for s in np.argsort(-by_symbol, kind="stable").tolist():
        own[s] = np.where(room > 0, likeness[s], -np.inf).argmax()
        room[own[s]] -= 1
    return own


def members(class_of: np.ndarray, by_symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each symbol in its class, and by class and place the logarithm of the smoothed count (-inf: no member)."""
    place, bias = np.zeros(SYMBOLS, np.int64), np.full((CLASSES, MEMBERS), -np.inf, np.float32)
    for c in range(CLASSES):
        own = np.flatnonzero(class_of == c)
        place[own] = np.arange(len(own))
        n = by_symbol[own] + 0.5
        bias[c, :len(own)] = np.log(n / n.sum())
    return place, bias


def _steps(weights: np.ndarray, seen: np.ndarray, bias: np.ndarray, feats: list[np.ndarray], target: np.ndarray,
           classes: np.ndarray | None = None) -> None:
    """Mini-batch gradient steps; a bucket moves by the mean gradient of the tokens that have it.  With ``classes``, ``bias``
    has a row for each."""
    for k in range(0, len(target), BATCH):
        own = [f[k:k + BATCH] for f in feats]
        y = target[k:k + BATCH]
        grad = np.empty((len(y), weights.shape[1]), np.float32)
        for j in range(0, len(y), CACHED):
            at = slice(j, j + CACHED)
            some = logits(weights, bias if classes is None else bias.take(classes[k:k + BATCH][at], axis=0), [f[at] for f in own], grad[at])
            np.exp(some, out=some)
            some /= some.sum(axis=1, keepdims=True)
        grad[np.arange(len(y)), y] -= 1
        for f in own:
            order = np.argsort(f.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
            ordered = f[order]
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            buckets, n = ordered[first], np.diff(first, append=len(f))
            move = _sums(grad, order, first, n)
            move *= (RATE / (n + 1.0)).astype(np.float32)[:, None]
            weights[buckets] = np.subtract(weights.take(buckets, axis=0), move, out=move)
            seen[buckets] += n


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the ``n`` rows at ``order`` from each ``first`` on: the k-th rows of all at once, the few long ones each at a time."""
    sums = rows.take(order[first], axis=0)
    k, left = 1, np.flatnonzero(n > 1)
    while len(left) > 64:
        sums[left] += rows.take(order[first[left] + k], axis=0)
        k += 1
        left = left[n[left] > k]
    for i in left.tolist():
        sums[i] += rows.take(order[first[i] + k:first[i] + n[i]], axis=0).sum(axis=0)
    return sums


@dataclass
class Model:
    """Classes, places in them, and the biases and weights of both softmaxes."""

    class_of: np.ndarray
    place: np.ndarray
    bias: np.ndarray
    member_bias: np.ndarray
    weights: np.ndarray
    member_weights: np.ndarray

    def log_symbols(self, one: np.ndarray, two: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """log P(symbol | history) of each token."""
        feats, classes = features(one, two), self.class_of[symbols]
        inside = log_chosen(self.member_weights, self.member_bias.take(classes, axis=0), member_features(feats, classes), self.place[symbols])
        return log_chosen(self.weights, self.bias, feats, classes) + inside

    def train(self, seen: np.ndarray, member_seen: np.ndarray, symbols: np.ndarray, starts: np.ndarray) -> None:
        """Gradient steps of both softmaxes; inside, a token's class is the only one that moves."""
        feats, classes = features(*_history(symbols, starts)), self.class_of[symbols]
        _steps(self.weights, seen, self.bias, feats, classes)
        _steps(self.member_weights, member_seen, self.member_bias, member_features(feats, classes), self.place[symbols], classes)


def untrained(vocab: Vocabulary, class_of: np.ndarray) -> Model:
    size = np.bincount(class_of, weights=vocab.by_symbol, minlength=CLASSES)
    bias = np.log((size + 0.5) / (size + 0.5).sum()).astype(np.float32)
    place, member_bias = members(class_of, vocab.by_symbol)
    return Model(class_of, place, bias, member_bias, np.zeros((BUCKETS, CLASSES), np.float32), np.zeros((BUCKETS, MEMBERS), np.float32))


def few_tasks(docs: DataFrame) -> DataFrame:
    """Small partitions read together: every task sends its weights, so tasks may grow in number with the input only."""
    size = plan_bytes(docs)
    return docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES + 1)) if size else docs


def train_weights(docs: DataFrame, fold: Column, vocab: Vocabulary, model: Model) -> Model:
    """``ROUNDS`` distributed updates, each over another part of the training texts (``fold``: its number)."""
    sc = docs.sparkSession.sparkContext
    words_of = sc.broadcast(vocab)
    for r in range(ROUNDS):
        now = sc.broadcast(model)

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start = now.value
            own = replace(start, weights=start.weights.copy(), member_weights=start.member_weights.copy())
            seen, member_seen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
            for batch in batches:
                for part in byte_slices(batch, "text"):
                    _, _, symbols, starts = words_of.value.texts(part.column("text"))
                    own.train(seen, member_seen, symbols, starts)
            task = TaskContext.get().partitionId()
            for first, table, times in ((0, own.weights, seen), (BUCKETS, own.member_weights, member_seen)):
                for b in range(0, BUCKETS, BLOCK):
                    n = times[b:b + BLOCK].astype(np.float32)
                    if n.any():
                        yield pa.record_batch([pa.array([first + b], pa.int32()), pa.array([task % 64], pa.int32()),
                                               pa.array([np.hstack([n[:, None], n[:, None] * table[b:b + BLOCK]]).tobytes()], pa.binary())],
                                              ["block", "lane", "x"])

        def add(table: pa.Table) -> pa.Table:
            total = 0.0
            for x in table.column("x"):
                total = total + np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
            return pa.table([table.column("block")[:1], table.column("lane")[:1], pa.array([total.astype(np.float32).tobytes()], pa.binary())],
                            ["block", "lane", "x"])

        schema = "block int, lane int, x binary"
        sent = few_tasks(docs.filter(F.pmod(fold, F.lit(ROUNDS)) == r).select("text")).mapInArrow(update, schema)
        sums = sent.groupBy("block", "lane").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
        model = replace(model, weights=model.weights.copy(), member_weights=model.member_weights.copy())
        for row in sums.collect():  # a fixed number of blocks
            total = np.frombuffer(row["x"], np.float32).reshape(BLOCK, -1)
            at = np.flatnonzero(total[:, 0])
            table = model.weights if row["block"] < BUCKETS else model.member_weights
            table[row["block"] % BUCKETS + at] = total[at, 1:] / total[at, :1]
    return model


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row.

    ``training``: a condition on the column ``id`` that admits a row to the training part.
    """
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", ~F.coalesce(training, F.lit(True)))
    learn = rows.filter("not held_out")
    counts = cut_lineage(word_counts(learn), "counts")
    vocab = vocabulary(counts)
    class_of = classes_of(learn, vocab)
    model = train_weights(learn, F.xxhash64("id", "text"), vocab, untrained(vocab, class_of))
    in_group = np.log10(vocab.by_symbol + 0.5 * (vocab.words_in + 1))  # of the tail; a head word is its symbol
    in_group[:HEAD] = 0
    floor = float(np.log10(vocab.total + 0.5 * (vocab.distinct + 1)))
    shared = docs.sparkSession.sparkContext.broadcast((vocab, model, in_group))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, trained, in_group = shared.value
        task, n_slice = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in byte_slices(batch, "text", GROUP_BYTES):
                rare_words, ranks, symbols, starts = vocab.texts(part.column("text"))
                one, two = _history(symbols, starts)
                gain = np.empty(len(symbols))
                for k in range(0, len(symbols), CACHED):
                    at = slice(k, k + CACHED)
                    s = symbols[at]
                    gain[at] = trained.log_symbols(one[at], two[at], s) / np.log(10) - in_group[s]
                logs = vocab.logs[ranks]  # 0 for a rank of -1, whose place is the last
                base = np.add.reduceat(logs, starts)
                # a word of a group of rare ones: its own count, where the broadcast ones have it
                model = np.add.reduceat(gain + np.where(symbols >= HEAD, logs, 0), starts)
                rare = np.flatnonzero(ranks < 0)
                index: dict[bytes, int] = {}
                ref = np.array([index.setdefault(w, len(index)) for w in rare_words], np.int32)
                refs = np.split(ref, np.searchsorted(rare, starts[1:]))
                lengths = np.diff(starts, append=len(ranks))
                g = (task << 24) + n_slice
                n_slice += 1
                n = len(starts)
                yield pa.record_batch([pa.array([g] * n), part.column("id"), part.column("held_out"),
                                       pa.array(lengths), pa.array(lengths - [len(x) for x in refs]), pa.array(base), pa.array(model),
                                       pa.array([x.tobytes() for x in refs], pa.binary()),
                                       pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32())], names)
                own = list(index)
                for k in range(0, len(own), 50_000):
                    some = own[k:k + 50_000]
                    m = len(some)
                    yield pa.record_batch([pa.array([g] * m), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()),
                                           pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                                           pa.nulls(m, pa.binary()), pa.array(some, pa.binary()),
                                           pa.array(range(k, k + m), pa.int32())], names)

    schema = ("g long, id long, held_out boolean, n_tokens long, found long, base double, model double, refs binary, "
              "word binary, idx int")
    names = [x.split(" ")[0] for x in schema.split(", ")]
    staged = cut_lineage(rows.mapInArrow(emit, schema), "scored")
    rare = staged.filter("idx is not null").select("g", "idx", "word").join(counts, "word", "left")
    rare = rare.select(F.col("g").alias("slice"), "idx", F.coalesce("n", F.lit(0)).alias("n"))
    texts = staged.filter("idx is null").drop("word", "idx")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        c = np.zeros(len(right) or 1, np.int64)
        c[right.column("idx").to_numpy()] = right.column("n").to_numpy()
        logs, is_known = np.log10(c + 0.5), c > 0
        refs = [np.frombuffer(x, np.int32) for x in left.column("refs").to_pylist()]
        rest = np.array([logs[x].sum() for x in refs])
        known = np.array([is_known[x].sum() for x in refs], np.int64)
        n = left.column("n_tokens").to_numpy()
        return pa.table([left.column("id"), left.column("held_out"), left.column("n_tokens"),
                         pa.array(left.column("found").to_numpy() + known, pa.int64()),
                         pa.array(left.column("base").to_numpy() + rest - n * floor, pa.float64()),
                         pa.array(left.column("model").to_numpy() + rest, pa.float64())], out)

    out = ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    done = texts.groupBy("g").cogroup(rare.groupBy("slice")).applyInArrow(
        finish, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return done.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                       F.lit(vocab.total).cast("long").alias("train_tokens"), "base_score", "score")
