"""Suffix-array dedup by a common-prefix-aware distributed merge sort.

Every byte that belongs to a ``length``-byte string which starts earlier too (in an earlier document, or earlier in the
same one) is removed; strings are judged on the input.  The steps:

1. Texts that are whole copies of an earlier text are settled by their digest and count once in what follows.
2. Each string is represented by its anchor, the ``K``-byte gram of least hash in it, so equal strings have equal anchors
   at equal places.  Anchors whose hash occurs once in all documents start no repeated string and are left out.  Each
   task sends one anchor per hash at most, in blocks, so a frequent gram does not gather its occurrences anywhere.
3. The suffixes at the remaining anchors are sorted: tasks sort their own into runs (merging equal contexts), deal the
   runs by prefix ranges and exchange them front-coded; a loser tree combines the runs of a range and compares only
   beyond the prefix that two heads are known to share with the last winner.
4. Neighbours that share ``K`` bytes form a class.  In it the strings around each anchor are compared exactly, and all
   but the earliest start of each string are marked.
5. Anchors whose hash occurs more than ``HOT`` times do not meet in a class: tasks keep the earliest start of each of
   their strings, by its 128-bit digest, and these meet by digest.

Documents are ordered by id (null ids last), equal ids by a hash of their text; rows with equal id and equal text are one
document and get the same result.  Null is the empty text; texts shorter than ``length`` lose nothing unless nothing
repeats in them by definition; an empty table gives an empty result; further columns are ignored.  The input is read more
than once, so it must be re-readable (a table).
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices, give_back, input_partitions, utf8_values
from lakekit.session import cut_lineage

LENGTH = 100
K = 32
#: bound of the sampled prefixes that cut the suffix order into ranges (rows)
SAMPLE = 20_000
#: occurrences of an anchor up to which its class is resolved in one task, and strings a task holds before it sends them
HOT, HELD = 4096, 400_000
#: anchors whose contexts a task sorts at a time (whole ranges)
SORTED = 1 << 15
_P = 0x9E3779B97F4A7C15
_ENTRY = struct.Struct("<BBBqqiii")  # shared prefix, rest, left length; document, its hash, anchor, first, last start
_MARK = struct.Struct("<ii")
LAST = (1 << 63) - 1


def gram_hashes(data: bytes, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k``-byte gram, by doubling."""
    n, cur, width, acc, got = len(data), np.frombuffer(data, np.uint8).astype(np.uint64) * np.uint64(_P) + np.uint64(1), 1, None, 0
    while True:
        if k & width:
            if acc is None:
                acc, got = cur, width
            else:
                m = n - got - width + 1
                acc, got = acc[:m] * np.uint64(pow(_P, width, 1 << 64)) + cur[got:got + m], got + width
        if width * 2 > k:
            break
        m = n - 2 * width + 1
        cur, width = cur[:m] * np.uint64(pow(_P, width, 1 << 64)) + cur[width:width + m], width * 2
    acc = acc ^ (acc >> np.uint64(31))
    acc = acc * np.uint64(0xD6E8FEB86659FD93)
    return acc ^ (acc >> np.uint64(32))


def anchors(data: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, place, first and last start of the strings that each anchor represents."""
    least = gram_hashes(data, k)
    hashes, at, width, need = least, np.arange(len(least)), 1, length - k + 1
    while width < need:
        step = min(width, need - width)
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return hashes[at[first]], at[first], first, last


def squeeze(data: bytes) -> bytes:
    """Compressed, with the length before it."""
    return struct.pack("<q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], struct.unpack_from("<q", data)[0], codec="zstd", asbytes=True)


def squeeze_rows(x: np.ndarray) -> bytes:
    """Records by byte planes, so that high bytes, which are mostly zero, lie together."""
    return squeeze(np.frombuffer(x.tobytes(), np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes())


def unsqueeze_rows(data: bytes, kind: np.dtype) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), np.uint8).reshape(kind.itemsize, -1)
    return np.frombuffer(planes.T.tobytes(), kind)


def _of_documents(ids: np.ndarray, hs: np.ndarray, parts: int) -> np.ndarray:
    """The part that a document's places are gathered in."""
    mixed = (ids.astype(np.uint64) * np.uint64(_P)) ^ hs.astype(np.uint64)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def _gathered(blocks: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """id, h, marks (``fields``, 32-bit each): a row a document from blocks (part, x) that hold many documents' places.

    A task that found places of many documents sends a block a part instead of a row a document.
    """
    kind = np.dtype([("id", "<i8"), ("h", "<i8"), *((f, "<i4") for f in fields)])
    place = np.dtype([(f, "<i4") for f in fields])

    def gather(table: pa.Table) -> pa.Table:
        x = np.concatenate([unsqueeze_rows(b, kind) for b in table.column("x").to_pylist()])
        x = x[np.lexsort((x["h"], x["id"]))]
        start = np.flatnonzero(np.concatenate(([True], (np.diff(x["id"]) != 0) | (np.diff(x["h"]) != 0))))
        marks = np.empty(len(x), place)
        for f in fields:
            marks[f] = x[f]
        return pa.table([pa.array(x["id"][start]), pa.array(x["h"][start]),
                         pa.array([m.tobytes() for m in np.split(marks, start[1:])], pa.binary())], ["id", "h", "marks"])

    return blocks.groupBy("part").applyInArrow(gather, "id long, h long, marks binary")


def _dealt(x: np.ndarray, parts: int) -> pa.Table:
    """part, x: the rows of ``x`` (with id and h) in a block for each part."""
    part = _of_documents(x["id"], x["h"], parts)
    order = np.argsort(part, kind="stable")
    x, part = x[order], part[order]
    start = np.flatnonzero(np.concatenate(([True], np.diff(part) != 0))) if len(x) else np.empty(0, np.int64)
    return pa.table([pa.array(part[start], pa.int64()), pa.array([squeeze_rows(b) for b in np.split(x, start[1:])] if len(x) else [], pa.binary())],
                    ["part", "x"])


def _repeated_anchors(texts: DataFrame, parts: int, length: int, hot: int = HOT) -> tuple[DataFrame, np.ndarray]:
    """id, h, marks: anchors (place, first, last: 32-bit) whose hash occurs again; and the sorted hashes that occur more
    than ``hot`` times.  texts: id, h, text."""
    kind = np.dtype([("hash", "<u8"), ("id", "<i8"), ("h", "<i8"), ("at", "<i4"), ("back", "<i4"), ("more", "<i4"), ("n", "<i4")])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple, np.ndarray] = {}  # by text: of the copies in a task the first one stands for all
        for part in (part for batch in batches for part in byte_slices(batch, "text")):
            for i, h, data in zip(part.column("id").to_pylist(), part.column("h").to_pylist(), utf8_values(part.column("text"))):
                if len(data) < length:
                    continue
                text = (h, len(data), hash(data))
                if text in own:
                    own[text]["id"] = min(i, int(own[text]["id"][0]))
                    continue
                hashes, at, first, last = anchors(data, length)
                x = np.empty(len(at), kind)
                x["hash"], x["id"], x["h"], x["at"], x["back"], x["more"], x["n"] = hashes, i, h, at, at - first, last - first, 1
                own[text] = x
        if not own:
            return
        x = np.concatenate(list(own.values()))
        own.clear()
        x = x[np.argsort(x["hash"], kind="stable")]
        _, start, count = np.unique(x["hash"], return_index=True, return_counts=True)
        again = np.repeat(count > 1, count)
        one = x[start]  # one of each hash meets those of other tasks
        one["n"] = count
        bucket = (one["hash"] % np.uint64(parts)).astype(np.int64)
        known = count > 1
        order = np.lexsort((known, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order] * 2 + known[order])) + 1
        rest = x[again]
        del x, start, again
        for part in np.split(order, cuts):
            yield block(int(bucket[part[0]]), 1 if known[part[0]] else 0, one[part])
        del one, order, bucket, known
        rest = rest[np.argsort(rest["id"], kind="stable")]
        for j, part in enumerate(np.array_split(rest, max(1, len(rest) >> 14))):
            yield block((len(rest) + j * 7919) % parts, 2, part)
        del rest, part
        give_back()

    def block(bucket: int, sort: int, x: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([bucket]), pa.array([sort], pa.int32()), pa.array([squeeze_rows(x)], pa.binary())], ["b", "kind", "x"])

    def confirm(table: pa.Table) -> pa.Table:
        blocks = [(s, unsqueeze_rows(x, kind)) for s, x in zip(table.column("kind").to_pylist(), table.column("x").to_pylist())]
        parts_, often = [x for s, x in blocks if s < 2], np.empty(0, np.uint64)
        known = [np.full(len(x), s == 1) for s, x in blocks if s < 2]
        found = [x for s, x in blocks if s == 2]
        if parts_:
            x, k = np.concatenate(parts_), np.concatenate(known)
            order = np.lexsort((x["at"], x["h"], x["hash"]))
            x, k = x[order], k[order]
            _, start, inverse = np.unique(x["hash"], return_index=True, return_inverse=True)
            # copies of a text share its hash and the place; another place or text, or a task that knows one, repeats
            other = np.concatenate(([False], (np.diff(x["hash"]) == 0) & ((np.diff(x["h"]) != 0) | (np.diff(x["at"]) != 0))))
            again = np.logical_or.reduceat(other | k, start)[inverse]
            often = x["hash"][start][np.add.reduceat(x["n"].astype(np.int64), start) > hot]
            found.append(x[again & ~k])  # those known to repeat are among the others already
        out = np.concatenate(found) if found else np.empty(0, kind)
        places = np.empty(len(out), [("id", "<i8"), ("h", "<i8"), ("at", "<i4"), ("first", "<i4"), ("last", "<i4")])
        places["id"], places["h"], places["at"] = out["id"], out["h"], out["at"]
        places["first"] = out["at"] - out["back"]
        places["last"] = places["first"] + out["more"]
        sent = _dealt(places, parts)
        if len(often):
            sent = pa.concat_tables([sent, pa.table([pa.array([-1], pa.int64()), pa.array([often.tobytes()], pa.binary())], ["part", "x"])])
        return sent

    rows = texts.mapInArrow(emit, "b long, kind int, x binary")
    sent = cut_lineage(rows.groupBy("b").applyInArrow(confirm, "part long, x binary"), "anchors")
    # at most one hash in ``hot`` anchors
    often = [np.frombuffer(r["x"], np.uint64) for r in sent.filter("part < 0").collect()]
    return _gathered(sent.filter("part >= 0"), ("at", "first", "last")), np.sort(np.concatenate([np.empty(0, np.uint64), *often]))


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, hi = start, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def encode_run(entries: list[tuple]) -> bytes:
    """Front-coded: each entry holds only what follows the prefix that it shares with the one before."""
    out, before = [], b""
    for right, left, i, h, at, first, last in entries:
        same = shared_prefix(before, right)
        out.append(_ENTRY.pack(same, len(right) - same, len(left), i, h, at, first, last) + right[same:] + left)
        before = right
    return b"".join(out)


def decode_run(run: bytes) -> Iterator[tuple[int, tuple]]:
    """(prefix shared with the entry before, entry)."""
    pos, right = 0, b""
    while pos < len(run):
        same, rest, n_left, *place = _ENTRY.unpack_from(run, pos)
        pos += _ENTRY.size
        right = right[:same] + run[pos:pos + rest]
        left = run[pos + rest:pos + rest + n_left]
        pos += rest + n_left
        yield same, (right, left, *place)


def merge_runs(runs: list[bytes]) -> Iterator[tuple[int, tuple]]:
    """(prefix shared with the entry before, entry) of all runs in order, by a loser tree.

    Each head carries the prefix that it shares with the last winner.  Of two heads the one that shares more is smaller,
    as both follow the last winner; only heads that share the same length are compared, and only beyond it.  The prefix
    that a loser shares with its winner is what it will be compared by next.
    """
    sources = [decode_run(r) for r in runs]
    size = 1
    while size < len(sources):
        size *= 2
    heads: list[tuple | None] = [None] * size
    known = [0] * size
    for i, s in enumerate(sources):
        if (x := next(s, None)) is not None:
            heads[i] = x[1]
    losers = [-1] * size

    def duel(a: int, b: int) -> tuple[int, int]:
        """Winner, loser; the loser's known prefix becomes the one shared with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = shared_prefix(x[0], y[0], known[a])
        if (x[0][n:n + 1], x[0] == y[0] and x[1]) <= (y[0][n:n + 1], x[0] == y[0] and y[1]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    winners = list(range(size))
    level = size
    while level > 1:  # the first winner, from the leaves up
        level //= 2
        nxt = []
        for j in range(level):
            w, lost = duel(winners[2 * j], winners[2 * j + 1])
            losers[level + j] = lost
            nxt.append(w)
        winners = nxt
    top, same = winners[0], 0
    while heads[top] is not None:
        yield same, heads[top]
        x = next(sources[top], None)
        heads[top], known[top] = (None, 0) if x is None else (x[1], x[0])
        node, cur = (size + top) // 2, top
        while node >= 1:
            w, lost = duel(cur, losers[node])
            losers[node], cur = lost, w
            node //= 2
        top, same = cur, known[cur]


def _resolve(group: list[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(document, hash, first, last start) of the strings in a class that start earlier too."""
    if len(group) < 2:
        return
    least: dict[tuple, tuple] = {}
    for right, left, i, h, at, first, last in group:  # equal contexts: the earliest stands for the others
        key, place = (right, left, at - first, at - last), (i, h, at)
        if key not in least or place < least[key]:
            least[key] = place
    earliest: dict[bytes, tuple] = {}
    strings = []
    for (right, left, a, b), (i, h, at) in least.items():
        whole, n = left + right, len(left)
        own = [whole[n - o:n - o + length] for o in range(a, b - 1, -1)]
        strings.append((i, h, at - a, own))
        for k, s in enumerate(own):
            place = (i, h, at - a + k)
            if s not in earliest or place < earliest[s]:
                earliest[s] = place
    for right, left, i, h, at, first, last in group:
        if least[(right, left, at - first, at - last)] != (i, h, at):
            yield i, h, first, last
    for i, h, first, own in strings:
        start = None
        for k, s in enumerate(own):
            if earliest[s] != (i, h, first + k):
                start = first + k if start is None else start
            elif start is not None:
                yield i, h, start, first + k - 1
                start = None
        if start is not None:
            yield i, h, start, first + len(own) - 1


def repeated_starts(texts: DataFrame, parts: int, length: int = LENGTH, hot: int = HOT, at_once: int = SORTED) -> DataFrame:
    """id, h, marks (pairs of first and last start of repeated strings); texts: id, h, text."""
    prefix = F.expr(f"substring(text, 1 + cast(pmod(xxhash64(h, id), length(text)) as int), {K})").alias("s")
    prefixes = (texts.filter(F.octet_length("text") >= length).select(F.xxhash64("h", "id").alias("o"), prefix)
                .orderBy("o").limit(SAMPLE).collect())
    sample = sorted(r["s"].encode()[:K] for r in prefixes)  # a bounded, documented sample of prefixes
    splits = sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []
    found, often = _repeated_anchors(texts, parts, length, hot)
    both = texts.join(found, ["id", "h"])
    place = np.dtype([("at", "<i4"), ("first", "<i4"), ("last", "<i4")])
    found_kind = np.dtype([("id", "<i8"), ("h", "<i8"), ("first", "<i4"), ("last", "<i4")])
    anchor_kind = np.dtype([("t", "<i4"), ("p", "<i4"), ("at", "<i4"), ("first", "<i4"), ("last", "<i4")])
    string_kind = np.dtype([("d0", "<u8"), ("d1", "<u8"), ("id", "<i8"), ("h", "<i8"), ("at", "<i4")])

    def message(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], ["p", "kind", "x"])

    def dealt_strings(earliest: dict[bytes, tuple]) -> list[tuple]:
        x = np.empty(len(earliest), string_kind)
        digests = np.frombuffer(b"".join(earliest), np.uint64).reshape(-1, 2)
        x["d0"], x["d1"] = digests[:, 0], digests[:, 1]
        x["id"], x["h"], x["at"] = np.array(list(earliest.values()), np.int64).reshape(-1, 3).T
        p = (x["d0"] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(p, kind="stable")
        return [(int(p[o[0]]), 2, squeeze_rows(x[o])) for o in np.split(order, np.flatnonzero(np.diff(p[order])) + 1) if len(o)]

    def in_order(texts: list[tuple], anchor: np.ndarray, later: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
        """A run of each range of these anchors, whose ranges are whole; later equal contexts are settled in ``later``."""
        least: dict[tuple, tuple] = {}
        done: list[tuple] = []
        for t, _, at, first, last in anchor.tolist():
            i, h, data = texts[t]
            key = (data[at:first + length + (last - first)], data[first:at], at - last)
            mine, other = (i, h, at, first, last), least.get(key)
            if other is None:
                least[key] = mine
            elif mine[:3] != other[:3]:  # an equal context in this task: the later one is settled
                if mine[:3] < other[:3]:
                    least[key], mine = mine, other
                done.append((*mine[:2], *mine[3:]))
        later.append(np.array(done, found_kind))
        dealt = defaultdict(list)
        for e in sorted((right, left, *own) for (right, left, _), own in least.items()):
            dealt[bisect_right(splits, e[0][:K])].append(e)
        for p, x in dealt.items():
            yield p, 0, squeeze(encode_run(x))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 8 << 20):
                texts = list(zip(part.column("id").to_pylist(), part.column("h").to_pylist(), utf8_values(part.column("text"))))
                done = defaultdict(list)
                earliest: dict[bytes, tuple] = {}  # of strings at frequent anchors
                found_here = [np.empty(0, anchor_kind)]
                for t, ((i, h, data), blob) in enumerate(zip(texts, part.column("marks").to_pylist())):
                    own = np.sort(np.frombuffer(blob, place))
                    frequent = np.isin(gram_hashes(data, K)[own["at"]], often) if len(often) else np.zeros(len(own), bool)
                    for at, first, last in own[frequent].tolist():
                        for k in range(first, last + 1):
                            digest, mine = hashlib.blake2b(data[k:k + length], digest_size=16).digest(), (i, h, k)
                            other = earliest.setdefault(digest, mine)
                            if mine < other:
                                earliest[digest], mine, other = mine, other, mine
                            if mine != other:  # an equal string in this task: the later one is settled
                                spans = done[mine[:2]]
                                if spans and spans[-1][1] == mine[2] - 1:
                                    spans[-1] = (spans[-1][0], mine[2])
                                else:
                                    spans.append((mine[2], mine[2]))
                    if len(earliest) >= HELD:
                        yield message(dealt_strings(earliest))
                        earliest = {}
                    x = np.empty(int((~frequent).sum()), anchor_kind)
                    x["t"], x["at"], x["first"], x["last"] = t, *(own[~frequent][f] for f in ("at", "first", "last"))
                    x["p"] = [bisect_right(splits, data[at:at + K]) for at in x["at"].tolist()]
                    found_here.append(x)
                settled = [np.array([(*d, *span) for d, spans in done.items() for span in spans], found_kind)]
                # contexts are copies of the text: those of some ranges at a time
                x = np.concatenate(found_here)
                x = x[np.argsort(x["p"], kind="stable")]
                starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(x)), bool), np.diff(x["p"]) != 0)))
                many = np.flatnonzero(np.diff(starts // at_once)) + 1
                out = [m for some in np.split(x, starts[many]) for m in in_order(texts, some, settled)]
                rest = np.concatenate(settled)
                to = np.mod(rest["h"] + rest["id"], parts)
                order = np.argsort(to, kind="stable")
                out += [(int(to[o[0]]), 1, squeeze_rows(rest[o])) for o in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(o)]
                out += dealt_strings(earliest)
                if out:
                    yield message(out)
        give_back()

    def combine(table: pa.Table) -> pa.Table:
        own = list(zip(table.column("kind").to_pylist(), table.column("x").to_pylist()))
        known = [unsqueeze_rows(x, found_kind) for kind, x in own if kind == 1]
        strings = [unsqueeze_rows(x, string_kind) for kind, x in own if kind == 2]
        if strings:
            x = np.concatenate(strings)
            x = x[np.lexsort((x["at"], x["h"], x["id"], x["d1"], x["d0"]))]
            new = np.concatenate(([True], (np.diff(x["d0"]) != 0) | (np.diff(x["d1"]) != 0)))
            least = x[np.flatnonzero(new)[np.cumsum(new) - 1]]  # by string; a repeated row has it at the same place
            x = x[(x["id"] != least["id"]) | (x["h"] != least["h"]) | (x["at"] != least["at"])]
            later = np.empty(len(x), found_kind)
            later["id"], later["h"], later["first"], later["last"] = x["id"], x["h"], x["at"], x["at"]
            known.append(later)
        group: list[tuple] = []
        marks: list[tuple] = []
        for same, e in merge_runs([unsqueeze(x) for kind, x in own if not kind]):
            if same < K:
                marks += _resolve(group, length)
                group.clear()
            group.append(e)
            if len(marks) >= 1 << 16:
                known.append(np.array(marks, found_kind))
                marks.clear()
        marks += _resolve(group, length)
        return _dealt(np.concatenate([*known, np.array(marks, found_kind)]), parts)

    sent = both.mapInArrow(runs, "p long, kind int, x binary")
    return _gathered(sent.groupBy("p").applyInArrow(combine, "part long, x binary"), ("first", "last"))


def spans_of(marks: bytes, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal byte spans covered by strings that start at the marked places."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(_MARK.iter_unpack(marks)):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + length))
        else:
            out.append((first, last + length))
    return out


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: tuple[str, ...] = (),
          prefix: str = "", hot: int = HOT) -> DataFrame:
    """``id_col``, the columns ``keep``, n_bytes, spans (removed byte spans, maximal) and kept (the other bytes); the last
    three with ``prefix`` before their names."""
    key = F.coalesce(docs[id_col].cast("long"), F.lit(LAST))
    base = docs.select(docs[id_col].alias("__id"), *[docs[c].alias(f"__keep_{c}") for c in keep], key.alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = base.withColumn("h", F.xxhash64("text")).withColumn("digest", F.sha2("text", 256))
    firsts = cut_lineage(rows.groupBy("digest").agg(F.min("id").alias("id")), "firsts")
    settled = (rows.select("id", "h", "digest").join(firsts.withColumnRenamed("id", "least"), "digest")
               .filter("id > least").select("id", "h").distinct().withColumn("copy", F.lit(True)))
    parts = input_partitions(docs.select(text_col), 8 << 20)
    marks = repeated_starts(rows.select("id", "h", "text"), parts, length, hot)
    known = cut_lineage(marks.join(settled, ["id", "h"], "full"), "marks")  # small, so the texts are shuffled once for it
    own = rows.join(known, ["id", "h"], "left")
    names = ["__id", *[f"__keep_{c}" for c in keep]]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in byte_slices(batch, "text"):
                sizes, spans, kept = [], [], []
                for data, blob, copy in zip(utf8_values(part.column("text")), part.column("marks").to_pylist(), part.column("copy").to_pylist()):
                    own = [(0, len(data))] if copy and len(data) >= length else spans_of(blob or b"", length)
                    left, at = [], 0
                    for a, b in own:
                        left.append(data[at:a])
                        at = b
                    sizes.append(len(data))
                    spans.append([{"start": a, "end": b} for a, b in own])
                    kept.append(b"".join(left) + data[at:])
                yield pa.record_batch([*(part.column(c) for c in names), pa.array(sizes, pa.int64()), pa.array(spans, span),
                                       pa.array(kept, pa.binary())], [*names, "n_bytes", "spans", "kept"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name in names)
    out = own.select(*names, "text", "marks", "copy").mapInArrow(
        cut, schema + "n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary")
    ids = [] if id_col in keep else [F.col("__id").alias(id_col)]
    return out.select(*ids, *[F.col(f"__keep_{c}").alias(c) for c in keep],
                      *[F.col(c).alias(prefix + c) for c in ("n_bytes", "spans", "kept")])

