"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep copied hash states.

Each row is a leaf, the digest of its fields.  The leaves of a group (in id order) form a tree of ``FAN`` children a
parent, the groups' roots (in group order) another one.  A parent hashes its children one after the other and keeps a copy
of the hash state before each child's slot.  To fold a changed leaf up, each parent on its path resumes the state before
the matching slot with the replacement and the siblings to the right; what is to the left is not hashed again.

Leaves are dealt into blocks of ``FAN ** levels`` neighbours, each built in one task; the blocks' roots are the nodes of
the next round, so a group of any size is built in a few rounds.  The path above a block is the same for all its leaves:
it is carried down round by round, and its states are made once a block.

Defined results: a null field is ``-``, any other its UTF-8 byte count, ``:`` and value; a null group comes first, a null
id before all others; rows of equal id are ordered by leaf, so repeated rows are leaves of their own; a lone node is its
tree's root; an empty table has no rows and no root; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.ordering import running_total
from lakekit.session import cut_lineage

FAN = 8
LEVELS = 3
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


class Parent:
    """A node with its children's digests and a copy of its hash state before each child's slot."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: bytes):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for at in range(0, len(children), HEX):
            self.states.append(state.copy())
            state.update(children[at:at + HEX])
        self.digest = state.hexdigest().encode()

    def resumed(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with ``digest`` in ``slot``: the state before it, the replacement, the right siblings."""
        state = self.states[slot].copy()
        state.update(digest)
        state.update(self.children[(slot + 1) * HEX:])
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return self.children[:slot * HEX] + self.children[(slot + 1) * HEX:]


def height(total: int, levels: int) -> int:
    """Levels that a block of a tree of ``total`` nodes is built up: until one node is left, ``levels`` at most."""
    up, nodes = 0, 1
    while nodes < total and up < levels:
        nodes, up = nodes * FAN, up + 1
    return up


def build(nodes: list[bytes], up: int) -> tuple[list[list[Parent]], bytes]:
    """The parents of ``up`` levels over neighbouring nodes, and the top digest."""
    grown = []
    for _ in range(up):
        grown.append([Parent(b"".join(nodes[i:i + FAN])) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in grown[-1]]
    return grown, nodes[0]


def steps(grown: list[list[Parent]], at: int) -> list[tuple[Parent, int]]:
    """The parents above node ``at`` of a block, each with the slot that the path takes."""
    out = []
    for parents in grown:
        out.append((parents[at // FAN], at % FAN))
        at //= FAN
    return out


def pack(path: list[tuple[Parent, int]]) -> bytes:
    return b"".join(bytes((slot, len(p.children) // HEX)) + p.children for p, slot in path)


def unpack(data: bytes) -> list[tuple[Parent, int]]:
    out, at = [], 0
    while at < len(data):
        end = at + 2 + data[at + 1] * HEX
        out.append((Parent(data[at + 2:end]), data[at]))
        at = end
    return out


def fold(path: list[tuple[Parent, int]], digest: bytes) -> bytes:
    for parent, slot in path:
        digest = parent.resumed(slot, digest)
    return digest


def _in_order(group: pa.Table) -> tuple[pa.Table, list[int], list[bytes], int]:
    group = group.sort_by("pos")
    return group, group.column("pos").to_pylist(), [d.encode() for d in group.column("digest").to_pylist()], group.column("total")[0].as_py()


def climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each round (tree, pos, total, digest), and each tree's root (pos 0)."""
    size = FAN ** levels

    def root_of(key, group):
        _, pos, digests, total = _in_order(group)
        _, top = build(digests, height(total, levels))
        return pa.table({"tree": [key[0].as_py()], "pos": [pos[0] // size], "total": [-(-total // size)], "digest": [top.decode()]})

    rounds = []
    while True:
        rounds.append(nodes)
        grouped = nodes.groupBy("tree", F.expr(f"pos div {size}").alias("block"))
        nodes = cut_lineage(grouped.applyInArrow(root_of, "tree string, pos long, total long, digest string"), "merkle-nodes")
        if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
            return rounds, nodes


def _with_path(nodes: DataFrame, above: DataFrame, levels: int, each, schema: str) -> DataFrame:
    """``each(group, path of the block's node i, row of ``above``)`` for each block of nodes and the row of its root."""
    size = FAN ** levels

    def run(group, upper):
        group, pos, digests, total = _in_order(group)
        grown, _ = build(digests, height(total, levels))
        rest = unpack(upper.column("path")[0].as_py())
        return each(group, digests, lambda i: steps(grown, pos[i] - pos[0]) + rest, upper)

    left = nodes.groupBy("tree", F.expr(f"pos div {size}").alias("block"))
    return left.cogroup(above.groupBy("tree", "pos")).applyInArrow(run, schema)


def carry_down(rounds: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """Paths (tree, pos, subroot, root, path) of the nodes that ``rounds`` begins with, from those of the trees' roots."""
    schema = "tree string, pos long, subroot string, root string, path binary"

    def down(group, digests, path, upper):
        n = group.num_rows
        same = {c: pa.array([upper.column(c)[0].as_py()] * n, pa.string()) for c in ("subroot", "root")}
        return pa.table({"tree": group.column("tree"), "pos": group.column("pos"), **same,
                         "path": pa.array([pack(path(i)) for i in range(n)], pa.binary())})

    for nodes in reversed(rounds):
        above = cut_lineage(_with_path(nodes, above, levels, down, schema), "merkle-paths")
    return above


def leaves(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", tree_col: str = "lang", tampered: Column | None = None,
           text_col: str = "text") -> DataFrame:
    """Written table of id, tree, row, digest and ``claimed`` (the digest of the row as it is claimed to be: with its
    text's A-Z lower-cased where ``tampered``, on the id, holds)."""
    text = docs[text_col].cast("string")
    other = F.when(tampered, F.translate(text, UPPER, LOWER)).otherwise(text) if tampered is not None else text
    value = lambda c, t: t if c == text_col else docs[c]
    tree = F.coalesce(F.concat(F.lit("+"), docs[tree_col].cast("string")), F.lit("!"))  # null before any other
    return cut_lineage(docs.select(docs[id_col].alias("id"), tree.alias("tree"), F.monotonically_increasing_id().alias("row"),
                                   leaf([value(c, text) for c in fields]).alias("digest"),
                                   leaf([value(c, other) for c in fields]).alias("claimed")), "merkle-leaves")


def proofs(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """For the table of :func:`leaves`: id, leaf, subroot, root, proof_sha256 (digest of all siblings from the leaf to the
    root, left to right) and folded_root (the claimed leaf folded up among the original siblings)."""
    totals = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
    placed = running_total(rows, ["tree"], ["id", "digest", "row"], F.lit(1), "pos")
    placed = cut_lineage(placed.join(totals, "tree"), "merkle-places")
    rounds, tops = climb(placed.select("tree", "pos", "total", "digest"), levels)
    # the groups' roots are the leaves of one more tree
    named = running_total(tops.select("tree", F.lit("").alias("all"), "digest"), ["all"], ["tree"], F.lit(1), "pos")
    named = cut_lineage(named.crossJoin(F.broadcast(tops.agg(F.count(F.lit(1)).alias("total"))))  # one row
                        .select(F.col("tree").alias("group"), F.lit("").alias("tree"), "pos", "total", "digest"), "merkle-groups")
    upper, last = climb(named.drop("group"), levels)
    start = last.select("tree", "pos", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
                        F.lit(b"").alias("path"))
    over = carry_down(upper, start, levels).drop("subroot", "tree")
    above = named.join(over, "pos").select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("pos"),
                                           F.col("digest").alias("subroot"), "root", "path")
    above = carry_down(rounds[1:], cut_lineage(above, "merkle-paths"), levels)
    id_type = rows.schema["id"].dataType.simpleString()

    def prove(group, digests, path, upper):
        proof, folded = [], []
        for i, claimed in enumerate(group.column("claimed").to_pylist()):
            way = path(i)
            proof.append(hashlib.sha256(b"".join(p.siblings(s) for p, s in way)).hexdigest())
            folded.append(fold(way, claimed.encode()).decode())
        same = {c: pa.array([upper.column(c)[0].as_py()] * group.num_rows, pa.string()) for c in ("subroot", "root")}
        return pa.table({"id": group.column("id"), "leaf": group.column("digest"), **same, "proof_sha256": proof, "folded_root": folded})

    return _with_path(placed, above, levels, prove, f"id {id_type}, leaf string, subroot string, root string, "
                                                    "proof_sha256 string, folded_root string")
