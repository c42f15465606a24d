"""Merkle manifest of a dataset, its trees stored in van Emde Boas layout.

Method: the rows of a group (a source) are the leaves of a tree in which RUN
neighbours have one parent; the roots of the groups are the leaves of one more
tree. A tree is cut into aligned subtrees of HEIGHT levels of edges. Each is a
row of its own: an array of digests in van Emde Boas order, that is, split at
half height, the upper part first, then the lower subtrees from left to right,
each split alike. Where a node lies is arithmetic on its depth and number
(`addresses`); the same arithmetic serves building a subtree from its leaves and
reading the siblings along a path. The roots of the subtrees are the leaves of
the next round, until each group has one root.

Scale: leaf digests are built-in functions over the row; text goes no further.
Leaves are numbered by ranks.ranked(), so a group of any size spreads over many
tasks: one task works on one subtree of at most RUN**HEIGHT leaves. Rounds are
log(rows of the largest group) to the base RUN**HEIGHT: 3 for a billion rows.
Proofs go from the top down: a subtree gets the path above it (one row per
subtree) and hands its own leaves' paths on.

Defined results: a null id comes before all others, a null group before all
groups; rows with one id are ordered by their leaf digests (equal rows are
interchangeable leaves); groups are ordered by their UTF-8 bytes; an empty table
gives no rows. Columns that are not asked for are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize
from .ranks import map_groups, ranked

#: Children of a node, and levels of edges in a stored subtree.
RUN, HEIGHT = 3, 7
_HEX = 64
_NONE = b"0" * _HEX


def size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (RUN**levels - 1) // (RUN - 1)


@functools.lru_cache(maxsize=None)
def addresses(levels: int, depth: int) -> list[int]:
    """Place of each node of one depth (the root has 0) in the van Emde Boas
    order of a full tree of so many levels."""
    return _addresses(levels, depth).tolist()


def _addresses(levels: int, depth: int) -> np.ndarray:
    number = np.arange(RUN**depth)
    if levels == 1:
        return number
    upper = levels // 2
    lower = levels - upper
    if depth < upper:
        return _addresses(upper, depth)
    below = RUN**(depth - upper)
    return size(upper) + number // below * size(lower) + _addresses(lower, depth - upper)[number % below]


def height_of(leaves: int) -> int:
    """Levels of edges above so many leaves."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // RUN), h + 1
    return h


def build(leaves: list[bytes], height: int) -> list[bytes]:
    """Hexadecimal digests of a subtree in van Emde Boas order; nodes without a
    leaf below them are _NONE."""
    tree, row = [_NONE] * size(height + 1), leaves
    for depth in range(height, -1, -1):
        if depth < height:
            row = [hashlib.sha256(b"".join(row[i:i + RUN])).hexdigest().encode() for i in range(0, len(row), RUN)]
        for at, digest in zip(addresses(height + 1, depth), row, strict=False):
            tree[at] = digest
    return tree


def siblings(tree: list[bytes], height: int, leaves: int, leaf: int) -> list[tuple[bytes, bytes]]:
    """Per level from a leaf upwards: the digests to the left of the path's node
    in its run, and those to its right."""
    out = []
    for depth in range(height, 0, -1):
        at, first = addresses(height + 1, depth), leaf // RUN * RUN
        run = [tree[a] for a in at[first:min(first + RUN, leaves)]]
        out.append((b"".join(run[:leaf - first]), b"".join(run[leaf - first + 1:])))
        leaf, leaves = leaf // RUN, -(-leaves // RUN)
    return out


def fold(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        node = hashlib.sha256(left + node + right).hexdigest().encode()
    return node


def _pack(path: list[tuple[bytes, bytes]]) -> bytes:
    return b";".join(a + b"," + b for a, b in path)


def _unpack(data: bytes) -> list[tuple[bytes, bytes]]:
    return [tuple(p.split(b",")) for p in data.split(b";")] if data else []


_NODES = "k string, block long, n int, height int, nodes binary, root string"


def _subtree(full: int):
    return lambda name, rows: _stored(full, *name, rows)


def _stored(full: int, k: str, block: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    leaves = [x.encode() for x in rows.column("leaf").to_pylist()]
    # a first subtree that is not full is all of its tree
    height = height_of(len(leaves)) if block == 0 else full
    tree = build(leaves, height)
    cols = [pa.array([k]), pa.array([block], pa.int64()), pa.array([len(leaves)], pa.int32()), pa.array([height], pa.int32()),
            pa.array([bytes.fromhex(b"".join(tree).decode())], pa.binary()), pa.array([tree[0].decode()])]
    names = ["k", "block", "n", "height", "nodes", "root"]
    if "member" in rows.column_names:
        members = rows.column("member").combine_chunks()
        members = members if isinstance(members, pa.Array) else pa.concat_arrays(members.chunks)
        cols.append(pa.ListArray.from_arrays(pa.array([0, len(members)], pa.int32()), members))
        names.append("members")
    yield pa.RecordBatch.from_arrays(cols, names)


def _tree(nodes: bytes) -> list[bytes]:
    text = nodes.hex().encode()
    return [text[i:i + _HEX] for i in range(0, len(text), _HEX)]


def _leaves(b: pa.RecordBatch) -> Iterator[tuple]:
    """Per stored subtree: its leaves, and the path of each."""
    cols = (b.column(c).to_pylist() for c in ("n", "height", "nodes", "path"))
    for n, height, nodes, up in zip(*cols, strict=True):
        tree, above, at = _tree(nodes), _unpack(up), addresses(height + 1, height)
        yield [tree[a] for a in at[:n]], [siblings(tree, height, n, i) + above for i in range(n)]


def _repeated(b: pa.RecordBatch, name: str, row: int, n: int) -> pa.Array:
    return pa.array([b.column(name)[row].as_py()] * n, b.column(name).type)


_UP = "k string, block long, subroot string, path binary"


def _down(full: int):
    """Subtrees with the path above their root: the path above each leaf, which
    is the root of a subtree of the round before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, (leaves, paths) in enumerate(_leaves(b)):
                n = len(leaves)
                blocks = pa.array(np.arange(n) + b.column("block")[row].as_py() * RUN**full)
                yield pa.RecordBatch.from_arrays(
                    [_repeated(b, "k", row, n), blocks, _repeated(b, "subroot", row, n), pa.array(list(map(_pack, paths)), pa.binary())], ["k", "block", "subroot", "path"])

    return run


def _members(b: pa.RecordBatch, row: int) -> pa.Array:
    return b.column("members").slice(row, 1).flatten()


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member's leaf and the path above it."""
    for b in batches:
        for row, (leaves, paths) in enumerate(_leaves(b)):
            yield pa.RecordBatch.from_arrays([_members(b, row), pa.array([x.decode() for x in leaves], pa.string()), pa.array(list(map(_pack, paths)), pa.binary())], ["member", "leaf", "path"])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member: the digest of its siblings, and the root that the leaf as
    presented folds to."""
    for b in batches:
        for row, (leaves, paths) in enumerate(_leaves(b)):
            members = _members(b, row)
            shown = members.field("presented").to_pylist()
            proof = [hashlib.sha256(b"".join(a + c for a, c in p)).hexdigest() for p in paths]
            folded = [fold(s.encode() if s else own, p).decode() for s, own, p in zip(shown, leaves, paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [members, pa.array([x.decode() for x in leaves], pa.string()), _repeated(b, "subroot", row, len(leaves)), pa.array(proof, pa.string()), pa.array(folded, pa.string())],
                ["member", "leaf", "subroot", "proof_sha256", "folded_root"])


class Forest:
    """The stored subtrees of every round, and one root per key."""

    def __init__(self, leaves: DataFrame, height: int = HEIGHT):
        """leaves(k, rank, leaf, member): ranks from 0 without gaps per key;
        subtrees of `height` levels of edges."""
        self.height = height
        self.rounds: list[DataFrame] = []
        member = T.StructType([T.StructField("members", T.ArrayType(leaves.schema["member"].dataType))])
        row, schema = leaves, T.StructType([*T.StructType.fromDDL(_NODES).fields, *member.fields])
        while True:
            cut = row.withColumn("block", F.expr(f"rank div {RUN**height}"))
            stored = materialize(map_groups(cut, ["k", "block"], ["rank"], _subtree(height), schema))
            self.rounds.append(stored)
            if not stored.agg(F.max("block")).head()[0]:
                break
            row, schema = stored.select("k", F.col("block").alias("rank"), F.col("root").alias("leaf")), _NODES
        self.roots = self.rounds[-1].select("k", "root")

    def with_paths(self, above: DataFrame | None = None) -> DataFrame:
        """The subtrees of the first round with `path`, the siblings above their
        roots; `above`(k, subroot, path) goes on above the root of each key."""
        if above is None:
            above = self.roots.select("k", F.col("root").alias("subroot"), F.lit(b"").alias("path"))
        up = above.select("k", F.lit(0).cast("long").alias("block"), "subroot", "path")
        for stored in reversed(self.rounds[1:]):
            up = stored.join(up, ["k", "block"]).mapInArrow(_down(self.height), _UP)
        return self.rounds[0].join(up, ["k", "block"])


def leaf(*cols: Column) -> Column:
    """H of the columns' values: each its UTF-8 byte count, a colon and itself,
    or `-` if it is null."""
    parts = []
    for c in cols:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def forest(docs: DataFrame, id_col: Column, group_col: Column, digest: Column, presented: Column, height: int = HEIGHT) -> tuple[Forest, Forest]:
    """One tree per group (keys: empty for the null group, else `s` and the
    group's name) and the tree over the groups' roots."""
    group = F.coalesce(F.concat(F.lit("s"), group_col.cast("string")), F.lit(""))
    rows = docs.select(group.alias("k"), digest.alias("leaf"), F.struct(id_col.alias("id"), presented.alias("presented")).alias("member"))
    groups = Forest(ranked(rows, "k", [F.col("member.id").asc_nulls_first(), F.col("leaf")]), height)
    # one row per group; the key order is that of the groups, the null one first
    tops = groups.roots.select(F.lit("").alias("k"), F.col("root").alias("leaf"), F.struct(F.col("k").alias("group")).alias("member"))
    return groups, Forest(ranked(tops, "k", [F.col("member.group")]), height)


def prove(docs: DataFrame, id_col: Column, group_col: Column, digest: Column, presented: Column, height: int = HEIGHT) -> DataFrame:
    """Build the manifest over the leaves `digest` and check every row against
    it by the leaf that is presented for it (null: its own). Returns id, leaf,
    subroot (of its group), root, proof_sha256 (H of its siblings, from the leaf
    to the root, left to right), folded_root, verified."""
    groups, top = forest(docs, id_col, group_col, digest, presented, height)
    root = [r[0] for r in top.roots.select("root").collect()]  # one row; none for an empty table
    path = top.with_paths().mapInArrow(_named, "member struct<group string>, leaf string, path binary")
    subtrees = groups.with_paths(path.select(F.col("member.group").alias("k"), F.col("leaf").alias("subroot"), "path"))
    member = T.StructField("member", groups.rounds[0].schema["members"].dataType.elementType)
    more = T.StructType.fromDDL("leaf string, subroot string, proof_sha256 string, folded_root string").fields
    checked = subtrees.mapInArrow(_check, T.StructType([member, *more]))
    return checked.select(
        F.col("member.id").alias("id"), "leaf", "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "proof_sha256", "folded_root",
        F.col("folded_root").eqNullSafe(F.lit(root[0] if root else None).cast("string")).alias("verified"))
