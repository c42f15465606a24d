"""SimHash near-dedup with a Gray-order hierarchical index.

Method: fingerprints are sorted by Gray rank, so that neighbours share bits;
runs of neighbours form the nodes of a tree, and each node keeps only the bits
all its members share and its ancestors do not (masked patterns). A search goes
down the tree, adds up the differing bits of each node's pattern and drops the
whole group once the sum exceeds the limit.

Scale: the distinct fingerprints are cut into BLOCKS blocks of bits. Two
fingerprints that differ in at most LIMIT bits agree on BLOCKS - LIMIT blocks,
so they meet in a group that shares these blocks; the blocks are the top node
of the group's tree. Copies (equal fingerprints) are aggregated first. A group
with more than SLICE members is dealt into slices, and every pair of slices
gets a task of its own, so no group grows past 2 * SLICE members in a task. A
group reports a spanning forest of its links (one edge per member at most), and
members already connected are not searched against each other again.

Defined results: a text that is null or has no word has fingerprint zero and
is linked like any other; rows that repeat an id are kept as rows; a null id is
never the component id unless the whole component has only null ids. Of each
component exactly one row is kept, whatever the ids of other components are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, materialize, runs, ship, values, with_row
from .components import connected

SHINGLE = 4
LIMIT = 4
BLOCKS = 6
SLICE = 1 << 14
FANOUT = 8
PAIRS_AT_ONCE = 1 << 21
BUNDLE = 1 << 17

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the text's word shingles (unsigned)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - np.array([len(w) for w in words])
    k = min(shingle, len(words))
    joined = b" ".join(words)
    of = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1:].tolist(), strict=True)
    h = np.fromiter((of(joined[s:e], 42) for s, e in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = h[at:at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray code."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class _Level:
    """Nodes of one level: shared bits, those the parent lacks, the children."""

    def __init__(self, mask, bits, first, last):
        self.mask, self.bits, self.first, self.last = mask, bits, first, last
        self.residual = mask
        self.children = None


def build_index(f: np.ndarray, group: np.ndarray) -> list[_Level]:
    """Levels from the leaves (one per fingerprint) up to one root per group.
    f is sorted by (group, Gray rank)."""
    n = len(f)
    at = np.arange(n)
    levels = [_Level(np.full(n, _ALL), f, at, at + 1)]
    own, any_, all_ = group, f, f
    while True:
        start = runs(own)
        size = np.diff(np.append(start, len(own)))
        if (size == 1).all() and len(levels) > 1:
            return levels
        in_group = np.arange(len(own)) - np.repeat(start, size)
        lead = np.flatnonzero(in_group % FANOUT == 0)
        any_, all_ = np.bitwise_or.reduceat(any_, lead), np.bitwise_and.reduceat(all_, lead)
        below, mask = levels[-1], ~(any_ ^ all_)
        kids = np.diff(np.append(lead, len(own)))
        node = _Level(mask, all_ & mask, below.first[lead], below.last[np.append(lead[1:], len(own)) - 1])
        node.children = (lead, kids)
        below.residual = below.mask & ~np.repeat(mask, kids)
        levels.append(node)
        own = own[lead]


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the labels (pointers to a smaller member) along the pairs."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label[:] = nxt


def link(f: np.ndarray, group: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Label of every fingerprint (index of a member of its component) under
    links of at most `limit` differing bits inside its group."""
    n = len(f)
    label = np.arange(n)
    levels = build_index(f, group)
    start = runs(group)
    size = np.diff(np.append(start, n))
    root_of, cost = np.repeat(np.arange(len(start)), size), np.repeat(size, size)
    block = np.cumsum(cost) // PAIRS_AT_ONCE
    edges = np.append(runs(block), n)
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        q = np.arange(s, e)
        node = root_of[s:e]
        q, node = q[cost[s:e] > 1], node[cost[s:e] > 1]
        acc = np.zeros(len(q), np.uint8)
        for depth in range(len(levels) - 1, -1, -1):
            lv = levels[depth]
            acc = acc + np.bitwise_count((f[q] ^ lv.bits[node]) & lv.residual[node])
            keep = (acc <= limit) & (lv.last[node] > q + 1)
            if depth and s:
                low = np.minimum.reduceat(label, lv.first)
                high = np.maximum.reduceat(label, lv.first)
                mine = label[q]
                keep &= (low[node] != mine) | (high[node] != mine)
            q, node, acc = q[keep], node[keep], acc[keep]
            if not depth:
                break
            lead, kids = lv.children
            many = kids[node]
            q, acc = np.repeat(q, many), np.repeat(acc, many)
            base = np.cumsum(many) - many
            node = np.repeat(lead[node] - base, many) + np.arange(len(q))
        _union(label, q, node)
    return label


def block_bounds(blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """(shift, width) of each block of the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _routes(fp: Column, limit: int) -> list[tuple[int, Column]]:
    """One (number, shared bits) per choice of blocks that may all agree."""
    blocks = max(BLOCKS, limit + 1)
    bounds = block_bounds(blocks)
    out = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - limit)):
        mask = sum(((1 << w) - 1) << s for s, w in (bounds[c] for c in chosen))
        signed = mask - (1 << 64) if mask >> 63 else mask
        out.append((n, fp.bitwiseAND(F.lit(signed).cast("long"))))
    return out


def _links(limit: int):
    def settle(part: list[tuple]) -> pa.RecordBatch:
        f = np.concatenate([p[0] for p in part])
        group = np.repeat(np.arange(len(part)), [len(p[0]) for p in part])
        order = np.lexsort((gray_rank(f), group))
        f = f[order]
        label = link(f, group[order], limit)
        far = label != np.arange(len(f))
        return pa.RecordBatch.from_arrays([pa.array(f[far].view(np.int64)), pa.array(f[label[far]].view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups arrive sorted by key; small ones are searched together."""
        part, total, open_, key = [], 0, [], None
        for b in batches:
            k = np.stack([b.column(c).to_numpy() for c in ("route", "shared", "a", "b")])
            f = b.column("fp").to_numpy().view(np.uint64)
            if not len(f):
                continue
            edges = np.append(runs(*k), len(f))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                now = tuple(k[:, s])
                if now != key and open_:
                    part.append((np.concatenate(open_),))
                    total += len(part[-1][0])
                    open_ = []
                    if len(part[-1][0]) == 1:
                        total -= 1
                        part.pop()
                    elif total >= BUNDLE:
                        yield settle(part)
                        part, total = [], 0
                key = now
                open_.append(f[s:e])
        if open_:
            part.append((np.concatenate(open_),))
        if part:
            yield settle(part)

    return run


def links(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """prints(fp): distinct fingerprints. Returns (u, v) edges that connect
    exactly the fingerprints linked by chains of at most `limit` differing bits."""
    options = F.array(*[F.struct(F.lit(n).alias("route"), shared.alias("shared")) for n, shared in _routes(F.col("fp"), limit)])
    routed = prints.select("fp", F.explode(options).alias("r")).select("fp", "r.route", "r.shared")
    hot = materialize(routed.groupBy("route", "shared").count().filter(F.col("count") > SLICE)
                      .select("route", "shared", F.ceil(F.col("count") / SLICE).cast("int").alias("slices")))
    dealt = routed.join(hot, ["route", "shared"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    cells = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return (cells.select("route", "shared", F.least("mine", "other").cast("long").alias("a"), F.greatest("mine", "other").cast("long").alias("b"), "fp")
            .withColumn("route", F.col("route").cast("long"))
            .repartition("route", "shared", "a", "b").sortWithinPartitions("route", "shared", "a", "b")
            .mapInArrow(_links(limit), "u long, v long"))


def _prints(shingle: int):
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, shingle) for x in values(b.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    return run


def _with_prints(shingle: int):
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, shingle) for x in values(b.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(fp.view(np.int64))], ["row", "fp"])

    return run


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row, and per distinct fp the label (a fingerprint) of
    its component and the component's smallest id."""
    ship(docs.sparkSession)
    prints = materialize(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_prints(shingle), "id long, fp long"))
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    labels = materialize(connected(links(distinct.select("fp"), limit)))
    members = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = members.groupBy("label").agg(F.min("least").alias("component"))
    return prints, members.join(least, "label").select("fp", "label", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """One row per document: id, fp (signed long), component (smallest id that
    can be reached by links of at most `limit` differing bits)."""
    prints, named = _grouped(docs, id_col, text_col, shingle, limit)
    return prints.join(named, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` per component: the one with the smallest id (a null id
    comes last), of several the first in the order of all columns."""
    prints, named = _grouped(docs, id_col, text_col, SHINGLE, LIMIT)
    # rows that may stay: their id is the smallest of their own component
    found = prints.join(named, "fp").filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("id", "fp", "label").count()
    total = found.groupBy("label").agg(F.sum("count").alias("n"))
    kept = materialize(found.join(total, "label").select(F.col("id").alias("kept_id"), F.col("fp").alias("kept_fp"), "label", "n"))
    whole = docs.select(F.struct(*columns(docs)).alias("row"), F.col(text_col).alias("text"))
    rows = whole.mapInArrow(_with_prints(SHINGLE), with_row(whole, "fp long"))
    own = F.col("row")[id_col].cast("long")
    joined = rows.join(kept, (F.col("fp") == F.col("kept_fp")) & own.eqNullSafe(F.col("kept_id"))).select("row", "label", "n")
    once = joined.filter("n = 1").select("row")
    again = joined.filter("n > 1").groupBy("label").agg(F.min("row").alias("row")).select("row")
    return once.unionByName(again).select("row.*")
