"""Repair of conversation structure by a square-root checkpointed DP.

Method: the rows of a conversation, in turn order, are edited at least cost into
rows whose role initials read `(s?(ua)+)?`. Keep costs 0, Rerole 1, Delete 2
(blank and duplicate rows must go), Insert 5, and a truncated row that stays 5
more. Of all cheapest edits the one whose letters come first in ASCII order
counts: D, I, K, R. The cost of the rest of a conversation from each of the four
states of the pattern (a state-cost vector) is computed backwards, but kept at
checkpoints alone: between blocks of rows, and inside a block every square root
of its rows. Going forwards, the vectors between two checkpoints are computed
anew, and an edit is tight if its cost and the next vector add up to this one.

Scale: a conversation of any length is cut into blocks of about the square root
of the longest one's rows, so that neither a block nor the list of a
conversation's blocks is longer than that. Blocks become 4 x 4 matrices of costs in
one map; a backward pass over a conversation's matrices gives the vector behind
each block; then each block is walked forwards from every state, in one more
map; a forward pass picks the walk that starts where the block before has ended.
Rows are numbered by ranks.ranked(). Which rows repeat an earlier one is found by
a digest of role and text, with partial aggregation, so a text that fills a third
of the table is no hot key. Only flags (a byte a row) go through the DP; texts
are read once more when the edits are applied, one row at a time.

Defined results: a null conversation id is one conversation of its own; null
turns come first, as do turns that are no whole numbers; rows with one turn are
ordered by the first HEAD letters of role and text and then by their digest
(equal rows are interchangeable); null roles and texts count as one space; a role is
known by its first character; an empty table gives no rows; turn gaps are counted
modulo 2**64. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship
from .ranks import by_group, map_groups, ranked

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Rows of a block, at least.
BLOCK = 512
#: Letters of role and text that order rows of one turn (a bound on sort keys).
HEAD = 256
INF = 1 << 60
#: States: nothing yet, after s, after u, after a. Where s, u and a lead from each.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Where an inserted or reroled row leads.
_MADE = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_END = (0, INF, INF, 0)
_LETTERS = "\0sua"
#: A row's flag byte: its initial's number, and the bits below.
_GONE, _TRUNCATED = 4, 8

_LETTER = r"[^\x20\x09-\x0D]"


def _inserted(v: list[int]) -> list[int]:
    """A state-cost vector when rows may be inserted first."""
    u = min(v[2], v[3] + INSERT)
    a = min(v[3], u + INSERT)
    u = min(u, a + INSERT)
    return [min(v[0], u + INSERT), min(v[1], u + INSERT), u, a]


def _before(flag: int, after: list[int]) -> list[int]:
    """The vector before a row from the one behind it."""
    v = [c + DELETE for c in after]
    if not flag & _GONE:
        more = CUT if flag & _TRUNCATED else 0
        letter = _LETTERS[flag & 3]
        for q in range(4):
            to = _NEXT[q].get(letter)
            cost = after[_MADE[q]] + REROLE + more
            if to is not None and after[to] + KEEP + more < cost:
                cost = after[to] + KEEP + more
            if cost < v[q]:
                v[q] = cost
    return _inserted(v)


def end_vector() -> list[int]:
    return _inserted(list(_END))


def costs(flags: bytes, behind: list[int]) -> list[int]:
    """The vector before a block of rows."""
    for f in reversed(flags):
        behind = _before(f, behind)
    return behind


def matrix(flags: bytes) -> list[int]:
    """Cost from each state before a block to each state behind it (16 numbers;
    rows inserted behind the block belong to what follows)."""
    columns = [costs(flags, [0 if q == end else INF for q in range(4)]) for end in range(4)]
    return [min(columns[end][q], INF) for q in range(4) for end in range(4)]


def through(m: list[int], behind: list[int]) -> list[int]:
    return [min(INF, *(m[4 * q + e] + behind[e] for e in range(4))) for q in range(4)]


def _step(state: int, flag: int | None, here: list[int], after: list[int]) -> tuple[str, int, bool]:
    """The first tight edit: its letter, the state it leads to, and whether it
    uses up the row (flag None: no row is left)."""
    need = here[state]
    more = CUT if flag and flag & _TRUNCATED else 0
    if flag is not None and after[state] + DELETE == need:
        return "D", state, True
    to = _MADE[state]
    if here[to] + INSERT == need:
        return "I", to, False
    keep = _NEXT[state].get(_LETTERS[flag & 3])
    if keep is not None and after[keep] + KEEP + more == need:
        return "K", keep, True
    return "R", to, True


def walk(flags: bytes, state: int, behind: list[int]) -> tuple[str, int]:
    """The edits of a block from `state` on, and the state that they end in."""
    stride = max(1, math.isqrt(len(flags)))
    marks = list(range(0, len(flags), stride))
    at = {len(flags): behind}  # vectors at the checkpoints
    for s in reversed(marks):
        at[s] = costs(flags[s:s + stride], at[min(s + stride, len(flags))])
    out = []
    for s in marks:
        part = flags[s:s + stride]
        vectors = [at[s + len(part)]]
        for f in reversed(part):
            vectors.append(_before(f, vectors[-1]))
        vectors.reverse()
        for i, f in enumerate(part):
            used = False
            while not used:
                letter, state, used = _step(state, f, vectors[i], vectors[i + 1])
                out.append(letter)
    return "".join(out), state


def finish(state: int) -> str:
    """Rows inserted behind the last one."""
    here, out = end_vector(), []
    while _END[state] != here[state]:
        letter, state, _ = _step(state, None, here, here)
        out.append(letter)
    return "".join(out)


def key(conv: Column) -> Column:
    """A conversation's key: empty for the null one, else `c` and its id."""
    return F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit(""))


def _flagged(rows: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    text, role = F.coalesce(text.cast("string"), F.lit(" ")), F.coalesce(role.cast("string"), F.lit(" "))
    blank = ~text.rlike(_LETTER)
    truncated = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in ("s", 1, "u", 2, "a", 3)]), F.substring(role, 1, 1)), F.lit(0))
    return rows.select(
        key(conv).alias("k"), turn.try_cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        blank.alias("blank"), truncated.alias("truncated"), initial.cast("int").alias("initial"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"))


_BLOCKS = ("k string, block long, flags binary, matrix array<long>, n_blank long, n_duplicate long, n_truncated long, illegal long, first_initial int, last_initial int, "
           "turns long, first_turn long, last_turn long")


def _legal(a: int, b: int) -> bool:
    return (_LETTERS[a] + _LETTERS[b]) in ("su", "ua", "au")


def _block(name: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows of one block: first the ranks of texts' first rows (kind 0), then the
    rows themselves."""
    k, block = name
    kind = rows.column("kind").to_numpy()
    rank = rows.column("rank").to_numpy()
    firsts, own = set(rank[kind == 0].tolist()), rows.filter(pa.array(kind == 1))
    blank, cut = own.column("blank").to_pylist(), own.column("truncated").to_pylist()
    initial, turn = own.column("initial").to_pylist(), own.column("turn").to_pylist()
    again = [r not in firsts for r in rank[kind == 1].tolist()]
    duplicate = [d and not b for d, b in zip(again, blank, strict=True)]
    truncated = [c and not b and not d for c, b, d in zip(cut, blank, duplicate, strict=True)]
    flags = bytes(i | (_GONE if b or d else 0) | (_TRUNCATED if c else 0) for i, b, d, c in zip(initial, blank, duplicate, truncated, strict=True))
    known = [t for t in turn if t is not None]
    turns = sum(1 for a, b in zip([None, *known], known, strict=False) if a != b)
    values = [k, block, flags, matrix(flags), sum(blank), sum(duplicate), sum(truncated), sum(not _legal(a, b) for a, b in zip(initial, initial[1:], strict=False)),
              initial[0], initial[-1], turns, known[0] if known else None, known[-1] if known else None]
    yield pa.RecordBatch.from_pylist([dict(zip((f.split()[0] for f in _BLOCKS.split(", ")), values, strict=True))], schema=_BLOCK_SCHEMA)


_BLOCK_SCHEMA = pa.schema([
    ("k", pa.string()), ("block", pa.int64()), ("flags", pa.binary()), ("matrix", pa.list_(pa.int64())), ("n_blank", pa.int64()), ("n_duplicate", pa.int64()),
    ("n_truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.int32()), ("last_initial", pa.int32()), ("turns", pa.int64()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64())])


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of conversations, the last one first: the vector behind each."""
    last, vector = None, None
    for b in batches:
        ks, out = b.column("k").to_pylist(), []
        for k, m in zip(ks, b.column("matrix").to_pylist(), strict=True):
            if k != last:
                last, vector = k, end_vector()
            out.append(vector)
            vector = through(m, vector)
        yield pa.RecordBatch.from_arrays([b.column("k"), b.column("block"), pa.array(out, pa.list_(pa.int64()))], ["k", "block", "behind"])


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block walked from every state that it can be entered in."""
    for b in batches:
        audits, ends, starts = [], [], []
        for block, flags, behind in zip(b.column("block").to_pylist(), b.column("flags").to_pylist(), b.column("behind").to_pylist(), strict=True):
            found = [walk(flags, q, behind) if block or not q else ("", 0) for q in range(4)]
            audits.append([a for a, _ in found])
            ends.append([e for _, e in found])
            starts.append(costs(flags, behind)[0])
        yield pa.RecordBatch.from_arrays(
            [b.column("k"), b.column("block"), pa.array(audits, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32())), pa.array(starts, pa.int64())],
            ["k", "block", "audits", "ends", "cost"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str | None, str | None]]:
    """(k, letter, role, text) of every edit, in order, from a partition sorted by
    (k, block, kind, rank): a block's walks (kind 0) stand before its rows. A
    last (k, "", None, None) ends a conversation."""
    last, state, made, letters = None, 0, 0, iter(())

    def put(letter, role, text):
        nonlocal made
        if letter in ("I", "R"):
            made = _MADE[made]
            return last, letter, _ROLE[made], "" if letter == "I" else text
        if letter == "K":
            made = _NEXT[made][role[0]]
        return last, letter, role, text

    for b in batches:
        for k, kind, audits, ends, role, text in zip(*(b.column(c).to_pylist() for c in ("k", "kind", "audits", "ends", "role", "text")), strict=True):
            if k != last:
                if last is not None:
                    yield from (put(x, None, None) for x in finish(state))
                    yield last, "", None, None
                last, state, made = k, 0, 0
            if kind == 0:
                letters, state = iter(audits[state]), ends[state]
                continue
            for letter in letters:
                yield put(letter, role, text)
                if letter != "I":
                    break
    if last is not None:
        yield from (put(x, None, None) for x in finish(state))
        yield last, "", None, None


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, held, last, n = ["k", "step", "edit", "role", "text"], [], None, 0
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    for k, letter, role, text in _edits(batches):
        last, n = k, 0 if k != last else n
        if not letter:
            continue
        held.append((k, n, letter, role, text))
        n += 1
        if len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of a conversation's edits and the digest of its repaired rows."""
    names, held = ["k", "audit", "repaired_sha256"], []
    letters, digest, empty = [], hashlib.sha256(), True
    for k, letter, role, text in _edits(batches):
        if letter:
            letters.append(letter)
            if letter != "D":
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
            continue
        held.append((k, "".join(letters), digest.hexdigest()))
        letters, digest, empty = [], hashlib.sha256(), True
        if len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*held, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*held, strict=True)], names)


class Repair:
    """The cheapest edits of every conversation of a table.

    blocks: faults, turns and costs per block of rows; edits(): every edit as a
    row; report(): one row per conversation.
    """

    def __init__(self, rows: DataFrame, conv: Column, turn: Column, role: Column, text: Column, block: int = BLOCK):
        ship(rows.sparkSession)
        marked = _flagged(rows, conv, turn, role, text)
        self.rows = ranked(marked, "k", [F.col("turn").asc_nulls_first(), F.substring("role", 1, HEAD), F.substring("text", 1, HEAD), F.col("digest")])
        longest = self.rows.agg(F.max("rank")).head()[0] or 0
        self.length = max(block, math.isqrt(longest) + 1)
        place = F.expr(f"rank div {self.length}")
        nothing = {"turn": "long", "blank": "boolean", "truncated": "boolean", "initial": "int"}
        firsts = self.rows.groupBy("k", "digest").agg(F.min("rank").alias("rank")).select("k", place.alias("block"), F.lit(0).alias("kind"), "rank", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
        own = self.rows.select("k", place.alias("block"), F.lit(1).alias("kind"), "rank", *nothing)
        self.blocks = materialize(map_groups(firsts.unionByName(own), ["k", "block"], ["kind", "rank"], _block, _BLOCKS))
        behind = self.blocks.select("k", "block", "matrix").repartition("k").sortWithinPartitions("k", F.desc("block")).mapInArrow(_behind, "k string, block long, behind array<long>")
        self.walks = materialize(self.blocks.select("k", "block", "flags").join(behind, ["k", "block"])
                                 .mapInArrow(_walks, "k string, block long, audits array<string>, ends array<int>, cost long"))

    def _ordered(self) -> DataFrame:
        walks = self.walks.select("k", "block", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("rank"), "audits", "ends", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        rows = self.rows.select("k", F.expr(f"rank div {self.length}").alias("block"), F.lit(1).alias("kind"), "rank", F.lit(None).cast("array<string>").alias("audits"), F.lit(None).cast("array<int>").alias("ends"), "role", "text")
        return walks.unionByName(rows).repartition("k").sortWithinPartitions("k", "block", "kind", "rank")

    def edits(self) -> DataFrame:
        """k (empty for the null conversation, else `c` and its id), step, edit
        (D, I, K, R), and the role and text of the row (repaired; of a deleted
        row its own)."""
        return self._ordered().mapInArrow(_edit_rows, "k string, step long, edit string, role string, text string")

    def report(self) -> DataFrame:
        """k, gaps, blank, duplicate, truncated, illegal, cost, audit,
        repaired_sha256 (of the repaired rows as `role:text`, newline-joined)."""
        counts = self.blocks.drop("flags", "matrix").repartition("k").sortWithinPartitions("k", "block").mapInArrow(
            _counts, "k string, gaps long, blank long, duplicate long, truncated long, illegal long")
        cost = self.walks.filter("block = 0").select("k", "cost")
        return counts.join(cost, "k").join(self._ordered().mapInArrow(_digests, "k string, audit string, repaired_sha256 string"), "k")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of conversations in order -> counts per conversation."""
    out = []
    for (k,), held in by_group(batches, ["k"]):
        total, last, turn, low, turns = np.zeros(4, np.int64), None, None, None, 0
        for b in held:
            for r in b.to_pylist():
                total += (r["n_blank"], r["n_duplicate"], r["n_truncated"], r["illegal"] + (last is not None and not _legal(last, r["first_initial"])))
                last = r["last_initial"]
                if r["first_turn"] is not None:
                    turns += r["turns"] - (r["first_turn"] == turn)
                    low, turn = r["first_turn"] if low is None else low, r["last_turn"]
        gaps = 0 if low is None else turn - low + 1 - turns
        out.append((k, (gaps + (1 << 63)) % (1 << 64) - (1 << 63), *total.tolist()))
        if len(out) >= 4096:
            yield _counted(out)
            out = []
    if out:
        yield _counted(out)


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], ["k", "gaps", "blank", "duplicate", "truncated", "illegal"])
