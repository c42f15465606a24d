"""Exact dedup of byte strings with threshold-bounded interval expansion.

Method: a string of LENGTH bytes that starts anywhere else in the corpus goes,
wherever it stands. Texts are indexed in pieces that surely hold all that can
match together: a Burrows-Wheeler transform is built of each lot of pieces, and
a breadth-first backward extension over it finds the common prefixes of
neighbouring suffixes by increasing value, stopping at LENGTH; suffixes between
two such ends share LENGTH bytes or more.

How pieces meet: every run of LENGTH bytes holds a content-defined anchor (see
anchors.py), so two equal runs hold equal anchors at the same place. Around an
anchor at a, the bytes from a - (LENGTH - GRAM) to a + LENGTH hold every run of
which it is the anchor: its piece. First only two hashes per anchor travel, of
the anchor and of its piece. Equal pieces repeat as a whole and need no index;
anchors that occur once repeat nothing; only where an anchor has different
pieces, one piece of each kind is indexed with the others of that anchor.

Scale: a chunk sends one entry per kind of piece; an anchor with several kinds in
one chunk is dealt by piece, so a frequent anchor is not one task. An anchor
with more than GROUP kinds of pieces is not indexed: its runs are counted by two
64-bit hashes in an aggregation, exactly and without a group in one task. Texts
are shuffled twice, joined with their own places.

Defined results: a null text is empty; a text shorter than LENGTH keeps all;
rows that repeat both id and text repeat each other; a null id is one more id;
other columns are carried through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, anchors
from .common import chunks, columns, materialize, NULL_ID, release, runs, ship, shuffle_partitions, text_bytes, values, with_row
from .fm_index import prefix_classes
from .homes import PACKED, pack, unpack

LENGTH = 200
CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 32 << 20
LOT_BYTES = 1 << 20
GROUP = 6_000

_ALONE, _KIND, _OTHERS = 0, 1, 2  # kinds of entries: alone of its anchor in its chunk, one of several, a mark that there are several
_NONE = np.uint64(0)


def pieces(data: bytes, starts: np.ndarray, length: int) -> tuple:
    """Anchors of texts laid end to end: (text number, place in the text, from
    and to of the piece, hash of the anchor, hash of the piece)."""
    view = memoryview(data)
    at = anchors(np.frombuffer(data, np.uint8), starts, length)
    doc = np.searchsorted(starts, at, side="right") - 1
    ends = np.append(starts[1:], len(data))[doc]
    low, high = np.maximum(at - (length - GRAM), starts[doc]), np.minimum(at + length, ends)
    of = xxhash.xxh64_intdigest
    anchor = np.fromiter((of(view[i:i + GRAM], 1) for i in at.tolist()), np.uint64, len(at))
    piece = np.fromiter((of(view[i:j], a - i) for i, j, a in zip(low.tolist(), high.tolist(), at.tolist(), strict=True)), np.uint64, len(at))
    return doc, at - starts[doc], low - starts[doc], high - starts[doc], anchor, piece


_ENTRY = "bucket int, ids binary, marks binary, counts binary, at binary, low binary, high binary, anchor binary, piece binary, kind binary, settled binary"
_FIELDS = (("at", np.int32), ("low", np.int32), ("high", np.int32), ("anchor", np.uint64), ("piece", np.uint64), ("kind", np.uint8), ("settled", np.uint8))
_ENTRY_SCHEMA = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("ids", "marks", "counts", *(f for f, _ in _FIELDS))])


def _entries(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(_texts(batches, length), lambda d: len(d[1]), CHUNK_BYTES):
            lens = np.array([len(x) for _, x in part], np.int64)
            starts = np.cumsum(lens) - lens
            doc, at, low, high, anchor, piece = pieces(b"".join(x for _, x in part), starts, length)
            if not len(doc):
                continue
            order = np.lexsort((piece, anchor))
            new_anchor = np.zeros(len(order), bool)
            new_anchor[runs(anchor[order])] = True
            first = runs(anchor[order], piece[order])  # one entry of each kind
            many = np.diff(np.append(first, len(order)))
            several = np.bincount(np.cumsum(new_anchor)[first])[np.cumsum(new_anchor)[first]] > 1
            # settled: 1 if the piece is known to repeat; the entries that stand
            # for no kind are told so and travel as settled places only
            out_doc, out_kind = [doc[order[first]]], [np.where(several, _KIND, _ALONE).astype(np.uint8)]
            chosen = [order[first]]
            settled = [(many > 1).astype(np.uint8)]
            rest = np.ones(len(order), bool)
            rest[first] = False
            chosen.append(order[rest])
            out_doc.append(doc[order[rest]])
            out_kind.append(np.zeros(int(rest.sum()), np.uint8))
            settled.append(np.full(int(rest.sum()), 2, np.uint8))
            marks = order[first][several & new_anchor[first]]
            chosen.append(marks)
            out_doc.append(doc[marks])
            out_kind.append(np.full(len(marks), _OTHERS, np.uint8))
            settled.append(np.zeros(len(marks), np.uint8))
            chosen, kind, settled = np.concatenate(chosen), np.concatenate(out_kind), np.concatenate(settled)
            col = {"at": at[chosen], "low": low[chosen], "high": high[chosen], "anchor": anchor[chosen], "piece": piece[chosen], "kind": kind, "settled": settled}
            d = doc[chosen]
            by_piece = (kind == _KIND) | (settled == 2)
            bucket = (np.where(by_piece, col["piece"], col["anchor"]) % np.uint64(buckets)).astype(np.int32)
            # nothing is asked of places that are settled already: no hashes
            col["anchor"] = np.where(settled == 2, _NONE, col["anchor"])
            col["piece"] = np.where(settled == 2, _NONE, col["piece"])
            by = np.lexsort((col["at"], d, bucket))
            bucket, d = bucket[by], d[by]
            col = {k: v[by] for k, v in col.items()}
            edges = np.append(runs(bucket), len(bucket))
            rows = []
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                lead = runs(d[s:e])
                docs = d[s:e][lead].tolist()
                ids = np.array([part[i][0] for i in docs], np.int64)
                text = np.array([xxhash.xxh64_intdigest(part[i][1], 42) for i in docs], np.uint64)
                counts = np.diff(np.append(lead, e - s)).astype(np.int32)
                rows.append((int(bucket[s]), ids.tobytes(), text.tobytes(), counts.tobytes(), *(col[f][s:e].astype(t).tobytes() for f, t in _FIELDS)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENTRY_SCHEMA, strict=True)], schema=_ENTRY_SCHEMA)

    return run


def _texts(batches, length: int):
    for b in batches:
        for i, x in zip(b.column("id").to_pylist(), values(b.column("text")), strict=True):
            raw = (x or "").encode()
            if len(raw) >= length:
                yield i, raw


def _decide(buckets: int):
    """Of one bucket, packed by document: (0, from, to) of pieces that repeat as
    a whole, and (1, place, 1 if the piece is the only one of its kind) of the
    pieces to be indexed."""
    def run(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list] = {f: [] for f in ("id", "mark", *(f for f, _ in _FIELDS))}
        for b in parts:
            for r in b.to_pylist():
                counts = np.frombuffer(r["counts"], np.int32)
                got["id"].append(np.repeat(np.frombuffer(r["ids"], np.int64), counts))
                got["mark"].append(np.repeat(np.frombuffer(r["marks"], np.uint64), counts))
                for f, t in _FIELDS:
                    got[f].append(np.frombuffer(r[f], t))
        if not got["id"]:
            return
        c = {k: np.concatenate(v) for k, v in got.items()}
        del got
        open_ = np.flatnonzero(c["settled"] < 2)
        # marks come first among the entries of their anchor and count as a kind
        mark = c["kind"][open_] == _OTHERS
        piece = np.where(mark, _NONE, c["piece"][open_])
        order = open_[np.lexsort((~mark, piece, c["anchor"][open_], c["kind"][open_] == _KIND))]
        group = c["kind"][order] == _KIND
        is_mark = c["kind"][order] == _OTHERS
        p = np.where(is_mark, _NONE, c["piece"][order])
        lead_anchor, lead = runs(c["anchor"][order], group), runs(c["anchor"][order], group, p, is_mark)
        size = np.diff(np.append(lead, len(order)))
        whole = np.add.reduceat(c["settled"][order], lead, dtype=np.int64) + size > 1 if len(order) else np.zeros(0, bool)
        kinds = np.add.reduceat(np.isin(np.arange(len(order)), lead), lead_anchor, dtype=np.int64) if len(order) else np.zeros(0, np.int64)
        of_anchor = np.repeat(np.arange(len(lead_anchor)), np.diff(np.append(lead_anchor, len(order))))
        ask = (kinds[of_anchor] > 1) | group
        of_kind = np.repeat(np.arange(len(lead)), size)
        covered = whole[of_kind] & ~is_mark
        first = np.zeros(len(order), bool)
        first[lead] = True
        ask &= first & ~is_mark
        single = ask & ~covered
        span_at = np.concatenate([order[covered], np.flatnonzero(c["settled"] == 2)])
        at = np.concatenate([span_at, order[ask]])
        places = np.zeros((len(at), 3), np.int32)
        places[:len(span_at), 1:] = np.stack([c["low"][span_at], c["high"][span_at]], axis=1)
        places[len(span_at):] = np.stack([np.ones(int(ask.sum())), c["at"][order[ask]], single[ask]], axis=1)
        if len(at):
            yield pack(c["id"][at], c["mark"][at], places, buckets)
        release()

    return run


_PLACES = "id long, mark long, spans binary, asked binary"


def _gather(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: spans and asked, as _decide found them."""
    rows = []
    for i, m, p in unpack(parts, 3):
        asked = p[:, 0] == 1
        rows.append((i, m, p[~asked, 1:].tobytes() or None, p[asked, 1:].tobytes() or None))
    cols = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "mark", "spans", "asked"])
    release()


_PIECE = "anchor long, id long, mark long, low int, single boolean, piece binary"


def _cut_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for i, m, x, asked in zip(b.column("id").to_pylist(), b.column("mark").to_pylist(), values(b.column("text")), values(b.column("asked")), strict=True):
                raw = x.encode()
                for at, single in np.frombuffer(asked, np.int32).reshape(-1, 2).tolist():
                    low = max(0, at - (length - GRAM))
                    for c, v in zip(cols, (xxhash.xxh64_intdigest(raw[at:at + GRAM], 1), i, m, low, single == 1, raw[low:at + length]), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            cols[0][:] = np.array(cols[0], np.uint64).view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["anchor", "id", "mark", "low", "single", "piece"])

    return run


def repeated_runs(lot: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """lot of (id, mark, low, single, piece): the (id, mark, place) of every run
    of `length` bytes in a single piece that also starts elsewhere."""
    lens = np.array([len(p[4]) for p in lot], np.int64)
    starts = np.cumsum(lens + 1) - lens - 1
    seq = np.zeros(int((lens + 1).sum()), np.int64)
    seq[np.delete(np.arange(len(seq)), starts + lens)] = np.frombuffer(b"".join(p[4] for p in lot), np.uint8).astype(np.int64) + 1
    present = np.zeros(257, np.int64)
    present[seq] = 1
    seq = np.cumsum(present)[seq] + (present[0] == 0)  # symbols in order, from 1; 1 parts pieces
    order, kind = prefix_classes(seq, length)
    keep = order < len(seq)
    order, kind = order[keep], kind[keep]
    piece = np.searchsorted(starts, order, side="right") - 1
    fits = order + length <= starts[piece] + lens[piece]
    order, kind, piece = order[fits], kind[fits], piece[fits]
    if not len(order):
        return []
    keys: dict[tuple, int] = {}
    text = np.array([keys.setdefault((p[0], p[1]), len(keys)) for p in lot], np.int64)
    place = np.array([p[2] for p in lot], np.int64)[piece] + order - starts[piece]
    spot = text[piece] << 40 | place  # pieces of one text overlap: the same spot is no repeat
    first = runs(kind)
    sizes = np.diff(np.append(first, len(kind)))
    repeats = np.repeat(np.minimum.reduceat(spot, first) != np.maximum.reduceat(spot, first), sizes)
    single = np.array([p[3] for p in lot], bool)[piece]
    at = np.flatnonzero(repeats & single)
    return [(lot[i][0], lot[i][1], s) for i, s in zip(piece[at].tolist(), place[at].tolist(), strict=True)]


def _pack_runs(found: list[tuple[int, int, int]], length: int) -> pa.RecordBatch:
    found = sorted(set(found))
    ids, marks, at = (np.array([f[k] for f in found], np.int64) for k in range(3))
    new = np.ones(len(found), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]) | (at[1:] > at[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(found)) - 1
    pair = np.stack([at[first], at[last] + length], axis=1).astype(np.int32)
    ids, marks = ids[first], marks[first]
    edges = np.append(runs(ids, marks), len(ids))
    return pa.RecordBatch.from_arrays([pa.array(ids[edges[:-1]]), pa.array(marks[edges[:-1]]), pa.array([pair[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], ["id", "mark", "spans"])


def _index(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces sorted by anchor; lots end between anchors."""
        lot, size, last = [], 0, None
        for b in batches:
            for anchor, *piece in zip(*(b.column(c).to_pylist() for c in ("anchor", "id", "mark", "low", "single", "piece")), strict=True):
                if size >= LOT_BYTES and anchor != last:
                    yield _pack_runs(repeated_runs(lot, length), length)
                    lot, size = [], 0
                last = anchor
                lot.append(tuple(piece))
                size += len(piece[-1])
        if lot:
            yield _pack_runs(repeated_runs(lot, length), length)

    return run


def _single_runs(length: int):
    """Every run of a piece by two hashes (for anchors with very many kinds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, m, low, single, piece in zip(*(b.column(c).to_pylist() for c in ("id", "mark", "low", "single", "piece")), strict=True):
                for s in range(len(piece) - length + 1):
                    r = piece[s:s + length]
                    out.append((xxhash.xxh64_intdigest(r, 3), xxhash.xxh64_intdigest(r, 4), i, m, low + s, single))
            cols = list(zip(*out, strict=True)) or [()] * 6
            h = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in cols[:2]]
            yield pa.RecordBatch.from_arrays([*h, pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.bool_())], ["h1", "h2", "id", "mark", "at", "single"])

    return run


def _counted(pieces_: DataFrame, length: int) -> DataFrame:
    """Spans of repeated runs, by counting; for what is not indexed."""
    runs_ = pieces_.mapInArrow(_single_runs(length), "h1 long, h2 long, id long, mark long, at int, single boolean")
    spot = F.struct("id", "mark", "at")
    twice = runs_.groupBy("h1", "h2").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a <> b").select("h1", "h2")
    found = runs_.filter("single").join(twice, ["h1", "h2"], "left_semi").select("id", "mark", "at").distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _pack_runs(list(zip(*(b.column(c).to_pylist() for c in ("id", "mark", "at")), strict=True)), length)

    return found.mapInArrow(pack, "id long, mark long, spans binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """docs(id, text) -> (id, mark, spans): packed (from, to) byte ranges that
    are covered by repeated runs; mark is the text's XXH64."""
    spark = docs.sparkSession
    buckets = max(shuffle_partitions(spark), text_bytes(docs, "text") // BUCKET_BYTES)
    entries = docs.mapInArrow(_entries(length, buckets), _ENTRY)
    decided = entries.groupBy("bucket").applyInArrow(_decide(buckets), PACKED)
    places = materialize(decided.groupBy("home").applyInArrow(_gather, _PLACES))
    asked = places.filter("asked IS NOT NULL").select(F.col("id").alias("a_id"), F.col("mark").alias("a_mark"), "asked")
    keyed = docs.withColumn("mark", F.xxhash64("text"))
    texts = keyed.join(asked, (F.col("id") == F.col("a_id")) & (F.col("mark") == F.col("a_mark"))).select("id", "mark", "text", "asked")
    cut = materialize(texts.mapInArrow(_cut_pieces(length), _PIECE))
    frequent = materialize(cut.groupBy("anchor").count().filter(F.col("count") > group).select("anchor"))
    few = cut.join(frequent, "anchor", "left_anti")
    indexed = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_index(length), "id long, mark long, spans binary")
    counted = _counted(cut.join(frequent, "anchor", "left_semi"), length)
    again = (keyed.filter(F.octet_length("text") >= length).select("id", "mark", F.octet_length("text").alias("n"))
             .groupBy("id", "mark", "n").count().filter("count > 1"))
    # rows that repeat id and text: the whole text, as one packed span
    whole = again.mapInArrow(_whole, "id long, mark long, spans binary")
    return (places.filter("spans IS NOT NULL").select("id", "mark", "spans").union(indexed).union(counted).union(whole)
            .groupBy("id", "mark").agg(F.collect_list("spans").alias("spans")))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [np.array([0, n], np.int32).tobytes() for n in b.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("mark"), pa.array(spans, pa.binary())], ["id", "mark", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kept, total, gone, n_spans = [], [], [], []
        for x, spans in zip(values(b.column("text")), values(b.column("spans")), strict=True):
            raw = (x or "").encode()
            mask = np.zeros(len(raw) + 1, np.int32)
            for s in spans or ():
                pair = np.frombuffer(s, np.int32).reshape(-1, 2)
                np.add.at(mask, pair[:, 0], 1)
                np.add.at(mask, pair[:, 1], -1)
            out = np.cumsum(mask[:-1]) > 0
            n = int(out.sum())
            kept.append(np.frombuffer(raw, np.uint8)[~out].tobytes() if n else raw)
            total.append(len(raw))
            gone.append(n)
            n_spans.append(int((out[1:] & ~out[:-1]).sum() + out[0]) if n else 0)
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(kept, pa.binary()), *(pa.array(v, pa.int64()) for v in (total, gone, n_spans))], ["row", "kept", "n_bytes", "n_removed", "n_spans"])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Remove every byte covered by a string of `length` bytes that also starts
    anywhere else. One row per input row: row (the whole input row as a
    struct), kept (the bytes that stay), n_bytes, n_removed, n_spans."""
    ship(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(id_col), F.lit(NULL_ID)).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    spans = repeated_spans(slim, length, group).withColumnsRenamed({"id": "s_id", "mark": "s_mark"})
    whole = docs.select(
        F.struct(*columns(docs)).alias("row"), F.coalesce(F.col(id_col), F.lit(NULL_ID)).cast("long").alias("id"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("mark"))
    joined = whole.join(spans, (F.col("id") == F.col("s_id")) & (F.col("mark") == F.col("s_mark")), "left")
    schema = with_row(whole, "kept binary, n_bytes long, n_removed long, n_spans long")
    return joined.select("row", F.col(f"row.{text_col}").alias("text"), "spans").mapInArrow(_cut, schema)
