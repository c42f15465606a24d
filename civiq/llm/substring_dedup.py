"""Substring dedup on word windows with a count-min prefilter.

Method: every chunk of documents makes a sparse count-min sketch of its word
windows (each window once per document, counters saturating at 2); the sketches
are merged block by block in Spark. A merged sketch never underestimates, so a
window that occurs in two documents is always estimated repeated. A second pass
groups only the windows estimated repeated, by 96-bit hashes, and finds the
smallest document that holds each.

Scale: the sketch is `width_bits` wide per row, chosen from the text size and
never above MAX_WIDTH_BITS, so what is broadcast is at most 2 * 2**28 bits
(64 MB, packed); beyond that the estimates only become looser, the result stays
whole. A Python worker unpacks it once and lets the packed blocks go. In the second pass a chunk sends one entry per distinct window and
document at most and settles repeats inside itself, so a window that a third of
all documents share reaches its bucket once per chunk.

Defined results: a null text has no words; a null id counts as larger than any
other id; rows that repeat an id are neither smaller nor larger than each other;
other columns are carried through untouched whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, columns, NULL_ID, release, runs, ship, shuffle_partitions, text_bytes, values, with_row, WordHashes
from .homes import PACKED, pack, unpack

WINDOW = 13
CHUNK_WORDS = 500_000
MIN_WIDTH_BITS, MAX_WIDTH_BITS = 20, 28
BLOCK_BITS = 20
DEPTH = 2
BUCKET_BYTES = 32 << 20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ROW = (np.uint64(1), np.uint64(0xD6E8FEB86659FD93))


def window_hashes(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes (64 and 32 bits) of every run of `width` word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    other = (words ^ (words >> np.uint64(29))) * _M2
    a, b = words[:n].copy(), other[:n].copy()
    for k in range(1, width):
        a *= _M1
        a += words[k:n + k]
        b *= _M1
        b += other[k:n + k]
    a ^= a >> np.uint64(31)
    a *= _M2
    a ^= a >> np.uint64(32)
    return a, (b >> np.uint64(32)).astype(np.uint32)


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Counter of each hash in one row of the sketch."""
    return ((h * _ROW[row]) >> np.uint64(64 - bits)).astype(np.int64)


class _Chunk:
    """Windows of some documents: hashes, the document of each, the position."""

    def __init__(self, part: list[tuple], width: int):
        lens = np.array([len(w) for *_, w in part], np.int64)
        words = np.concatenate([w for *_, w in part]) if part else np.zeros(0, np.uint64)
        h, h2 = window_hashes(words, width)
        starts = np.cumsum(lens) - lens
        doc = np.repeat(np.arange(len(part), dtype=np.int32), lens)[:len(h)]
        pos = (np.arange(len(h)) - starts[doc]).astype(np.int32)
        inside = pos <= lens[doc] - width
        self.h, self.h2, self.doc, self.pos = h[inside], h2[inside], doc[inside], pos[inside]


def _read(batches, width: int) -> Iterator[list[tuple]]:
    """Chunks of (id, text hash, word hashes) of documents with a whole window."""
    known = WordHashes()

    def docs():
        for b in batches:
            known.trim()
            for i, x in zip(b.column("id").to_pylist(), values(b.column("text")), strict=True):
                raw = (x or "").encode()
                words = raw.split()
                if len(words) >= width:
                    yield i, xxhash.xxh64_intdigest(raw, 42), known.of(words)

    yield from chunks(docs(), lambda d: len(d[2]), CHUNK_WORDS)


def _pack(values: np.ndarray) -> bytes:
    """Sorted counters as gaps, byte plane by byte plane, deflated."""
    gaps = np.diff(values, prepend=0).astype(np.uint32)
    return zlib.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.int64)


_SKETCH = "part int, once binary, twice binary"


def _sketch(width: int, bits: int):
    low = min(bits, BLOCK_BITS)

    def run(batches):
        for part in _read(batches, width):
            c = _Chunk(part, width)
            order = np.argsort(c.h, kind="stable")
            h, doc = c.h[order], c.doc[order]
            first = runs(h)
            last = np.append(first[1:], len(h)) - 1
            weight = 1 + (doc[first] != doc[last]).astype(np.uint8)
            h = h[first]
            out: tuple[list, list, list] = ([], [], [])
            for row in range(DEPTH):
                at = cells(h, row, bits)
                by = np.argsort(at, kind="stable")
                at, w = at[by], weight[by]
                first = runs(at)
                many = np.add.reduceat(w, first, dtype=np.int64) > 1 if len(at) else np.zeros(0, bool)
                at = at[first]
                block = at >> low
                edges = np.append(runs(block), len(at))
                for s, e in zip(edges[:-1], edges[1:], strict=True):
                    inside, twice = at[s:e] & ((1 << low) - 1), many[s:e]
                    out[0].append(row << (bits - low) | int(block[s]))
                    out[1].append(_pack(inside[~twice]))
                    out[2].append(_pack(inside[twice]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["part", "once", "twice"])

    return run


def _merge(low: int):
    def run(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << low, np.uint8)
        for b in parts:
            for once, twice in zip(b.column("once"), b.column("twice"), strict=True):
                at = _unpack(once.as_py())
                counts[at] = np.minimum(counts[at] + 1, 2)
                counts[_unpack(twice.as_py())] = 2
        bits = np.packbits(counts >= 2, bitorder="little")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())], ["part", "bits"])

    return run


def repeated_sketch(docs: DataFrame, width: int, bits: int) -> list[tuple[int, bytes]]:
    """Blocks of the merged sketch as packed "counter is 2 or more" bits: at
    most DEPTH * 2**bits bits in all, whatever the number of documents."""
    low = min(bits, BLOCK_BITS)
    parts = docs.mapInArrow(_sketch(width, bits), _SKETCH)
    merged = parts.groupBy("part").applyInArrow(_merge(low), "part int, bits binary")
    return [(r[0], bytes(r[1])) for r in merged.collect()]


def width_bits(total: int) -> int:
    """Counters of a row of the sketch, as a power of two, for texts of so many
    bytes: about three for a word or more, up to MAX_WIDTH_BITS."""
    return min(max(int(total).bit_length() - 1, MIN_WIDTH_BITS), MAX_WIDTH_BITS)


class Estimates:
    """Answers from the sketch. It is broadcast as packed blocks; a Python worker
    unpacks them when it first asks, lets each go then and keeps the counters for
    its next task, so that it never holds both."""

    def __init__(self, blocks: list[tuple[int, bytes]], bits: int):
        self.bits, self.blocks = bits, blocks
        self.rows: np.ndarray | None = None

    def _unpack(self) -> np.ndarray:
        if self.rows is None:
            self.rows = np.zeros((DEPTH, (1 << self.bits) // 8), np.uint8)
        flat = self.rows.reshape(-1, (1 << min(self.bits, BLOCK_BITS)) // 8)
        while self.blocks:
            part, data = self.blocks[-1]
            flat[part] = np.frombuffer(zlib.decompress(data), np.uint8)
            self.blocks.pop()
        return self.rows

    def repeated(self, h: np.ndarray) -> np.ndarray:
        """Whether each window is estimated to be in two documents or more."""
        keep = np.ones(len(h), bool)
        for row, bitmap in enumerate(self._unpack()):
            at = cells(h[keep], row, self.bits)
            keep[keep] = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return keep


_ENTRY = "bucket int, ids binary, hashes binary, counts binary, h binary, h2 binary, pos binary"


def _entry_row(bucket, part, doc, pos, h=None, h2=None):
    """One packed row: entries sorted by document, documents named once."""
    first = runs(doc)
    counts = np.diff(np.append(first, len(doc))).astype(np.int32)
    docs = doc[first]
    ids = np.array([part[d][0] for d in docs], np.int64)
    marks = np.array([part[d][1] for d in docs], np.uint64)
    return (bucket, ids.tobytes(), marks.tobytes(), counts.tobytes(), None if h is None else h.tobytes(), None if h2 is None else h2.tobytes(), pos.tobytes())


def _suspects(width: int, buckets: int, shared):
    schema = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("ids", "hashes", "counts", "h", "h2", "pos")])

    def run(batches):
        estimates = shared.value
        for n, part in enumerate(_read(batches, width)):
            c = _Chunk(part, width)
            keep = estimates.repeated(c.h)
            h, h2, doc, pos = c.h[keep], c.h2[keep], c.doc[keep], c.pos[keep]
            if not len(h):
                continue
            order = np.lexsort((h2, h))
            h, h2, doc, pos = h[order], h2[order], doc[order], pos[order]
            ids = np.array([p[0] for p in part], np.int64)[doc]
            first = runs(h, h2)
            least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(h))))
            settled = ids > least
            out = []
            if settled.any():
                by = np.lexsort((pos[settled], doc[settled]))
                out.append(_entry_row(n % buckets, part, doc[settled][by], pos[settled][by]))
            h, h2, doc, pos = h[~settled], h2[~settled], doc[~settled], pos[~settled]
            bucket = (h2 % np.uint32(buckets)).astype(np.int32)
            by = np.lexsort((pos, doc, bucket))
            bucket, h, h2, doc, pos = bucket[by], h[by], h2[by], doc[by], pos[by]
            edges = np.append(runs(bucket), len(bucket))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                out.append(_entry_row(int(bucket[s]), part, doc[s:e], pos[s:e], h[s:e], h2[s:e]))
            yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _settle(buckets: int):
    def run(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of one bucket of window hashes: the starts whose window is in a smaller
        document, packed for the buckets that gather them by document."""
        settled, open_ = [], []
        for b in parts:
            for r in b.to_pylist():
                counts = np.frombuffer(r["counts"], np.int32)
                entry = (np.repeat(np.frombuffer(r["ids"], np.int64), counts), np.repeat(np.frombuffer(r["hashes"], np.uint64), counts), np.frombuffer(r["pos"], np.int32))
                if r["h"] is None:
                    settled.append(entry)
                else:
                    open_.append((*entry, np.frombuffer(r["h"], np.uint64), np.frombuffer(r["h2"], np.uint32)))
        if open_:
            ids, marks, pos, h, h2 = map(np.concatenate, zip(*open_, strict=True))
            order = np.lexsort((h2, h))
            first = runs(h[order], h2[order])
            least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(h))))
            late = order[ids[order] > least]
            settled.append((ids[late], marks[late], pos[late]))
        found = [np.concatenate(c) for c in zip(*settled, strict=True)]
        if found and len(found[0]):
            yield pack(found[0], found[1], found[2][:, None], buckets)
        release()

    return run


def _gather(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The starts of each document of one bucket, as one row per document."""
    rows = [(i, m, p.tobytes()) for i, m, p in unpack(parts, 1)]
    cols = list(zip(*rows, strict=True)) or [()] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["id", "mark", "starts"])
    release()


def repeated_starts(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(id, mark, starts): packed int32 word positions at which a window starts
    that also starts in a document with a smaller id. `mark` is the text's
    XXH64, so rows that share an id keep their own positions."""
    spark = docs.sparkSession
    total = text_bytes(docs, "text")
    bits = width_bits(total)
    buckets = max(shuffle_partitions(spark), total // BUCKET_BYTES)
    shared = spark.sparkContext.broadcast(Estimates(repeated_sketch(docs, width, bits), bits))
    entries = docs.mapInArrow(_suspects(width, buckets, shared), _ENTRY)
    found = entries.groupBy("bucket").applyInArrow(_settle(buckets), PACKED)
    return found.groupBy("home").applyInArrow(_gather, "id long, mark long, starts binary")


def _cut(width: int):
    def run(batches):
        for b in batches:
            out = []
            for x, starts in zip(values(b.column("text")), values(b.column("starts")), strict=True):
                words = (x or "").encode().split()
                cover = np.zeros(len(words) + 1, np.int32)
                if starts:
                    at = np.frombuffer(starts, np.int32)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + width, -1)
                gone = np.cumsum(cover[:-1]) > 0
                n = int(gone.sum())
                kept = words if not n else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out.append((b" ".join(kept).decode(), len(words), n))
            cols = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["row", "kept", "n_words", "n_removed"])

    return run


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """Remove every word covered by a window of `width` words that also starts
    in a document with a smaller id. Returns one row per input row: row (the
    whole input row as a struct), kept (the words that stay, joined by one
    space), n_words, n_removed."""
    ship(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(id_col), F.lit(NULL_ID)).cast("long").alias("id"), F.col(text_col).alias("text"))
    starts = repeated_starts(slim, width).withColumnsRenamed({"id": "s_id", "mark": "s_mark"})
    whole = docs.select(
        F.struct(*columns(docs)).alias("row"),
        F.coalesce(F.col(id_col), F.lit(NULL_ID)).cast("long").alias("id"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("mark"))
    joined = whole.join(starts, (F.col("id") == F.col("s_id")) & (F.col("mark") == F.col("s_mark")), "left")
    schema = with_row(whole, "kept string, n_words long, n_removed long")
    return joined.select("row", F.col(f"row.{text_col}").alias("text"), "starts").mapInArrow(_cut(width), schema)
