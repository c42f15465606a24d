"""Benchmark decontamination with an FM-index per shard of documents.

Method: the documents of a task are cut into shards of about SHARD_WORDS words.
Each shard's words become an integer sequence over the benchmark's vocabulary,
an FM-index is built on it, the benchmark's windows are searched backwards
through wavelet ranks, occurrences are located by sampled suffix positions and
their spans merged. A word outside the benchmark's vocabulary can be in no
match, so a stretch of such words stands as one gap symbol, and so does a run of
vocabulary words shorter than the shortest window: nothing that can match is
left out, and the index holds a small part of the text.

Scale: documents are read once and not shuffled. The benchmark is searched in
blocks of at most BLOCK_BYTES of item text. One block is the usual case and needs
one pass. For a larger benchmark the documents are written once with a number per
row; each block's pass reads them and gives the marks of the few rows that it
hits, which are merged by that number.

Defined results: a null text has no words; a null or wordless item has no
window; windows of items with a null id mark words but are not listed; an item
id that repeats is listed once; other columns are carried through untouched;
`hits` is empty for a document without a hit where the benchmark has more blocks
than one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, columns, materialize, runs, ship, values
from .fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1_500_000
BLOCK_BYTES = 8 << 20

# Bytes of a word: digits, a-z and all of any non-ASCII character; A-Z become
# a-z, every other ASCII byte parts words.
_TABLE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Phrases:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i:i + window]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for n in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == n]
            self.by_length[n] = (np.array(own, np.int64), [sorted(x for x in owners[p] if x is not None) for p in own])
        self.shortest = min(self.by_length, default=0)

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))


def _sequence(ids: np.ndarray, doc: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard without what cannot match: (symbols with 1 as gap, the word
    position of each symbol)."""
    known = ids > 0
    first = runs(known, doc)
    size = np.diff(np.append(first, len(ids)))
    keep = known[first] & (size >= shortest)
    first, size = first[keep], size[keep]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    room = np.cumsum(size + 1) - (size + 1)
    at = np.repeat(first - room, size + 1) + np.arange(int((size + 1).sum()))
    gap = room + size
    seq = ids[np.minimum(at, len(ids) - 1)]
    seq[gap] = 1
    return seq, at


def find(shard: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """For documents given as words: the hit words (as one mask over all words
    in order), the number of words of each document, the items found in each."""
    lens = np.array([len(w) for w in shard], np.int64)
    doc = np.repeat(np.arange(len(shard)), lens)
    ids = np.concatenate([phrases.ids(w) for w in shard]) if len(doc) else np.zeros(0, np.int64)
    cover = np.zeros(len(ids) + 1, np.int64)
    items: list[set[str]] = [set() for _ in shard]
    seq, at = _sequence(ids, doc, phrases.shortest)
    if len(seq):
        index = FMIndex(seq)
        top = len(index.less)
        for n, (patterns, owners) in phrases.by_length.items():
            there = np.flatnonzero((patterns < top).all(axis=1))
            sp, ep = index.search(patterns[there])
            many = ep - sp
            which = np.repeat(there, many)
            rows = np.repeat(sp - (np.cumsum(many) - many), many) + np.arange(len(which))
            word = at[index.locate(rows)]
            np.add.at(cover, word, 1)
            np.add.at(cover, word + n, -1)
            pairs = np.unique(np.stack([doc[word], which]), axis=1)
            for d, p in pairs.T.tolist():
                items[d].update(owners[p])
    return np.cumsum(cover[:-1]) > 0, lens, items


def _pass(shared, text_of):
    """Marks of one block of the benchmark: every column but the text's own is
    handed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for b in batches:
            done = 0
            for part in chunks(map(words_of, values(text_of(b))), len, SHARD_WORDS):
                mask, lens, items = find(part, phrases)
                hits, n_hit = [], []
                for end, n in zip(np.cumsum(lens).tolist(), lens.tolist(), strict=True):
                    own = mask[end - n:end]
                    n_hit.append(int(own.sum()))
                    hits.append(np.packbits(own).tobytes())
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(done, len(part)), pa.array(lens), pa.array(n_hit, pa.int64()), pa.array(hits, pa.binary()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string()))], [b.schema.names[0], "n_words", "n_hit", "hits", "items"])
                done += len(part)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of several blocks of the benchmark for one document -> one."""
    for b in batches:
        n_hit, hits, items = [], [], []
        for masks, found in zip(b.column("all_hits").to_pylist(), b.column("all_items").to_pylist(), strict=True):
            whole = np.bitwise_or.reduce([np.frombuffer(m, np.uint8) for m in masks])
            hits.append(whole.tobytes())
            n_hit.append(int(np.bitwise_count(whole).sum()))
            items.append(sorted({x for own in found for x in own}))
        yield pa.RecordBatch.from_arrays(
            [b.column("at"), pa.array(n_hit, pa.int64()), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))], ["at", "n_hit", "hits", "items"])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).toLocalIterator()
    yield from chunks(((r[0], r[1]) for r in items), lambda r: len(r[1] or "") + 16, BLOCK_BYTES)


_MARKS = "n_words long, n_hit long, hits binary, items array<string>"


def mark(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row per document: row (the columns `keep` of the input row as a
    struct; all of them by default), n_words, n_hit, hits (packed bits, one per
    word), items (ids whose windows occur, sorted as strings)."""
    spark = docs.sparkSession
    ship(spark)
    blocks = _blocks(benchmark, id_col, text_col)
    first, second = next(blocks, []), next(blocks, None)
    kept = [c for c in docs.columns if keep is None or c in keep]
    row = F.struct(*[c for c, name in zip(columns(docs), docs.columns, strict=True) if name in kept]).alias("row")

    def one(state, text_of, block):
        shared = spark.sparkContext.broadcast(Phrases(block, window))
        schema = T.StructType([state.schema.fields[0], *T.StructType.fromDDL(_MARKS).fields])
        return state.mapInArrow(_pass(shared, text_of), schema)

    def own_text(b):
        return b.column("text")

    if second is None:
        if text_col in kept:  # the text is in the row, so it is not sent twice
            at = kept.index(text_col)
            return one(docs.select(row), lambda b: b.column("row").field(at), first)
        return one(docs.select(row, F.col(text_col).alias("text")), own_text, first)
    # a larger benchmark: the table is written once with a number per row, each
    # block's pass gives the marks of the rows that it hits alone
    base = materialize(docs.select(F.monotonically_increasing_id().alias("at"), row, F.col(text_col).alias("text")))
    parts, total = [], None
    for block in chain([first, second], blocks):
        marks = one(base.select("at", "text"), own_text, block)
        total = materialize(marks.select("at", "n_words")) if total is None else total
        parts.append(materialize(marks.filter("n_hit > 0").drop("n_words", "n_hit")))
    every = functools.reduce(DataFrame.unionByName, parts)
    merged = every.groupBy("at").agg(F.collect_list("hits").alias("all_hits"), F.collect_list("items").alias("all_items")).mapInArrow(_merged, "at long, n_hit long, hits binary, items array<string>")
    none = F.array().cast("array<string>")
    return base.select("at", "row").join(total, "at").join(merged, "at", "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("hits", F.lit(b"")).alias("hits"), F.coalesce("items", none).alias("items"))
