"""Quality rules, the main one being the frequency of lines across documents.

Method: a line is normalised (words joined by one space, A-Z in lower case) and
hashed together with its host. Per host and line the documents that hold it are
counted, once each. A line found in more than LIMIT documents and in more than one
of SHARE of its host's documents is boilerplate and goes from every document. A
document is rejected if it fails the base rules (fewer than 50 words, or over half
of its words in repeated 3-word windows), or if it is depleted: over half of its
words went with such lines.

Scale: the first pass sends partial counts, 24 bytes per distinct line of a chunk.
The lines above the limits mark the bits of a sketch of at most SKETCH_BITS, which
goes to every task. The second pass measures the documents and names those of
their lines whose bits are set; only these, not all lines, meet the exact list
again (salted by document, as one line may be in a third of all documents). Text
is never shuffled.

Defined results: every row is a document, also where rows or ids repeat; a null
text has no words, a null host is a host of its own; lines without a word are not
counted; an empty table gives no rows. Other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, release, ship, values

#: A line above both goes: documents of a host, and one of so many of its documents.
LIMIT, SHARE = 10, 1000
LEAST_WORDS = 50
SKETCH_BITS = 1 << 27
SALTS = 16
CHUNK_LINES = 500_000
_SPACE, _SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
_MASK = (1 << 64) - 1


def host_key(host: str | None) -> int:
    return xxhash.xxh64_intdigest(b"" if host is None else b"h" + host.encode(), 42)


def line_key(host: int, words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words).lower(), host)


def lines_of(text: str | None) -> list[list[bytes]]:
    """The words of every line."""
    return [line.split() for line in (text or "").encode().split(b"\n")]


def _signed(x: np.ndarray | list[int]) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per host and per line of a host, for a chunk of documents."""
    keys, hosts, docs = [], [], {}

    def flush():
        both = np.unique(np.stack([np.array(hosts, np.uint64), np.array(keys, np.uint64)]), axis=1, return_counts=True)
        (h, k), n = both
        h = np.append(h, np.array(list(docs), np.uint64))
        n = np.append(n, np.array(list(docs.values()), np.int64))
        whole = np.arange(len(h)) >= len(k)
        k = np.append(k, np.zeros(len(docs), np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k.view(np.int64)), pa.array(whole), pa.array(n.astype(np.int64))], ["host", "line", "whole", "n"])

    for b in batches:
        for host, text in zip(b.column("host").to_pylist(), values(b.column("text")), strict=True):
            h = host_key(host)
            docs[h] = docs.get(h, 0) + 1
            own = {line_key(h, words) for words in lines_of(text) if words}
            keys.extend(own)
            hosts.extend([h] * len(own))
            if len(keys) >= CHUNK_LINES:
                yield flush()
                keys, hosts, docs = [], [], {}
                release()
    if docs:
        yield flush()


def frequent_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", limit: int = LIMIT, share: int = SHARE) -> DataFrame:
    """host, line (hashes) and n, the documents that hold the line, of all lines
    above the limits."""
    ship(docs.sparkSession)
    parts = docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")).mapInArrow(_count, "host long, line long, whole boolean, n long")
    counts = materialize(parts.groupBy("host", "line", "whole").agg(F.sum("n").alias("n")).filter(F.col("whole") | (F.col("n") > limit)))
    hosts = counts.filter("whole").select("host", F.col("n").alias("docs"))
    return materialize(counts.filter("NOT whole").join(hosts, "host").filter(F.col("n") * share > F.col("docs")).select("host", "line", "n"))


def _sketch(frequent: DataFrame) -> tuple[int, dict[int, bytes]]:
    """Number of bits, and the set bits in blocks of 2**15, at most SKETCH_BITS."""
    n = frequent.count()
    bits = 1 << 15
    while bits < min(SKETCH_BITS, 16 * n):
        bits *= 2
    at = F.pmod(F.col("line"), F.lit(bits))
    rows = frequent.groupBy(F.expr(f"pmod(line, {bits}) div 32768").cast("int").alias("block")).agg(F.bitmap_construct_agg(F.pmod(at, F.lit(32768))).alias("held"))
    return bits, {r[0]: bytes(r[1]) for r in rows.collect()}


class Maybe:
    """Whether a line may be in the list: false only for lines that are not."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self.bits, self.map = bits, np.zeros(bits >> 3, np.uint8)
        for block, held in blocks.items():
            self.map[block << 12:(block << 12) + len(held)] = np.frombuffer(held, np.uint8)

    def holds(self, line: int) -> bool:
        at = line & self.bits - 1
        return bool(self.map[at >> 3] >> (at & 7) & 1)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words covered by windows of `width` words that occur twice or more."""
    if len(words) <= width:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    n, window = len(words) - width + 1, ids[:len(words) - width + 1]
    for k in range(1, width):
        if len(known) ** (k + 1) >= 1 << 63:  # numbers of the windows so far instead
            window = np.unique(window, return_inverse=True)[1]
        window = window * len(known) + ids[k:k + n]
    _, of, count = np.unique(window, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[of] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


_FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())]
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64()), ("places", pa.list_(pa.int32()))]))


def measure(text: str | None) -> tuple[tuple[int, ...], list[list[bytes]]]:
    """The base figures of a text, and the words of its lines."""
    text = text or ""
    raw = text.encode()
    lines = raw.split(b"\n")
    split = [line.split() for line in lines]
    words = [w for line in split for w in line]
    full = [line for line, own in zip(lines, split, strict=True) if own]
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return (len(words), len(text) - spaces, symbols, len(full) - len(set(full)), repeated_words(words)), split


def _measured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = shared.value
        for b in batches:
            figures, found = [], []
            for host, text in zip(b.column("host").to_pylist(), values(b.column("text")), strict=True):
                own, split = measure(text)
                figures.append(own)
                h, at = host_key(host), {}
                for place, words in enumerate(split):
                    if words:
                        key = line_key(h, words)
                        if maybe.holds(key):
                            at.setdefault(key, (len(words), []))[1].append(place)
                found.append([{"line": (k + (1 << 63) & _MASK) - (1 << 63), "words": n * len(places), "places": places} for k, (n, places) in at.items()])
            cols = list(zip(*figures, strict=True)) or [()] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays(
                [b.column("at"), b.column("id"), *(pa.array(c, t) for c, (_, t) in zip(cols, _FIELDS, strict=True)), pa.array(found, _LINES)],
                ["at", "id", *(n for n, _ in _FIELDS), "found"])

    return run


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", limit: int = LIMIT, share: int = SHARE) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, removed_lines (numbers of the lines that go, from 0; see
    without_lines), removed_words, base_failed, depleted, kept."""
    spark = docs.sparkSession
    ship(spark)
    frequent = frequent_lines(docs, host_col, text_col, limit, share)
    shared = spark.sparkContext.broadcast(Maybe(*_sketch(frequent)))
    host = F.col(host_col).cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).alias("id"), host.alias("host"), F.col(text_col).alias("text"))
    more = T.StructType.fromDDL("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, found array<struct<line: long, words: long, places: array<int>>>")
    schema = T.StructType([rows.schema["at"], rows.schema["id"], *more.fields])
    measured = materialize(rows.mapInArrow(_measured(shared), schema))
    named = measured.select("at", F.explode("found").alias("f")).select("at", "f.line", "f.words", "f.places", F.pmod("at", F.lit(SALTS)).cast("int").alias("salt"))
    listed = frequent.select("line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).distinct()
    gone = named.join(listed, ["line", "salt"]).groupBy("at").agg(F.sum("words").alias("removed_words"), F.array_sort(F.flatten(F.collect_list("places"))).alias("removed_lines"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    removed = F.coalesce("removed_words", F.lit(0))
    return (measured.drop("found").join(gone, "at", "left").drop("at")
            .withColumn("removed_words", removed).withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))
            .withColumn("base_failed", base).withColumn("depleted", 2 * F.col("removed_words") > F.col("n_words"))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")))


def without_lines(text: Column, removed_lines: Column) -> Column:
    """A text without the lines of these numbers."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(removed_lines, i)), "\n")
