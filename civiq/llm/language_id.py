"""Language ID by rank-order n-gram profiles.

Method: a language's profile is the list of its PROFILE most frequent letter
n-grams (1 to 3 letters, words padded with a boundary mark), counted over all
learning documents. A document's own most frequent n-grams are compared with
each profile by the out-of-place distance: the sum of rank differences, PROFILE
for an n-gram the profile lacks. The nearest profile wins.

Scale: learning is one pass that sends partial counts per chunk and language;
prediction is a map with the profiles broadcast (languages x PROFILE entries,
the label set of languages being closed). No document is shuffled.

Defined results: a null text or one without a letter is `und` with score 0, as
is everything if nothing can be learned; ties go to the n-gram, and then the
language, that is smaller; a null language label is not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, ship, values, with_row

PROFILE = 400
UNKNOWN = "und"
CHUNK_GRAMS = 4_000_000
PIECE = 1 << 20
_EDGE = 1  # marks a word boundary; not a letter
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter (made once per worker)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _codes(text: str | None) -> np.ndarray:
    """Lower-case letters as code points, each run of others as one edge mark,
    with an edge mark at both ends; empty if there is no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.concatenate([[_EDGE], np.where(letter, codes, _EDGE), [_EDGE]]).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _EDGE) | (codes[:-1] != _EDGE)
    return codes[keep]


def grams(text: str | None) -> Iterator[np.ndarray]:
    """All n-grams of 1 to 3 code points as packed numbers, piece by piece."""
    c = _codes(text)
    for s in range(0, len(c), PIECE):
        p = c[s:s + PIECE + 2]
        n = min(PIECE, len(c) - s)
        one = p[:n]
        two = p[:-1][:n] << 21 | p[1:][:n]
        three = (p[:-2] << 42 | p[1:-1] << 21 | p[2:])[:n]
        yield np.concatenate([one[one != _EDGE], two, three[p[1:-1][:n] != _EDGE]])


def counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    total = 0

    def flush():
        for lang, parts in held.items():
            g, n = counted(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), values(b.column("text")), strict=True):
            for g in grams(text):
                held.setdefault(lang, []).append(g)
                total += len(g)
                if total >= CHUNK_GRAMS:
                    yield from flush()
                    held, total = {}, 0
    yield from flush()


def learn(docs: DataFrame, profile: int = PROFILE) -> DataFrame:
    """docs(lang, text) -> the profiles (lang, gram, rank), ranks from 0."""
    counts = docs.filter("lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(_count, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # the limit is on the row number itself, so each map task sends its first rows alone
    top = total.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= profile)
    return top.select("lang", "gram", (F.col("place") - 1).alias("rank"))


class Profiles:
    """Ranks of all profiles side by side."""

    def __init__(self, rows: list[tuple[str, int, int]], profile: int):
        self.profile = profile
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The nearest language, 1 - distance / the largest distance, and
        whether the text has a letter."""
        g, n = counted(list(grams(text)))
        if not len(g) or not self.langs:
            return UNKNOWN, 0.0, len(g) > 0
        top = g[np.argsort(-n, kind="stable")[:self.profile]]
        at = np.searchsorted(self.grams, top)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != top] = len(self.grams)
        ranks = self.ranks[at]
        off = np.where(ranks < 0, self.profile, np.abs(ranks - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(off.argmin())
        return self.langs[best], 1.0 - float(off[best]) / (self.profile * len(top)), True


def identify(docs: DataFrame, learn_from: Column, text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> DataFrame:
    """Learn profiles from the rows for which `learn_from` is true, then judge
    every row by its text alone: row (the whole input row), lang_pred, score,
    has_letter (false: `und` for want of a letter, not of profiles)."""
    spark = docs.sparkSession
    ship(spark)
    learned = learn(docs.filter(learn_from).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")), profile)
    rows = [tuple(r) for r in learned.collect()]  # languages x PROFILE rows
    shared = spark.sparkContext.broadcast(Profiles(rows, profile))

    def run(batches):
        for b in batches:
            found = [shared.value.predict(x) for x in values(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())], ["row", "lang_pred", "score", "has_letter"])

    whole = docs.select(F.struct(*columns(docs)).alias("row"), F.col(text_col).alias("text"))
    return whole.mapInArrow(run, with_row(whole, "lang_pred string, score double, has_letter boolean"))
