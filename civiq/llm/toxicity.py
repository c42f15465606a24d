"""Toxicity by weak supervision.

Method: many voters look at a text: fixed lexicons, patterns, and lexicons mined
from labelled learning rows. A generative model of their votes, fitted by EM over
the counts of all vote patterns of the whole table, estimates each voter's
accuracy in both classes and the correlations between voters (a tree in which a
voter's vote depends on the class and on one other voter). Its posterior labels
train a linear classifier on mined units, lexicon words and the fixed voters'
votes, which scores every text. Given labels serve to mine units and as known
classes in the EM; the classifier sees posteriors alone.

Scale: texts are read by maps. All labels of learning rows are joined with their
texts (units) and with the votes (known classes), by a shuffle if they are many.
What reaches the driver is bounded by parameters: MINED units, 2**voters vote
patterns, and the features of at most FITTED learning rows, labelled or not (the
documented sample the classifier is fitted on, the first ones in the order of a
hash of the row's id and features).

Defined results: a null or empty text has no unit and no vote and gets the score
of such a text; labels other than 0 and 1 or without id are ignored; of several
labels of one id the larger part decides, toxic if equal; without labels of both
classes nothing is mined and the fixed voters and lexicon words alone decide.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash, materialize, ship, values, with_row

FITTED = 40_000
#: Bits of the sketch of labelled ids.
ID_BITS = 1 << 26
MINED = 2_000
MINED_VOTERS = 6
PREFIXES = (5, 6, 7)
BURST = 6
CHUNK_UNITS = 400_000

# Words of the fixed voters.
LEXICONS = {
    "insult": "idiot idiots moron morons imbecile fool fools clown clowns loser losers dimwit jerk jerks dumb stupid",
    "contempt": "pathetic worthless disgusting useless ridiculous disgrace repulsive despicable vile inferior",
    "dehumanising": "scum vermin trash garbage filth parasite parasites subhuman rat rats pig pigs cockroach",
    "profanity": "damn hell crap bastard bastards bitch ass asshole shit fuck fucking",
    "threat": "kill die hurt destroy burn hang shoot beat murder",
    "other_languages": "idiota estúpido estúpida imbécil basura asqueroso inútil idiote stupide connard ordure dégoûtant "
                       "minable dumm dummkopf abschaum widerlich wertlos versager trottel müll",
}
# Patterns of the pattern voters.
PATTERNS = {
    "address": r"\b(?:you|your|u)\b(?:\W+\w+){0,3}\W+(?:idiot|moron|loser|clown|scum|trash|stupid|pathetic|worthless|disgusting)",
    "shouting": r"\b[A-Z]{4,}\b(?:\W+[A-Z]{4,}\b){2}",
    "exclaiming": r"[!?]{3,}",
}

#: The first voters: lexicons, "dense", patterns.
FIXED = len(LEXICONS) + 1 + len(PATTERNS)

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def units_of(word: str) -> list[str]:
    """What is counted of a word: itself and its beginnings."""
    return [word, *(word[:k] + "~" for k in PREFIXES if len(word) >= k)]


class _Units(dict):
    """word -> values kept for it, made by `make`; keeps no long words and is
    emptied past its bound."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        found = self.make(word)
        if len(word) <= 64:
            self[word] = found
        return found


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    units = _Units(units_of)

    def flush():
        names = sorted(set(counts[0]) | set(counts[1]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[1][n] for n in names], pa.int64()), pa.array([counts[0][n] for n in names], pa.int64())], ["unit", "toxic", "clean"])

    for b in batches:
        for text, label in zip(values(b.column("text")), b.column("label").to_pylist(), strict=True):
            own: Counter = Counter()
            for word, n in Counter(words_of(text)).items():
                for u in units[word]:
                    own[u] += n
            counts[label].update({u: min(n, BURST) for u, n in own.items()})
            if len(counts[0]) + len(counts[1]) > CHUNK_UNITS:
                yield from flush()
                counts = (Counter(), Counter())
    yield from flush()


def mine(labelled: DataFrame, mined: int = MINED) -> list[tuple[str, float]]:
    """labelled(text, label) -> the units that speak most for label 1, with
    their log odds, strongest first (at most `mined` of them)."""
    total = labelled.mapInArrow(_mine, "unit string, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = materialize(total)
    sums = total.agg(F.sum("toxic"), F.sum("clean")).head()
    if not sums[0] or not sums[1]:
        return []
    share = F.lit(sums[0] / sums[1])
    expected = F.col("clean") * share
    strength = (F.col("toxic") - expected) / F.sqrt(F.col("toxic") + expected + 1)
    rows = (total.filter("toxic >= 4").withColumn("z", strength).filter("z > 1.5")
            .select("unit", "z", F.log((F.col("toxic") + 0.5) / (expected + 0.5)).alias("odds"))
            .orderBy(F.desc("z"), "unit").limit(mined).collect())
    return [(r["unit"], r["odds"]) for r in rows]


class Voters:
    """All voters, and the features of the linear classifier."""

    def __init__(self, mined: list[tuple[str, float]], groups: int = MINED_VOTERS):
        self.lexicons = {w: i for i, words in enumerate(LEXICONS.values()) for w in words.split()}
        strong = {u for u, _ in mined}
        # lexicon words are units too, without odds where they are not mined
        units = [*mined, *((w, 0.0) for w in self.lexicons if w not in strong)]
        self.index = {u: i for i, (u, _) in enumerate(units)}
        self.odds = np.array([o for _, o in units])
        self.groups = groups
        self.patterns = [re.compile(p, re.I if k == "address" else 0) for k, p in PATTERNS.items()]
        self.names = [*LEXICONS, "dense", *PATTERNS, *(f"mined_{g}" for g in range(groups))]
        self.width = len(units) + 3 + FIXED

    def _known(self, word: str) -> tuple[int, list[int]]:
        return self.lexicons.get(word, -1), [self.index[u] for u in units_of(word) if u in self.index]

    def reader(self):
        """text -> (votes as bits, unit numbers, unit counts, words)."""
        known = _Units(self._known)
        n_lex = len(LEXICONS)

        def read(text: str | None) -> tuple[int, list[int], list[int], int]:
            words = words_of(text)
            lexical, hits = [0] * n_lex, {}
            for word, n in Counter(words).items():
                lexicon, own = known[word]
                if lexicon >= 0:
                    lexical[lexicon] += n
                for i in own:
                    hits[i] = hits.get(i, 0) + n
            votes = [n > 0 for n in lexical]
            votes.append(sum(lexical) * 150 >= max(len(words), 150) * 1.0 and sum(lexical) > 1)
            votes.extend(bool(p.search(text or "")) for p in self.patterns)
            drawn = [0.0] * self.groups
            for i, n in hits.items():
                if n > 1:
                    drawn[i % self.groups] += self.odds[i] * math.log(n)
            votes.extend(d > 2.0 for d in drawn)
            bits = sum(1 << k for k, v in enumerate(votes) if v)
            at = sorted(hits)
            return bits, at, [hits[i] for i in at], len(words)

        return read


def vote_bits(patterns: np.ndarray, voters: int) -> np.ndarray:
    return (patterns[:, None] >> np.arange(voters)) & 1


class LabelModel:
    """P(class) and P(vote | class, vote of the parent voter), by EM over vote
    patterns with counts; rows whose class is known keep it."""

    ROUNDS = 40

    def __init__(self, patterns: np.ndarray, label: np.ndarray, counts: np.ndarray, voters: int):
        """label: 0, 1, or -1 where the class is not known."""
        v = vote_bits(patterns, voters)
        self.parent = np.full(voters, -1)
        start = 1 / (1 + np.exp(3.0 - 1.5 * v.sum(axis=1)))
        post = np.where(label >= 0, np.clip(label, 0.02, 0.98), start)
        for step in range(self.ROUNDS):
            self._fit(v, post, counts)
            if step == 5:
                self._tree(v, post, counts)
                self._fit(v, post, counts)
            new = self.posterior(patterns)
            post = np.where(label >= 0, np.clip(label, 0.02, 0.98), new)

    def _fit(self, v, post, counts):
        weight = np.stack([(1 - post) * counts, post * counts])
        self.prior = np.clip((weight.sum(axis=1) + 1) / (weight.sum() + 2), 1e-4, 1)
        self.table = np.zeros((v.shape[1], 2, 2))  # voter, class, parent's vote
        for j in range(v.shape[1]):
            p = v[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(v), int)
            for y in (0, 1):
                rate = (weight[y] @ v[:, j] + 0.5) / (weight[y].sum() + 1)
                for b in (0, 1):
                    w = weight[y] * (p == b)
                    # shrunk towards the rate over both votes of the parent
                    self.table[j, y, b] = (w @ v[:, j] + 10 * rate) / (w.sum() + 10)

    def _tree(self, v, post, counts):
        """Correlated voters: the maximum spanning tree of the mutual
        information of two votes given the class."""
        m = v.shape[1]
        info = np.zeros((m, m))
        weight = np.stack([(1 - post) * counts, post * counts])
        total = weight.sum() + 1e-9
        for i in range(m):
            for j in range(i):
                for y in (0, 1):
                    base = weight[y].sum() + 1e-9
                    for a in (0, 1):
                        for b in (0, 1):
                            both = weight[y] @ ((v[:, i] == a) & (v[:, j] == b))
                            left, right = weight[y] @ (v[:, i] == a), weight[y] @ (v[:, j] == b)
                            if both > 0:
                                info[i, j] += both / total * math.log(both * base / (left * right))
                info[j, i] = info[i, j]
        inside = {0}
        while len(inside) < m:
            value, i, j = max((info[i, j], i, j) for i in inside for j in range(m) if j not in inside)
            self.parent[j] = i if value > 1e-5 else -1
            inside.add(j)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        v = vote_bits(patterns, len(self.parent))
        log = np.log(self.prior)[:, None] + np.zeros((2, len(v)))
        for j, p in enumerate(self.parent):
            seen = v[:, p] if p >= 0 else np.zeros(len(v), int)
            for y in (0, 1):
                rate = self.table[j, y][seen]
                log[y] += np.log(np.where(v[:, j] > 0, rate, 1 - rate))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


def features(votes, at, counts, words, odds) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text: (numbers, values)."""
    at, n = np.asarray(at, np.int64), np.asarray(counts, float)
    m = len(odds)
    drawn = float((odds[at] * np.minimum(n, BURST)).sum()) if len(at) else 0.0
    extra = [drawn / math.sqrt(words + 20.0), math.log1p(drawn), drawn / (words + 20.0)]
    fixed = [m + 3 + k for k in range(FIXED) if votes >> k & 1]
    return np.concatenate([at, [m, m + 1, m + 2], fixed]).astype(np.int64), np.concatenate([np.log1p(n), extra, np.ones(len(fixed))])


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, width: int, rounds: int = 400, decay: float = 2e-4) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression on soft
    labels, by Adam over all rows."""
    size = np.array([len(a) for a, _ in rows])
    row, col = np.repeat(np.arange(len(rows)), size), np.concatenate([a for a, _ in rows])
    val = np.concatenate([v for _, v in rows])
    w, m, s = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    mean = np.clip(target.mean(), 1e-4, 1 - 1e-4)
    w[-1] = math.log(mean / (1 - mean))
    for t in range(1, rounds + 1):
        z = np.bincount(row, val * w[col], len(rows)) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target) / len(rows)
        g = np.append(np.bincount(col, val * err[row], width) + decay * w[:-1], err.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    return w


def _maybe_labelled(text: DataFrame, known: DataFrame) -> DataFrame:
    """text(l_id, text) without most rows that have no label: their ids miss a
    sketch of the labelled ids (none with a label is lost)."""
    spark = text.sparkSession
    place = F.pmod(F.xxhash64("l_id"), F.lit(ID_BITS))
    held = known.select(place.alias("at")).groupBy(F.expr("at div 32768").cast("int").alias("block")).agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits"))
    sketch = np.zeros(ID_BITS >> 3, np.uint8)
    for block, bits in held.collect():  # ID_BITS / 8 bytes at most
        sketch[block << 12:(block << 12) + len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    shared = spark.sparkContext.broadcast(sketch)

    def run(batches):
        for b in batches:
            at = b.column("at").to_numpy()
            yield b.select(["l_id", "text"]).filter(pa.array(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0))

    return text.withColumn("at", place).mapInArrow(run, text.schema)


def _read_all(shared):
    def run(batches):
        read = shared.value.reader()
        for b in batches:
            found = [read(x) for x in values(b.column("text"))]
            cols = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["row", "votes", "at", "counts", "words"])

    return run


def score(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns of every row of `docs`, with score and predicted.
    Labels are learned only from rows of `labels` for which `learn_from` (over
    its id column) is true."""
    spark = docs.sparkSession
    ship(spark)
    known = materialize(labels.filter(learn_from & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
                        .groupBy(F.col(id_col).alias("l_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))
    text = _maybe_labelled(docs.select(F.col(id_col).alias("l_id"), F.col(text_col).alias("text")), known)
    # one plan at every size: labels may be many
    voters = Voters(mine(text.join(known.hint("merge"), "l_id").select("text", "label")))
    shared = spark.sparkContext.broadcast(voters)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.col(id_col).alias("l_id"), learn_from.alias("learns")).alias("row"), F.col(text_col).alias("text"))
    schema = with_row(whole, "votes int, at array<int>, counts array<int>, words int")
    read = materialize(whole.mapInArrow(_read_all(shared), schema))
    all_votes = dict(map(tuple, read.groupBy("votes").count().collect()))  # at most 2**voters rows
    if not all_votes:
        return read.select(*[F.col("row")[c].alias(c) for c in keep], F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    seen = read.select(F.col("row.l_id").alias("l_id"), "votes").join(known.hint("merge"), "l_id").groupBy("votes", "label").count().collect()  # at most 2 * 2**voters rows
    for votes, _, n in seen:
        all_votes[votes] -= n
    cols = np.array(sorted([(v, y, n) for v, y, n in seen] + [(v, -1, n) for v, n in all_votes.items() if n]), np.int64)
    model = LabelModel(cols[:, 0], cols[:, 1], cols[:, 2].astype(float), len(voters.names))
    names = ("votes", "at", "counts", "words")
    fit = read.select(F.struct(F.col("row.l_id").alias("l_id"), *names).alias("key"), "row.learns")
    learning = fit.filter("learns")
    if not learning.limit(1).count():
        learning = fit
    # if equal rows lie beyond the hash cut all together, the first rows in order
    rows = first_by_hash(learning, "key", FITTED).collect() or learning.orderBy("key").limit(FITTED).collect()
    rows = sorted((r["key"] for r in rows), key=lambda r: (r["l_id"] is None, r["l_id"] or 0, *(r[c] for c in names)))
    target = model.posterior(np.array([r["votes"] for r in rows], np.int64))
    weights = fit_linear([features(*(r[c] for c in names), voters.odds) for r in rows], target, voters.width)
    linear = spark.sparkContext.broadcast((voters.odds, weights))

    def judge(batches):
        odds, w = linear.value
        for b in batches:
            out = []
            for found in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                i, v = features(*found, odds)
                out.append(float(1 / (1 + np.exp(-np.clip(v @ w[i] + w[-1], -60, 60)))))
            p = np.array(out, float)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["row", "score", "predicted"])

    scored = read.mapInArrow(judge, with_row(read, "score double, predicted int"))
    return scored.select(*[F.col("row")[c].alias(c) for c in keep], "score", "predicted")
