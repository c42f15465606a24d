"""Batch search: BM25 ranked full-text search and LIKE substring search.

A batch of questions ``(question_id, texto)`` is searched at once:

* BM25 (C6, E15, F1, D1): query terms are joined to the term statistics and
  to the postings on ``term``; the per-(question, document) aggregate keeps
  documents holding every query term and sums the BM25 contributions
  (k1 = 1.2, b = 0.75, idf floored at 1e-6, corpus statistics over the whole
  index). Blocks of ids whose bound cannot reach the k-th score are not read.
  Top-k per question is a row_number window, which Spark plans as a
  partial WindowGroupLimit before the shuffle, so a question matching most
  documents still ships at most k rows per map task.
* LIKE (C5, F2): ``%q%`` on comment, city or category with SQL-LIKE
  semantics (``%``/``_`` wildcards, ASCII-only case folding), newest first.
  Literal runs between wildcards give grams that a match must hold; a pattern is
  tested against the documents that hold its rarest gram. With an index, a plain
  pattern's inner words give candidates instead. Only patterns without three
  literal letters are broadcast into a nested-loop join, in batches of bounded
  bytes.
* ``search_auto`` (F3): questions that sanitize to an empty query use LIKE,
  the others BM25.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ascii_lower, name_grams, sanitize_query, tokenize
from ..llm.common import ship
from ..schema import BM25_MIN_IDF, CONTEXT_LINE, DEFAULT_TOP_K, HIT_COLUMNS
from ..session import materialize
from .filters import ReportFilter, as_filter, filter_columns_predicate
from .index import TextIndex, contribution, explode_terms
from .sketch import key_sketch, mark_held

# Largest bytes of patterns broadcast into one nested-loop join.
LIKE_BROADCAST_BYTES = 16 << 20
# Letters of the grams that LIKE patterns are filed under, and how many of a
# pattern are looked up to find its rarest.
LONG_GRAM, SHORT_GRAM, FILED_GRAMS = 8, 3, 4
# Bits of the sketch of filed grams (a prime: numbers are told apart by their
# residue), and bytes of text whose windows are looked up at once.
GRAM_BITS, GRAM_STEP = 16_777_213, 1 << 18
# Largest (question, term) table whose derived tables are broadcast.
QUERY_TERMS_BROADCAST_ROWS = 2_000_000
# Largest candidate (question, document, term) table broadcast against postings.
PAIRS_BROADCAST_ROWS = 1_000_000
# Documents whose postings meet questions in one bucket, and (candidate, term)
# pairs that are looked up there at once.
BUCKET_DOCS, PAIRS_STEP = 1024, 1 << 19
# Blocks of ids per question that are scored before a k-th score is known.
FIRST_BLOCKS = 8
# Largest ranked-hit table (k rows per question) broadcast to fetch hit columns.
HITS_BROADCAST_ROWS = 1_000_000

FILTER_COLS = ["f_ciudad", "f_categoria_problema", "f_urgente", "f_fecha_desde", "f_fecha_hasta"]


def query_terms(questions: DataFrame, text_col: str = "texto") -> DataFrame:
    """(question_id, term, qtf, n_terms): tokens of the sanitized question; a
    repeated term scores once per occurrence, so its count is kept."""
    toks = tokenize(sanitize_query(F.col(text_col)))
    q = questions.select("question_id", toks.alias("tokens"))
    q = explode_terms(q.withColumn("n_terms", F.size(F.array_distinct("tokens"))),
                      "question_id", "n_terms")
    return q.groupBy("question_id", "term", "n_terms").agg(F.count(F.lit(1)).alias("qtf"))


def _idf(n_docs: Column, df: Column) -> Column:
    raw = F.ln((n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))
    return F.when(raw <= 0, F.lit(BM25_MIN_IDF)).otherwise(raw)


def bm25_scores(questions: DataFrame, index: TextIndex, qt: DataFrame | None = None,
                n_qt: int | None = None) -> DataFrame:
    """(question_id, id, score) for every document that holds all terms."""
    if qt is None:
        qt = materialize(query_terms(questions))
        n_qt = qt.count()
    terms = _weighted_terms(index, qt, n_qt)
    return _scored(index, terms, n_qt, _rarest(terms))


def _small(df: DataFrame, n: int) -> DataFrame:
    """A query-side table of at most ``n`` rows: broadcast below the bound, so the
    postings are filtered map-side and never shuffled by term; above it the joins
    stay shuffle joins (AQE splits skewed partitions)."""
    return F.broadcast(df) if n <= QUERY_TERMS_BROADCAST_ROWS else df


def _weighted_terms(index: TextIndex, qt: DataFrame, n_qt: int) -> DataFrame:
    """(question_id, term, n_terms, df, weight): query terms that the index holds,
    with what multiplies their contribution (repetitions times idf)."""
    n_docs = index.corpus.select(F.col("n_docs").cast("double")).scalar()
    return index.terms.join(_small(qt, n_qt), "term").select(
        "question_id", "term", "n_terms", "df", (F.col("qtf") * _idf(n_docs, F.col("df"))).alias("weight"))


def _rarest(terms: DataFrame) -> DataFrame:
    """(question_id, term, second, df): the rarest term of each question with its
    documents, and the next one (null if there is none). A question with a term
    absent from the index cannot match anything and has none."""
    two = F.slice(F.array_sort(F.collect_list(F.struct("df", "term"))), 1, 2)
    return (terms.groupBy("question_id", "n_terms").agg(F.count(F.lit(1)).alias("n_known"), two.alias("r"))
            .where(F.col("n_known") == F.col("n_terms"))
            .select("question_id", F.col("r")[0]["term"].alias("term"), F.get("r", F.lit(1))["term"].alias("second"), F.col("r")[0]["df"].alias("df")))


def _scored(index: TextIndex, terms: DataFrame, n_qt: int, rare: DataFrame,
            blocks: DataFrame | None = None) -> DataFrame:
    """BM25 scores of the documents that hold all terms of a question.

    Candidate documents come from each question's rarest term (every match
    must contain it), with ``blocks(question_id, term, block)`` the documents that
    lie in one of the question's blocks; only for those candidates are the other
    terms' postings looked up, by the unique posting key (term, id).
    Without blocks, a candidate must hold the second rarest term too before it is
    multiplied by the question's terms. Few candidates are joined to the postings;
    many, and blocks, meet them in buckets of ids.
    A stop word shared by many questions is therefore shuffled once, never fanned
    out per question, and no (question, document) pair is formed for
    documents lacking the rarest term.
    """
    post = index.postings.select("term", "id")
    if blocks is not None:
        return _scored_in_buckets(index, terms, n_qt, blocks)
    cand = post.join(_small(rare, n_qt), "term").select("question_id", "id", "second")
    seconds = rare.where("second IS NOT NULL").select(F.col("second").alias("term")).distinct()
    held = post.join(_small(seconds, n_qt), "term", "left_semi").select(F.col("term").alias("second"), "id")
    cand = materialize(cand.where("second IS NULL").unionByName(cand.join(held, ["second", "id"], "left_semi")).select("question_id", "id"))
    pairs = cand.join(_small(terms.drop("df"), n_qt), "question_id")
    if pairs.count() > PAIRS_BROADCAST_ROWS:
        return _scored_in_buckets(index, terms, n_qt, cand)
    # candidate (question, document, term) rows are few: probe the postings
    # with them map-side, no shuffle of the postings at all
    rel = index.postings.join(F.broadcast(materialize(pairs)), ["term", "id"])
    agg = rel.groupBy("question_id", "id", "n_terms").agg(
        F.count(F.lit(1)).alias("n_hit"), F.sum(F.col("weight") * contribution(_avgdl(index))).alias("score"))
    return agg.where(F.col("n_hit") == F.col("n_terms")).select("question_id", "id", "score")


def _avgdl(index: TextIndex) -> Column:
    return index.corpus.select(F.col("avgdl").cast("double")).scalar()


def _scored_in_buckets(index: TextIndex, terms: DataFrame, n_qt: int, asked: DataFrame) -> DataFrame:
    """BM25 scores of documents that hold all terms of a question, among its
    ``asked`` ones: (question_id, id), or (question_id, block) for all documents of
    a block. Postings of the asked terms, with numbers for terms, meet the questions
    in buckets of whole blocks of ids. A question goes there once with its list of
    terms, so no (question, document, term) row is formed."""
    spark = index.postings.sparkSession
    ship(spark)
    by_block = "block" in asked.columns
    asked = asked.where(F.col("block" if by_block else "id").isNotNull())
    wanted = asked.select("question_id").distinct()
    own = terms.join(wanted, "question_id", "left_semi")
    numbers = materialize(own.select("term").distinct().withColumn("number", F.monotonically_increasing_id()))
    lists = own.join(_small(numbers, n_qt), "term").groupBy("question_id", "n_terms").agg(
        F.sort_array(F.collect_list(F.struct("number", "weight"))).alias("l")).select(
        "question_id", "n_terms", F.col("l.number").alias("numbers"), F.col("l.weight").alias("weights"))
    n_buckets = -(-(index.corpus.head()["n_docs"] or 1) // BUCKET_DOCS)
    block = F.floor(F.col("id") / index.block_ids)
    bucket = F.pmod(F.xxhash64("block" if by_block else "id"), F.lit(n_buckets)).alias("bucket")
    post = index.postings.where(F.col("id").isNotNull())
    if by_block:
        post = post.withColumn("block", block)
        found = asked.select("block").distinct()
        post = post.join(F.broadcast(found) if found.count() <= HITS_BROADCAST_ROWS else found, "block", "left_semi")
        groups = asked.select(bucket, "question_id", F.array("block").alias("places"))
    else:
        groups = asked.select(bucket, "question_id", "id").groupBy("bucket", "question_id").agg(F.collect_set("id").alias("places"))
    post = post.join(_small(numbers, n_qt), "term").select(bucket, "number", "id", contribution(_avgdl(index)).alias("c"))
    groups = groups.join(lists, "question_id")
    schema = T.StructType([asked.schema["question_id"], index.postings.schema["id"], T.StructField("score", T.DoubleType())])
    return post.groupBy("bucket").cogroup(groups.groupBy("bucket")).applyInArrow(_score_bucket(index.block_ids if by_block else None), schema)


def _score_bucket(block_ids: int | None, step: int = PAIRS_STEP):
    """Postings (number, id, c) and questions (question_id, n_terms, numbers,
    weights, places) of a bucket to (question_id, id, score). Places are ids or,
    with ``block_ids``, one block."""
    def run(post: pa.Table, asked: pa.Table) -> pa.Table:
        column = lambda t, name: t.column(name).combine_chunks()
        if not len(post) or not len(asked):
            empty = np.zeros(0, np.int64)
            return pa.table({"question_id": column(asked, "question_id").take(pa.array(empty)),
                             "id": column(post, "id").take(pa.array(empty)), "score": pa.array(empty, pa.float64())})
        docs, local = np.unique(column(post, "id").to_numpy(zero_copy_only=False), return_inverse=True)
        known, number = np.unique(column(post, "number").to_numpy(), return_inverse=True)
        m = len(docs)
        # postings in the order of (term, document), rows of one pair added up
        key, c = number * m + local, column(post, "c").to_numpy()
        order = np.lexsort((c, key))
        key, first = np.unique(key[order], return_index=True)
        c, count = np.add.reduceat(c[order], first), np.diff(first, append=len(order))

        lists = column(asked, "numbers")
        flat, weight = lists.flatten().to_numpy(), column(asked, "weights").flatten().to_numpy()
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        start = np.cumsum(size) - size
        term = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        # the questions whose terms the bucket all knows
        rows = np.flatnonzero(np.logical_and.reduceat(known[term] == flat, start))
        places = column(asked, "places").take(pa.array(rows))
        if block_ids:
            # candidates: in the block, the documents of the term with fewest there
            block, own = places.flatten().to_numpy(), np.floor(docs / block_ids).astype(np.int64)
            at, back = _spread(start[rows], size[rows])
            low = np.searchsorted(key, term[at] * m + np.searchsorted(own, block, "left")[back])
            n = np.searchsorted(key, term[at] * m + np.searchsorted(own, block, "right")[back]) - low
            best = np.lexsort((n, back))[np.cumsum(size[rows]) - size[rows]]
            at, back = _spread(low[best], n[best])
            row, doc = rows[back], key[at] % m
        else:
            row = np.repeat(rows, np.diff(places.offsets.to_numpy()))
            doc = np.searchsorted(docs, places.flatten().to_numpy(zero_copy_only=False))
        n_terms = column(asked, "n_terms").to_numpy()
        hit, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        cuts = np.append(np.searchsorted(np.cumsum(size[row]), np.arange(0, size[row].sum(), step), "right"), len(row))
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if s == e:
                continue
            at, back = _spread(start[row[s:e]], size[row[s:e]])
            want = term[at] * m + doc[s:e][back]
            j = np.minimum(np.searchsorted(key, want), len(key) - 1)
            there, head = key[j] == want, np.cumsum(size[row[s:e]]) - size[row[s:e]]
            whole = np.add.reduceat(count[j] * there, head) == n_terms[row[s:e]]
            scores.append(np.add.reduceat(weight[at] * c[j] * there, head)[whole])
            hit.append(s + np.flatnonzero(whole))
        hit = np.concatenate(hit)
        return pa.table({"question_id": column(asked, "question_id").take(pa.array(row[hit])),
                         "id": pa.array(docs[doc[hit]], column(post, "id").type), "score": np.concatenate(scores)})

    return run


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of runs laid end to end, and the number of each one's run."""
    back = np.repeat(np.arange(len(size)), size)
    return np.arange(len(back)) + (start - (np.cumsum(size) - size))[back], back


def _block_bounds(index: TextIndex, terms: DataFrame, n_qt: int, rare: DataFrame) -> DataFrame:
    """(question_id, term, block, bound): the blocks that hold every term of a
    question, with its rarest term and a bound that no document of the block
    scores above. Blocks come from the rarest term, so a question has no more of
    them than that term has documents."""
    asked = terms.join(_small(rare.select("question_id").distinct(), n_qt), "question_id", "left_semi")
    held = index.bounds_of(materialize(asked.select("term").distinct()), n_qt <= QUERY_TERMS_BROADCAST_ROWS)
    own = held.select("term", "block").join(_small(rare, n_qt), "term").select(
        "question_id", "block", F.col("term").alias("rare"))
    asked = own.join(_small(terms.drop("df"), n_qt), "question_id")
    return (asked.join(held, ["term", "block"]).groupBy("question_id", "rare", "block", "n_terms")
            .agg(F.count(F.lit(1)).alias("n_hit"), F.sum(F.col("weight") * F.col("bound")).alias("bound"))
            .where(F.col("n_hit") == F.col("n_terms")).select("question_id", F.col("rare").alias("term"), "block", "bound"))


def bm25_top(index: TextIndex, qt: DataFrame, n_qt: int, k: int,
             allowed: Callable[[DataFrame], DataFrame], first: int = FIRST_BLOCKS) -> DataFrame:
    """(question_id, rank, id, score): the k best documents of each question among
    those that ``allowed`` keeps.

    Where the rarest term has no more documents than ``first`` blocks have ids, all
    of them are candidates. For other questions the ``first`` blocks with the
    highest bounds are scored; of the other blocks only those are read whose bound
    reaches the k-th score found so far (equal scores included: the smaller id may
    lie there), so postings of a frequent term are mostly left alone."""
    order = [F.desc(F.round("score", 9)), F.asc("id")]
    terms = materialize(_weighted_terms(index, qt, n_qt))
    rare = materialize(_rarest(terms))
    w = Window.partitionBy("question_id").orderBy(F.desc("bound"), F.asc("block"))
    few = F.col("df") <= first * index.block_ids
    direct = allowed(_scored(index, terms, n_qt, rare.where(few)))
    rare = rare.where(~few)
    if rare.isEmpty():
        return top_k_per_question(direct, k, order)
    direct = top_k_per_question(direct, k, order)
    bounds = materialize(_block_bounds(index, terms, n_qt, rare).withColumn("place", F.row_number().over(w)))
    head = allowed(_scored(index, terms, n_qt, rare, bounds.where(F.col("place") <= first)))
    rest = bounds.where(F.col("place") > first)
    if rest.isEmpty():
        return direct.unionByName(top_k_per_question(head, k, order))
    head = materialize(top_k_per_question(head, k, order))
    kth = head.where(F.col("rank") == k).select("question_id", F.col("score").alias("kth"))
    # scores are compared rounded to 9 places: half a unit on either side
    reach = F.col("kth").isNull() | (F.col("bound") >= F.col("kth") - F.lit(2e-9) * (1 + F.abs("kth")))
    more = materialize(rest.join(kth, "question_id", "left").where(reach).select("question_id", "term", "block"))
    found = allowed(_scored(index, terms, n_qt, rare, more))
    return direct.unionByName(top_k_per_question(head.drop("rank").unionByName(found), k, order))


def _with_filters(scored: DataFrame, reports: DataFrame, flt: ReportFilter | dict | None,
                  questions: DataFrame | None) -> DataFrame:
    """Keep matches allowed by the filters, before ranking."""
    f = as_filter(flt)
    if f != ReportFilter():
        scored = scored.join(reports.where(f.predicate()).select("id"), "id", "left_semi")
    if questions is not None and all(c in questions.columns for c in FILTER_COLS):
        qf = questions.select("question_id", *FILTER_COLS)
        rf = reports.select("id", "ciudad", "categoria_problema", "urgente", "fecha_reporte")
        scored = (scored.join(qf, "question_id").join(rf, "id")
                  .where(filter_columns_predicate("f_"))
                  .select(*[c for c in scored.columns]))
    return scored


def _filter_cols(questions: DataFrame) -> list[str]:
    """The per-question filter columns, if the questions carry them."""
    return FILTER_COLS if all(c in questions.columns for c in FILTER_COLS) else []


def _distinct_queries(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(asked, fan): one question per distinct query - the bag of its terms and
    its filters - and (question_id, asked_id) for all questions. Ranking runs
    per distinct query; only ranked rows are fanned out."""
    extra = _filter_cols(questions)
    terms = F.array_sort(tokenize(sanitize_query(F.col("texto"))))
    keyed = materialize(questions.select("question_id", "texto", *extra, F.to_json(F.struct(terms.alias("t"), *extra)).alias("_key")))
    first = keyed.groupBy("_key").agg(F.min("question_id").alias("asked_id"))
    fan = keyed.join(first, "_key").select("question_id", "asked_id")
    asked = keyed.join(first.select(F.col("asked_id").alias("question_id")), "question_id", "left_semi").drop("_key")
    return asked, fan


def top_k_per_question(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    w = Window.partitionBy("question_id").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _attach_hits(top: DataFrame, reports: DataFrame, bounded: bool = False) -> DataFrame:
    """Hit columns for the ranked rows. ``bounded`` says the caller proved
    the ranked table small (k rows per question, questions counted): it is
    then broadcast and the reports are only scanned, never shuffled by id.
    AQE would reach the same join only after shuffling the whole report
    table, so the bound is checked up front; above it the join shuffles."""
    return (F.broadcast(top) if bounded else top).join(reports.select(*HIT_COLUMNS), "id")


def bm25_search(questions: DataFrame, reports: DataFrame, index: TextIndex | None = None,
                k: int = DEFAULT_TOP_K, filters: ReportFilter | dict | None = None,
                with_hits: bool = True) -> DataFrame:
    """F1: ranked top-k per question: (question_id, rank, id, score, hit columns)."""
    index = index or TextIndex.build(reports)
    asked, fan = _distinct_queries(questions)
    qt = materialize(query_terms(asked))
    n_qt = qt.count()
    top = bm25_top(index, qt, n_qt, k, lambda scored: _with_filters(scored, reports, filters, asked))
    top = top.select(F.col("question_id").alias("asked_id"), "rank", "id", F.round("score", 6).alias("score"))
    # at most k rows per query, and no more queries than query-term rows
    hits = _attach_hits(top, reports, k * n_qt <= HITS_BROADCAST_ROWS) if with_hits else top
    return fan.join(hits, "asked_id").select("question_id", "rank", "id", "score", *[
        c for c in hits.columns if c not in ("asked_id", "rank", "id", "score")])


def contains_regex(q: Column) -> Column:
    """A regular expression for what LIKE ``%q%`` finds. The parts between ``%``
    are each taken where they first occur, behind the one before, and never looked
    for again (atomic groups): a text is read once, where LIKE's own expression
    goes through it again for every place of an earlier part."""
    escaped = F.regexp_replace(q, r"([\x21-\x24\x26-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7E])", r"\\$1")
    parts = F.regexp_replace(F.replace(escaped, F.lit("_"), F.lit(".")), "%+", ")(?>.*?")
    return F.concat(F.lit(r"(?s)\A(?>.*?"), parts, F.lit(")"))


def literal_runs(q: Column) -> Column:
    """The distinct literal runs between the wildcards of a pattern."""
    return F.array_distinct(F.regexp_extract_all(q, F.lit("([^%_]+)"), F.lit(1)))


def _like_test() -> Column:
    """A pattern without ``%``/``_`` is a plain substring test (no regex); the
    others must hold every literal run before the expression is tried."""
    sub, pat = F.col("q"), F.col("pat")
    plain = F.col("_c").contains(sub) | F.col("_ci").contains(sub) | F.col("_k").contains(sub)

    def held(c: str) -> Column:
        return F.forall("runs", lambda run: F.col(c).contains(run)) & F.rlike(F.col(c), pat)

    return F.when(F.col("wild"), held("_c") | held("_ci") | held("_k")).otherwise(plain)


def _like_join(pats: DataFrame, docs: DataFrame) -> DataFrame:
    """Nested-loop match of broadcast patterns against documents, in one pass
    over the documents: for patterns without a literal gram alone."""
    return docs.join(F.broadcast(pats), _like_test(), "inner")


def _inner_terms(q: Column) -> Column:
    """Terms that any text containing the plain pattern must hold whole: those
    not touching an end of the pattern."""
    core = F.regexp_replace(q, r"^[\p{L}\p{N}\p{M}]+|[\p{L}\p{N}\p{M}]+$", "")
    return F.array_distinct(tokenize(core))


def _like_candidates(patterns: DataFrame, docs: DataFrame, index: TextIndex) -> DataFrame:
    """Matches of plain patterns with inner terms: candidates come from the
    postings of a pattern's rarest inner term, and only these are tested."""
    terms = patterns.select("_key", F.size("_inner").alias("n"), F.explode("_inner").alias("term"))
    rare = (terms.join(index.terms, "term").groupBy("_key", "n")
            .agg(F.count(F.lit(1)).alias("known"), F.min(F.struct("df", "term")).alias("r"))
            .where("known = n").select("_key", F.col("r.term").alias("term")))
    cand = index.postings.select("term", "id").join(rare, "term").select("_key", "id")
    sub = F.col("q")
    return (cand.join(patterns, "_key").join(docs, "id")
            .where(F.col("_c").contains(sub) | F.col("_ci").contains(sub) | F.col("_k").contains(sub)))


def literal_grams(q: Column) -> Column:
    """Substrings that every match of a LIKE pattern holds: LONG_GRAM letters of
    its longest literal run, or SHORT_GRAM if the run is shorter; FILED_GRAMS of
    them, the first in the order of a hash. None for runs that are shorter still."""
    runs = F.transform(literal_runs(q), lambda r: F.struct(F.length(r).alias("n"), r.alias("run")))
    run = F.array_max(runs)["run"]
    grams = F.when(F.length(run) >= LONG_GRAM, name_grams(run, LONG_GRAM)).when(F.length(run) >= SHORT_GRAM, name_grams(run, SHORT_GRAM))
    first = F.slice(F.array_sort(F.transform(grams, lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g")))), 1, FILED_GRAMS)
    return F.coalesce(F.transform(first, lambda x: x["g"]), F.array().cast("array<string>"))


def _gram_number(gram: Column) -> Column:
    """The bytes that a gram is looked up by as a number: its first LONG_GRAM, or
    SHORT_GRAM for a short one. A text that holds the gram holds these bytes."""
    n = F.when(F.length(gram) >= LONG_GRAM, LONG_GRAM).otherwise(SHORT_GRAM)
    return F.conv(F.hex(F.substring(F.encode(gram, "UTF-8"), F.lit(1), n)), 16, -10).cast("long")


def _gram_sketch(filed: DataFrame) -> bytes:
    """A bit for each residue of the filed numbers: 2 MB, however many there are."""
    place = F.pmod("number", F.lit(GRAM_BITS)) + F.lit(1)
    rows = filed.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    size = 1 << 12  # bytes of one bitmap
    out = bytearray(size * (GRAM_BITS // (8 * size) + 1))
    for r in rows:
        out[(r["b"] - 1) * size:r["b"] * size] = r["bits"]
    return bytes(out)


def _find_grams(shared, lengths: list[int]):
    """Batches of (id, texts...) to the (id, number) of their windows of so many
    bytes whose bit is set, each once per batch and text column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_set = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        for b in batches:
            for column in b.columns[1:]:
                rows, numbers = gram_hits(column, lengths, is_set)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(numbers)], ["id", "number"])

    return run


def gram_hits(column: pa.Array, lengths: list[int], is_set: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) pairs, distinct: which rows of a text column hold a window of
    one of these lengths in bytes whose number has its bit set. A window lies in
    one text; nulls hold none."""
    column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    rows, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in lengths:
        for at in range(0, len(text) - n + 1, GRAM_STEP):
            part = text[at:at + GRAM_STEP + n - 1].astype(np.uint64)
            value = np.zeros(len(part) - n + 1, np.uint64)
            for j in range(n):
                value = value << np.uint64(8) | part[j:j + len(value)]
            value = value.view(np.int64)
            hit = np.flatnonzero(is_set[value % GRAM_BITS])
            row = np.searchsorted(off, at + hit, "right") - 1
            inside = at + hit + n <= off[row + 1]
            rows.append(row[inside])
            numbers.append(value[hit[inside]])
    pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(numbers)]), axis=1)
    return pairs[0], pairs[1]


def _like_by_grams(patterns: DataFrame, docs: DataFrame) -> DataFrame:
    """Matches of patterns with literal grams, in one pass over the documents'
    bytes: windows that the sketch of the filed grams lets through are joined with
    the grams and written as (id, number); a pattern goes to the documents that
    hold its rarest gram, and only these are tested. A pattern with a gram that no
    document holds matches nothing."""
    spark = docs.sparkSession
    filed = materialize(patterns.select("_key", F.explode("_grams").alias("gram")).select(
        "_key", _gram_number(F.col("gram")).alias("number"), F.when(F.length("gram") >= LONG_GRAM, LONG_GRAM).otherwise(SHORT_GRAM).alias("n")))
    lengths = sorted(r[0] for r in filed.select("n").distinct().collect())  # at most two
    ship(spark)
    sketch = spark.sparkContext.broadcast(_gram_sketch(filed))
    schema = T.StructType([docs.schema["id"], T.StructField("number", T.LongType())])
    grams = docs.select("id", "_c", "_ci", "_k").mapInArrow(_find_grams(sketch, lengths), schema)
    held = materialize(grams.join(filed.select("number").distinct(), "number").select("id", "number").distinct())
    df = held.groupBy("number").agg(F.count(F.lit(1)).alias("df"))
    rarest = (filed.join(df, "number", "left").groupBy("_key").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "number")).alias("r"))
              .where("r.df > 0").select("_key", F.col("r.number").alias("number")))
    cand = materialize(held.join(rarest, "number").select("_key", "id").distinct())
    asked = docs.join(F.broadcast(cand.select("id").distinct()), "id", "left_semi") if cand.count() <= HITS_BROADCAST_ROWS else mark_held(
        docs, key_sketch(cand, "id"), "id", "_held").where("_held").drop("_held")
    return cand.join(patterns.select("_key", "q", "pat", "runs", "wild"), "_key").join(asked, "id").where(_like_test()).drop("q", "pat", "runs", "wild")


def _like_pattern_matches(questions: DataFrame, reports: DataFrame,
                          filters: ReportFilter | dict | None, text_col: str,
                          index: TextIndex | None = None) -> tuple[DataFrame, DataFrame]:
    """(pats(question_id, _key), matched(_key, hit columns)): matches per
    distinct pattern and filters, not yet fanned out to the questions. With an
    index, patterns with inner terms take candidates from their postings; others
    with a literal gram meet the reports that hold it; only patterns without
    either are tested against every report."""
    extra = _filter_cols(questions)
    q = ascii_lower(F.col(text_col))
    pats = questions.select("question_id", q.alias("q"), *extra)
    pats = pats.withColumn("_key", F.to_json(F.struct("q", *extra)))
    docs = reports.where(as_filter(filters).predicate()).select(
        *HIT_COLUMNS, ascii_lower("comentario").alias("_c"), ascii_lower("ciudad").alias("_ci"),
        ascii_lower("categoria_problema").alias("_k"))
    # Distinct patterns are what the join has to test; the same pattern asked
    # by many questions is matched once and fanned out by an equi-join.
    distinct = materialize(pats.drop("question_id").distinct().withColumn(
        "wild", F.col("q").contains("%") | F.col("q").contains("_")).withColumn(
        "pat", contains_regex(F.col("q"))).withColumn(
        "runs", literal_runs(F.col("q"))).withColumn(
        "_inner", F.when(F.col("wild"), F.array().cast("array<string>")).otherwise(_inner_terms(F.col("q")))).withColumn(
        "_grams", literal_grams(F.col("q"))))
    out = ["_key", *extra, *HIT_COLUMNS]
    found = []
    if index is not None:
        found.append(_like_candidates(distinct.where(F.size("_inner") > 0), docs, index).select(*out))
        distinct = distinct.where(F.size("_inner") == 0)
    by_grams = distinct.where(F.size("_grams") > 0)
    found.append(_like_by_grams(by_grams, docs).join(by_grams.select("_key", *extra), "_key").select(*out) if extra else _like_by_grams(by_grams, docs).select(*out))
    distinct = distinct.where(F.size("_grams") == 0)
    size = distinct.agg(F.coalesce(F.sum(2 * F.octet_length("q") + F.octet_length("_key") + 64), F.lit(0))).head()[0]
    nb = max(1, math.ceil(size / LIKE_BROADCAST_BYTES))
    bucket = F.pmod(F.xxhash64("_key"), F.lit(nb))
    found += [_like_join(distinct.where(bucket == i) if nb > 1 else distinct, docs).select(*out) for i in range(nb)]
    matched = reduce(DataFrame.unionByName, found)
    if extra:
        matched = matched.where(filter_columns_predicate("f_"))
    return pats.select("question_id", "_key"), matched.select("_key", *HIT_COLUMNS)


def like_matches(questions: DataFrame, reports: DataFrame,
                 filters: ReportFilter | dict | None = None,
                 text_col: str = "texto") -> DataFrame:
    """(question_id, hit columns) for reports whose comment, city or
    category contains the question text (SQL LIKE semantics: ``%``/``_``
    wildcards, ASCII-only case folding, no escape character)."""
    pats, matched = _like_pattern_matches(questions, reports, filters, text_col)
    return matched.join(pats, "_key").select("question_id", *HIT_COLUMNS)


def like_search(questions: DataFrame, reports: DataFrame, k: int = DEFAULT_TOP_K,
                filters: ReportFilter | dict | None = None,
                index: TextIndex | None = None) -> DataFrame:
    """newest-first top-k of the LIKE matches (ties by id); an index of the
    same reports, if there is one, saves testing every report.

    The order depends on the document alone, so the top k of a pattern with its
    filters is the top k of each question asking it: ranking runs per distinct
    pattern on (fecha_reporte, id) only, the texts are attached after the cut,
    and only k rows per question are fanned out."""
    pats, matched = _like_pattern_matches(questions, reports, filters, "texto", index)
    w = Window.partitionBy("_key").orderBy(F.desc("fecha_reporte"), F.asc("id"))
    top = (matched.select("_key", "id", "fecha_reporte").withColumn("rank", F.row_number().over(w))
           .where(F.col("rank") <= k).drop("fecha_reporte"))
    hits = top.join(reports.select(*HIT_COLUMNS), "id")
    return hits.join(pats, "_key").select("question_id", "rank", *HIT_COLUMNS)


def search_auto(questions: DataFrame, reports: DataFrame, index: TextIndex | None = None,
                k: int = DEFAULT_TOP_K, filters: ReportFilter | dict | None = None,
                use_index: bool = True) -> DataFrame:
    """BM25 for questions with a non-empty sanitized query, LIKE for the
    rest; ``used_fts`` says which. Zero BM25 hits do not fall back. Without an
    index (``use_index=False``: the store has none) every question uses LIKE."""
    if not use_index:
        return like_search(questions, reports, k, filters).withColumn("used_fts", F.lit(False))
    s = questions.withColumn("_san", sanitize_query("texto"))
    fts_q = s.where(F.col("_san") != "").drop("_san")
    like_q = s.where(F.col("_san") == "").drop("_san")
    a = bm25_search(fts_q, reports, index, k, filters).drop("score").withColumn(
        "used_fts", F.lit(True))
    b = like_search(like_q, reports, k, filters, index).withColumn("used_fts", F.lit(False))
    return a.unionByName(b)


def render_contexts(hits: DataFrame) -> DataFrame:
    """One context text per question: a line per hit, in rank order."""
    line = F.format_string(CONTEXT_LINE.replace("{}", "%s"), F.col("id"), F.col("fecha_reporte"),
                           F.col("ciudad"), F.col("categoria_problema"), F.col("urgente"),
                           F.col("comentario"))
    return hits.groupBy("question_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", line.alias("l")))),
                                 lambda x: x["l"]), "\n").alias("context"))
