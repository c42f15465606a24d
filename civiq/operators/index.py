"""Full-text index over reports: postings, document lengths, corpus statistics.

Tokens follow the index tokenizer: lower-case, accents removed, split at
anything that is not a letter or a digit. The three searchable columns are
tokenized separately and counted together.

* ``postings(term, id, tf, doc_len)`` - one row per (term, document). The
  document length rides along so scoring needs no join back to documents.
* ``term_stats(term, df)`` - document frequency per term.
* ``corpus_stats(n_docs, avgdl)`` - one row.
* ``bounds(term, block, bound)`` - the greatest BM25 contribution of a term in a
  block of consecutive ids, for searches that leave out blocks.

All tokens of a document sit in one row, so they are sorted and counted there:
postings need no hash table and no shuffle. Only rows whose id is (or shares its
sketch bit with) a repeated one are grouped by (term, id).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..schema import BM25_B, BM25_K1
from ..session import materialize
from .sketch import key_sketch, mark_held

INDEX_COLUMNS = ["comentario", "ciudad", "categoria_problema"]
#: Consecutive ids in one block of the bounds.
BLOCK_IDS = 1024


def doc_tokens(reports: DataFrame, id_col: str = "id",
               columns: list[str] | None = None) -> DataFrame:
    """(id, tokens): tokens of the searchable columns, in column order."""
    cols = columns or INDEX_COLUMNS
    toks = F.concat(*[tokenize(c) for c in cols]) if len(cols) > 1 else tokenize(cols[0])
    return reports.select(F.col(id_col).alias("id"), toks.alias("tokens"))


def doc_stats(reports: DataFrame, **kw) -> DataFrame:
    """(id, doc_len)."""
    return doc_tokens(reports, **kw).select("id", F.size("tokens").alias("doc_len"))


def explode_terms(d: DataFrame, *keep: str) -> DataFrame:
    """(*keep, term) - one row per token of ``d.tokens``.

    ``explode`` would let the optimizer infer ``size(tokens) > 0`` and push
    that filter below the projection (and any repartition) into the scan, so
    every text would be tokenized twice. ``explode_outer`` infers nothing;
    the null row it emits for a document without tokens is dropped after the
    generator, where the filter cannot move.
    """
    ex = d.select(*keep, F.explode_outer("tokens").alias("term"))
    return ex.where(F.col("term").isNotNull())


def _row_postings(d: DataFrame) -> DataFrame:
    """(term, id, tf, doc_len) of every row of (id, tokens) by itself. Sorted
    tokens are cut where a new term starts; an outer generator for the reason in
    ``explode_terms``."""
    d = d.select("id", F.sort_array("tokens").alias("tokens"))
    d = d.select("id", "tokens", F.size("tokens").alias("doc_len"))
    token = lambda i: F.get("tokens", i)
    places = F.when(F.col("doc_len") > 0, F.sequence(F.lit(0), F.col("doc_len") - 1)).otherwise(F.array().cast("array<int>"))
    d = d.select("id", "tokens", "doc_len", F.filter(places, lambda i: (i == 0) | (token(i) != token(i - 1))).alias("starts"))
    entries = F.transform("starts", lambda i, j: F.struct(
        token(i).alias("term"), (F.coalesce(F.get("starts", j + 1), F.col("doc_len")) - i).cast("long").alias("tf")))
    return d.select("id", "doc_len", F.inline_outer(entries)).where(F.col("term").isNotNull()).select("term", "id", "tf", "doc_len")


def postings(reports: DataFrame, id_col: str = "id", **kw) -> DataFrame:
    """(term, id, tf, doc_len). Rows that repeat an id (with texts of one length)
    are counted together: ids are counted alone first, and if some repeat, the rows
    that a bit sketch of them lets through are grouped by (term, id)."""
    ids = reports.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    again = materialize(key_sketch(ids.where("n > 1"), "id"))
    if again.isEmpty():
        return _row_postings(doc_tokens(reports, id_col, **kw))
    marked = mark_held(reports, again, id_col, "_again")
    single = _row_postings(doc_tokens(marked.where(~F.col("_again")), id_col, **kw))
    shared = _row_postings(doc_tokens(marked.where("_again"), id_col, **kw))
    return single.unionByName(shared.groupBy("term", "id", "doc_len").agg(F.sum("tf").alias("tf")).select(*single.columns))


def corpus_stats(reports: DataFrame, **kw) -> DataFrame:
    """One row: number of indexed documents and mean document length. Every
    row counts, including documents without tokens."""
    return doc_stats(reports, **kw).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.avg("doc_len"), F.lit(0.0)).alias("avgdl"))


def term_stats(post: DataFrame) -> DataFrame:
    """(term, df): documents containing the term. Postings hold one row per
    (term, document), so this is a plain count with map-side combining."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def contribution(avgdl: Column) -> Column:
    """What one occurrence of a query term adds to a document's BM25 score, before
    its idf: grows with ``tf``, falls with ``doc_len``."""
    k1, b, tf = F.lit(BM25_K1), F.lit(BM25_B), F.col("tf").cast("double")
    return tf * (k1 + F.lit(1.0)) / (tf + k1 * (F.lit(1.0) - b + b * F.col("doc_len") / avgdl))


def term_bounds(post: DataFrame, corpus: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(term, block, bound): the greatest contribution of a term among the
    ``block_ids`` consecutive ids of a block; combined map-side."""
    avgdl = corpus.select(F.col("avgdl").cast("double")).scalar()
    return post.groupBy("term", F.floor(F.col("id") / block_ids).alias("block")).agg(
        F.max(contribution(avgdl)).alias("bound"))


class TextIndex:
    """The index tables of one report DataFrame (lazy until used)."""

    def __init__(self, postings_df: DataFrame, terms_df: DataFrame, corpus_df: DataFrame,
                 bounds_df: DataFrame | None = None, block_ids: int = BLOCK_IDS):
        self.postings = postings_df
        self.terms = terms_df
        self.corpus = corpus_df
        self.block_ids = block_ids
        self._bounds = bounds_df

    @property
    def bounds(self) -> DataFrame:
        """``term_bounds`` of this index, made when first asked for."""
        if self._bounds is None:
            self._bounds = materialize(term_bounds(self.postings, self.corpus, self.block_ids))
        return self._bounds

    def bounds_of(self, terms: DataFrame, few: bool = True) -> DataFrame:
        """The bounds of ``terms(term)``; those that are not there yet are made for
        these terms alone. ``few``: the terms are broadcast."""
        terms = F.broadcast(terms) if few else terms
        if self._bounds is not None:
            return self._bounds.join(terms, "term", "left_semi")
        return materialize(term_bounds(self.postings.join(terms, "term", "left_semi"), self.corpus, self.block_ids))

    @classmethod
    def build(cls, reports: DataFrame, checkpoint: bool = True, **kw) -> "TextIndex":
        """Build the index. With ``checkpoint`` (default) each table is
        materialized once in the shared checkpoint folder - documents are
        tokenized a single time, later searches reuse the tables, and a lost
        executor does not force re-tokenizing. Corpus statistics come from
        the postings (total tokens) and a plain row count (every document,
        with or without tokens)."""
        keep = materialize if checkpoint else (lambda d: d)
        p = keep(postings(reports, **kw))
        total = p.agg(F.coalesce(F.sum("tf"), F.lit(0)).cast("double")).scalar()
        corpus = reports.agg(F.count(F.lit(1)).alias("n_docs")).select(
            "n_docs", F.when(F.col("n_docs") > 0, total / F.col("n_docs"))
            .otherwise(F.lit(0.0)).alias("avgdl"))
        return cls(p, keep(term_stats(p)), keep(corpus))

    def write(self, path: str, partitions: int | None = None) -> None:
        """Store the index (bounds in a folder that names their block length). Postings are range-partitioned on (term, id) - a
        stop word is split across files rather than landing in one - and
        sorted, so Parquet min/max statistics skip row groups for term
        lookups."""
        p = self.postings
        if partitions:
            p = p.repartitionByRange(partitions, "term", "id")
        else:
            p = p.repartitionByRange("term", "id")
        p.sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{path}/postings")
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        self.corpus.write.mode("overwrite").parquet(f"{path}/corpus")
        self.bounds.write.mode("overwrite").parquet(f"{path}/bounds_{self.block_ids}")

    @classmethod
    def read(cls, spark, path: str) -> "TextIndex":
        """A stored index; bounds that were not stored are made when needed."""
        try:
            bounds = spark.read.parquet(f"{path}/bounds_{BLOCK_IDS}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            bounds = None
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"),
                   spark.read.parquet(f"{path}/corpus"), bounds)
