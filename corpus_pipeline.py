"""A training-data pipeline of five stages over the documents table.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and works
on all that its predecessor kept. run() writes every stage's rows as Parquet in
the shared checkpoint folder and reads them again for the next one. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiq.llm import decontaminate, language_id, sentencepiece_codec, simhash_dedup, substring_dedup
from civiq.llm.common import materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go. Profiles are learned from the labelled
    documents; where there are none, every document with a letter stays."""
    found = language_id.identify(docs, F.col("lang").isNotNull())
    return found.filter("has_letter").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash, the one with the smallest
    id stays."""
    return simhash_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that also start in a document with a smaller id go from
    the text (the rest is joined by single spaces; n_chars follows); a document
    that loses all its words goes. Texts that lose nothing stay as they are."""
    found = substring_dedup.dedup_windows(docs).filter("n_removed = 0 OR n_removed < n_words")
    gone = F.col("n_removed") > 0
    new = {"text": F.when(gone, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(gone, F.length("kept")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.filter("n_hit = 0").select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the piece ids of the text, their number, and the text that the
    ids decode to."""
    ids = sentencepiece_codec.encode(docs).select(F.col("row.doc_id").alias("doc_id"), "ids")
    out = sentencepiece_codec.decode(ids)
    return out.select("row.doc_id", "row.ids", F.coalesce(F.size("row.ids"), F.lit(0)).cast("long").alias("n_ids"), F.col("decoded").alias("text"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: XXH64 fingerprints, FM-index and Viterbi are not SQL; tests/llm compares the
#: rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
