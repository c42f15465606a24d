"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, conversation_repair, decontaminate, language_id, license_scan, line_quality, lm_scoring, merkle_manifest, sentencepiece_codec, simhash_dedup, sql, substring_dedup,
               suffix_dedup, toxicity)
from .common import remainder, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 3, 1)
    out = language_id.identify(table(spark, sf_dir, "documents"), ~held_out)
    return out.select(F.col("row.doc_id").alias("doc_id"), remainder(F.col("row.doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_scoring.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7, 2))
    return out.withColumnRenamed("id", "doc_id")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = sentencepiece_codec.encode(table(spark, sf_dir, "documents")).select("row.doc_id", "row.text", "ids")
    out = sentencepiece_codec.decode(ids)
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(F.size("row.ids"), F.lit(0)).cast("long").alias("n_ids"),
        F.sha2(F.array_join(F.col("row.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.col("decoded").eqNullSafe(F.col("row.text")).alias("round_trip"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.size("licenses").cast("long").alias("n_places"),
        F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("licenses.dice"), F.lit(0.0)).alias("score"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~remainder(F.col("doc_id"), 5, 0))
    return out.select("doc_id", remainder(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_windows(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_quality.judge(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of `conv_id:turn` modulo 20."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    cols = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    report = conversation_repair.Repair(damaged(conversations), *cols).report()
    every = conversations.select("conv_id").distinct().withColumn("k", conversation_repair.key(F.col("conv_id")))
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(report, "k", "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    without = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    out = merkle_manifest.prove(docs, F.col("doc_id"), F.col("source"), merkle_manifest.leaf(*fields, F.col("text")), F.when(tampered, merkle_manifest.leaf(*fields, without)))
    return out.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_license_scan": op6_license_scan,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL = {
    "op7_suffix_dedup": sql.OP7,
    "op8_benchmark_decontamination": sql.OP8,
    "op10_substring_dedup": sql.OP10,
    "op11_quality_rules": sql.OP11,
    "op12_conversation_repair": sql.OP12,
    "op13_merkle_manifest": sql.OP13,
}
