"""Prompt assembly (G8) and the batch ask job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sanitize_query
from ..schema import (
    DEFAULT_TOP_K,
    PROMPT_CONTEXT_HEADER,
    PROMPT_INSTRUCTIONS,
    PROMPT_QUESTION_HEADER,
    PROMPT_STATS_HEADER,
    PROMPT_SYSTEM,
)
from .index import TextIndex
from .questions import QuestionStats
from .search import render_contexts, search_auto


def build_prompts(questions: DataFrame, contexts: DataFrame, stats: DataFrame | None = None
                  ) -> DataFrame:
    """(question_id, prompt). A question without hits gets an empty
    context; the statistics block appears only when there are lines."""
    q = questions.select("question_id", "texto").join(contexts, "question_id", "left")
    if stats is not None:
        q = q.join(stats, "question_id", "left")
    else:
        q = q.withColumn("stats", F.lit(""))
    ctx = F.coalesce("context", F.lit(""))
    st = F.coalesce("stats", F.lit(""))
    block = F.when(st != "", F.concat(F.lit(f"\n\n{PROMPT_STATS_HEADER}\n"), st)).otherwise(F.lit(""))
    prompt = F.concat(
        F.lit(f"{PROMPT_SYSTEM}\n\n{PROMPT_CONTEXT_HEADER}\n"), ctx, block,
        F.lit(f"\n\n{PROMPT_QUESTION_HEADER}\n"), F.col("texto"),
        F.lit(f"\n\n{PROMPT_INSTRUCTIONS}\n"))
    return q.select("question_id", prompt.alias("prompt"))


def ask_batch(questions: DataFrame, reports: DataFrame, documents: DataFrame | None = None,
              index: TextIndex | None = None, k: int = DEFAULT_TOP_K,
              use_index: bool = True) -> DataFrame:
    """Statistics over ``reports`` + search (k hits, no filters) over
    ``documents`` (default: the reports themselves) + prompt, per question.
    Returns (question_id, used_fts, prompt). ``use_index=False``: the store has
    no text index, every question is searched by LIKE."""
    docs = documents if documents is not None else reports
    stats = QuestionStats(questions, reports).stats_text()
    hits = search_auto(questions, docs, index, k, use_index=use_index)
    prompts = build_prompts(questions, render_contexts(hits), stats)
    # the search mode depends on the question alone (a question without hits
    # still used the full-text path unless its query sanitizes to nothing)
    fts = questions.select("question_id", ((sanitize_query("texto") != "") & F.lit(use_index)).alias("used_fts"))
    return prompts.join(fts, "question_id").select("question_id", "used_fts", "prompt")
