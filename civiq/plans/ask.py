"""Batch ask - a table of questions to finished prompts.

Statistics come from the report table, contexts from the text index (the
default is the reports themselves, as in the source). The job stops at the
prompt column; calling a language model is outside the data work.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.index import TextIndex
from ..operators.prompts import ask_batch
from ..schema import DEFAULT_TOP_K


def ask(spark: SparkSession, questions: DataFrame, out_dir: str,
        k: int = DEFAULT_TOP_K, write_to: str | None = None) -> DataFrame:
    """``questions(question_id, texto)`` against the ETL output in ``out_dir``."""
    reports = spark.read.parquet(os.path.join(out_dir, "reports"))
    try:
        index = TextIndex.read(spark, os.path.join(out_dir, "report_search"))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        index = None  # no stored index: questions are searched by LIKE
    prompts = ask_batch(questions, reports, reports, index, k, use_index=index is not None)
    if write_to:
        prompts.write.mode("overwrite").parquet(write_to)
        return spark.read.parquet(write_to)
    return prompts
