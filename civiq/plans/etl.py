"""The ETL job - raw CSV -> clean reports table, clean CSV, text index.

Steps (each a distributed write; a written table is re-read for the next
step, so lineage is cut and a lost executor recomputes from files):

1. A1  read the raw CSV (all text, NA markers -> null, arrival order) and vote
       on the date style of every file (B4).
2. B11 clean, validate and de-duplicate.
3. A4  write the report table beside the old one, check NOT NULL, replace it.
4. A2  write the clean CSV beside it; A3 read it back and compare counts.
5. A6  build and write the text index (postings, term stats, corpus stats).
6. A10 source and clean row counts.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import transform, with_date_style
from ..operators.index import TextIndex
from ..session import replace_folder
from ..sources.csv import read_reports_csv, verify_written, write_csv


def run_etl(spark: SparkSession, input_path: str, out_dir: str,
            index: bool = True) -> dict:
    """Returns paths and row counts. ``out_dir`` should be shared storage."""
    reports_path = os.path.join(out_dir, "reports")
    csv_path = os.path.join(out_dir, "reports_csv")
    index_path = os.path.join(out_dir, "report_search")

    # A10 and the NOT NULL check are observed while the clean table is written:
    # one pass over the CSV. The target is replaced only after the check.
    seen, made = Observation("source"), Observation("clean")
    raw = with_date_style(read_reports_csv(spark, input_path)).observe(seen, F.count(F.lit(1)).alias("rows"))
    clean = transform(raw)
    clean = clean.observe(made, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in clean.columns])
    staged = f"{out_dir.rstrip('/')}/_staged_{uuid.uuid4().hex}"
    clean.write.parquet(staged)
    src_rows, got = seen.get["rows"], made.get
    bad = {c: got[f"null_{c}"] for c in clean.columns if got[f"null_{c}"]}
    if bad:
        raise ValueError(f"null values in NOT NULL columns: {bad}")
    replace_folder(spark, staged, reports_path)
    clean_rows = got["rows"]
    reports = spark.read.parquet(reports_path)

    write_csv(reports, csv_path)
    verify_written(spark, csv_path, clean_rows, fmt="csv")

    if index:
        TextIndex.build(reports).write(index_path)
    return {
        "reports": reports_path,
        "csv": csv_path,
        "index": index_path if index else None,
        "source_rows": src_rows,
        "clean_rows": clean_rows,
    }

