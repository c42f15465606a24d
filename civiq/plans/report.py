"""The analysis job - chart tables, store profile and summary.

The source drew seven PNG charts on one machine; here each chart's data is a
table written to ``out_dir/<chart>``, and the summary (rows, profile, chart
table paths) is one JSON row. The reports are scanned once, to a cube (grouping
sets); every table and the profile come from that.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis as A


def generate_all(spark: SparkSession, reports: DataFrame, out_dir: str, store: str | None = None) -> dict:
    """Paths of the chart tables and the profile. With ``store`` (an ETL output
    folder) the profile says which of its parts are there."""
    cube = A.ReportCube(reports)
    paths = {}
    for name, df in cube.charts().items():
        path = os.path.join(out_dir, name)
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    prof = cube.profile().first().asDict()
    if store is not None:
        prof |= A.store_profile(spark, store).select("has_reports", "has_index").first().asDict()
    summary = {
        "db": {k: (str(v) if v is not None else None) for k, v in prof.items()},
        "charts": paths,
        "rows": prof["row_count"],
    }
    # The summary as a one-row JSON table
    spark.createDataFrame([(json.dumps(summary, ensure_ascii=False),)], "summary string") \
        .select(F.from_json("summary", "db map<string,string>, charts map<string,string>, rows long")
                .alias("s")).select("s.*") \
        .coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "summary"))
    return summary
