"""Sources, sinks and whole pipelines: files are written to the shared
checkpoint folder and read back."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import analysis as A
from ..operators import clean as C
from ..plans.ask import ask
from ..plans.etl import run_etl
from ..plans.report import generate_all
from ..schema import COLUMN_RENAME_MAP, REPORT_COLUMNS, REPORT_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources import csv as CSV
from ..sources import tables as S
from . import register
from .cleaning import chain, cleaned_as_reports
from .questions import ask_sql
from .reports import correlation_rows

_RAW = list(COLUMN_RENAME_MAP)
_COLS = ", ".join(REPORT_COLUMNS)


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/civiq-files/{uuid.uuid4().hex}"


def _raw_files(spark, sf) -> str:
    """The raw reports as CSV in arrival order (one range of it per file)."""
    base = _folder(spark)
    CSV.write_csv(S.raw_reports(spark, sf).orderBy("seq").select(*_RAW), base)
    return base


def csv_scan(spark, sf):
    """Two folders of files whose headers are in opposite order."""
    base, raw = _folder(spark), S.raw_reports(spark, sf)
    CSV.write_csv(raw.where("seq % 2 = 0").select(*_RAW), f"{base}/a")
    CSV.write_csv(raw.where("seq % 2 = 1").select(*reversed(_RAW)), f"{base}/b")
    return CSV.read_reports_csv(spark, f"{base}/*").select(*_RAW)


#: Rows of one file that csv_scan_split writes: one task sorts and writes them.
ROWS_A_FILE = 1_000_000


def csv_scan_split(spark, sf):
    """One file (for more than ROWS_A_FILE rows: one for each such range of them)
    whose comments hold line breaks, commas and quotes, read in sixteen splits."""
    base = _folder(spark)
    broken = F.concat(F.coalesce("Comentario", F.lit("")), F.lit('\n"'), F.coalesce("Nombre", F.lit("-")), F.lit('",\r\n""'), F.coalesce("Ciudad", F.lit("-")))
    comment = F.when(F.col("seq") % 3 != 0, broken).otherwise(F.col("Comentario"))
    raw = S.raw_reports(spark, sf).withColumn("Comentario", comment)
    files = max(1, math.ceil(raw.count() / ROWS_A_FILE))
    CSV.write_csv(raw.repartitionByRange(files, "seq").sortWithinPartitions("seq").select(*_RAW), base)
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(base).agg(F.max("length")).head()[0]
    return CSV.read_reports_csv(spark, base, split_bytes=max(1, size // 16)).select(*_RAW)


def _date_styles():
    """The day's text in each style, one style per file."""
    y, m, d = (F.substring("fecha_reporte", *at) for at in ((1, 4), (6, 2), (9, 2)))
    day = F.to_date("fecha_reporte")
    return [
        F.concat_ws("-", m, d, y), F.concat_ws("/", d, m, y), F.concat(y, m, d), F.concat_ws(".", y, m, d),
        F.concat_ws("/", m, d, F.substring(y, 3, 2)), F.date_format(day, "MMM d, yyyy"), F.date_format(day, "d MMMM yyyy"),
        F.concat("fecha_reporte", F.lit(" 10:30 AM")), F.concat("fecha_reporte", F.lit("T10:30:00Z")),
        F.concat_ws("-", d, m, F.substring(y, 3, 2)), F.concat_ws("/", m, d, y)]


def clean_date_styles(spark, sf):
    """The reports dealt over files, each with a date style of its own."""
    base, reports = _folder(spark), S.reports(spark, sf)
    styles = _date_styles()
    for i, style in enumerate(styles):
        own = reports.where(F.col("id") % len(styles) == i)
        CSV.write_csv(own.select(F.col("id").cast("string").alias("ID"), style.alias("Fecha del reporte")).coalesce(1), f"{base}/style{i}")
    raw = C.with_date_style(CSV.read_reports_csv(spark, f"{base}/*"))
    return C.normalize_fecha(C.trim_strings(C.rename_columns(raw))).select(F.col("id").cast("long").alias("id"), "fecha_reporte")


def csv_round_trip(spark, sf):
    base, reports = _folder(spark), S.reports(spark, sf)
    CSV.write_csv(reports.select(*REPORT_COLUMNS), base)
    CSV.verify_written(spark, base, reports.count())
    return spark.read.option("header", True).option("escape", '"').schema(REPORT_SCHEMA).csv(base)


def table_round_trip(spark, sf):
    base, reports = _folder(spark), S.reports(spark, sf).select(*REPORT_COLUMNS)
    C.assert_not_null(reports)
    reports.write.parquet(base)
    return spark.read.parquet(base)


def upsert_tables(spark, sf):
    """All reports but a sixth are stored; every third one, that sixth included,
    comes in twice, the second time with another city."""
    reports = S.reports(spark, sf).select(*REPORT_COLUMNS)
    third = reports.where("id % 3 = 0")
    incoming = third.withColumn("seq", F.lit(1)).unionByName(
        third.withColumn("ciudad", F.concat("ciudad", F.lit("!"))).withColumn("seq", F.lit(2)))
    return C.upsert(reports.where("id % 6 <> 3"), incoming)


def etl_pipeline(spark, sf):
    done = run_etl(spark, _raw_files(spark, sf), _folder(spark))
    return spark.read.parquet(done["reports"])


def report_pipeline(spark, sf):
    """The rows of every chart table that the analysis job has written: their keys
    as text and their number."""
    done = generate_all(spark, S.reports(spark, sf), _folder(spark))
    out = None
    for name, path in sorted(done["charts"].items()):
        df = spark.read.parquet(path)
        keys = [c for c in df.columns if c not in ("count", "corr")]
        label = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
        rows = df.select(F.lit(name).alias("chart"), label.alias("keys"), F.col("count" if "count" in df.columns else "corr").cast("double").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def ask_plan(spark, sf):
    """Questions against the stored ETL output (reports and index)."""
    out = _folder(spark)
    run_etl(spark, _raw_files(spark, sf), out)
    return ask(spark, S.questions(spark, sf), out)


def store_presence(spark, sf):
    out = _folder(spark)
    run_etl(spark, _raw_files(spark, sf), out)
    return A.store_profile(spark, out)


register("csv_scan", chain("r0", "SELECT " + ", ".join(f'"{c}"' for c in _RAW) + " FROM r0"))(csv_scan)
_BREAKS = """'
"' || coalesce("Nombre", '-') || '",' || chr(13) || '
""' || coalesce("Ciudad", '-')"""
register("csv_scan_split", O.with_(["v_raw_reports", "broken AS (SELECT * REPLACE (CASE WHEN seq % 3 <> 0 THEN coalesce(\"Comentario\", '') || "
                                    + _BREAKS + ' ELSE "Comentario" END AS "Comentario") FROM v_raw_reports)'],
                                   "SELECT " + ", ".join(f'{O.na(chr(34) + c + chr(34))} AS "{c}"' for c in _RAW) + " FROM broken"))(csv_scan_split)
register("clean_date_styles", O.with_(["v_reports"], "SELECT id, fecha_reporte FROM v_reports"))(clean_date_styles)
register("csv_round_trip", O.with_(["v_reports"], f"SELECT {_COLS} FROM v_reports"))(csv_round_trip)
register("table_round_trip", O.with_(["v_reports"], f"SELECT {_COLS} FROM v_reports"))(table_round_trip)
register("upsert_tables", O.with_(["v_reports"], f"""
SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN ciudad || '!' ELSE ciudad END AS ciudad)
FROM (SELECT {_COLS} FROM v_reports)"""))(upsert_tables)
register("etl_pipeline", chain("dd", f"SELECT {_COLS} FROM dd"))(etl_pipeline)
register("report_pipeline", O.with_(["v_reports", f"""
pairs AS ({correlation_rows()})""", """
tc AS (SELECT ciudad FROM v_reports GROUP BY ciudad ORDER BY COUNT(*) DESC, ciudad LIMIT 12)""", """
tk AS (SELECT categoria_problema FROM v_reports GROUP BY categoria_problema ORDER BY COUNT(*) DESC, categoria_problema LIMIT 12)""", """
cats AS (SELECT categoria_problema AS k, COUNT(*) AS n FROM v_reports GROUP BY 1 ORDER BY n DESC, k LIMIT 15)""", """
cities AS (SELECT ciudad AS k, COUNT(*) AS n FROM v_reports GROUP BY 1 ORDER BY n DESC, k LIMIT 15)"""], """
SELECT chart, keys, CAST(value AS DOUBLE) AS value FROM (
SELECT 'heatmap_correlaciones' AS chart, var1 || '|' || var2 AS keys, corr AS value FROM pairs
UNION ALL SELECT 'heatmap_ciudad_categoria', tc.ciudad || '|' || tk.categoria_problema, COUNT(v.id)
  FROM tc CROSS JOIN tk LEFT JOIN v_reports v ON v.ciudad = tc.ciudad AND v.categoria_problema = tk.categoria_problema GROUP BY 2
UNION ALL SELECT 'bar_categorias', k, n FROM cats
UNION ALL SELECT 'bar_ciudades', k, n FROM cities
UNION ALL SELECT 'bar_urgente', CAST(urgente AS VARCHAR) || '|' || CASE urgente WHEN 1 THEN 'Urgente (1)' ELSE 'No urgente (0)' END, COUNT(*) FROM v_reports GROUP BY urgente
UNION ALL SELECT 'line_diario', fecha_reporte, COUNT(*) FROM v_reports GROUP BY fecha_reporte
UNION ALL SELECT 'line_mensual', substr(fecha_reporte, 1, 7) || '-01', COUNT(*) FROM v_reports GROUP BY 2)"""))(report_pipeline)
register("store_presence", chain("dd", "SELECT true AS has_reports, true AS has_index, count(*) AS row_count FROM dd"))(store_presence)
register("ask_plan", ask_sql([*cleaned_as_reports(), "questions", "v_text AS (SELECT * FROM v_reports)"]))(ask_plan)
