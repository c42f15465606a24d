"""Cleaning queries over the raw reports view (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import clean as C
from ..schema import (
    COLUMN_RENAME_MAP,
    COMMENT_NULL_MARKERS,
    FLAG_COLUMNS,
    GENERO_MAP,
    NOT_URGENT_LABELS,
    REPORT_COLUMNS,
    REQUIRED_FIELDS,
    URGENT_LABELS,
)
from ..sources import tables as S
from . import register


def _raw(spark, sf):
    return S.raw_reports(spark, sf)


def _trimmed(spark, sf):
    return C.trim_strings(C.rename_columns(C.mark_na(_raw(spark, sf))))


def _validated(spark, sf):
    return C.validate(C.mark_na(_raw(spark, sf)))


# --- SQL chain -------------------------------------------------------------

_RAW = list(COLUMN_RENAME_MAP.keys())
_CLEAN = list(COLUMN_RENAME_MAP.values())


def _lst(xs):
    return ", ".join(O.q(x) for x in xs)


_na = ", ".join(f'{O.na(chr(34) + c + chr(34))} AS "{c}"' for c in _RAW)
_ren = ", ".join(f'"{r}" AS {c}' for r, c in COLUMN_RENAME_MAP.items())
_trim = ", ".join(f"{O.strip_ws(c)} AS {c}" for c in _CLEAN)
_gen = "CASE " + " ".join(f"WHEN genero = {O.q(k)} THEN {O.q(v)}"
                          for k, v in GENERO_MAP.items()) + " END"
_age = f"round_even({O.to_number('edad')}, 0)"
_urg = (f"CASE WHEN lower({O.strip_ws('nivel_urgencia')}) IN ({_lst(URGENT_LABELS)}) THEN 1 "
        f"WHEN lower({O.strip_ws('nivel_urgencia')}) IN ({_lst(NOT_URGENT_LABELS)}) THEN 0 END")
_flags = ", ".join(f"{O.to_flag(c)} AS {c}" for c in FLAG_COLUMNS)
_required = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_FIELDS + ["urgente"])
_cols = ", ".join(REPORT_COLUMNS)

STEPS = {
    "r0": f"r0 AS (SELECT seq, {_na} FROM v_raw_reports)",
    "r1": f"r1 AS (SELECT seq, {_ren} FROM r0)",
    "t": f"t AS (SELECT seq, {_trim} FROM r1)",
    "v3": (f"v3 AS (SELECT * REPLACE (CASE WHEN lower(comentario) IN "
           f"({_lst(COMMENT_NULL_MARKERS)}) THEN NULL ELSE comentario END AS comentario) FROM t)"),
    "v4": f"v4 AS (SELECT * REPLACE ({O.parse_date('fecha_reporte')} AS fecha_reporte) FROM v3)",
    "v5": (f"v5 AS (SELECT * REPLACE (TRY_CAST({_age} AS INTEGER) AS edad) FROM v4 "
           f"WHERE {_age} BETWEEN 0 AND 120)"),
    "v6": f"v6 AS (SELECT * REPLACE ({_gen} AS genero) FROM v5)",
    "v7": f"v7 AS (SELECT * REPLACE ({_flags}) FROM v6)",
    "v8": f"v8 AS (SELECT *, {_urg} AS urgente FROM v7)",
    "v9": f"v9 AS (SELECT * FROM v8 WHERE {_required})",
    "val": (f"val AS (SELECT * REPLACE ({O.to_long('id')} AS id) "
            f"FROM v9 WHERE {O.to_long('id')} IS NOT NULL)"),
    "dd": ("dd AS (SELECT * FROM val QUALIFY row_number() OVER "
           "(PARTITION BY id ORDER BY seq) = 1)"),
    "lw": ("lw AS (SELECT * FROM val QUALIFY row_number() OVER "
           "(PARTITION BY id ORDER BY seq DESC) = 1)"),
}
ORDER = list(STEPS)


def chain(upto: str, body: str) -> str:
    steps = ORDER[: ORDER.index(upto) + 1]
    if upto == "lw":
        steps = [s for s in steps if s != "dd"]
    return O.with_(["v_raw_reports"] + [STEPS[s] for s in steps], body)


def cleaned_as_reports() -> list[str]:
    """CTEs in which ``v_reports`` is the cleaned table (the view it is made of is
    called ``v_orders`` there)."""
    source = O.CTE["v_reports"].replace("v_reports AS", "v_orders AS")
    raw = O.CTE["v_raw_reports"].replace("FROM v_reports", "FROM v_orders")
    return [source, raw, *[STEPS[s] for s in ORDER[:ORDER.index("dd") + 1]], f"v_reports AS (SELECT {_cols} FROM dd)"]


_RAW_SEL = "seq, " + ", ".join(f'"{c}"' for c in _RAW)
register("na_markers", chain("r0", f"SELECT {_RAW_SEL} FROM r0"))(
    lambda spark, sf: C.mark_na(_raw(spark, sf)))
register("clean_rename", chain("r1", "SELECT * FROM r1"))(
    lambda spark, sf: C.rename_columns(C.mark_na(_raw(spark, sf))))
register("clean_trim", chain("t", "SELECT * FROM t"))(_trimmed)
register("clean_comment_nulls", chain("v3", "SELECT seq, comentario FROM v3"))(
    lambda spark, sf: C.clean_comment_nulls(_trimmed(spark, sf)).select("seq", "comentario"))
register("clean_date", O.with_(["v_raw_reports", STEPS["r0"], STEPS["r1"], STEPS["t"]],
                               f"SELECT seq, {O.parse_date('fecha_reporte')} AS fecha_reporte "
                               "FROM t"))(
    lambda spark, sf: C.normalize_fecha(_trimmed(spark, sf)).select("seq", "fecha_reporte"))
register("clean_age", O.with_(["v_raw_reports", STEPS["r0"], STEPS["r1"], STEPS["t"]],
                              f"SELECT seq, TRY_CAST({_age} AS INTEGER) AS edad FROM t "
                              f"WHERE {_age} BETWEEN 0 AND 120"))(
    lambda spark, sf: C.normalize_edad(_trimmed(spark, sf)).select("seq", "edad"))
register("clean_gender", O.with_(["v_raw_reports", STEPS["r0"], STEPS["r1"], STEPS["t"]],
                                 f"SELECT seq, {_gen} AS genero FROM t"))(
    lambda spark, sf: C.normalize_genero(_trimmed(spark, sf)).select("seq", "genero"))
register("clean_flags", O.with_(["v_raw_reports", STEPS["r0"], STEPS["r1"], STEPS["t"]],
                                f"SELECT seq, {_flags} FROM t"))(
    lambda spark, sf: C.normalize_flags(_trimmed(spark, sf)).select("seq", *FLAG_COLUMNS))
register("clean_urgency", O.with_(["v_raw_reports", STEPS["r0"], STEPS["r1"], STEPS["t"]],
                                  f"SELECT seq, nivel_urgencia, {_urg} AS urgente FROM t"))(
    lambda spark, sf: C.normalize_urgencia(_trimmed(spark, sf)).select(
        "seq", "nivel_urgencia", "urgente"))
register("clean_validated", chain("val", f"SELECT seq, {_cols} FROM val"))(
    lambda spark, sf: _validated(spark, sf).select("seq", *REPORT_COLUMNS))
register("clean_full", chain("dd", f"SELECT {_cols} FROM dd"))(
    lambda spark, sf: C.transform(_raw(spark, sf)))
register("dedup_first", chain("dd", "SELECT id, seq FROM dd"))(
    lambda spark, sf: C.dedup_first(_validated(spark, sf)).select("id", "seq"))
register("upsert_last_wins", chain("lw", f"SELECT seq, {_cols} FROM lw"))(
    lambda spark, sf: C.upsert_last_wins(_validated(spark, sf)).select("seq", *REPORT_COLUMNS))
register("etl_row_counts", chain(
    "dd", "SELECT (SELECT COUNT(*) FROM v_raw_reports) AS source_rows, "
    "(SELECT COUNT(*) FROM dd) AS clean_rows"))(
    lambda spark, sf: (lambda raw: C.row_counts(raw, C.transform(raw)))(_raw(spark, sf)))
register("clean_null_check", chain(
    "dd", "SELECT " + ", ".join(f"count_if({c} IS NULL) AS n_null_{c}" for c in REPORT_COLUMNS)
    + " FROM dd"))(
    lambda spark, sf: C.transform(_raw(spark, sf)).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in REPORT_COLUMNS]))
