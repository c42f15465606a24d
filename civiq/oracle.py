"""DuckDB SQL for every registered query (the correctness oracle).

The driver registers the raw parquet tables as views; the report-shaped views
are rebuilt here as CTEs that DuckDB runs. Each query is an independent SQL
string: ``sql(name)`` prefixes the CTEs it needs.
"""

from __future__ import annotations

from .functions.text import FOLD_FROM, FOLD_TO, TOKEN_PATTERN, WORD_CLASS, WS_CLASS
from .schema import (
    BM25_B,
    BM25_K1,
    BM25_MIN_IDF,
    NA_MARKERS,
    PROMPT_CONTEXT_HEADER,
    PROMPT_INSTRUCTIONS,
    PROMPT_QUESTION_HEADER,
    PROMPT_STATS_HEADER,
    PROMPT_SYSTEM,
)
from .sources.tables import CONVERSATION_ID_BASE, NATION_QUESTIONS, QUESTION_FIXTURES


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

CTE = {}

CTE["v_reports"] = """
v_reports AS (
  SELECT o.o_orderkey AS id,
         c.c_name AS nombre,
         CAST((c.c_custkey * 7 + o.o_orderkey) % 90 + 10 AS INTEGER) AS edad,
         CASE o.o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'Otro' ELSE 'M' END AS genero,
         n.n_name AS ciudad,
         concat_ws(' ', c.c_mktsegment, o.o_orderpriority, n.n_name) AS comentario,
         c.c_mktsegment AS categoria_problema,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Urgente' ELSE 'No urgente' END AS nivel_urgencia,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgente,
         substr(CAST(o.o_orderdate AS VARCHAR), 1, 10) AS fecha_reporte,
         CASE WHEN o.o_totalprice > 200000 THEN 1 ELSE 0 END AS acceso_internet,
         CASE WHEN c.c_acctbal > 5000 THEN 1 ELSE 0 END AS atencion_previa_gobierno,
         CASE WHEN n.n_regionkey IN (0, 2) THEN 1 ELSE 0 END AS zona_rural
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

CTE["v_raw_reports"] = """
v_raw_reports AS (
  SELECT id AS seq,
         CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN 'x'
              WHEN id % 103 = 0 THEN '1e30' WHEN id % 107 = 0 THEN '9007199254740992'
              WHEN id % 109 = 0 THEN '9007199254740993'
              WHEN id % 10 = 9 THEN CAST(id - 1 AS VARCHAR)
              WHEN id % 13 = 0 THEN CAST(id AS VARCHAR) || '.0'
              ELSE CAST(id AS VARCHAR) END AS "ID",
         CASE WHEN id % 101 = 0 THEN NULL ELSE ' ' || nombre || ' ' END AS "Nombre",
         CASE WHEN id % 17 = 0 THEN '130' WHEN id % 19 = 0 THEN 'abc'
              WHEN id % 23 = 0 THEN '-0.5' WHEN id % 29 = 0 THEN '120.5'
              WHEN id % 31 = 0 THEN 'NaN' WHEN id % 37 = 0 THEN '1d'
              WHEN id % 43 = 0 THEN '9999999999'
              ELSE CAST(edad AS VARCHAR) || '.0' END AS "Edad",
         CASE WHEN id % 11 = 0 THEN 'O' WHEN id % 41 = 0 THEN 'femenino' ELSE genero END AS "Género",
         CASE WHEN id % 43 = 0 THEN '   ' ELSE '  ' || ciudad || ' ' END AS "Ciudad",
         CASE WHEN id % 47 = 0 THEN ' NaN ' WHEN id % 53 = 0 THEN '   '
              WHEN id % 59 = 0 THEN 'null' ELSE comentario END AS "Comentario",
         categoria_problema AS "Categoría del problema",
         CASE WHEN id % 5 = 0 THEN ' ALTA ' WHEN id % 71 = 0 THEN 'media'
              WHEN id % 7 = 0 THEN 'Baja urgencia' ELSE nivel_urgencia END AS "Nivel de urgencia",
         CASE WHEN id % 61 = 0 THEN '2020-13-45'
              WHEN id % 6 = 0 THEN substr(fecha_reporte, 6, 2) || '/' || substr(fecha_reporte, 9, 2) || '/' || substr(fecha_reporte, 1, 4)
              WHEN id % 4 = 0 THEN fecha_reporte || ' 10:30:00'
              WHEN id % 7 = 0 THEN CAST(CAST(substr(fecha_reporte, 6, 2) AS INTEGER) AS VARCHAR) || '/' || CAST(CAST(substr(fecha_reporte, 9, 2) AS INTEGER) AS VARCHAR) || '/' || substr(fecha_reporte, 1, 4)
              WHEN id % 11 = 0 THEN fecha_reporte || 'T10:30:00'
              WHEN id % 13 = 0 THEN fecha_reporte || ' 10:30'
              WHEN id % 17 = 0 THEN replace(fecha_reporte, '-', '/')
              WHEN id % 19 = 0 THEN fecha_reporte || ' 10:30:00.5'
              WHEN id % 23 = 0 THEN substr(fecha_reporte, 6, 2) || '/' || substr(fecha_reporte, 9, 2) || '/' || substr(fecha_reporte, 1, 4) || ' 10:30:00'
              ELSE fecha_reporte END AS "Fecha del reporte",
         CASE WHEN id % 73 = 0 THEN '2' WHEN id % 3 = 0 THEN CAST(acceso_internet AS VARCHAR) || '.0'
              ELSE CAST(acceso_internet AS VARCHAR) END AS "Acceso a internet",
         CASE WHEN id % 79 = 0 THEN '0.5' ELSE CAST(atencion_previa_gobierno AS VARCHAR) END AS "Atención previa del gobierno",
         CASE WHEN id % 83 = 0 THEN 'True' ELSE CAST(zona_rural AS VARCHAR) END AS "Zona rural"
  FROM v_reports
)"""

CTE["v_text"] = """
v_text AS (
  SELECT doc_id AS id, text AS comentario, source AS ciudad, lang AS categoria_problema,
         CAST(2020 + doc_id % 5 AS VARCHAR) || '-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0')
           || '-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS fecha_reporte,
         CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS urgente
  FROM documents
)"""

CTE["bq"] = """
bq AS (SELECT item_id AS question_id, text AS texto FROM benchmark)"""

_fixture_rows = ",\n    ".join(f"({i}, {q(t)})" for i, t in QUESTION_FIXTURES)
_nation_rows = " ".join(
    f"UNION ALL SELECT {b} + n_nationkey, {q(x)} || n_name || {q(y)} FROM nation" for b, x, y in NATION_QUESTIONS)
CTE["questions"] = f"""
questions AS (
  SELECT * FROM (VALUES
    {_fixture_rows}) AS t(question_id, texto)
  UNION ALL
  SELECT (conv_id + 1) * {CONVERSATION_ID_BASE} + turn AS question_id, text AS texto
  FROM conversations WHERE role = 'user'
  {_nation_rows}
)"""

CTE["sq"] = """
sq AS (SELECT min(doc_id) AS question_id, source || ' ' || lang AS texto FROM documents GROUP BY source, lang)"""

CTE["sbq"] = """
sbq AS (SELECT item_id * 2 AS question_id, text AS texto FROM benchmark
        UNION ALL SELECT item_id * 2 + 1, substr(text, 2) FROM benchmark
        UNION ALL SELECT * FROM (VALUES {}) AS t(question_id, texto))""".format(
    ", ".join(f"(-{i}, {q(t)})" for i, t in QUESTION_FIXTURES if i >= 15))

CTE["wbq"] = r"""
wbq AS (SELECT item_id * 4 AS question_id, replace(text, ' ', '_') AS texto FROM benchmark
        UNION ALL SELECT item_id * 4 + 1, substr(text, 1, 24) || '%' || right(text, 24) FROM benchmark
        UNION ALL SELECT item_id * 4 + 2, substr(text, 1, 12) || '\' || substr(text, 13, 12) FROM benchmark
        UNION ALL SELECT item_id * 4 + 3, '_' || substr(text, 2, 2) || '%x_' FROM benchmark)"""

_marks = [(i, t) for i, t in QUESTION_FIXTURES if i >= 15]
CTE["fq"] = f"""
fq AS (
  SELECT *, CASE WHEN question_id % 3 = 0 THEN 'src0' END AS f_ciudad,
    CASE WHEN question_id % 5 = 0 THEN 'en' END AS f_categoria_problema,
    CASE WHEN question_id % 2 = 0 THEN 1 END AS f_urgente, '2021-01-01' AS f_fecha_desde,
    CASE WHEN question_id % 7 = 0 THEN '2023-06-30' ELSE '' END AS f_fecha_hasta
  FROM (SELECT min(doc_id) AS question_id, source || ' ' || lang AS texto FROM documents GROUP BY source, lang
        UNION ALL SELECT * FROM (VALUES {", ".join(f"(-{i}, {q(t)})" for i, t in _marks)}) AS t(question_id, texto))
)"""

DEPENDS = {
    "v_raw_reports": ["v_reports"],
}


def with_(ctes: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for d in DEPENDS.get(name, []):
            add(d)
        if name not in order:
            order.append(name)

    for c in ctes:
        add(c)
    return "WITH " + ",".join(CTE[c] if c in CTE else c for c in order) + "\n" + body


# ---------------------------------------------------------------------------
# Expression helpers (the same rules as civiq.functions, in DuckDB SQL)
# ---------------------------------------------------------------------------

def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '\\A[{WS_CLASS}]+|[{WS_CLASS}]+\\z', '', 'g')"


def fold(x: str) -> str:
    return f"translate(lower({x}), {q(FOLD_FROM)}, {q(FOLD_TO)})"


def tokens(x: str) -> str:
    return f"coalesce(regexp_extract_all({fold(x)}, '{TOKEN_PATTERN}'), [])"


def sanitize(x: str) -> str:
    s = f"regexp_replace({x}, '[^{WORD_CLASS}{WS_CLASS}]', ' ', 'g')"
    s = f"regexp_replace({s}, '[{WS_CLASS}]+', ' ', 'g')"
    return strip_ws(s)


def ascii_lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def na(x: str) -> str:
    markers = ", ".join(q(m) for m in NA_MARKERS)
    return f"CASE WHEN {x} IN ({markers}) THEN NULL ELSE {x} END"


NUMERIC_RE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def to_number(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{NUMERIC_RE}') THEN TRY_CAST({x} AS DOUBLE) END"


def to_flag(x: str) -> str:
    n = to_number(x)
    return f"CASE WHEN {n} IN (0.0, 1.0) THEN CAST({n} AS INTEGER) END"


def to_long(x: str) -> str:
    whole = f"regexp_full_match({x}, '[+-]?[0-9]+([.]0*)?')"
    return (f"CASE WHEN {whole} THEN TRY_CAST(regexp_replace({x}, '[.]0*$', '') AS BIGINT) "
            f"WHEN abs({to_number(x)}) < 9.2e18 THEN CAST(trunc({to_number(x)}) AS BIGINT) END")


DATE_FORMATS = [d + t for d in ("%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d")
                for t in ("", " %H:%M:%S", "T%H:%M:%S", " %H:%M", "T%H:%M", " %H:%M:%S.%f", "T%H:%M:%S.%f")
                if not (t.startswith("T") and "/" in d)]


def parse_date(x: str) -> str:
    tries = ", ".join(f"try_strptime({x}, '{f}')" for f in DATE_FORMATS)
    return f"strftime(CAST(coalesce({tries}) AS DATE), '%Y-%m-%d')"


BM25 = {"k1": BM25_K1, "b": BM25_B, "min_idf": BM25_MIN_IDF}
PROMPT = {
    "system": PROMPT_SYSTEM,
    "instructions": PROMPT_INSTRUCTIONS,
    "ctx": PROMPT_CONTEXT_HEADER,
    "stats": PROMPT_STATS_HEADER,
    "question": PROMPT_QUESTION_HEADER,
}
