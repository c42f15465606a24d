"""Question queries: dates, intents, mentions, window statistics, stats lines,
direct answers, prompts and the batch ask job (Q over V; contexts over T).

The DuckDB oracle filters reports by each question's date window with plain
string comparison (the source's semantics), independently of the month-cube
plan the Spark side uses.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions.text import WORD_CLASS
from ..operators import index as IX
from ..operators import prompts as PR
from ..operators import search as SE
from ..operators.questions import QuestionStats, parse_questions, totals_in_windows
from ..schema import (
    CATEGORY_WORD,
    CITY_WORD,
    COUNT_WORDS,
    DEFAULT_TOP_K,
    MONTH_WORD,
    MONTHS_ES,
    MORE_WORDS,
    PROMPT_CONTEXT_HEADER,
    PROMPT_INSTRUCTIONS,
    PROMPT_QUESTION_HEADER,
    PROMPT_STATS_HEADER,
    PROMPT_SYSTEM,
    RECORD_WORDS,
    URGENT_WORDS,
)
from ..sources import tables as S
from ..sources.tables import CONVERSATION_ID_BASE
from . import register
from .search import context_line, index_ctes, like_ctes, match_ctes, topk_cte


def _qs(spark, sf):
    return QuestionStats(S.questions(spark, sf), S.reports(spark, sf))


# --- SQL ------------------------------------------------------------------------

def _any(words):
    return "(" + " OR ".join(f"contains(q, {O.q(w)})" for w in words) + ")"


_YM = rf"(?:^|[^{WORD_CLASS}])((?:19|20)[0-9]{{2}})-([0-9]{{1,2}})(?:$|[^{WORD_CLASS}])"
_MON = "CASE " + " ".join(f"WHEN contains(q, {O.q(n)}) THEN {O.q(m)}" for n, m in MONTHS_ES) + " END"
_MORE = _any(MORE_WORDS)
_REC = _any(RECORD_WORDS)

PARSE = [
    f"qp0 AS (SELECT question_id, texto, lower({O.strip_ws('texto')}) AS q FROM questions)",
    f"""qp1 AS (SELECT *, strip_accents(q) AS qn,
            regexp_extract(q, '{_YM}', 1) AS ym_y, regexp_extract(q, '{_YM}', 2) AS ym_m,
            list_filter(regexp_split_to_array(q, '[^{WORD_CLASS}]+'),
                        lambda x: regexp_full_match(x, '(19|20)[0-9]{{2}}')) AS ys,
            {_MON} AS mon FROM qp0)""",
    f"""qp AS (SELECT question_id, texto, q, qn,
            CASE WHEN ym_y <> '' THEN ym_y || '-' || lpad(CAST(CAST(ym_m AS INTEGER) AS VARCHAR), 2, '0') || '-01'
                 WHEN len(ys) > 0 AND mon IS NOT NULL THEN ys[1] || '-' || mon || '-01'
                 WHEN len(ys) > 0 THEN ys[1] || '-01-01' END AS fecha_desde,
            CASE WHEN ym_y <> '' THEN ym_y || '-' || lpad(CAST(CAST(ym_m AS INTEGER) AS VARCHAR), 2, '0') || '-31'
                 WHEN len(ys) > 0 AND mon IS NOT NULL THEN ys[1] || '-' || mon || '-31'
                 WHEN len(ys) > 0 THEN ys[-1] || '-12-31' END AS fecha_hasta,
            {_any(COUNT_WORDS)} AND {_REC} AS f_count,
            {_any(URGENT_WORDS)} AS f_urgent,
            {_MORE} AND contains(q, '{CITY_WORD}') AS f_top_city,
            {_MORE} AND contains(q, '{CATEGORY_WORD}') AS f_top_category,
            contains(q, '{MONTH_WORD}') AS f_month,
            {_MORE} AND contains(q, '{CITY_WORD}') AND {_REC} AS f_answer_city,
            {_MORE} AND contains(q, '{MONTH_WORD}') AS f_answer_month
            FROM qp1)""",
]
WIN = "a.fecha_desde IS NOT DISTINCT FROM b.fecha_desde AND a.fecha_hasta IS NOT DISTINCT FROM b.fecha_hasta"
WINDOWS = [
    "wins AS (SELECT DISTINCT fecha_desde, fecha_hasta FROM qp)",
    """wr AS (SELECT w.fecha_desde, w.fecha_hasta, r.* FROM wins w JOIN v_reports r
           ON (w.fecha_desde IS NULL OR r.fecha_reporte >= w.fecha_desde)
          AND (w.fecha_hasta IS NULL OR r.fecha_reporte <= w.fecha_hasta))""",
    "wtot AS (SELECT fecha_desde, fecha_hasta, COUNT(*) AS n, count_if(urgente = 1) AS nu FROM wr GROUP BY ALL)",
    "wcity AS (SELECT fecha_desde, fecha_hasta, ciudad AS name, COUNT(*) AS n, count_if(urgente = 1) AS nu FROM wr GROUP BY ALL)",
    "wcat AS (SELECT fecha_desde, fecha_hasta, categoria_problema AS name, COUNT(*) AS n, count_if(urgente = 1) AS nu FROM wr GROUP BY ALL)",
    "wmes AS (SELECT fecha_desde, fecha_hasta, substr(fecha_reporte, 1, 7) AS name, COUNT(*) AS n FROM wr GROUP BY ALL)",
    "topcity AS (SELECT * FROM wcity QUALIFY row_number() OVER (PARTITION BY fecha_desde, fecha_hasta ORDER BY n DESC, name) = 1)",
    "topcat AS (SELECT * FROM wcat QUALIFY row_number() OVER (PARTITION BY fecha_desde, fecha_hasta ORDER BY n DESC, name) = 1)",
    "peak AS (SELECT * FROM wmes QUALIFY row_number() OVER (PARTITION BY fecha_desde, fecha_hasta ORDER BY n DESC, name) = 1)",
    "gcity AS (SELECT ciudad AS name, COUNT(*) AS n_global FROM v_reports GROUP BY 1)",
    "gcat AS (SELECT categoria_problema AS name, COUNT(*) AS n_global FROM v_reports GROUP BY 1)",
    """mc AS (SELECT qp.question_id, g.name, g.n_global FROM qp JOIN gcity g ON g.name <> ''
           AND strip_accents(lower(g.name)) <> '' AND contains(qp.qn, strip_accents(lower(g.name))))""",
    """mk AS (SELECT qp.question_id, g.name, g.n_global FROM qp JOIN gcat g ON g.name <> ''
           AND contains(qp.qn, strip_accents(lower(g.name))))""",
]


def _mention_lines(m: str, w: str, label: str, g: int) -> str:
    return f"""SELECT m.question_id, {g} AS g, -m.n_global AS k1, m.name AS k2,
        {O.q(label)} || m.name || '; registros: ' || CAST(coalesce(b.n, 0) AS VARCHAR)
        || CASE WHEN a.f_urgent THEN '; urgentes: ' || CAST(coalesce(b.nu, 0) AS VARCHAR) ELSE '' END AS line
      FROM {m} m JOIN qp a USING (question_id)
      LEFT JOIN {w} b ON {WIN} AND b.name = m.name"""


LINES = [f"""lines AS (
  SELECT a.question_id, 1 AS g, 0 AS k1, '' AS k2, 'Total urgentes: ' || CAST(coalesce(b.nu, 0) AS VARCHAR) AS line
    FROM qp a LEFT JOIN wtot b ON {WIN} WHERE a.f_count AND a.f_urgent
  UNION ALL
  SELECT a.question_id, 2, 0, '', 'Total registros: ' || CAST(coalesce(b.n, 0) AS VARCHAR)
    FROM qp a LEFT JOIN wtot b ON {WIN} WHERE a.f_count
  UNION ALL {_mention_lines('mc', 'wcity', 'Ciudad: ', 3)}
  UNION ALL {_mention_lines('mk', 'wcat', 'Categoría: ', 4)}
  UNION ALL
  SELECT a.question_id, 5, 0, '', 'Top ciudad por registros: ' || b.name || ' (' || CAST(b.n AS VARCHAR) || ')'
    FROM qp a JOIN topcity b ON {WIN}
   WHERE a.f_top_city AND a.question_id NOT IN (SELECT question_id FROM mc)
  UNION ALL
  SELECT a.question_id, 6, 0, '', 'Top categoría por registros: ' || b.name || ' (' || CAST(b.n AS VARCHAR) || ')'
    FROM qp a JOIN topcat b ON {WIN}
   WHERE a.f_top_category AND a.question_id NOT IN (SELECT question_id FROM mk)
  UNION ALL
  SELECT a.question_id, 7, 0, '', 'Mes pico de registros: ' || b.name || ' (' || CAST(b.n AS VARCHAR) || ')'
    FROM qp a JOIN peak b ON {WIN} WHERE a.f_month
)""", """stats AS (SELECT question_id, string_agg(line, chr(10) ORDER BY g, k1, k2) AS stats
             FROM lines GROUP BY question_id)"""]

BASE = ["v_reports", "questions"] + PARSE


def _sql(body: str, extra: list[str] | None = None) -> str:
    return O.with_(BASE + (extra or []), body)


# --- queries -----------------------------------------------------------------------

register("extract_dates", _sql("SELECT question_id, fecha_desde, fecha_hasta FROM qp"))(
    lambda spark, sf: parse_questions(S.questions(spark, sf)).select(
        "question_id", "fecha_desde", "fecha_hasta"))

register("question_intents", _sql(
    "SELECT question_id, f_count, f_urgent, f_top_city, f_top_category, f_month FROM qp"))(
    lambda spark, sf: parse_questions(S.questions(spark, sf)).select(
        "question_id", "f_count", "f_urgent", "f_top_city", "f_top_category", "f_month"))

register("mention_city", _sql("SELECT question_id, name AS ciudad FROM mc", WINDOWS))(
    lambda spark, sf: _qs(spark, sf).city_mentions().select(
        "question_id", F.col("name").alias("ciudad")))
register("mention_category", _sql("SELECT question_id, name AS categoria FROM mk", WINDOWS))(
    lambda spark, sf: _qs(spark, sf).category_mentions().select(
        "question_id", F.col("name").alias("categoria")))

register("question_totals", _sql(f"""
SELECT a.question_id, a.fecha_desde, a.fecha_hasta, coalesce(b.n, 0) AS total,
       coalesce(b.nu, 0) AS total_urgentes
FROM qp a LEFT JOIN wtot b ON {WIN}""", WINDOWS))(lambda spark, sf: _qs(spark, sf).totals())

_DAY = "format('{{}}-{{:02d}}-{{:02d}}', {x} % 8 + 1992, {x} % 13 + 1, {x} % 31 + 1)"
register("question_totals_days", O.with_(["v_reports", f"""dw AS (
  SELECT question_id, CASE WHEN i % 11 = 0 THEN NULL WHEN i % 11 = 1 THEN '' ELSE {_DAY.format(x='i')} END AS f_fecha_desde,
    CASE WHEN j % 9 = 0 THEN NULL ELSE {_DAY.format(x='j')} END AS f_fecha_hasta
  FROM (SELECT (conv_id + 1) * {CONVERSATION_ID_BASE} + turn AS question_id, conv_id * 37 + turn * 101 AS i, conv_id * 53 + turn * 7 AS j FROM conversations))""",
    """dd AS (SELECT fecha_reporte AS f, count(*) AS n, count_if(urgente = 1) AS nu FROM v_reports GROUP BY 1)"""], """
SELECT question_id, f_fecha_desde, f_fecha_hasta, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, CAST(coalesce(sum(nu), 0) AS BIGINT) AS total_urgentes
FROM dw LEFT JOIN dd ON (coalesce(f_fecha_desde, '') = '' OR f >= f_fecha_desde) AND (coalesce(f_fecha_hasta, '') = '' OR f <= f_fecha_hasta)
GROUP BY ALL"""))(
    lambda spark, sf: totals_in_windows(
        S.day_windows(spark, sf).withColumnsRenamed({"f_fecha_desde": "fecha_desde", "f_fecha_hasta": "fecha_hasta"}), S.reports(spark, sf))
    .withColumnsRenamed({"fecha_desde": "f_fecha_desde", "fecha_hasta": "f_fecha_hasta"}))

register("top_city_per_question", _sql(f"""
SELECT a.question_id, b.name AS ciudad, b.n AS count FROM qp a JOIN topcity b ON {WIN}""", WINDOWS))(
    lambda spark, sf: _qs(spark, sf).top_per_question("ciudad", "ciudad"))
register("top_category_per_question", _sql(f"""
SELECT a.question_id, b.name AS categoria, b.n AS count FROM qp a JOIN topcat b ON {WIN}""", WINDOWS))(
    lambda spark, sf: _qs(spark, sf).top_per_question("categoria_problema", "categoria"))
register("peak_month", _sql(f"""
SELECT a.question_id, b.name AS mes, b.n AS count FROM qp a JOIN peak b ON {WIN}""", WINDOWS))(
    lambda spark, sf: _qs(spark, sf).peak_month())

register("stats_context", _sql("""
SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY g, k1, k2) AS INTEGER)
       AS line_no, line FROM lines""", WINDOWS + LINES))(lambda spark, sf: _qs(spark, sf).lines())

register("calc_answer", _sql("""
SELECT question_id, CASE
    WHEN f_count AND f_urgent THEN 'Hay ' || CAST(gt.nu AS VARCHAR) || ' reportes urgentes en total.'
    WHEN f_count THEN 'Hay ' || CAST(gt.n AS VARCHAR) || ' registros en total.'
    WHEN f_answer_city AND tc.name IS NOT NULL
      THEN 'La ciudad con más reportes es ' || tc.name || ' con ' || CAST(tc.n AS VARCHAR) || ' registros.'
    WHEN f_top_category AND tk.name IS NOT NULL
      THEN 'La categoría con más reportes es ' || tk.name || ' con ' || CAST(tk.n AS VARCHAR) || ' registros.'
    WHEN f_answer_month AND pm.name IS NOT NULL
      THEN 'El mes con más reportes es ' || pm.name || ' con ' || CAST(pm.n AS VARCHAR) || ' registros.'
  END AS answer
FROM qp
CROSS JOIN (SELECT COUNT(*) AS n, count_if(urgente = 1) AS nu FROM v_reports) gt
LEFT JOIN (SELECT * FROM topcity WHERE fecha_desde IS NULL) tc ON true
LEFT JOIN (SELECT * FROM topcat WHERE fecha_desde IS NULL) tk ON true
LEFT JOIN (SELECT * FROM peak WHERE fecha_desde IS NULL) pm ON true
WHERE answer IS NOT NULL""", WINDOWS + ["""wins0 AS (SELECT NULL AS x)"""]))(
    lambda spark, sf: _qs(spark, sf).answers())


def _prompt_sql(qsrc: str, with_stats: bool) -> str:
    head = O.q(f"{PROMPT_SYSTEM}\n\n{PROMPT_CONTEXT_HEADER}\n")
    mid = O.q(f"\n\n{PROMPT_QUESTION_HEADER}\n")
    tail = O.q(f"\n\n{PROMPT_INSTRUCTIONS}\n")
    sh = O.q(f"\n\n{PROMPT_STATS_HEADER}\n")
    block = (f"CASE WHEN coalesce(s.stats, '') <> '' THEN {sh} || s.stats ELSE '' END"
             if with_stats else "''")
    join = "LEFT JOIN stats s USING (question_id)" if with_stats else ""
    return f"""SELECT x.question_id, {head} || coalesce(c.context, '') || {block} || {mid} || x.texto
            || {tail} AS prompt FROM {qsrc} x LEFT JOIN ctx c USING (question_id) {join}"""


def _ctx(src: str) -> str:
    return f"""ctx AS (SELECT question_id, string_agg({context_line()}, chr(10) ORDER BY rank) AS context
               FROM {src} GROUP BY question_id)"""


register("build_prompts", O.with_(
    ["v_text", "bq"] + index_ctes() + match_ctes("bq") + [
        topk_cte(), "hits AS (SELECT t.question_id, t.rank, v.* FROM top t JOIN v_text v USING (id))",
        _ctx("hits")], _prompt_sql("bq", False)))(
    lambda spark, sf: PR.build_prompts(
        S.search_queries(spark, sf),
        SE.render_contexts(SE.bm25_search(S.search_queries(spark, sf), S.text_reports(spark, sf),
                                          k=DEFAULT_TOP_K))))

_ASK_SEARCH = [
    f"fq AS (SELECT * FROM questions WHERE {O.sanitize('texto')} <> '')",
    f"lq AS (SELECT * FROM questions WHERE {O.sanitize('texto')} = '')",
] + index_ctes() + match_ctes("fq") + [topk_cte()] + like_ctes("lq") + [
    """hits AS (SELECT t.question_id, t.rank, v.id, v.comentario, v.ciudad, v.categoria_problema,
                v.fecha_reporte, v.urgente FROM top t JOIN v_text v USING (id)
             UNION ALL SELECT question_id, rank, id, comentario, ciudad, categoria_problema,
                fecha_reporte, urgente FROM ltop)""", _ctx("hits")]

def ask_sql(tables: list[str]) -> str:
    """SQL of finished prompts; ``tables`` define v_reports, v_text and questions."""
    return O.with_(
        tables + PARSE + WINDOWS + LINES + _ASK_SEARCH,
        f"""SELECT p.question_id, {O.sanitize('texto')} <> '' AS used_fts, p.prompt
            FROM ({_prompt_sql('questions', True)}) p JOIN questions USING (question_id)""")


register("ask_batch", ask_sql(["v_reports", "questions", "v_text"]))(
    lambda spark, sf: PR.ask_batch(S.questions(spark, sf), S.reports(spark, sf),
                                   S.text_reports(spark, sf)))
