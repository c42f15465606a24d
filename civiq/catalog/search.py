"""Index and search queries over documents as reports (T) with benchmark
texts (B) or questions (Q) as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions.text import sanitize_query, strip_accents
from ..operators import index as IX
from ..operators import search as SE
from ..operators.filters import ReportFilter
from ..schema import BM25_B, BM25_K1, BM25_MIN_IDF, DEFAULT_TOP_K
from ..sources import tables as S
from . import register


def _t(spark, sf):
    return S.text_reports(spark, sf)


def _b(spark, sf):
    return S.search_queries(spark, sf)


# --- SQL building blocks -----------------------------------------------------

def tok(x: str) -> str:
    """Index tokens in DuckDB (its own accent stripping)."""
    return f"coalesce(regexp_extract_all(strip_accents(lower({x})), '[\\p{{L}}\\p{{N}}]+'), [])"


def index_ctes(src: str = "v_text") -> list[str]:
    return [
        f"""docs AS (SELECT id, list_concat({tok('comentario')}, {tok('ciudad')},
                {tok('categoria_problema')}) AS toks FROM {src})""",
        """post AS (SELECT term, id, COUNT(*) AS tf, doc_len FROM
                (SELECT id, CAST(len(toks) AS INTEGER) AS doc_len, unnest(toks) AS term FROM docs)
                GROUP BY term, id, doc_len)""",
        """corpus AS (SELECT COUNT(*) AS n_docs, coalesce(avg(len(toks)), 0.0) AS avgdl FROM docs)""",
        """tdf AS (SELECT term, COUNT(*) AS df FROM post GROUP BY term)""",
    ]


def match_ctes(qsrc: str) -> list[str]:
    k1, b, mi = BM25_K1, BM25_B, BM25_MIN_IDF
    idf = "ln((c.n_docs - tdf.df + 0.5) / (tdf.df + 0.5))"
    return [
        f"qs AS (SELECT question_id, {tok(O.sanitize('texto'))} AS toks FROM {qsrc})",
        """qt AS (SELECT question_id, term, n_terms, COUNT(*) AS qtf FROM
               (SELECT question_id, len(list_distinct(toks)) AS n_terms, unnest(toks) AS term FROM qs)
               GROUP BY ALL)""",
        f"""qi AS (SELECT qt.*, CASE WHEN {idf} <= 0 THEN {mi} ELSE {idf} END AS idf
               FROM qt JOIN tdf USING (term) CROSS JOIN corpus c)""",
        f"""sc AS (SELECT qi.question_id, p.id, qi.n_terms, COUNT(*) AS n_hit,
               SUM(qi.qtf * qi.idf * (p.tf * ({k1} + 1.0))
                   / (p.tf + {k1} * (1.0 - {b} + {b} * p.doc_len / c.avgdl))) AS score
               FROM qi JOIN post p USING (term) CROSS JOIN corpus c GROUP BY ALL)""",
        "m AS (SELECT question_id, id, score FROM sc WHERE n_hit = n_terms)",
    ]


def topk_cte(k: int = DEFAULT_TOP_K, src: str = "m", where: str = "") -> str:
    return f"""top AS (SELECT question_id, id, score, CAST(row_number() OVER (PARTITION BY question_id
               ORDER BY round(score, 9) DESC, id) AS INTEGER) AS rank FROM {src} {where}
               QUALIFY rank <= {k})"""


HIT_SEL = "v.comentario, v.ciudad, v.categoria_problema, v.fecha_reporte, v.urgente"


def like_ctes(qsrc: str, docs: str = "v_text", k: int = DEFAULT_TOP_K, where: str = "") -> list[str]:
    lw = O.ascii_lower
    return [
        f"pats AS (SELECT question_id, '%' || {lw('texto')} || '%' AS pat FROM {qsrc})",
        f"""lm AS (SELECT p.question_id, v.id, {HIT_SEL} FROM pats p JOIN {docs} v
               ON ({lw('v.comentario')} LIKE p.pat OR {lw('v.ciudad')} LIKE p.pat
                   OR {lw('v.categoria_problema')} LIKE p.pat) {where})""",
        f"""ltop AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id
               ORDER BY fecha_reporte DESC, id) AS INTEGER) AS rank FROM lm QUALIFY rank <= {k})""",
    ]


def context_line(a: str = "") -> str:
    return (f"'- id=' || CAST({a}id AS VARCHAR) || ' fecha=' || {a}fecha_reporte || ' ciudad=' || "
            f"{a}ciudad || ' categoria=' || {a}categoria_problema || ' urgente=' || "
            f"CAST({a}urgente AS VARCHAR) || ': ' || {a}comentario")


# --- queries -------------------------------------------------------------------

register("strip_accents", O.with_(["v_text"], "SELECT id, strip_accents(comentario) AS texto_plano FROM v_text"))(
    lambda spark, sf: _t(spark, sf).select("id", strip_accents("comentario").alias("texto_plano")))

register("sanitize_query", O.with_(["questions"], f"SELECT question_id, {O.sanitize('texto')} AS consulta FROM questions"))(
    lambda spark, sf: S.questions(spark, sf).select(
        "question_id", sanitize_query("texto").alias("consulta")))

register("doc_lengths", O.with_(["v_text"] + index_ctes(),
                                "SELECT id, CAST(len(toks) AS INTEGER) AS doc_len FROM docs"))(
    lambda spark, sf: IX.doc_stats(_t(spark, sf)))
register("build_postings", O.with_(["v_text"] + index_ctes(), "SELECT term, id, tf, doc_len FROM post"))(
    lambda spark, sf: IX.postings(_t(spark, sf)))
register("corpus_stats", O.with_(["v_text"] + index_ctes(),
                                 "SELECT n_docs, round(avgdl, 9) AS avgdl FROM corpus"))(
    lambda spark, sf: IX.corpus_stats(_t(spark, sf)).select(
        "n_docs", F.round("avgdl", 9).alias("avgdl")))
register("term_df", O.with_(["v_text"] + index_ctes(), "SELECT term, df FROM tdf"))(
    lambda spark, sf: IX.term_stats(IX.postings(_t(spark, sf))))

register("match_all_terms", O.with_(["v_text", "bq"] + index_ctes() + match_ctes("bq"),
                                    "SELECT question_id, id, round(score, 6) AS score FROM m"))(
    lambda spark, sf: SE.bm25_scores(_b(spark, sf), IX.TextIndex.build(_t(spark, sf))).select(
        "question_id", "id", F.round("score", 6).alias("score")))


def _bm25_sql(qsrc: str, where: str = "", k: int = DEFAULT_TOP_K) -> str:
    return O.with_(
        ["v_text", qsrc] + index_ctes() + match_ctes(qsrc) + [topk_cte(k, "m", where)],
        f"""SELECT t.question_id, t.rank, t.id, round(t.score, 6) AS score, {HIT_SEL}
            FROM top t JOIN v_text v USING (id)""")


def _bm25(spark, sf, flt=None):
    t = _t(spark, sf)
    return SE.bm25_search(_b(spark, sf), t, IX.TextIndex.build(t), DEFAULT_TOP_K, flt)


FILTERED = ReportFilter(urgente=1, fecha_desde="2022-01-01")
register("bm25_topk", _bm25_sql("bq"))(lambda spark, sf: _bm25(spark, sf))
register("bm25_topk_filtered", _bm25_sql(
    "bq", "WHERE id IN (SELECT id FROM v_text WHERE urgente = 1 AND fecha_reporte >= '2022-01-01')"))(
    lambda spark, sf: _bm25(spark, sf, FILTERED))

register("like_search", O.with_(["v_text", "bq"] + like_ctes("bq"), f"""
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente FROM ltop"""))(
    lambda spark, sf: SE.like_search(_b(spark, sf), _t(spark, sf)))
register("like_search_indexed", O.with_(["v_text", "sbq", *like_ctes("sbq")], """
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente FROM ltop"""))(
    lambda spark, sf: SE.like_search(S.passage_queries(spark, sf), _t(spark, sf),
                                     index=IX.TextIndex.build(_t(spark, sf))))
register("like_wildcards", O.with_(["v_text", "wbq", *like_ctes("wbq")], """
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente FROM ltop"""))(
    lambda spark, sf: SE.like_search(S.wildcard_queries(spark, sf), _t(spark, sf)))
register("like_search_filtered", O.with_(["v_text", "bq"] + like_ctes(
    "bq", where="WHERE v.urgente = 0 AND v.fecha_reporte <= '2023-06-30'"), f"""
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente FROM ltop"""))(
    lambda spark, sf: SE.like_search(_b(spark, sf), _t(spark, sf), DEFAULT_TOP_K,
                                     ReportFilter(urgente=0, fecha_hasta="2023-06-30")))

register("search_auto", O.with_(
    ["v_text", "questions", f"fq AS (SELECT * FROM questions WHERE {O.sanitize('texto')} <> '')",
     f"lq AS (SELECT * FROM questions WHERE {O.sanitize('texto')} = '')"]
    + index_ctes() + match_ctes("fq") + [topk_cte()] + like_ctes("lq"), f"""
SELECT t.question_id, t.rank, t.id, {HIT_SEL}, true AS used_fts FROM top t JOIN v_text v USING (id)
UNION ALL
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente,
       false AS used_fts FROM ltop"""))(
    lambda spark, sf: SE.search_auto(S.questions(spark, sf), _t(spark, sf)))

register("bm25_topk_many_hits", _bm25_sql("sq"))(
    lambda spark, sf: SE.bm25_search(S.source_queries(spark, sf), _t(spark, sf)))

_F_WHERE = ("(coalesce(f_ciudad, '') = '' OR {v}ciudad = f_ciudad) AND (coalesce(f_categoria_problema, '') = '' "
            "OR {v}categoria_problema = f_categoria_problema) AND (f_urgente IS NULL OR {v}urgente = f_urgente) "
            "AND {v}fecha_reporte >= f_fecha_desde AND (f_fecha_hasta = '' OR {v}fecha_reporte <= f_fecha_hasta)")
register("search_auto_filtered", O.with_(
    ["v_text", "fq", f"ftq AS (SELECT * FROM fq WHERE {O.sanitize('texto')} <> '')",
     f"flq AS (SELECT * FROM fq WHERE {O.sanitize('texto')} = '')"]
    + index_ctes() + match_ctes("ftq")
    + ["mf AS (SELECT m.* FROM m JOIN ftq USING (question_id) JOIN v_text v USING (id) WHERE "
       + _F_WHERE.format(v="v.") + ")", topk_cte(DEFAULT_TOP_K, "mf")]
    + like_ctes("flq", where="JOIN flq USING (question_id) WHERE " + _F_WHERE.format(v="v.")), f"""
SELECT t.question_id, t.rank, t.id, {HIT_SEL}, true AS used_fts FROM top t JOIN v_text v USING (id)
UNION ALL
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente,
       false AS used_fts FROM ltop"""))(
    lambda spark, sf: SE.search_auto(S.filtered_queries(spark, sf), _t(spark, sf)))
register("search_auto_no_index", O.with_(["v_text", "bq"] + like_ctes("bq"), """
SELECT question_id, rank, id, comentario, ciudad, categoria_problema, fecha_reporte, urgente,
       false AS used_fts FROM ltop"""))(
    lambda spark, sf: SE.search_auto(_b(spark, sf), _t(spark, sf), use_index=False))

register("render_contexts", O.with_(
    ["v_text", "bq"] + index_ctes() + match_ctes("bq") + [topk_cte()], f"""
SELECT t.question_id, string_agg({context_line('v.')}, chr(10) ORDER BY t.rank) AS context
FROM top t JOIN v_text v USING (id) GROUP BY t.question_id"""))(
    lambda spark, sf: SE.render_contexts(_bm25(spark, sf)))
