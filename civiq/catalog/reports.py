"""Statistics and analysis queries over the clean reports view (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..operators import analysis as A
from ..operators import stats as ST
from ..operators.filters import ReportFilter
from ..sources import tables as S
from . import register


def _v(spark, sf):
    return S.reports(spark, sf)


# ---------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------

FILTER_CASES = {
    "city": (ReportFilter(ciudad="NATION_3"), "ciudad = 'NATION_3'"),
    "category": (ReportFilter(categoria_problema="BUILDING"), "categoria_problema = 'BUILDING'"),
    "urgent": (ReportFilter(urgente=1), "urgente = 1"),
    "not_urgent": (ReportFilter(urgente=0), "urgente = 0"),
    "from": (ReportFilter(fecha_desde="1998-01-01"), "fecha_reporte >= '1998-01-01'"),
    "to": (ReportFilter(fecha_hasta="1996-12-31"), "fecha_reporte <= '1996-12-31'"),
    "all": (ReportFilter(ciudad="NATION_3", categoria_problema="BUILDING", urgente=1,
                         fecha_desde="1996-01-01", fecha_hasta="1998-12-31"),
            "ciudad = 'NATION_3' AND categoria_problema = 'BUILDING' AND urgente = 1 "
            "AND fecha_reporte >= '1996-01-01' AND fecha_reporte <= '1998-12-31'"),
}

for _case, (_flt, _where) in FILTER_CASES.items():
    register(f"filtered_count_{_case}",
             O.with_(["v_reports"], f"SELECT COUNT(*) AS cnt FROM v_reports WHERE {_where}"))(
        (lambda flt: lambda spark, sf: ST.count_reports(_v(spark, sf), flt))(_flt))

register("count_reports", O.with_(["v_reports"], "SELECT COUNT(*) AS cnt FROM v_reports"))(
    lambda spark, sf: ST.count_reports(_v(spark, sf)))
register("count_urgent", O.with_(
    ["v_reports"], "SELECT COUNT(*) AS cnt FROM v_reports WHERE urgente = 1"))(
    lambda spark, sf: ST.count_urgent(_v(spark, sf)))
register("count_by_city", O.with_(
    ["v_reports"], "SELECT ciudad, COUNT(*) AS count FROM v_reports GROUP BY ciudad"))(
    lambda spark, sf: ST.count_by_city(_v(spark, sf)))
register("count_by_city_filtered", O.with_(
    ["v_reports"], "SELECT ciudad, COUNT(*) AS count FROM v_reports "
    "WHERE fecha_reporte >= '1997-01-01' AND fecha_reporte <= '1997-12-31' GROUP BY ciudad"))(
    lambda spark, sf: ST.count_by_city(_v(spark, sf), ReportFilter(
        fecha_desde="1997-01-01", fecha_hasta="1997-12-31")))
register("count_by_category", O.with_(
    ["v_reports"], "SELECT categoria_problema AS categoria, COUNT(*) AS count "
    "FROM v_reports GROUP BY categoria_problema"))(
    lambda spark, sf: ST.count_by_category(_v(spark, sf)))
register("urgent_by_city", O.with_(
    ["v_reports"], "SELECT ciudad, COUNT(*) AS count FROM v_reports WHERE urgente = 1 "
    "GROUP BY ciudad"))(
    lambda spark, sf: ST.urgent_by_city(_v(spark, sf)))
register("urgent_by_category", O.with_(
    ["v_reports"], "SELECT categoria_problema AS categoria, COUNT(*) AS count FROM v_reports "
    "WHERE urgente = 1 GROUP BY categoria_problema"))(
    lambda spark, sf: ST.urgent_by_category(_v(spark, sf)))
register("monthly_counts", O.with_(
    ["v_reports"], "SELECT substr(fecha_reporte, 1, 7) AS mes, COUNT(*) AS count "
    "FROM v_reports GROUP BY 1"))(
    lambda spark, sf: ST.monthly_counts(_v(spark, sf)))
register("monthly_counts_filtered", O.with_(
    ["v_reports"], "SELECT substr(fecha_reporte, 1, 7) AS mes, COUNT(*) AS count "
    "FROM v_reports WHERE ciudad = 'NATION_3' AND urgente = 1 GROUP BY 1"))(
    lambda spark, sf: ST.monthly_counts(_v(spark, sf), ReportFilter(ciudad="NATION_3", urgente=1)))

# ---------------------------------------------------------------------------
# Analysis (A7-A9, E8-E14)
# ---------------------------------------------------------------------------

register("scan_reports", O.with_(["v_reports"], """
SELECT id, nombre, edad, genero, ciudad, comentario, categoria_problema, nivel_urgencia, urgente,
       TRY_CAST(fecha_reporte AS DATE) AS fecha_reporte, acceso_internet,
       atencion_previa_gobierno, zona_rural
FROM v_reports"""))(lambda spark, sf: A.load_reports(_v(spark, sf)))

_NULLS = " + ".join(f"count_if({c} IS NULL)" for c in [
    "id", "nombre", "edad", "genero", "ciudad", "comentario", "categoria_problema",
    "nivel_urgencia", "urgente", "fecha_reporte", "acceso_internet",
    "atencion_previa_gobierno", "zona_rural"])
register("profile_reports", O.with_(["v_reports"], f"""
SELECT COUNT(*) AS row_count, min(fecha_reporte) AS min_fecha, max(fecha_reporte) AS max_fecha,
       CAST({_NULLS} AS BIGINT) AS null_cells
FROM v_reports"""))(lambda spark, sf: A.profile(_v(spark, sf)))

register("top_categories", O.with_(["v_reports"], """
SELECT categoria_problema, COUNT(*) AS count FROM v_reports GROUP BY 1
ORDER BY count DESC, categoria_problema LIMIT 15"""))(
    lambda spark, sf: A.top_categories(_v(spark, sf)))
register("top_cities", O.with_(["v_reports"], """
SELECT ciudad, COUNT(*) AS count FROM v_reports GROUP BY 1
ORDER BY count DESC, ciudad LIMIT 15"""))(lambda spark, sf: A.top_cities(_v(spark, sf)))

register("top_categories_many_keys", """
SELECT CAST(l_partkey AS VARCHAR) AS categoria_problema, COUNT(*) AS count FROM lineitem GROUP BY 1
ORDER BY count DESC, categoria_problema LIMIT 15""")(
    lambda spark, sf: A.top_of_many(S.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("categoria_problema")), "categoria_problema", 15))

register("urgent_distribution", O.with_(["v_reports", """
c AS (SELECT urgente, COUNT(*) AS count FROM v_reports GROUP BY urgente)""", """
l AS (SELECT count_if(urgente IN (0, 1)) = 2 AND COUNT(*) = 2 AS labelled FROM c)"""], """
SELECT urgente,
       CASE WHEN labelled AND urgente = 0 THEN 'No urgente (0)'
            WHEN labelled AND urgente = 1 THEN 'Urgente (1)'
            ELSE CAST(urgente AS VARCHAR) END AS label,
       count
FROM c, l"""))(lambda spark, sf: A.urgent_distribution(_v(spark, sf)))

register("daily_series", O.with_(["v_reports"], """
SELECT TRY_CAST(fecha_reporte AS DATE) AS fecha, COUNT(*) AS count FROM v_reports
WHERE TRY_CAST(fecha_reporte AS DATE) IS NOT NULL GROUP BY 1"""))(
    lambda spark, sf: A.daily_series(_v(spark, sf)))
register("monthly_series", O.with_(["v_reports"], """
SELECT CAST(date_trunc('month', TRY_CAST(fecha_reporte AS DATE)) AS DATE) AS mes,
       COUNT(*) AS count FROM v_reports
WHERE TRY_CAST(fecha_reporte AS DATE) IS NOT NULL GROUP BY 1"""))(
    lambda spark, sf: A.monthly_series(_v(spark, sf)))

_CROSSTAB_SUB = ["v_reports", """
tc AS (SELECT ciudad FROM v_reports GROUP BY ciudad ORDER BY COUNT(*) DESC, ciudad LIMIT 12)""", """
tk AS (SELECT categoria_problema FROM v_reports GROUP BY categoria_problema
       ORDER BY COUNT(*) DESC, categoria_problema LIMIT 12)""", """
sub AS (SELECT * FROM v_reports WHERE ciudad IN (SELECT ciudad FROM tc)
        AND categoria_problema IN (SELECT categoria_problema FROM tk))"""]
register("crosstab_top", O.with_(_CROSSTAB_SUB + ["""
cs AS (SELECT DISTINCT ciudad FROM sub)""", """
ks AS (SELECT DISTINCT categoria_problema FROM sub)"""], """
SELECT cs.ciudad, ks.categoria_problema, CAST(COUNT(sub.id) AS BIGINT) AS count
FROM cs CROSS JOIN ks
LEFT JOIN sub ON sub.ciudad = cs.ciudad AND sub.categoria_problema = ks.categoria_problema
GROUP BY 1, 2"""))(lambda spark, sf: A.crosstab_top(_v(spark, sf)))
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
register("crosstab_top_wide", O.with_(_CROSSTAB_SUB, "SELECT ciudad, " + ", ".join(
    f"COUNT(id) FILTER (WHERE categoria_problema = '{c}') AS \"{c}\"" for c in _SEGMENTS)
    + " FROM sub GROUP BY ciudad"))(
    lambda spark, sf: A.crosstab_top(_v(spark, sf), wide=True))


def correlation_rows() -> str:
    """SQL of (var1, var2, corr)."""
    from ..schema import CORRELATION_COLUMNS as cols
    sel = [f"SELECT '{a}' AS var1, '{b}' AS var2, round(CASE WHEN isnan(corr({a}, {b})) THEN NULL "
           f"ELSE corr({a}, {b}) END, 9) AS corr FROM v_reports" for a in cols for b in cols]
    return "\nUNION ALL\n".join(sel)


register("correlation_matrix", O.with_(["v_reports"], correlation_rows()))(lambda spark, sf: A.correlation_matrix(_v(spark, sf)))

register("analysis_summary", O.with_(["v_reports"], f"""
SELECT COUNT(*) AS rows, min(fecha_reporte) AS min_fecha, max(fecha_reporte) AS max_fecha,
       {len(A.CHART_TABLES)} AS n_charts, '{",".join(A.CHART_TABLES)}' AS charts
FROM v_reports"""))(lambda spark, sf: A.summary(_v(spark, sf)))

