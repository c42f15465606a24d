"""Filtered counts and group counts over reports (the retrieval statistics).

Each operator is one filter (pushed to the scan) plus one hash aggregate
with map-side partial aggregation, so a hot city or month never reaches a
single reducer as raw rows. Ordered results are ordered like the source
(count descending; ties broken by key ascending so the order is total).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_key
from .filters import ReportFilter, as_filter


def _filtered(reports: DataFrame, flt: ReportFilter | dict | None) -> DataFrame:
    return reports.where(as_filter(flt).predicate())


def count_reports(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """One row ``cnt``."""
    return _filtered(reports, flt).agg(F.count(F.lit(1)).alias("cnt"))


def count_urgent(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """Count with ``urgente = 1`` forced on a copy of the filters."""
    return count_reports(reports, as_filter(flt).with_urgent())


def _count_by(reports: DataFrame, key: str, out: str, flt) -> DataFrame:
    return (_filtered(reports, flt).groupBy(F.col(key).alias(out))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(out)))


def count_by_city(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """``(ciudad, count)`` by count descending."""
    return _count_by(reports, "ciudad", "ciudad", flt)


def count_by_category(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """``(categoria, count)`` by count descending."""
    return _count_by(reports, "categoria_problema", "categoria", flt)


def urgent_by_city(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """E5."""
    return count_by_city(reports, as_filter(flt).with_urgent())


def urgent_by_category(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """E6."""
    return count_by_category(reports, as_filter(flt).with_urgent())


def monthly_counts(reports: DataFrame, flt: ReportFilter | dict | None = None) -> DataFrame:
    """``(mes, count)`` with ``mes`` the first 7 characters of the date,
    ascending."""
    return (_filtered(reports, flt).groupBy(month_key("fecha_reporte").alias("mes"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("mes"))
