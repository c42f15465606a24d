"""Optional conjunctive report filters (city, category, urgent, date range).

Two forms:

* ``ReportFilter`` - one filter bag for a whole job, compiled to a literal
  predicate that Catalyst pushes into the Parquet scan.
* ``filter_columns_predicate`` - per-row filters carried as nullable columns
  (batch mode: every question may have its own filter bag).

A value that is empty or null is skipped, except ``urgente`` where only null
means "no filter" (0 is a real filter value). Comparisons are exact and
case-sensitive; dates compare as ISO text.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FILTER_FIELDS = ["ciudad", "categoria_problema", "urgente", "fecha_desde", "fecha_hasta"]


@dataclass(frozen=True)
class ReportFilter:
    ciudad: str | None = None
    categoria_problema: str | None = None
    urgente: int | bool | None = None
    fecha_desde: str | None = None
    fecha_hasta: str | None = None

    def with_urgent(self) -> "ReportFilter":
        return replace(self, urgente=1)

    def predicate(self, prefix: str = "") -> Column:
        p = []
        if self.ciudad:
            p.append(F.col(prefix + "ciudad") == F.lit(self.ciudad))
        if self.categoria_problema:
            p.append(F.col(prefix + "categoria_problema") == F.lit(self.categoria_problema))
        if self.urgente is not None:
            p.append(F.col(prefix + "urgente") == F.lit(int(self.urgente)))
        if self.fecha_desde:
            p.append(F.col(prefix + "fecha_reporte") >= F.lit(self.fecha_desde))
        if self.fecha_hasta:
            p.append(F.col(prefix + "fecha_reporte") <= F.lit(self.fecha_hasta))
        return reduce(lambda a, b: a & b, p, F.lit(True))


def as_filter(f: ReportFilter | dict | None) -> ReportFilter:
    if f is None:
        return ReportFilter()
    if isinstance(f, ReportFilter):
        return f
    return ReportFilter(**{k: v for k, v in f.items() if k in FILTER_FIELDS})


def filter_columns_predicate(f_prefix: str = "f_", r_prefix: str = "") -> Column:
    """Predicate over per-row filter columns ``f_ciudad, f_categoria_problema,
    f_urgente, f_fecha_desde, f_fecha_hasta`` against report columns."""
    def skip(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")) == ""

    city, cat = f_prefix + "ciudad", f_prefix + "categoria_problema"
    urg, lo, hi = f_prefix + "urgente", f_prefix + "fecha_desde", f_prefix + "fecha_hasta"
    return (
        (skip(city) | (F.col(r_prefix + "ciudad") == F.col(city)))
        & (skip(cat) | (F.col(r_prefix + "categoria_problema") == F.col(cat)))
        & (F.col(urg).isNull() | (F.col(r_prefix + "urgente") == F.col(urg).cast("int")))
        & (skip(lo) | (F.col(r_prefix + "fecha_reporte") >= F.col(lo)))
        & (skip(hi) | (F.col(r_prefix + "fecha_reporte") <= F.col(hi)))
    )
