"""Analytics tables behind the report charts, plus store profiling.

Every table is one aggregate over the report scan (partial aggregation
map-side). Top-N lists are bounded by N, so they may be broadcast for the
membership (semi) joins of the crosstab.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import (
    CORRELATION_COLUMNS,
    CROSSTAB_TOP_CATEGORIES,
    CROSSTAB_TOP_CITIES,
    REPORT_COLUMNS,
    TOP_CATEGORIES,
    TOP_CITIES,
    URGENT_LABEL_0,
    URGENT_LABEL_1,
)
from ..session import materialize

#: Counters of a frequent-items summary, keys of it that are counted exactly, and
#: groups of partitions whose summaries are merged first.
TRACKED_KEYS, LISTED_KEYS, SUMMARY_PARTS = 1 << 16, 2048, 64

CHART_TABLES = [
    "heatmap_correlaciones",
    "heatmap_ciudad_categoria",
    "bar_categorias",
    "bar_ciudades",
    "bar_urgente",
    "line_diario",
    "line_mensual",
]


def load_reports(reports: DataFrame) -> DataFrame:
    """Full scan with the date coerced to a DATE (bad text -> null)."""
    return reports.withColumn("fecha_reporte", F.to_date(
        F.try_to_timestamp(F.col("fecha_reporte"), F.lit("yyyy-MM-dd"))))


def profile(reports: DataFrame) -> DataFrame:
    """One aggregate: rows, date range and the number of null cells."""
    cols = [c for c in REPORT_COLUMNS if c in reports.columns]
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0)).cast("long")
    return reports.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("fecha_reporte").alias("min_fecha"),
        F.max("fecha_reporte").alias("max_fecha"),
        nulls.alias("null_cells"),
    )


def _readable(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def store_profile(spark: SparkSession, out_dir: str) -> DataFrame:
    """Which parts of a store (an ETL output folder) are there, and the
    number of stored reports: (has_reports, has_index, row_count), one row."""
    reports = _readable(spark, f"{out_dir}/reports")
    has_index = all(_readable(spark, f"{out_dir}/report_search/{part}") is not None
                    for part in ("postings", "terms", "corpus"))
    rows = (reports if reports is not None else spark.range(0)).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(F.lit(reports is not None).alias("has_reports"), F.lit(has_index).alias("has_index"), "row_count")


def _top(reports: DataFrame, key: str, n: int) -> DataFrame:
    return (reports.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(key)).limit(n))


def top_categories(reports: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The n most frequent categories."""
    return _top(reports, "categoria_problema", n)


def top_cities(reports: DataFrame, n: int = TOP_CITIES) -> DataFrame:
    """The n most frequent cities."""
    return _top(reports, "ciudad", n)


def top_of_many(rows: DataFrame, key: str, n: int, tracked: int = TRACKED_KEYS, listed: int = LISTED_KEYS) -> DataFrame:
    """E10/E11 for keys without a bound on their number: the n most frequent values
    (key, count), counted exactly, ties by key ascending, a null key like any other.

    A mergeable frequent-items summary of ``tracked`` counters is made per task and
    merged in two steps; only its ``listed`` best keys are then counted, so no key is
    shuffled. A key outside that list has at most ``bound`` rows: the summary's
    error allows twice its epsilon, and a full list ends at its last estimate. The
    counted keys are the answer if the n-th of them has more rows than that. Otherwise
    (frequencies too flat for the summary) all keys are counted."""
    tracked = max(tracked, listed)
    part = F.pmod(F.spark_partition_id(), F.lit(SUMMARY_PARTS))
    parts = rows.groupBy(part.alias("_part")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("s"), F.count(F.lit(1)).alias("n"))
    # grouped by a constant: without rows there is no group, and nothing to merge
    one = parts.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {listed})").alias("top"), F.sum("n").alias("n")).first()
    if one is None:
        return _top(rows, key, n)
    counters = 1 << math.ceil(math.log2(math.ceil(tracked / 0.75)))
    bound = 2 * math.ceil(3.5 / counters * one["n"]) if counters * 0.75 < one["n"] else 0
    if len(one["top"]) == listed:
        bound = max(bound, one["top"][-1]["count"])
    names = [r["item"] for r in one["top"]]
    kind = rows.schema[key].dataType
    cand = rows.sparkSession.createDataFrame([(v,) for v in names], T.StructType([T.StructField("_cand", kind)]))
    counted = rows.join(F.broadcast(cand), F.col(key).eqNullSafe(F.col("_cand")), "left_semi")
    best = _top(counted, key, n).collect()
    if bound and (len(best) < n or best[-1]["count"] <= bound):
        return _top(rows, key, n)
    return rows.sparkSession.createDataFrame([tuple(r) for r in best], T.StructType(
        [T.StructField(key, kind), T.StructField("count", T.LongType())]))


def urgent_distribution(reports: DataFrame) -> DataFrame:
    """Count per urgent flag, labelled when both flags occur."""
    return urgent_labels(reports.groupBy("urgente").agg(F.count(F.lit(1)).alias("count")))


def urgent_labels(counts: DataFrame) -> DataFrame:
    """(urgente, label, count) of the counts per flag."""
    labelled = counts.select(
        (F.count_if(F.col("urgente").isin(0, 1)) == 2) & (F.count(F.lit(1)) == 2)).scalar()
    label = (F.when(labelled & (F.col("urgente") == 0), F.lit(URGENT_LABEL_0))
             .when(labelled & (F.col("urgente") == 1), F.lit(URGENT_LABEL_1))
             .otherwise(F.col("urgente").cast("string")))
    return counts.select("urgente", label.alias("label"), "count").orderBy("urgente")


def daily_series(reports: DataFrame) -> DataFrame:
    """Reports per day, only days present, ascending."""
    d = load_reports(reports).where(F.col("fecha_reporte").isNotNull())
    return (d.groupBy(F.col("fecha_reporte").alias("fecha"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("fecha"))


def monthly_series(reports: DataFrame) -> DataFrame:
    """Reports per month (month start date), ascending."""
    d = load_reports(reports).where(F.col("fecha_reporte").isNotNull())
    return (d.groupBy(F.trunc("fecha_reporte", "month").alias("mes"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("mes"))


def city_category_counts(reports: DataFrame) -> DataFrame:
    """(ciudad, categoria_problema, n_rows, n_ids): the one aggregate that the
    top lists and the crosstab are made of."""
    return reports.groupBy("ciudad", "categoria_problema").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_ids"))


def _top_names(cells: DataFrame, key: str, n: int) -> list[str]:
    """The n most frequent names (n rows reach the driver)."""
    rows = (cells.groupBy(key).agg(F.sum("n_rows").alias("count"))
            .orderBy(F.desc("count"), F.asc(key)).limit(n).collect())
    return [r[key] for r in rows if r[key] is not None]


def crosstab_top(reports: DataFrame, top_cities_n: int = CROSSTAB_TOP_CITIES,
                 top_cats_n: int = CROSSTAB_TOP_CATEGORIES, wide: bool = False) -> DataFrame:
    """City x category counts over the top cities and top categories.

    The reports are scanned once, to the counts per pair; lists and cells come
    from these. Long form is zero-filled over the cities and categories present
    in the subset; wide form has one column per category (``_`` is added to a
    category called like the city column)."""
    return crosstab_cells(materialize(city_category_counts(reports)), top_cities_n, top_cats_n, wide)


def crosstab_cells(cells: DataFrame, top_cities_n: int = CROSSTAB_TOP_CITIES,
                   top_cats_n: int = CROSSTAB_TOP_CATEGORIES, wide: bool = False) -> DataFrame:
    """E13 from the counts per (city, category)."""
    cities = _top_names(cells, "ciudad", top_cities_n)
    cats = _top_names(cells, "categoria_problema", top_cats_n)
    sub = cells.where(F.col("ciudad").isin(cities) & F.col("categoria_problema").isin(cats))
    present = {r[0] for r in sub.select("categoria_problema").distinct().collect()}
    cats = sorted(c for c in cats if c in present)
    pivot = sub.groupBy(F.col("ciudad").alias("_ciudad")).pivot("categoria_problema", cats).agg(
        F.sum("n_ids")) if cats else sub.select(F.col("ciudad").alias("_ciudad")).distinct()
    slots = [f"_{i}" for i in range(len(cats))]
    pivot = pivot.toDF("_ciudad", *slots).na.fill(0)
    if wide:
        return pivot.select(F.col("_ciudad").alias("ciudad"), *[
            F.col(s).cast("long").alias(c if c != "ciudad" else "ciudad_")
            for s, c in zip(slots, cats, strict=True)]).orderBy("ciudad")
    if not cats:
        return sub.select("ciudad", "categoria_problema", F.col("n_ids").alias("count"))
    pairs = F.array(*[F.struct(F.lit(c).alias("categoria_problema"), F.col(s).cast("long").alias("count"))
                      for s, c in zip(slots, cats, strict=True)])
    return pivot.select(F.col("_ciudad").alias("ciudad"), F.inline(pairs))


def _moments(reports: DataFrame, cols: list[str]) -> tuple[list[Column], dict[tuple[str, str], tuple[str, str]]]:
    """The aggregates behind a correlation matrix (every pairwise population
    covariance, the deviations) and the names of each pair's two deviations."""
    aggs, sd, seen = [], {}, set()
    fields = {f.name: f for f in reports.schema.fields}
    for i, a in enumerate(cols):
        for b in cols[i:]:
            if a == b or not (fields[a].nullable or fields[b].nullable):
                both, key = F.lit(True), ""  # no nulls: deviations are shared
            else:
                both, key = F.col(a).isNotNull() & F.col(b).isNotNull(), f"_{a}__{b}"
            xa = F.when(both, F.col(a).cast("double"))
            xb = F.when(both, F.col(b).cast("double"))
            aggs.append(F.covar_pop(xa, xb).alias(f"cv_{a}__{b}"))
            sd[a, b] = (f"sd_{a}{key}", f"sd_{b}{key}")
            for name, x in zip(sd[a, b], (xa, xb), strict=True):
                if name not in seen:
                    seen.add(name)
                    aggs.append(F.stddev_pop(x).alias(name))
    return aggs, sd


def _correlations(one: DataFrame, cols: list[str], sd: dict[tuple[str, str], tuple[str, str]]) -> DataFrame:
    """(var1, var2, corr) of the one row of moments."""
    cells = []
    for a in cols:
        for b in cols:
            x, y = (a, b) if cols.index(a) <= cols.index(b) else (b, a)
            denom = F.col(sd[x, y][0]) * F.col(sd[x, y][1])
            r = F.when(denom != 0, F.col(f"cv_{x}__{y}") / denom)
            cells.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                  F.round(r, 9).alias("corr")))
    return one.select(F.inline(F.array(*cells)))


def correlation_matrix(reports: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of the numeric columns in long form.

    One aggregate computes every pairwise population covariance and standard
    deviation; a constant column gives NULL (no division by zero).
    """
    cols = [c for c in (cols or CORRELATION_COLUMNS) if c in reports.columns]
    aggs, sd = _moments(reports, cols)
    return _correlations(reports.agg(*aggs), cols, sd)


class ReportCube:
    """Everything that the charts and the profile need, from one scan of the
    reports: grouping sets per (city, category), per urgent flag, per day and over all,
    written once. Its rows grow with the distinct names and days, not with the reports.
    Empty reports give an empty cube."""

    KEYS = ("ciudad", "categoria_problema", "urgente", "fecha_reporte")
    SETS = (("ciudad", "categoria_problema"), ("urgente",), ("fecha_reporte",), ())

    def __init__(self, reports: DataFrame):
        self.cols = [c for c in CORRELATION_COLUMNS if c in reports.columns]
        moments, self._sd = _moments(reports, self.cols)
        cells = [c for c in REPORT_COLUMNS if c in reports.columns]
        nulls = sum((F.count_if(F.col(c).isNull()) for c in cells), F.lit(0)).cast("long")
        self.rows = materialize(reports.groupingSets([list(s) for s in self.SETS], *self.KEYS).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_ids"),
            F.min("fecha_reporte").alias("min_fecha"), F.max("fecha_reporte").alias("max_fecha"), nulls.alias("null_cells"), *moments))

    def _of(self, *keys: str) -> DataFrame:
        """The rows of one grouping set (a bit of its number per key left out)."""
        number = sum(1 << i for i, k in enumerate(reversed(self.KEYS)) if k not in keys)
        return self.rows.where(F.col("_set") == number)

    def profile(self) -> DataFrame:
        """A8."""
        return self._of().agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("row_count"), F.min("min_fecha").alias("min_fecha"),
                              F.max("max_fecha").alias("max_fecha"), F.coalesce(F.sum("null_cells"), F.lit(0)).cast("long").alias("null_cells"))

    def _series(self, key: Column, name: str) -> DataFrame:
        days = load_reports(self._of("fecha_reporte").select("fecha_reporte", "n_rows")).where(F.col("fecha_reporte").isNotNull())
        return days.groupBy(key.alias(name)).agg(F.sum("n_rows").alias("count")).orderBy(name)

    def _top(self, key: str, n: int) -> DataFrame:
        return (self._of("ciudad", "categoria_problema").groupBy(key).agg(F.sum("n_rows").alias("count"))
                .orderBy(F.desc("count"), F.asc(key)).limit(n))

    def charts(self) -> dict[str, DataFrame]:
        """The chart tables."""
        # an aggregate over all rows has one row, also without reports
        one = self._of().select(*[c for c in self.rows.columns if c.startswith(("cv_", "sd_"))])
        one = one.agg(*[F.max(c).alias(c) for c in one.columns])
        return {
            "heatmap_correlaciones": _correlations(one, self.cols, self._sd),
            "heatmap_ciudad_categoria": crosstab_cells(self._of("ciudad", "categoria_problema").select("ciudad", "categoria_problema", "n_rows", "n_ids")),
            "bar_categorias": self._top("categoria_problema", TOP_CATEGORIES),
            "bar_ciudades": self._top("ciudad", TOP_CITIES),
            "bar_urgente": urgent_labels(self._of("urgente").select("urgente", F.col("n_rows").alias("count"))),
            "line_diario": self._series(F.col("fecha_reporte"), "fecha"),
            "line_mensual": self._series(F.trunc("fecha_reporte", "month"), "mes"),
        }


def summary(reports: DataFrame, charts: list[str] | None = None) -> DataFrame:
    """The one-row analysis summary: rows, date range and chart tables."""
    names = charts or CHART_TABLES
    return reports.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("fecha_reporte").alias("min_fecha"),
        F.max("fecha_reporte").alias("max_fecha"),
    ).select("*", F.lit(len(names)).alias("n_charts"), F.lit(",".join(names)).alias("charts"))
