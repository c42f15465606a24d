"""Charts from one scan, top lists over many keys, key sketches."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiq.operators import analysis as A
from civiq.operators import clean as C
from civiq.operators.sketch import key_sketch, mark_held
from civiq.session import materialize
from civiq.sources import tables as S

from .conftest import SF_SMALL


def _rows(df):
    return sorted(map(str, df.collect()))


def test_cube_charts_equal_the_single_operators(spark):
    reports = S.reports(spark, SF_SMALL)
    cube = A.ReportCube(reports)
    single = {
        "heatmap_correlaciones": A.correlation_matrix, "heatmap_ciudad_categoria": A.crosstab_top,
        "bar_categorias": A.top_categories, "bar_ciudades": A.top_cities, "bar_urgente": A.urgent_distribution,
        "line_diario": A.daily_series, "line_mensual": A.monthly_series}
    charts = cube.charts()
    assert list(charts) == A.CHART_TABLES
    for name, fn in single.items():
        assert _rows(charts[name]) == _rows(fn(reports)), name
    assert _rows(cube.profile()) == _rows(A.profile(reports))


def test_cube_of_nulls_and_of_nothing(spark):
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in S.reports(spark, SF_SMALL).schema.fields])
    odd = {f.name: None for f in schema.fields}
    rows = [odd | {"id": 1, "ciudad": "A", "urgente": 1, "fecha_reporte": "2024-02-30"},
            odd | {"id": 2, "categoria_problema": "k", "fecha_reporte": "2024-02-01"}, odd]
    reports = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    cube = A.ReportCube(reports)
    assert _rows(cube.profile()) == _rows(A.profile(reports))
    charts = cube.charts()
    assert [tuple(r) for r in charts["line_diario"].collect()] == [tuple(r) for r in A.daily_series(reports).collect()]
    assert _rows(charts["bar_ciudades"]) == _rows(A.top_cities(reports))
    assert _rows(charts["bar_urgente"]) == _rows(A.urgent_distribution(reports))
    empty = A.ReportCube(reports.limit(0))
    assert empty.profile().first().asDict() == {"row_count": 0, "min_fecha": None, "max_fecha": None, "null_cells": 0}
    assert empty.charts()["line_mensual"].count() == 0
    assert [r.corr for r in empty.charts()["heatmap_correlaciones"].collect()] == [None] * 25


@pytest.mark.parametrize("skewed", [True, False])
def test_top_of_many_is_exact(spark, skewed):
    rnd = random.Random(3)
    keys = [f"k{int(4000 * rnd.random() ** (6 if skewed else 1))}" for _ in range(30000)] + [None] * 900 + ["tie1", "tie2"] * 300
    want = sorted(collections.Counter(keys).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:9]
    rows = spark.createDataFrame([(k,) for k in keys], "c string").repartition(7)
    got = [tuple(r) for r in A.top_of_many(rows, "c", 9, tracked=1500, listed=300).collect()]
    assert got == want
    # a summary far too small still gives the exact list
    assert [tuple(r) for r in A.top_of_many(rows, "c", 9, tracked=20, listed=20).collect()] == want
    assert A.top_of_many(rows.limit(0), "c", 9).collect() == []


def test_sketch_holds_every_key(spark):
    some = spark.range(0, 5000, 7).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    sketch = materialize(key_sketch(some, "id", 1 << 16))
    marked = mark_held(spark.range(5000).select(F.when(F.col("id") > 0, F.col("id")).alias("id")), sketch, "id", "held", 1 << 16)
    rows = {r.id: r.held for r in marked.collect()}
    assert all(rows[i or None] for i in range(0, 5000, 7))
    assert sum(rows.values()) < 5000 // 7 + 200
    assert not any(r.held for r in mark_held(some, materialize(key_sketch(some.limit(0), "id")), "id", "held").collect())


def test_dedup_and_upsert_with_one_bit_of_sketch(spark, monkeypatch):
    """A sketch so small that every row passes it changes no result."""
    rows = spark.createDataFrame([(i % 40, i, f"c{i}") for i in range(100)] + [(None, 7, "x"), (None, 3, "y")], "id long, seq long, ciudad string")
    first = sorted(map(str, C.dedup_first(rows).collect()))
    assert len(first) == 41 and "Row(id=None, seq=3, ciudad='y')" in first
    cur = rows.where("id IS NOT NULL").dropDuplicates(["id"]).drop("seq")
    new = spark.createDataFrame([(1, "n", 1), (1, "m", 2), (77, "z", 1)], "id long, ciudad string, seq long")
    done = C.upsert(cur, new)
    got = {r.id: r.ciudad for r in done.collect()}
    assert got[1] == "m" and got[77] == "z" and done.count() == len(got) == 41
    monkeypatch.setattr(C, "key_sketch", lambda df, key: key_sketch(df, key, 1))
    monkeypatch.setattr(C, "mark_held", lambda df, sk, key, name: mark_held(df, sk, key, name, 1))
    assert sorted(map(str, C.dedup_first(rows).collect())) == first
    assert {r.id: r.ciudad for r in C.upsert(cur, new).collect()} == got
