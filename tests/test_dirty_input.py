"""Ordinary dirty input: big numbers, long ids, date styles, odd names, files
with another column order; and the searches' rarely used branches."""

import os

import pytest
from pyspark.sql import functions as F

from civiq.operators import analysis as A
from civiq.operators import clean as C
from civiq.operators import search as SE
from civiq.schema import COLUMN_RENAME_MAP
from civiq.sources import csv as CSV
from civiq.sources import tables as S

from .conftest import SF_SMALL

RAW = list(COLUMN_RENAME_MAP)


def raw_row(**change):
    row = dict(zip(RAW, ["1", "Ana", "30", "F", "Cali", "agua", "Agua", "alta", "2023-01-05", "1", "0", "1"], strict=True))
    return {**row, **change}


def frame(spark, rows):
    data = [(i, *[r[c] for c in RAW]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "seq long, " + ", ".join(f"`{c}` string" for c in RAW))


def test_big_numbers_drop_the_row_and_not_the_job(spark):
    rows = [raw_row(ID="1", Edad="9999999999"), raw_row(ID="1e30"), raw_row(ID="99999999999999999999"), raw_row(ID="2")]
    assert [r.id for r in C.transform(frame(spark, rows)).collect()] == [2]


def test_ids_above_double_precision_stay_apart(spark):
    ids = ["9007199254740992", "9007199254740993", "9007199254740993.0", "7.9"]
    got = sorted(r.id for r in C.transform(frame(spark, [raw_row(ID=i) for i in ids])).collect())
    assert got == [7, 9007199254740992, 9007199254740993]


@pytest.mark.parametrize("text", [
    "1/5/2023", "2023-1-5", "2023-01-05T10:30:00", "2023-01-05 10:30", "2023/01/05", "2023-01-05 10:30:00.5",
    "01/05/2023 10:30:00", "2023-01-05", "01/05/2023"])
def test_date_styles(spark, text):
    df = spark.createDataFrame([(text,)], "fecha_reporte string")
    assert C.normalize_fecha(df).head()[0] == "2023-01-05"


def test_cleaning_twice_changes_nothing(spark):
    # (an empty city, once blanks are stripped, is a missing cell when read again)
    once = C.transform(S.raw_reports(spark, SF_SMALL)).where("ciudad <> ''")
    again = once.withColumns({c: F.col(c).cast("string") for c in once.columns})
    again = again.withColumnsRenamed({v: k for k, v in COLUMN_RENAME_MAP.items()}).withColumn("seq", F.col("ID").cast("long"))
    twice = C.transform(again.drop("urgente"))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_needs_an_order(spark):
    cur = spark.createDataFrame([(1, "a")], "id long, ciudad string")
    with pytest.raises(ValueError):
        C.upsert(cur, cur.union(cur))
    new = spark.createDataFrame([(1, "b", 2), (1, "c", 1)], "id long, ciudad string, seq long")
    assert [tuple(r) for r in C.upsert(cur, new).collect()] == [(1, "b")]


def test_csv_columns_are_matched_by_name(spark, scratch):
    import csv
    for n, cols in enumerate([RAW, RAW[::-1], RAW[1:]]):
        with open(os.path.join(scratch, f"{n}.csv"), "w", newline="", encoding="utf-8") as f:
            out = csv.DictWriter(f, cols, extrasaction="ignore")
            out.writeheader()
            out.writerow(raw_row(ID=str(n), Comentario='dos\nlineas "x"'))
    got = CSV.read_reports_csv(spark, scratch).select("ID", "Nombre", "Ciudad", "Comentario").collect()
    assert sorted((r[0] or "", *r[1:]) for r in got) == [
        ("", "Ana", "Cali", 'dos\nlineas "x"'), ("0", "Ana", "Cali", 'dos\nlineas "x"'), ("1", "Ana", "Cali", 'dos\nlineas "x"')]


def test_crosstab_with_odd_category_names(spark):
    rows = [(1, "Cali", "Agua S.A."), (2, "Cali", "a`b"), (3, "Bogotá", "ciudad"), (4, "Cali", "Agua S.A.")]
    df = spark.createDataFrame(rows, "id long, ciudad string, categoria_problema string")
    long = {(r[0], r[1]): r[2] for r in A.crosstab_top(df).collect()}
    assert len(long) == 6 and long["Cali", "Agua S.A."] == 2 and long["Bogotá", "a`b"] == 0
    wide = A.crosstab_top(df, wide=True)
    assert wide.columns == ["ciudad", "Agua S.A.", "a`b", "ciudad_"]
    assert [tuple(r) for r in wide.collect()] == [("Bogotá", 0, 0, 1), ("Cali", 2, 1, 0)]


def test_equal_questions_are_ranked_once(spark):
    docs = S.text_reports(spark, SF_SMALL)
    q = spark.range(200).select(F.col("id").alias("question_id"), F.lit("src0 src0").alias("texto"))
    asked, fan = SE._distinct_queries(q)
    assert asked.count() == 1 and fan.count() == 200
    hits = SE.bm25_search(q, docs, k=3).collect()
    assert len(hits) == 600 and len({(h.rank, h.id) for h in hits}) == 3


def test_search_limits_forced_down(spark, monkeypatch):
    docs, qs = S.text_reports(spark, SF_SMALL), S.filtered_queries(spark, SF_SMALL)
    row = lambda df: sorted((r.question_id, r.rank, r.id, r.used_fts) for r in df.collect())
    usual = row(SE.search_auto(qs, docs))
    for name in ("LIKE_BROADCAST_BYTES", "QUERY_TERMS_BROADCAST_ROWS", "PAIRS_BROADCAST_ROWS", "HITS_BROADCAST_ROWS"):
        monkeypatch.setattr(SE, name, 200 if name == "LIKE_BROADCAST_BYTES" else 0)
    assert row(SE.search_auto(qs, docs)) == usual


def test_like_honours_the_filters_of_each_question(spark):
    docs = spark.createDataFrame(
        [(1, "agua !!", "Cali", "x", "2023-01-01", 1), (2, "luz !!", "Bogotá", "x", "2023-01-02", 1)],
        "id long, comentario string, ciudad string, categoria_problema string, fecha_reporte string, urgente int")
    qs = spark.createDataFrame([(1, "!!", "Cali"), (2, "!!", None)], "question_id long, texto string, f_ciudad string")
    for c in SE.FILTER_COLS[1:]:
        qs = qs.withColumn(c, F.lit(None).cast("string"))
    assert sorted((r.question_id, r.id) for r in SE.like_search(qs, docs).collect()) == [(1, 1), (2, 1), (2, 2)]


def test_store_presence(spark, scratch):
    assert tuple(A.store_profile(spark, scratch).head()) == (False, False, 0)
