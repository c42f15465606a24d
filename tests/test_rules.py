"""Row-level fixtures for the semantic rules (small literal tables)."""

import math
import sqlite3

import pytest
from pyspark.sql import functions as F

from civiq.operators import analysis as A
from civiq.operators import clean as C
from civiq.operators import search as SE
from civiq.operators import stats as ST
from civiq.operators.index import TextIndex
from civiq.operators.questions import QuestionStats, parse_questions
from civiq.schema import RAW_COLUMNS, REPORT_SCHEMA

RAW_SCHEMA = "seq long, " + ", ".join(f"`{c}` string" for c in RAW_COLUMNS)


def raw_row(seq, id_="1", nombre="Ana", edad="30", genero="F", ciudad="Cali",
            comentario="agua", cat="Agua", nivel="Urgente", fecha="2023-01-05",
            acc="1", aten="0", rural="1"):
    return (seq, id_, nombre, edad, genero, ciudad, comentario, cat, nivel, fecha, acc, aten, rural)


def clean(spark, rows):
    return C.transform(C.mark_na(spark.createDataFrame(rows, RAW_SCHEMA)))


def reports_df(spark, rows):
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def report(id_, ciudad="Cali", cat="Agua", urg=1, fecha="2023-01-05", comentario="x", edad=30,
           acc=1, aten=0, rural=1):
    return (id_, "n", edad, "F", ciudad, comentario, cat, "Urgente" if urg else "No urgente",
            urg, fecha, acc, aten, rural)


# --- cleaning -------------------------------------------------------------------

def test_age_rounding_half_even_and_range(spark):
    rows = [raw_row(i, id_=str(i), edad=e) for i, e in
            enumerate(["-0.5", "120.5", "130", "abc", "1d", "inf", "NaN", " 23.0 ", "0.5", "1.5"])]
    got = {r.id: r.edad for r in clean(spark, rows).collect()}
    assert got == {0: 0, 1: 120, 7: 23, 8: 0, 9: 2}


def test_blank_city_kept_and_comment_markers_null(spark):
    rows = [raw_row(1, id_="1", ciudad="   "), raw_row(2, id_="2", comentario=" NaN "),
            raw_row(3, id_="3", comentario="NULL"), raw_row(4, id_="4", comentario="   "),
            raw_row(5, id_="5", comentario="None"), raw_row(6, id_="6", comentario=" ok ")]
    got = {r.id: (r.ciudad, r.comentario) for r in clean(spark, rows).collect()}
    assert got == {1: ("", "agua"), 6: ("Cali", "ok")}


def test_na_markers_match_untrimmed_cells(spark):
    rows = [raw_row(1, id_="1", nombre="NA"), raw_row(2, id_="2", nombre=" NA "),
            raw_row(3, id_="3", nombre="n/a"), raw_row(4, id_="4", nombre="")]
    got = {r.id: r.nombre for r in clean(spark, rows).collect()}
    assert got == {2: "NA"}


def test_dates_formats_and_invalid(spark):
    rows = [raw_row(1, id_="1", fecha="2023-01-05"), raw_row(2, id_="2", fecha="2023-01-05 10:30:00"),
            raw_row(3, id_="3", fecha="01/05/2023"), raw_row(4, id_="4", fecha="2023-13-01"),
            raw_row(5, id_="5", fecha="garbage")]
    got = {r.id: r.fecha_reporte for r in clean(spark, rows).collect()}
    assert got == {1: "2023-01-05", 2: "2023-01-05", 3: "2023-01-05"}


def test_flags_gender_urgency(spark):
    rows = [raw_row(1, id_="1", acc="1.0"), raw_row(2, id_="2", acc="2"),
            raw_row(3, id_="3", aten="0.5"), raw_row(4, id_="4", rural="True"),
            raw_row(5, id_="5", genero="O"), raw_row(6, id_="6", genero="femenino"),
            raw_row(7, id_="7", nivel=" ALTA "), raw_row(8, id_="8", nivel="baja urgencia"),
            raw_row(9, id_="9", nivel="media")]
    got = {r.id: (r.acceso_internet, r.genero, r.nivel_urgencia, r.urgente)
           for r in clean(spark, rows).collect()}
    assert got == {1: (1, "F", "Urgente", 1), 5: (1, "Otro", "Urgente", 1),
                   7: (1, "F", "ALTA", 1), 8: (1, "F", "baja urgencia", 0)}


def test_dedup_first_valid_row_after_coercion(spark):
    rows = [raw_row(1, id_="7", nombre=None), raw_row(2, id_="7.0", nombre="B"),
            raw_row(3, id_="07", nombre="C"), raw_row(4, id_="x"), raw_row(5, id_=None)]
    got = [(r.id, r.nombre) for r in clean(spark, rows).collect()]
    assert got == [(7, "B")]


def test_upsert_last_wins(spark):
    cur = reports_df(spark, [report(1, ciudad="A"), report(2, ciudad="B")])
    new = reports_df(spark, [report(2, ciudad="C"), report(3, ciudad="D")])
    got = {r.id: r.ciudad for r in C.upsert(cur, new).collect()}
    assert got == {1: "A", 2: "C", 3: "D"}


def test_cleaning_independent_of_partitioning(spark):
    rows = [raw_row(i, id_=str(i % 5), nombre=f"n{i}") for i in range(40)]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    a = sorted(C.transform(C.mark_na(df.repartition(1))).collect())
    b = sorted(C.transform(C.mark_na(df.repartition(7))).collect())
    assert a == b and len(a) == 5


def test_csv_source_quotes_newlines_markers(spark, scratch):
    path = f"{scratch}/raw.csv"
    header = ",".join(f'"{c}"' for c in RAW_COLUMNS)
    lines = [
        header,
        '1,Ana,30,F,Cali,"agua, sucia\ncon barro",Agua,Urgente,2023-01-05,1,0,1',
        '2,NA,30,F,Cali,agua,Agua,Urgente,2023-01-05,1,0,1',
        '1,Otra,31,M,Cali,luz,Luz,Baja,2023-02-05,0,0,1',
    ]
    with open(path, "w", encoding="utf-8") as f:
        f.write("﻿" + "\n".join(lines) + "\n")
    from civiq.sources.csv import read_reports_csv
    raw = read_reports_csv(spark, path)
    assert raw.count() == 3
    got = C.transform(raw).collect()
    assert [(r.id, r.nombre, r.comentario) for r in got] == [(1, "Ana", "agua, sucia\ncon barro")]


# --- search ----------------------------------------------------------------------

def test_like_semantics(spark):
    docs = reports_df(spark, [report(i, cat="Luz", comentario=t) for i, t in [
        (1, "abc"), (2, "a-c"), (3, "50% off"), (4, "500 off"), (5, "back\\slash"),
        (6, "ÁGUA"), (7, "AGUA")]])
    qs = spark.createDataFrame([(1, "a_c"), (2, "50%"), (3, "k\\s"), (4, "água"), (5, "agua")],
                               "question_id long, texto string")
    got = {}
    for r in SE.like_matches(qs, docs).collect():
        got.setdefault(r.question_id, set()).add(r.id)
    # 'Á' is not case-folded (ASCII only), so 'ÁGUA' matches neither query
    assert got == {1: {1, 2}, 2: {3, 4}, 3: {5}, 5: {7}}


def test_bm25_matches_sqlite_fts5(spark):
    corpus = [
        (1, "agua sucia en el barrio", "Cali", "Agua"),
        (2, "agua agua agua", "Cali", "Agua"),
        (3, "luz y agua", "Bogotá", "Luz"),
        (4, "huecos en la vía", "Medellín", "Vías"),
        (5, "agua potable escasa", "Cali", "Agua"),
        (6, "sin luz", "Cali", "Luz"),
    ]
    queries = [(1, "agua"), (2, "agua cali"), (3, "agua agua"), (4, "luz"), (5, "via medellin")]
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE s USING fts5(comentario, ciudad, categoria_problema)")
    con.executemany("INSERT INTO s(rowid, comentario, ciudad, categoria_problema) VALUES (?,?,?,?)",
                    corpus)
    expected = {}
    for qid, text in queries:
        for rowid, score in con.execute(
                "SELECT rowid, bm25(s) FROM s WHERE s MATCH ? ORDER BY bm25(s)", (text,)):
            expected[(qid, rowid)] = -score
    docs = reports_df(spark, [report(i, ciudad=c, cat=k, comentario=t) for i, t, c, k in corpus])
    qs = spark.createDataFrame(queries, "question_id long, texto string")
    got = {(r.question_id, r.id): r.score
           for r in SE.bm25_scores(qs, TextIndex.build(docs)).collect()}
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-12), (k, got[k], v)


def test_bm25_topk_ties_by_id_and_k(spark):
    docs = reports_df(spark, [report(i, comentario="agua") for i in range(1, 12)])
    qs = spark.createDataFrame([(1, "agua")], "question_id long, texto string")
    got = [(r.rank, r.id) for r in SE.bm25_search(qs, docs, k=8).orderBy("rank").collect()]
    assert got == [(i, i) for i in range(1, 9)]


def test_search_auto_modes(spark):
    docs = reports_df(spark, [report(1, comentario="¿?, ! agua"), report(2, comentario="agua")])
    qs = spark.createDataFrame([(1, "¿?, !"), (2, "agua"), (3, "nada")],
                               "question_id long, texto string")
    got = {(r.question_id, r.id, r.used_fts) for r in SE.search_auto(qs, docs).collect()}
    assert got == {(1, 1, False), (2, 1, True), (2, 2, True)}


# --- questions -----------------------------------------------------------------------

def test_mentions_accents_and_substrings(spark):
    reps = reports_df(spark, [report(1, ciudad="Medellín"), report(2, ciudad="Bogotá"),
                              report(3, ciudad="Cali"), report(4, ciudad="")])
    qs = spark.createDataFrame([(1, "problemas en MEDELLIN"), (2, "calidad del agua"),
                                (3, "nada")], "question_id long, texto string")
    got = {(r.question_id, r.name) for r in QuestionStats(qs, reps).city_mentions().collect()}
    assert got == {(1, "Medellín"), (2, "Cali")}


def test_date_extraction_rules(spark):
    qs = spark.createDataFrame([
        (1, "reportes en 1998-2"), (2, "en marzo de 1997 y 1999"), (3, "entre 1999 y 1996"),
        (4, "mayoría de 1999"), (5, "1996-1998 cantidad"), (6, "sin fecha"), (7, "en 1997-45"),
        (8, "setiembre 2001"), (9, "x1997 y 2000")], "question_id long, texto string")
    got = {r.question_id: (r.fecha_desde, r.fecha_hasta)
           for r in parse_questions(qs).collect()}
    assert got == {
        1: ("1998-02-01", "1998-02-31"), 2: ("1997-03-01", "1997-03-31"),
        3: ("1999-01-01", "1996-12-31"), 4: ("1999-05-01", "1999-05-31"),
        5: ("1996-01-01", "1998-12-31"), 6: (None, None), 7: ("1997-45-01", "1997-45-31"),
        8: ("2001-09-01", "2001-09-31"), 9: ("2000-01-01", "2000-12-31")}


def test_stats_lines_order_and_empty_window(spark):
    reps = reports_df(spark, [report(1, ciudad="Alfa", fecha="1997-01-02"),
                              report(2, ciudad="Beta", fecha="1997-02-02", urg=0),
                              report(3, ciudad="Beta", fecha="1998-02-02")])
    qs = spark.createDataFrame([
        (1, "¿Cuantos reportes urgentes en ALFA y Beta en 1997?"),
        (2, "mes con más reportes en 2030"),
        (3, "¿qué ciudad tiene más reportes?")], "question_id long, texto string")
    got = {}
    for r in QuestionStats(qs, reps).lines().collect():
        got.setdefault(r.question_id, []).append((r.line_no, r.line))
    assert sorted(got[1]) == [(1, "Total urgentes: 1"), (2, "Total registros: 2"),
                              (3, "Ciudad: Beta; registros: 1; urgentes: 0"),
                              (4, "Ciudad: Alfa; registros: 1; urgentes: 1")]
    assert 2 not in got
    assert got[3] == [(1, "Top ciudad por registros: Beta (2)")]


# --- analysis and empty input ---------------------------------------------------------

def test_correlation_constant_column_is_null(spark):
    reps = reports_df(spark, [report(i, edad=20 + i, urg=i % 2, acc=1) for i in range(6)])
    got = {(r.var1, r.var2): r.corr for r in A.correlation_matrix(reps).collect()}
    assert got[("acceso_internet", "edad")] is None
    assert got[("edad", "edad")] == pytest.approx(1.0)


def test_empty_input(spark):
    empty = reports_df(spark, [])
    assert ST.count_reports(empty).first().cnt == 0
    assert ST.count_by_city(empty).count() == 0
    assert A.daily_series(empty).count() == 0
    assert A.crosstab_top(empty).count() == 0
    qs = spark.createDataFrame([(1, "cantidad de reportes")], "question_id long, texto string")
    assert [r.line for r in QuestionStats(qs, empty).lines().collect()] == ["Total registros: 0"]
    assert SE.bm25_search(qs, empty).count() == 0
    assert C.transform(C.mark_na(spark.createDataFrame([], RAW_SCHEMA))).count() == 0
