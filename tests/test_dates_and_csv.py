"""Date styles voted per file, CSV split by quote parity, safe replacement."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from civiq.functions.dates import parse_date_iso
from civiq.operators import clean as C
from civiq.schema import COLUMN_RENAME_MAP
from civiq.session import materialize, replace_folder
from civiq.sources import csv as CSV
from civiq.sources.csv import read_reports_csv

# text, month first, day first
DATES = [
    ("2023-01-05", "2023-01-05", "2023-01-05"), ("2023-1-5", "2023-01-05", "2023-01-05"), ("05-01-2023", "2023-05-01", "2023-01-05"),
    ("13/02/2023", None, "2023-02-13"), ("02/13/2023", "2023-02-13", None), ("1-15-2023", "2023-01-15", None), ("20230105", "2023-01-05", "2023-01-05"),
    ("2023.01.05", "2023-01-05", "2023-01-05"), ("01/05/23", "2023-01-05", "2023-05-01"), ("01/05/99", "1999-01-05", "1999-05-01"),
    ("Jan 5, 2023", "2023-01-05", "2023-01-05"), ("5 January 2023", "2023-01-05", "2023-01-05"), ("5-JAN-2023", "2023-01-05", "2023-01-05"),
    ("September 30 2021", "2021-09-30", "2021-09-30"), ("2023-01-05 10:30 AM", "2023-01-05", "2023-01-05"), ("01/05/2023 10:30 PM", "2023-01-05", "2023-05-01"),
    ("2023-01-05T10:30:00Z", "2023-01-05", "2023-01-05"), ("2023-01-05T10:30:00+05:00", "2023-01-05", "2023-01-05"), ("2023/01/05 10:30:00.5", "2023-01-05", "2023-01-05"),
    ("2023-02-30", None, None), ("2020-13-45", None, None), ("2023-01-05 25:00", None, None), ("2023-01-05 13:30 PM", None, None), ("2023-01-05 x", None, None),
    ("x Jan 5, 2023", None, None), ("abc", None, None), ("may", None, None), ("", None, None), (None, None, None),
]


def test_date_styles(spark):
    df = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DATES)], "i int, x string")
    out = df.select("i", parse_date_iso("x").alias("m"), parse_date_iso("x", day_first=F.lit(True)).alias("d")).collect()
    assert {r.i: (r.m, r.d) for r in out} == {i: d[1:] for i, d in enumerate(DATES)}


def write(path, header, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)


def test_day_first_is_voted_per_file(spark, scratch):
    """A file's uniform column decides for its ambiguous cells; of equal votes
    the month comes first."""
    write(f"{scratch}/a.csv", ["ID", "Fecha del reporte"], [(1, "05/01/2023"), (2, "13/01/2023"), (3, "2023-03-04")])
    write(f"{scratch}/b.csv", ["Fecha del reporte", "ID"], [("05/01/2023", 4), ("01/13/2023", 5)])
    write(f"{scratch}/c.csv", ["ID", "Fecha del reporte"], [(6, "05-01-2023")])
    raw = C.with_date_style(read_reports_csv(spark, scratch))
    out = C.normalize_fecha(C.rename_columns(raw)).collect()
    assert {r.id: r.fecha_reporte for r in out} == {
        "1": "2023-01-05", "2": "2023-01-13", "3": "2023-03-04", "4": "2023-05-01", "5": "2023-01-13", "6": "2023-05-01"}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [None, 997, 5000])
def test_csv_is_split_inside_quoted_values(spark, scratch, end, split):
    """Line breaks, quotes and commas in values; splits cut anywhere."""
    rng, want = random.Random(3), []
    for f in range(2):
        header = ["ID", "Comentario", "Ciudad"][::-1 if f else 1]
        rows = []
        for i in range(400):
            text = "".join(rng.choice(["a", "é", '"', "\n", "\r\n", ",", " ", "word"]) for _ in range(rng.choice([0, 5, 40, 3000 if i % 90 == 1 else 7])))
            row = {"ID": f"{f}-{i}", "Comentario": text, "Ciudad": rng.choice(["A,b", "C\nd", "E"])}
            rows.append([row[c] for c in header])
            want.append((row["ID"], text or None, row["Ciudad"]))
        write(f"{scratch}/f{f}.csv", header, rows, end)
    out = read_reports_csv(spark, scratch, split_bytes=split)
    got = [(r.ID, r.Comentario, r.Ciudad) for r in out.orderBy("seq").collect()]
    assert got == want
    if split == 997:
        assert out.select("seq.file", "seq.block").distinct().count() >= 8


def test_csv_without_line_breaks_in_values(spark, scratch):
    write(f"{scratch}/a.csv", ["ID", "Comentario"], [(i, f"line {i}, \"quoted\"") for i in range(50)])
    got = read_reports_csv(spark, scratch, multiline=False).orderBy("seq").collect()
    assert [(r.ID, r.Comentario) for r in got] == [(str(i), f'line {i}, "quoted"') for i in range(50)]


def test_csv_folder_without_files(spark, scratch):
    out = read_reports_csv(spark, scratch)
    assert out.columns == [*COLUMN_RENAME_MAP, "seq"] and out.count() == 0
    assert C.transform(out).count() == 0


def test_failed_replacement_leaves_the_old_table(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/t")
    with pytest.raises(Exception):
        replace_folder(spark, f"{scratch}/missing", f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 3
    spark.range(5).write.parquet(f"{scratch}/new")
    replace_folder(spark, f"{scratch}/new", f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 5 and sorted(os.listdir(scratch)) == ["t"]


def test_more_rows_are_written_in_more_files(spark, monkeypatch):
    """csv_scan_split: no task sorts and writes all rows; the rows read are the same."""
    from civiq.catalog import stores

    from .conftest import SF_SMALL

    seen, read = [], stores.CSV.read_reports_csv

    def watched(spark, path, **kw):
        seen.append(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).groupBy(F.input_file_name()).count().collect())
        return read(spark, path, **kw)

    monkeypatch.setattr(stores.CSV, "read_reports_csv", watched)
    want = sorted(map(str, stores.csv_scan_split(spark, SF_SMALL).collect()))
    monkeypatch.setattr(stores, "ROWS_A_FILE", 400)
    assert sorted(map(str, stores.csv_scan_split(spark, SF_SMALL).collect())) == want
    assert len(seen[0]) == 1 and len(seen[1]) == -(-len(want) // 400)
    assert max(r["count"] for r in seen[1]) < len(want) / 2


def test_plain_lines_are_cut_in_place_and_parsed_once(spark, scratch):
    os.makedirs(f"{scratch}/plain")
    os.makedirs(f"{scratch}/both")
    plain = 'ID,Comentario\r\n1,"a, ""b"""\r\n\r\n2,c\r\n3,"d"'
    for name, text in (("plain/a.csv", plain), ("both/a.csv", plain), ("both/b.csv", 'Comentario,ID\n"e\nf",4\n,5\n')):
        with open(f"{scratch}/{name}", "w", newline="") as f:
            f.write(text)
    lines = CSV._lines(spark, f"{scratch}/plain")
    cut = CSV._records(lines, materialize(CSV._splits(lines)))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    read = CSV.read_reports_csv(spark, f"{scratch}/plain")
    assert read._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    want = [("1", 'a, "b"'), ("2", "c"), ("3", "d")]
    assert [(r.ID, r.Comentario) for r in read.orderBy("seq").collect()] == want
    for size in (None, 5, 17):
        both = CSV.read_reports_csv(spark, f"{scratch}/both", split_bytes=size).orderBy("seq").collect()
        assert [(r.ID, r.Comentario) for r in both] == [*want, ("4", "e\nf"), ("5", None)]


def test_lines_numbered_otherwise_end_the_job(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as f:
        f.write("ID\n1\n2\n")
    lines = CSV._lines(spark, scratch)
    splits = materialize(CSV._splits(lines))
    assert sorted(r.record for r in CSV._records(lines, splits).collect()) == ["1", "2"]
    shifted = [splits.withColumns({c: F.col(c) + by for c in ("first_row", "last_row")}) for by in (-1, 1)]
    for wrong in (splits.where("false"), *shifted):
        with pytest.raises(Exception, match="split anew"):
            CSV._records(lines, wrong).collect()
