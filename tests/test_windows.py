"""Windows of days and peak months against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from civiq.operators.questions import mention_join
from civiq.operators.windows import ends, month_blocks, peak_months, window_counts


def days_of(rng, n=300, gap=False):
    out = {}
    for _ in range(n):
        y, m = rng.randrange(1995, 2001), rng.randrange(1, 13)
        if gap and y == 1997:
            continue
        day = f"{y}-{m:02d}-{rng.randrange(1, 29):02d}"
        a, b = out.get(day, (0, 0))
        out[day] = (a + rng.randrange(1, 4), b + rng.randrange(0, 2))
    return out


def windows_of(rng, n=120):
    def end():
        return rng.choice([None, "", f"{rng.randrange(1993, 2003)}-{rng.randrange(0, 15):02d}-{rng.randrange(0, 33):02d}", f"{rng.randrange(1994, 2002)}-01-01", f"{rng.randrange(1994, 2002)}-12-31", "1997"])
    return [(f"w{i}", end(), end()) for i in range(n)] + [("whole", "1996-02-01", "1996-02-31"), ("day", "1996-02-03", "1996-02-03"), ("part", "1996-02-03", "1996-03-02")]


def inside(day, a, b):
    return (not a or day >= a) and (not b or day <= b)


def frames(spark, days, windows):
    d = spark.createDataFrame([(k, *v) for k, v in days.items()], "fecha string, n long, n_urg long")
    w = spark.createDataFrame(windows, "wkey string, a string, b string")
    return d, w.select("wkey", *(c.alias(n) for c, n in zip(ends(F.col("a"), F.col("b")), ("desde", "hasta"), strict=True)))


def test_window_counts(spark):
    rng = random.Random(1)
    days, windows = days_of(rng), windows_of(rng)
    d, w = frames(spark, {**days, "": (5, 5)}, windows)
    got = {r.wkey: (r.n, r.n_urg) for r in window_counts(d, w).collect()}
    for key, a, b in windows:
        own = [v for k, v in days.items() if inside(k, a, b)] + ([(5, 5)] if not a and not b else [])
        assert got[key] == (sum(v[0] for v in own), sum(v[1] for v in own)), (key, a, b)


@pytest.mark.parametrize("gap", [False, True])
def test_peak_months(spark, gap):
    rng = random.Random(2)
    days, windows = days_of(rng, gap=gap), windows_of(rng)
    d, w = frames(spark, days, windows)
    got = {r.wkey: (r.mes, r.n) for r in peak_months(d, w).collect()}
    for key, a, b in windows:
        months = {}
        for k, v in days.items():
            if inside(k, a, b):
                months[k[:7]] = months.get(k[:7], 0) + v[0]
        want = min(((-n, m) for m, n in months.items()), default=None)
        assert got.get(key) == (None if want is None else (want[1], -want[0])), (key, a, b)


def test_sparse_table_is_small(spark):
    months = spark.createDataFrame([(f"{y}-{m:02d}", y * m) for y in range(1990, 2000) for m in range(1, 13)], "mes string, n long")
    blocks, low, high = month_blocks(months)
    assert high - low == 119 and blocks.count() <= 120 * 7


def test_no_reports(spark):
    d = spark.createDataFrame([], "fecha string, n long, n_urg long")
    w = spark.createDataFrame([("w", "", "~")], "wkey string, desde string, hasta string")
    assert [tuple(r) for r in window_counts(d, w).collect()] == [("w", 0, 0)]
    assert peak_months(d, w).collect() == []


def test_mentions_of_short_and_odd_names(spark):
    texts = ["reportes de la paz y de san jose", "x", "", "no city here", "la paz", None, "ñandu ab", "abc abcabc"]
    names = ["la paz", "paz", "x", "ab", "abcabc", "san jose", "", "zzz", "abcd", "city"]
    qs = spark.createDataFrame(list(enumerate(texts)), "question_id long, q_norm string")
    dim = spark.createDataFrame([("city", n or "~", i, n) for i, n in enumerate(names)], "kind string, name string, n_global long, name_norm string")
    got = {(r.question_id, r.name) for r in mention_join(qs, dim).collect()}
    assert got == {(i, n or "~") for i, t in enumerate(texts) if t is not None for n in names if n in t}
