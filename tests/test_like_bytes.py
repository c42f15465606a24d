"""LIKE by windows of bytes and by one pass expressions; searches without blocks."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from civiq.operators import search as SE
from civiq.operators.index import TextIndex

TEXTS = ["", "abxab\nx", "a.b(c)[d]\\e", "ñandú 100%", "ab" * 3000, "ab" * 300 + "x", "uno dos tres cuatro", "UNO_dos", None, "😀ab😀x"]
PATTERNS = ["%", "_", "%%", "ab%x", "_ab%x_", "%x%ab%", "a.b(c)[d]\\e", "(c)[", "d_s%cu", "\\", "ñ_nd", "a_b%", "___", "dos tres cu", "_______dos", "!!", "100%", "😀_b", "_x%"]


def _like(pattern, text):
    low = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
    return re.search("(?s)" + "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in low(pattern)), low(text)) is not None


def test_like_finds_what_the_plain_expression_finds(spark):
    docs = spark.createDataFrame([(i, t, "c", None, "2024-01-01", 0) for i, t in enumerate(TEXTS)],
                                 "id long, comentario string, ciudad string, categoria_problema string, fecha_reporte string, urgente int")
    qs = spark.createDataFrame(list(enumerate(PATTERNS)), "question_id long, texto string")
    got = {(r.question_id, r.id) for r in SE.like_matches(qs, docs).collect()}
    assert got == {(q, i) for q, p in enumerate(PATTERNS) for i, t in enumerate(TEXTS) if (t is not None and _like(p, t)) or _like(p, "c")}


def test_windows_of_bytes_lie_in_one_text():
    texts = ["abcdefghij", None, "", "ñandú x", "abc", "ab"]
    is_set = np.zeros(SE.GRAM_BITS, bool)
    wanted = {int.from_bytes(g, "big", signed=True) for g in ("abc".encode(), "cdefghij".encode(), "ñandú ".encode())}
    is_set[[w % SE.GRAM_BITS for w in wanted]] = True
    want = {(i, w) for i, t in enumerate(texts) for w in wanted
            for n in (3, 8) for b in [(t or "").encode()] if any(int.from_bytes(b[j:j + n], "big", signed=True) == w for j in range(len(b) - n + 1))}
    column = pa.array(["cut off", *texts]).slice(1)
    rows, numbers = SE.gram_hits(column, [3, 8], is_set)
    assert {(r, n) for r, n in zip(rows.tolist(), numbers.tolist(), strict=True) if n in wanted} == want and len(want) == 4
    assert len(rows) == len(set(zip(rows.tolist(), numbers.tolist(), strict=True)))


def test_questions_with_a_rare_term_make_no_bounds(spark, monkeypatch):
    def refuse(*a, **kw):
        raise AssertionError("bounds were made")

    monkeypatch.setattr("civiq.operators.index.term_bounds", refuse)
    docs = spark.range(40).select("id", F.concat(F.lit("igual "), F.when(F.col("id") % 7 == 0, "siete raro").otherwise("otro")).alias("comentario"), F.lit("c").alias("ciudad"),
                                  F.lit("k").alias("categoria_problema"), F.lit("2024-01-01").alias("fecha_reporte"), F.lit(0).alias("urgente"))
    qs = spark.createDataFrame([(1, "siete igual"), (2, "siete otro"), (3, "raro"), (4, "siete nada")], "question_id long, texto string")
    got = SE.bm25_search(qs, docs, TextIndex.build(docs), 3, with_hits=False).collect()
    assert {(r.question_id, r.rank, r.id) for r in got} == {(q, n + 1, 7 * n) for q in (1, 3) for n in range(3)}
