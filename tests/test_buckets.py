"""Scores found in buckets of ids against scores of a plain loop."""

import math
import random
from collections import Counter

import pytest

from civiq.operators import search as SE
from civiq.operators.index import TextIndex
from civiq.session import materialize


def _docs(spark, n=700):
    rnd = random.Random(3)
    rows = [(i * 5 - 800, " ".join(rnd.choice("abcdefgh") * 2 for _ in range(rnd.choice([2, 5, 20]))), "c", "k", "2024-01-01", 0) for i in range(n)]
    rows += [rows[5], rows[5], (None, "aa bb", "c", "k", "2024-01-01", 0)]
    return materialize(spark.createDataFrame(rows, "id long, comentario string, ciudad string, categoria_problema string, fecha_reporte string, urgente int")), rows


def _want(questions, rows):
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(Counter(f"{r[1]} {r[2]} {r[3]}".split()))
    docs = {i: (sum(c, Counter()), c[0].total()) for i, c in texts.items()}
    df = Counter(t for c, _ in docs.values() for t in c)
    n, avgdl = len(rows), sum(c.total() for own in texts.values() for c in own) / len(rows)
    out = {}
    for q, text in questions:
        asked = Counter(text.split())
        for i, (tf, size) in docs.items():
            if i is not None and asked and all(t in tf for t in asked):
                out[q, i] = sum(k * max(1e-6, math.log((n - df[t] + .5) / (df[t] + .5))) * tf[t] * 2.2 / (tf[t] + 1.2 * (.25 + .75 * size / avgdl)) for t, k in asked.items())
    return out


QUESTIONS = [(1, "aa"), (2, "aa bb"), (3, "c k"), (4, "aa nada"), (5, "aa bb cc dd ee ff gg hh"), (6, "hh hh cc"), (7, "")]


@pytest.mark.parametrize("step", [SE.PAIRS_STEP if hasattr(SE, "PAIRS_STEP") else 0, 7])
def test_scores_in_buckets_are_the_scores(spark, monkeypatch, step):
    monkeypatch.setattr(SE, "PAIRS_BROADCAST_ROWS", -1)
    monkeypatch.setattr(SE, "BUCKET_DOCS", 100)
    docs, rows = _docs(spark)
    qs = spark.createDataFrame(QUESTIONS, "question_id long, texto string")
    index = TextIndex.build(docs)
    # tasks of a local session are forks of a server begun earlier: the step goes along
    whole = SE._score_bucket
    monkeypatch.setattr(SE, "_score_bucket", lambda block_ids: whole(block_ids, step))
    got = {(r.question_id, r.id): r.score for r in SE.bm25_scores(qs, index).collect()}
    want = _want(QUESTIONS, rows)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)
    terms = SE._weighted_terms(index, SE.query_terms(qs), 100)
    rare = SE._rarest(terms)
    index.block_ids = 64
    blocks = index.bounds.join(rare, "term").select("question_id", "term", "block")
    got = {(r.question_id, r.id): r.score for r in SE._scored(index, terms, 100, rare, blocks).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)


def test_candidates_of_frequent_terms_are_not_multiplied_by_terms(spark, monkeypatch):
    docs, _ = _docs(spark)
    built = TextIndex.build(docs)
    index = TextIndex(built.postings, built.terms, built.corpus, block_ids=20)
    written, write = [], SE.materialize

    def watched(df, *more):
        out = write(df, *more)
        if {"question_id", "id", "term"} <= set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(SE, "materialize", watched)
    qs = spark.createDataFrame([(3, "c k")], "question_id long, texto string")
    assert SE.bm25_search(qs, docs, index, 5, with_hits=False).count() == 5
    assert sum(written) == 0, written


def test_bounds_are_made_for_asked_terms_alone(spark):
    docs, _ = _docs(spark)
    built = TextIndex.build(docs)
    index = TextIndex(built.postings, built.terms, built.corpus, block_ids=20)
    qs = spark.createDataFrame([(3, "c k")], "question_id long, texto string")
    assert SE.bm25_search(qs, docs, index, 5, with_hits=False).count() == 5
    assert index._bounds is None
    asked = spark.createDataFrame([("aa",), ("k",), ("nada",)], "term string")
    alone = {tuple(r) for r in index.bounds_of(asked).collect()}
    assert alone == {tuple(r) for r in index.bounds.where("term IN ('aa', 'k')").collect()}
    assert alone == {tuple(r) for r in index.bounds_of(asked, few=False).collect()}
