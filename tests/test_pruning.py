"""Searches that leave out blocks against searches that score everything."""

import random

from pyspark.sql import functions as F

from civiq.operators import search as SE
from civiq.operators.index import TextIndex, postings, term_bounds, term_stats
from civiq.session import materialize

K = 5


def _docs(spark, n=3000):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        words = ["de"] * (rnd.choice([1, 1, 1, 2]) if i % 50 else 9) + [rnd.choice("abcdefgh") * 2 for _ in range(rnd.choice([4, 4, 30]))]
        rows.append((i * 3 - 900, " ".join(words), "c" if i % 2 else "d", "k", "2024-01-01", i % 2))
    return materialize(spark.createDataFrame(rows, "id long, comentario string, ciudad string, categoria_problema string, fecha_reporte string, urgente int"))


def _index(docs, block_ids):
    built = TextIndex.build(docs)
    return TextIndex(built.postings, built.terms, built.corpus, block_ids=block_ids)


def _whole(questions, docs, index, where="true"):
    """The k best of all scored documents, sorted on the driver."""
    kept = {r.id for r in docs.where(where).select("id").collect()}
    by = {}
    for r in SE.bm25_scores(questions, index).collect():
        if r.id in kept:
            by.setdefault(r.question_id, []).append((-round(r.score, 9), r.id))
    return {(q, n + 1, i) for q, rows in by.items() for n, (_, i) in enumerate(sorted(rows)[:K])}


def test_pruned_top_k_is_the_whole_top_k(spark):
    docs = _docs(spark)
    index = _index(docs, 60)
    qs = spark.createDataFrame([(1, "de"), (2, "aa bb"), (3, "de de hh"), (4, "nada"), (5, ""), (6, "k"), (7, "aa bb cc dd ee ff gg hh")], "question_id long, texto string")
    got = SE.bm25_search(qs, docs, index, K, with_hits=False)
    assert {(r.question_id, r.rank, r.id) for r in got.collect()} == _whole(qs, docs, index)
    got = SE.bm25_search(qs, docs, index, K, {"urgente": 1}, with_hits=False)
    assert {(r.question_id, r.rank, r.id) for r in got.collect()} == _whole(qs, docs, index, "urgente = 1")


def test_ties_take_the_smallest_ids_of_all_blocks(spark):
    docs = spark.createDataFrame([(i, "igual", "c", "k", "2024-01-01", 0) for i in range(-500, 500)],
                                 "id long, comentario string, ciudad string, categoria_problema string, fecha_reporte string, urgente int")
    qs = spark.createDataFrame([(1, "igual")], "question_id long, texto string")
    got = SE.bm25_search(qs, docs, _index(docs, 10), K, with_hits=False)
    assert sorted(r.id for r in got.collect()) == [-500, -499, -498, -497, -496]


def test_a_stop_word_scores_a_small_part_of_its_postings(spark, monkeypatch):
    docs = _docs(spark)
    index = _index(docs, 60)
    read, whole = [], SE._scored

    def watched(index, terms, n_qt, rare, blocks=None):
        out = whole(index, terms, n_qt, rare, blocks)
        read.append(out.count())
        return out

    monkeypatch.setattr(SE, "_scored", watched)
    qs = spark.createDataFrame([(1, "de")], "question_id long, texto string")
    assert SE.bm25_search(qs, docs, index, K, with_hits=False).count() == K
    df = index.terms.where("term = 'de'").first().df
    assert df == 3000 and sum(read) < df / 3, (df, read)


def test_bounds_are_reached_and_never_passed(spark):
    docs = _docs(spark, 300)
    post, index = postings(docs), _index(docs, 30)
    rows = term_bounds(post, index.corpus, 30).collect()
    avgdl = index.corpus.first().avgdl
    want = {}
    for r in post.collect():
        c = r.tf * 2.2 / (r.tf + 1.2 * (0.25 + 0.75 * r.doc_len / avgdl))
        key = (r.term, r.id // 30)
        want[key] = max(want.get(key, 0.0), c)
    assert {(r.term, r.block) for r in rows} == set(want)
    assert all(abs(r.bound - want[r.term, r.block]) < 1e-12 for r in rows)
    assert term_stats(post).count() == index.terms.count()


def test_a_stored_index_keeps_its_bounds(spark, scratch):
    docs = _docs(spark, 200)
    TextIndex.build(docs).write(f"{scratch}/index")
    back = TextIndex.read(spark, f"{scratch}/index")
    assert back._bounds is not None
    assert back.bounds.agg(F.count(F.lit(1))).first()[0] == term_bounds(back.postings, back.corpus).count()
