"""Postings counted inside each document, also where rows repeat an id."""

from collections import Counter

from civiq.operators.index import postings

SCHEMA = "id long, comentario string, ciudad string, categoria_problema string"


def _whole(rows):
    out = Counter()
    for i, *texts in rows:
        tokens = [t for x in texts if x for t in x.lower().split()]
        for t in tokens:
            out[t, i, len(tokens)] += 1
    return {(*k, n) for k, n in out.items()}


def _got(df):
    rows = [(r.term, r.id, r.doc_len, r.tf) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_postings_of_distinct_ids_are_not_shuffled(spark):
    rows = [(1, "b a b", "a", None), (2, "", None, ""), (3, None, "c", "c c"), (-4, "z", "y", "z"), (None, "a b", None, None)]
    got = postings(spark.createDataFrame(rows, SCHEMA))
    assert _got(got) == _whole(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan, plan


def test_rows_that_repeat_an_id_are_counted_together(spark):
    rows = [(1, "a b a", "x", None), (1, "b b c", "x", None), (1, "a", None, None), (2, "a b", None, None),
            (None, "a b", None, None), (None, "b b", None, None), (5, None, None, None), (5, None, None, None)]
    assert _got(postings(spark.createDataFrame(rows, SCHEMA))) == _whole(rows)
