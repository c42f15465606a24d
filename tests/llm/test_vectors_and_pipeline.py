"""Nearest neighbours against brute force; the pipeline against its stages'
brute-force versions."""

import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civiq.llm import ann, decontaminate, sentencepiece_codec, simhash_dedup, substring_dedup

from .data import documents, texts
from .test_dedup import WORD, slow_components, slow_windows
from .test_text import slow_marks


def brute(vectors, k):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    out = set()
    for i, v in vectors:
        if i % 100:
            continue
        d = np.sqrt(((x - np.array(v, float))**2).sum(axis=1))
        near = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out |= {(i, r + 1, int(ids[j])) for r, j in enumerate(near)}
    return out


@pytest.mark.parametrize("n,block", [(900, 8192), (900, 50), (7, 8192)])
def test_nearest_neighbours(spark, monkeypatch, n, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, 24)) + 3 * rng.normal(size=(5, 24))[rng.integers(0, 5, n)], 2).astype(np.float32)
    x[n // 2:n // 2 + 20] = x[0]  # ties
    good = [(i, x[i].tolist()) for i in range(n)]
    bad = [(5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [None] + [1.0] * 23), (5400, [float("inf")] * 24), (5500, [1.0]), (None, x[1].tolist())]
    df = spark.createDataFrame([(i, v, "q", 1) for i, v in [*good, *bad, good[0], good[3]]], "vec_id long, embedding array<float>, center string, id int").repartition(3)
    got = ann.nearest(df, F.col("id") % 100 == 0).collect()
    want = brute(good, ann.K)
    found = {(r.query_id, r.rank, r.vec_id) for r in got}
    pairs = lambda s: {(q, v) for q, _, v in s}
    assert len(found) == len(want)
    assert len(pairs(found) & pairs(want)) >= 0.95 * len(want)
    place = dict(good)
    for r in got:
        assert r.score == pytest.approx(np.sqrt(((np.array(place[r.query_id], float) - np.array(place[r.vec_id], float))**2).sum()), abs=1e-12)
    assert ann.nearest(df.filter("false"), F.col("id") % 100 == 0).count() == 0


def test_queries_are_packed_once_in_bounded_batches(monkeypatch):
    """A query was copied for each list that it probes, all copies of up to 10,000
    queries in one batch."""
    monkeypatch.setattr(ann.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 3))
    monkeypatch.setattr(ann, "BATCH_BYTES", 1 << 18, raising=False)
    x = np.random.default_rng(2).normal(size=(5000, 32))
    shared = types.SimpleNamespace(value=(ann.Model(x, 25), np.full(25, 200)))
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(5000)), pa.array(x.tolist())], ["id", "vec"])
    out = list(ann._queries(shared, ann.K)(iter([rows])))
    ids = [np.frombuffer(i, np.int64) for b in out for i in b.column("q_ids").to_pylist()]
    assert sum(b.nbytes for b in out) < 1.2 * x.nbytes
    assert max(b.nbytes for b in out) < 2 * ann.PACK * x.shape[1] * 8
    assert max(map(len, ids)) <= ann.PACK and sorted(np.concatenate(ids).tolist()) == list(range(5000))


@pytest.mark.parametrize("dtype,offset", [(np.float32, 0), (np.float64, 1000)])
def test_blocks_keep_ties_and_all_nearer_vectors(dtype, offset):
    """Blocks met one after another give what all vectors together give, also where
    distances tie and rounding of the products is large."""
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(3000, 16)) + offset).astype(dtype).astype(float)
    x[1000:1060] = x[5]
    ids = rng.permutation(3000)
    model = ann.Model(x, 3)
    row = {"home": 0, "q_ids": ids[:90].tobytes(), "q_vecs": ann._packed(x[:90]), "probed": np.full(90, 3, np.int32).tobytes()}
    asked, near = ann.Asked(model, row), model.assign(x)
    assert len(row["q_vecs"]) == 90 * 16 * (4 if dtype == np.float32 else 8)
    for at in np.array_split(np.arange(3000), 7):
        for c in range(3):
            mine = at[near[at] == c]
            if len(mine):
                codes, length, own = ann.encode(model, x[mine], c)
                asked.meet(model, {"center": c, "ids": ids[mine].tobytes(), "vecs": ann._packed(x[mine]), "codes": codes.tobytes(), "length": length.tobytes(), "own": own.tobytes()}, ann.K)
    at, v, d = asked.top
    hits = 0
    for i in range(90):
        dist = np.sqrt(((x - x[i])**2).sum(axis=1))
        want = [j for j in np.lexsort((ids, dist)) if j != i][:ann.K]
        got = v[at == i].tolist()
        assert len(got) == ann.K
        hits += len(set(got) & set(ids[want].tolist()))
    assert hits >= 0.99 * 90 * ann.K
    assert v[at == 5].tolist() == sorted(ids[1000:1060])[:ann.K]


def test_pipeline_stages(spark, scratch):
    rows = [(i, t) for i, t in texts() if i is not None]
    seen = set()
    rows = [(i, t) for i, t in rows if not (i in seen or seen.add(i))]  # ids as in documents
    documents(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    items = [(7, rows[4][1]), (8, "tick tock")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")

    left = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    _, comps = slow_components(left, simhash_dedup.LIMIT)
    left = [(i, t) for (i, t), c in zip(left, comps, strict=True) if i == c]
    cut = {r[0]: r for r in slow_windows(left, substring_dedup.WINDOW)}
    left = [(i, t) for i, t in left if cut[i][2] == 0 or cut[i][2] < cut[i][1]]

    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, scratch))
        kept.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    third = {r.doc_id: r.text for r in kept[2].collect()}
    assert sorted(third) == sorted(i for i, _ in left)
    assert all(third[i] == t for i, t in left if cut[i][2] == 0)
    assert {i: len(WORD.findall(third[i])) for i, _ in left} == {i: cut[i][1] - cut[i][2] for i, _ in left}
    clean = sorted(r[0] for r in slow_marks(sorted(third.items()), items, decontaminate.WINDOW) if not r[2])
    assert sorted(r.doc_id for r in kept[3].collect()) == clean
    pieces = sentencepiece_codec.Pieces()
    last = kept[4].collect()
    assert sorted(r.doc_id for r in last) == clean
    assert all(r.text == third[r.doc_id] == pieces.decode(r.ids) and r.n_ids == len(r.ids) for r in last)
    again = corpus_pipeline.run(spark, scratch)
    assert sorted(map(str, again.collect())) == sorted(map(str, last))


def test_pipeline_without_language_labels(spark):
    rows = [(1, "some words"), (2, "123 !!"), (3, None), (4, "漢字"), (5, "")]
    docs = documents(spark, rows)
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    letterless = docs.withColumn("lang", F.when(F.col("doc_id") == 2, "en"))
    for table in (none, letterless):
        kept = corpus_pipeline.identify_language(spark, table, "")
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [1, 4]
