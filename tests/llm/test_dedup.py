"""SimHash, substring and byte dedup against brute force."""

import hashlib
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from civiq.llm import components, simhash_dedup, substring_dedup, suffix_dedup
from civiq.llm.fm_index import prefix_classes, suffix_order

from .data import documents, texts, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BIG = (1 << 63) - 1


def slow_fingerprint(text, shingle=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_labels(rows, limit):
    """Fingerprints, and the component (a row's number) of every row."""
    fps = [slow_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return fps, [root(k) for k in range(len(rows))]


def slow_components(rows, limit):
    fps, label = slow_labels(rows, limit)
    least = {}
    for k, (i, _) in zip(label, rows, strict=True):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    return fps, [least.get(k) for k in label]


def order(rows):
    return sorted(rows, key=str)


def near(rng, rows):
    """Near copies: one word of a long text changed."""
    out = list(rows)
    long = max((t for _, t in rows if t), key=len).split()[:3000]
    for k in range(12):
        w = list(long)
        w[rng.randrange(len(w))] = f"changed{k}"
        out.append((100 + k, " ".join(w)))
    return out


def test_simhash(spark):
    import random
    rows = near(random.Random(4), texts())
    fps, comps = slow_components(rows, simhash_dedup.LIMIT)
    got = simhash_dedup.near_duplicates(documents(spark, rows)).collect()
    want = [(i, f - (1 << 64) if f >> 63 else f, c) for (i, _), f, c in zip(rows, fps, comps, strict=True)]
    assert order((r.id, r.fp, r.component) for r in got) == order(want)
    assert len(set(comps)) < len(rows) - 12


def test_simhash_hot_groups_are_sliced(spark, monkeypatch):
    rng = np.random.default_rng(5)
    center = int(rng.integers(1, 1 << 62))
    fps = sorted({center ^ sum(1 << int(b) for b in rng.choice(60, rng.integers(0, 7), replace=False)) for _ in range(300)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")

    def labels():
        found = components.connected(simhash_dedup.links(df))
        return {r.node: r.label for r in found.collect()}

    whole = labels()
    monkeypatch.setattr(simhash_dedup, "SLICE", 20)
    assert labels() == whole


@pytest.mark.parametrize("pairs", [1 << 21, 300])
def test_gray_index_links_like_brute_force(pairs, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "PAIRS_AT_ONCE", pairs)
    rng = np.random.default_rng(pairs)
    f = np.unique(np.array([int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 8), replace=False))
                            for c in rng.integers(0, 1 << 63, 6) for _ in range(60)], np.uint64))
    group = rng.integers(0, 3, len(f))
    by = np.lexsort((simhash_dedup.gray_rank(f), group))
    f, group = f[by], group[by]
    got = simhash_dedup.link(f, group)
    want = np.arange(len(f))
    close = (np.bitwise_count(f[:, None] ^ f) <= 4) & (group[:, None] == group)
    while True:
        new = np.array([want[close[i]].min() for i in range(len(f))])
        if (new == want).all():
            break
        want = new
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_simhash_keeps_one_of_each_group(spark):
    """Of every component the row with the smallest id, ids repeating or not."""
    rows = texts()
    _, label = slow_labels(rows, simhash_dedup.LIMIT)
    _, least = slow_components(rows, simhash_dedup.LIMIT)
    want = [least[k] for k in set(label)]
    kept = simhash_dedup.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    found = kept.collect()
    assert order(r.doc_id for r in found) == order(want)
    place = {}
    for k, row in zip(label, rows, strict=True):
        place.setdefault(row, k)
    assert {place[r.doc_id, r.text] for r in found} == set(label)


def test_simhash_keeps_rows_of_unrelated_texts(spark):
    """Null and repeated ids: every component keeps exactly one row."""
    import random
    rng = random.Random(8)
    a, b, c, d, e, f = (" ".join(words(rng, 60, 9000)) for _ in range(6))
    rows = [(1, a), (None, a), (None, b), (None, b), (None, c), (5, d), (5, e), (5, a), (9, f), (9, f), (None, "")]
    kept = [(r.doc_id, r.text) for r in simhash_dedup.keep_one(documents(spark, rows)).collect()]
    assert order(kept) == order([(1, a), (None, b), (None, c), (5, d), (5, e), (9, f), (None, "")])
    alone = simhash_dedup.keep_one(documents(spark, [(1, a), (None, a), (None, b)])).collect()
    assert order((r.doc_id, r.text) for r in alone) == order([(1, a), (None, b)])


def slow_windows(rows, width):
    key = lambda i: BIG if i is None else i
    first = {}
    all_words = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, all_words, strict=True):
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            first[k] = min(key(i), first.get(k, BIG))
    out = []
    for (i, _), w in zip(rows, all_words, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < key(i):
                gone[s:s + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("width,chunk,bits", [(13, 500_000, 20), (2, 50, 20), (13, 200, 6)])
def test_substring_dedup(spark, monkeypatch, width, chunk, bits):
    # few counters: everything is estimated repeated, the result stays the same
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(substring_dedup, "MIN_WIDTH_BITS", bits)
    monkeypatch.setattr(substring_dedup, "MAX_WIDTH_BITS", bits)
    out = substring_dedup.dedup_windows(documents(spark), width=width)
    got = out.select("row.doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256)).collect()
    assert order(tuple(r) for r in got) == order(slow_windows(texts(), width))


def test_sketch_is_held_once():
    # 0.5 GB of text: 64 MB of counters; a worker holds no packed blocks beside them
    assert 2 * (1 << substring_dedup.width_bits(510_000_000)) // 8 <= 64 << 20
    assert substring_dedup.width_bits(30_000_000_000) == substring_dedup.width_bits(510_000_000)
    bits, h = 20, np.random.default_rng(5).integers(0, 1 << 63, 1000).astype(np.uint64)
    blocks = []
    for row in range(substring_dedup.DEPTH):
        twice = np.zeros(1 << bits, np.uint8)
        twice[substring_dedup.cells(h[:400], row, bits)] = 1
        blocks.append((row, zlib.compress(np.packbits(twice, bitorder="little").tobytes())))
    shared = pickle.loads(pickle.dumps(substring_dedup.Estimates(blocks, bits)))
    for _ in range(2):  # two tasks of one worker
        assert shared.repeated(h)[:400].all() and not shared.repeated(h)[400:].any()
        assert not shared.blocks


def slow_bytes(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[s:s + length] for _, r in raw for s in range(len(r) - length + 1))
    out = []
    for i, r in raw:
        gone = bytearray(len(r))
        for s in range(len(r) - length + 1):
            if seen[r[s:s + length]] > 1:
                gone[s:s + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(r)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group,chunk", [(6000, 3 << 20), (0, 2000)])
def test_byte_dedup(spark, monkeypatch, group, chunk):
    # group 0: every anchor counts as frequent, its runs are counted instead
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    rows = [(i, t if t is None or len(t) < 60_000 else t[:9000] + t[-600:]) for i, t in texts()]
    out = suffix_dedup.dedup_bytes(documents(spark, rows), group=group)
    got = out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert order(tuple(r) for r in got) == order(slow_bytes(rows, suffix_dedup.LENGTH))


def test_interval_expansion_finds_all_common_prefixes():
    rng = np.random.default_rng(3)
    for t in range(60):
        s = rng.integers(1, 4, rng.integers(1, 60))
        s = np.tile(s, 3) if t % 3 == 0 else s
        length = int(rng.integers(1, 12))
        found, kind = prefix_classes(s, length)
        q = np.append(s, 0).tolist()
        assert suffix_order(np.array(q)).tolist() == sorted(range(len(q)), key=lambda i: q[i:])
        of = dict(zip(found.tolist(), kind.tolist(), strict=True))
        for i in range(len(q) - length + 1):
            for j in range(i):
                assert (of[i] == of[j]) == (q[i:i + length] == q[j:j + length])


@pytest.mark.parametrize("run", [
    lambda d: simhash_dedup.near_duplicates(d), lambda d: simhash_dedup.keep_one(d),
    lambda d: substring_dedup.dedup_windows(d), lambda d: suffix_dedup.dedup_bytes(d)])
def test_empty_table(spark, run):
    assert run(documents(spark, []).filter("false")).count() == 0
