"""Language ID, SentencePiece, licences, decontamination, toxicity and language
model scores on small tables."""

import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiq.llm import attention_lm, decontaminate, language_id, license_scan, lm_scoring, sentencepiece_codec, toxicity
from civiq.llm.fm_index import FMIndex

from .data import documents, texts

EN = "the cat and the dog went to the house with a friend of the man that was there and then they saw the water"
FR = "le chat et le chien sont allés à la maison avec un ami de cet homme qui était là et puis ils ont vu de l'eau"


def slow_language(learn, text, profile):
    """Out-of-place distances by plain counting."""
    def ranked(parts):
        n = Counter()
        for t in parts:
            low = "".join(c if c.isalpha() else " " for c in (t or "").lower())
            for w in low.split():
                n.update(w)
                padded = "\x01" + w + "\x01"
                n.update(padded[i:i + k] for k in (2, 3) for i in range(len(padded) - k + 1))
        # order of packed code points: shorter first
        return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], len(x[0]), x[0]))][:profile]

    own = ranked([text])
    if not own:
        return "und", 0.0
    found = []
    for lang in sorted(learn):
        rank = {g: i for i, g in enumerate(ranked(learn[lang]))}
        found.append((sum(abs(rank[g] - i) if g in rank else profile for i, g in enumerate(own)), lang))
    off, lang = min(found)
    return lang, 1 - off / (profile * len(own))


def test_language_id(spark):
    rows = [(0, EN), (1, FR), (2, EN.upper() + " 123"), (3, None), (4, ""), (5, "123 !!"), (6, "cat"), (7, FR * 900), (None, EN), (0, FR)]
    langs = ["en", "fr", None, "en", "fr", "en", None, None, None, None]
    df = spark.createDataFrame([(i, t, g) for (i, t), g in zip(rows, langs, strict=True)], "doc_id long, text string, lang string").repartition(3)
    got = language_id.identify(df, F.col("doc_id") < 2).select("row.doc_id", "row.text", "lang_pred", "score").collect()
    want = [(i, t, *slow_language({"en": [EN], "fr": [FR]}, t, language_id.PROFILE)) for i, t in rows]
    key = lambda r: str(tuple(r)[:2])
    assert [(*r[:3], round(r[3], 12)) for r in sorted(map(tuple, got), key=key)] == [(*r[:3], round(r[3], 12)) for r in sorted(want, key=key)]
    assert language_id.identify(df, F.lit(False)).filter("lang_pred <> 'und' OR score <> 0").count() == 0
    assert language_id.identify(df.filter("false"), F.lit(True)).count() == 0


def test_grams_in_pieces(monkeypatch):
    text = " ".join(f"mot{i} é{i}z" for i in range(300))
    whole = language_id.counted(list(language_id.grams(text)))
    monkeypatch.setattr(language_id, "PIECE", 37)
    parts = language_id.counted(list(language_id.grams(text)))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def plain_viterbi(word, pieces):
    best, back = [0.0], [0]
    for j in range(1, len(word) + 1):
        options = [(-(best[i] + pieces.scores[pieces.ids[word[i:j]]]), i) for i in range(j) if word[i:j] in pieces.ids]
        if word[j - 1] not in pieces.ids:
            options.append((-(best[j - 1] + pieces.unknown), j - 1))
        score, i = min(options)
        best.append(-score)
        back.append(i)
    out, j = [], len(word)
    while j:
        part = word[back[j]:j]
        out[:0] = [pieces.ids[part]] if part in pieces.ids else [pieces.byte[v] for v in part.encode()]
        j = back[j]
    return out


def test_sentencepiece(spark):
    pieces = sentencepiece_codec.Pieces()
    rows = texts() + [(90, " "), (91, "  a  \n\n b"), (92, "▁"), (93, "\x00 \x7f")]
    ids = sentencepiece_codec.encode(documents(spark, rows)).select("row.doc_id", "row.text", "ids")
    back = sentencepiece_codec.decode(ids).select("row.*", "decoded").collect()
    assert len(back) == len(rows)
    for r in back:
        assert r.decoded == r.text
        assert (r.ids is None) == (r.text is None)
        if r.text is not None and len(r.text) < 9000:
            assert r.ids == (plain_viterbi(" " + r.text, pieces) if r.text else [])
    assert sentencepiece_codec.encode(documents(spark).filter("false")).count() == 0


def test_decoding_gathers_bytes_of_many_texts_at_once(monkeypatch):
    pieces = sentencepiece_codec.Pieces()
    rng = np.random.default_rng(4)
    rows = [rng.integers(0, len(pieces.raw), n).tolist() for n in rng.integers(0, 30, 300)]
    rows += [[pieces.ids[" "]], [pieces.ids[" "]] * 3, [pieces.byte[0xC3]], [pieces.byte[0x20], pieces.byte[0xC3], pieces.byte[0xB1]], []]
    for step in (7, 1 << 18):
        monkeypatch.setattr(sentencepiece_codec, "DECODE_STEP", step)
        flat, counts = np.array([i for r in rows for i in r], np.int32), np.array([len(r) for r in rows], np.int32)
        assert list(pieces.decode_all(flat, counts)) == [pieces.decode(r) for r in rows]
    assert list(pieces.decode_all(np.zeros(0, np.int32), np.zeros(2, np.int32))) == ["", ""]


def test_segmentation_is_the_library_lattice_best():
    import sentencepiece
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    with open(sentencepiece_codec.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # the same pieces and scores as a unigram lattice
    lattice = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.Pieces())
    for word in ["the", "hested", "thtionner", "ouièan", "international"]:
        assert encoder.encode([word])[0].as_py() == lattice.nbest_encode(word, nbest_size=2)[0]


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(60):
        s = rng.integers(1, 4, rng.integers(1, 60))
        index = FMIndex(s)
        for n in (1, 2, 5):
            p = rng.integers(1, 4, (8, n))
            p = p[(p < len(index.less)).all(axis=1)]
            for q, a, b in zip(p, *index.search(p), strict=True):
                want = [i for i in range(len(s) - n + 1) if (s[i:i + n] == q).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def slow_marks(rows, items, window):
    def split(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    phrases = {}
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for i, t in rows:
        w, found = split(t), set()
        hit = [False] * len(w)
        for n in {len(p) for p in phrases}:
            for s in range(len(w) - n + 1):
                owners = phrases.get(tuple(w[s:s + n]))
                if owners:
                    found |= owners
                    hit[s:s + n] = [True] * n
        out.append((i, len(w), sum(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rows = texts()
    passage = rows[19][1]
    items = [(7, passage), (11, "tick, tock"), (5, None), (6, " ... "), (None, rows[0][1]), (7, rows[1][1]), (3, "One"), (4, rows[4][1][:200] + " altered end"), (12, "TICK tock")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.mark(documents(spark), bench).select("row.doc_id", "n_words", "n_hit", "items").collect()
    want = slow_marks(rows, items, decontaminate.WINDOW)
    assert sorted(map(str, ((r[0], r[1], r[2], list(r[3])) for r in got))) == sorted(map(str, want))
    assert decontaminate.mark(documents(spark), bench.filter("false")).filter("n_hit > 0").count() == 0
    assert decontaminate.mark(documents(spark).filter("false"), bench).count() == 0


def slow_licences(text, threshold):
    words = license_scan.normalised(text)
    grams = license_scan.bigrams(words)
    best = 0.0
    for parts in license_scan.TEMPLATES.values():
        for t in parts:
            bag = license_scan.bigrams(license_scan.normalised(t))
            w = min(len(bag), len(grams))
            for p in range(len(grams) - w + 1 if w else 0):
                best = max(best, license_scan.dice(bag, grams[p:p + w]))
    return best if best >= threshold else 0.0


def test_license_scan(spark):
    t = license_scan.TEMPLATES
    rows = [(0, "Some text.\nReleased under the MIT License.\nMore text"), (1, t["MIT"][1]), (2, t["MIT"][1].replace("Software", "Program", 1).upper()),
            (3, "Copyright (c) 2020 X\n" + t["ISC"][0]), (4, None), (5, ""), (6, "MIT"), (7, "word " * 5000 + t["Apache-2.0"][1]), (8, "the license is not here"),
            (9, t["GPL-3.0"][0] + " " + t["GPL-3.0"][0]), (None, t["CC-BY-NC-4.0"][0])]
    got = {r.doc_id: r for r in license_scan.scan(documents(spark, rows)).select("row.doc_id", "licenses").collect()}
    names = {i: [x.license for x in r.licenses] for i, r in got.items()}
    assert names == {0: ["MIT"], 1: ["MIT"], 2: ["MIT"], 3: ["ISC"], 4: [], 5: [], 6: [], 7: ["Apache-2.0"], 8: [], 9: ["GPL-3.0"] * 2, None: ["CC-BY-NC-4.0"]}
    for i, text in rows:
        assert max((x.dice for x in got[i].licenses), default=0.0) == pytest.approx(slow_licences(text, license_scan.THRESHOLD))


def test_toxicity(spark):
    import random
    rng = random.Random(3)
    insults, plain = ["idiot", "worthless", "grobnik", "blarfen"], [f"word{i}" for i in range(300)]
    rows = []
    for i in range(500):
        w = [rng.choice(plain) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(5):
                w[rng.randrange(60)] = rng.choice(insults)
        rows.append((i, " ".join(w), int(toxic)))
    docs = documents(spark, [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "blarfen " * 20000), (0, "another"), (None, "text")])
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(1, None), (2, 5), (None, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = toxicity.score(docs, labels, ~held).collect()
    assert len(got) == 505 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r.score for r in got if r.doc_id}
    out = [(by[i], x) for i, _, x in rows if i and zlib.crc32(str(i).encode()) % 5 == 0]
    assert min(s for s, x in out if x) > max(s for s, x in out if not x)
    assert by[902] > 0.5 and by[901] < 0.5 and by[900] == by[901]
    nothing = toxicity.score(docs, labels.filter("false"), ~held).collect()
    assert len(nothing) == 505
    assert toxicity.score(docs.filter("false"), labels, ~held).count() == 0


def all_widths(templates, text, threshold):
    """Places by trying every window of every width."""
    words = license_scan.normalised(text)
    grams, found = license_scan.bigrams(words), []
    for name, parts in templates.items():
        for t in parts:
            bag = license_scan.bigrams(license_scan.normalised(t))
            for p in range(len(grams)):
                for q in range(p + 1, len(grams) + 1):
                    value = license_scan.dice(bag, grams[p:q])
                    if value >= threshold:
                        found.append((name, value, p, q + 1))
    kept = []
    for f in sorted(found, key=lambda f: (-f[1], f[2] - f[3], f[2], f[0])):
        if all(f[3] <= k[2] or f[2] >= k[3] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[2])


def test_license_windows_of_all_widths():
    import random
    rng = random.Random(9)
    longer = license_scan.TEMPLATES["ISC"][0].split()
    longer[15:15] = [f"inserted{i}" for i in range(10)]
    found = license_scan.Scanner({"ISC": license_scan.TEMPLATES["ISC"][:1]}).scan("a b c " + " ".join(longer) + " d e")
    assert [(f[0], f[2], f[3]) for f in found] == [("ISC", 3, 3 + len(license_scan.normalised(" ".join(longer))))] and found[0][1] > 0.8
    for _ in range(60):
        templates = {n: [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(4, 14)))] for n in "XYZ"}
        text = [rng.choice("abcdefgh") for _ in range(12)]
        for t in (templates["X"][0], templates["Y"][0], templates["X"][0]):
            w = t.split()
            w[rng.randrange(len(w)):0] = rng.choices("ghab", k=rng.randrange(3))
            text += w[rng.randrange(2):] + rng.choices("abgh", k=rng.randrange(4))
        got = license_scan.Scanner(templates).scan(" ".join(text))
        want = all_widths(templates, " ".join(text), license_scan.THRESHOLD)
        assert [(f[0], round(f[1], 12), f[2], f[3]) for f in got] == [(f[0], round(f[1], 12), f[2], f[3]) for f in want]


@pytest.mark.parametrize("text, want", [
    ("Licensed under the MIT License", ["MIT"]), ("This project is licensed under the MIT license, see LICENSE.", ["MIT"]),
    ("Distributed under the ISC License", ["ISC"]), ("Released under the BSD 2-Clause License", ["BSD-2-Clause"]), ("licensed under the BSD 3-Clause license", ["BSD-3-Clause"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]), ("Licensed under the GNU Affero General Public License, version 3", ["AGPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 1.", ["GPL-1.0"]), ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ["CC-BY-ND-4.0"]), ("licensed under CC BY-NC-SA 4.0", ["CC-BY-NC-SA-4.0"]),
    ("This project is licensed under the Foo License", []), ("the general public license of the house", []),
])
def test_license_wordings(text, want):
    assert [f[0] for f in license_scan.Scanner().scan("some words before. " + text + "\nand more after")] == want


def test_whole_licenses():
    scanner = license_scan.Scanner()
    for name, text in license_scan.WHOLE.items():
        assert [f[0] for f in scanner.scan("before it " + text)] == [name]
    two = license_scan.TEMPLATES["BSD-2-Clause"][1]
    assert [f[0] for f in scanner.scan(two)] == ["BSD-2-Clause"]
    assert [f[0] for f in scanner.scan(license_scan.TEMPLATES["BSD-3-Clause"][1])] == ["BSD-3-Clause"]
    assert [f[0] for f in scanner.scan(license_scan.TEMPLATES["0BSD"][-1])] == ["0BSD"]


def toxic_rows(n, seed=6):
    """(id, text, toxic): every third text has words of several lexicons."""
    import random
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"word{rng.randrange(300)}" for _ in range(60)]
        if i % 3 == 0:
            for k in ("idiot", "pathetic", "scum", "idiot"):
                w[rng.randrange(60)] = k
        elif i % 10 == 1:
            w[0] = "kill"
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    return rows


@pytest.mark.parametrize("given", [(), (0,), (1,)])
def test_toxicity_without_labels_of_both_classes(spark, given):
    rows = toxic_rows(240)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if x in given and i % 2], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, [(i, t) for i, t, _ in rows]), labels, F.col("doc_id") % 5 != 0).collect()}
    assert min(got[i] for i, _, x in rows if x) > max(got[i] for i, _, x in rows if not x)


def test_toxicity_classifier_is_fitted_on_posteriors(spark, monkeypatch):
    """Of all learning rows, labelled or not; its targets are the model's."""
    seen = {}

    def posterior(self, patterns, real=toxicity.LabelModel.posterior):
        seen["post"] = real(self, patterns)
        return seen["post"]

    def fit(rows, target, width, real=toxicity.fit_linear):
        seen["fit"] = target
        return real(rows, target, width)

    monkeypatch.setattr(toxicity.LabelModel, "posterior", posterior)
    monkeypatch.setattr(toxicity, "fit_linear", fit)
    rows = toxic_rows(240)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i % 4 == 0], "doc_id long, toxic int")
    toxicity.score(documents(spark, [(i, t) for i, t, _ in rows]), labels, F.col("doc_id") % 5 != 0).count()
    assert len(seen["fit"]) == 192 and (seen["fit"] == seen["post"]).all()


def test_toxicity_mines_all_labels(spark, monkeypatch):
    """The bound of the classifier's sample does not bound mining or the EM."""
    seen = {}

    def mine(labelled, real=toxicity.mine):
        seen["mined"] = labelled.count()
        return real(labelled)

    def init(self, patterns, label, counts, voters, real=toxicity.LabelModel.__init__):
        seen["known"] = counts[label >= 0].sum()
        real(self, patterns, label, counts, voters)

    monkeypatch.setattr(toxicity, "mine", mine)
    monkeypatch.setattr(toxicity.LabelModel, "__init__", init)
    monkeypatch.setattr(toxicity, "FITTED", 20)
    rows = toxic_rows(240)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i % 4], "doc_id long, toxic int")
    got = toxicity.score(documents(spark, [(i, t) for i, t, _ in rows]), labels, F.col("doc_id") % 5 != 0)
    assert got.count() == 240
    assert seen == {"mined": 144, "known": 144}


def test_label_model_learns_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(20000) < 0.2
    votes = np.stack([np.where(y, rng.random(20000) < a, rng.random(20000) < b) for a, b in ((0.9, 0.02), (0.6, 0.05), (0.5, 0.3))] , axis=1)
    votes = np.concatenate([votes, votes[:, 1:2]], axis=1)  # a voter that repeats another
    bits = (votes.astype(int) << np.arange(4)).sum(axis=1)
    label = np.where(np.arange(20000) % 10 == 0, y, -1)
    rows, counts = np.unique(np.stack([bits, label], axis=1), axis=0, return_counts=True)
    model = toxicity.LabelModel(rows[:, 0], rows[:, 1], counts.astype(float), 4)
    post = model.posterior(bits)
    assert abs(model.prior[1] - 0.2) < 0.03
    assert model.parent[3] == 1 or model.parent[1] == 3
    assert ((post > 0.5) == y).mean() > 0.94


def test_windows_score_each_token_once():
    lens = np.array([1, 24, 25, 200, 3])
    tokens = np.arange(lens.sum()) + 5
    inputs, targets, text = attention_lm.windows(tokens, lens, 1)
    assert targets[targets >= 0].tolist() == tokens.tolist()
    first = np.cumsum(lens) - lens
    for w, t, d in zip(inputs, targets, text, strict=True):
        for k in np.flatnonzero(t >= 0):
            at = k + attention_lm.CONTEXT - attention_lm.STRIDE
            before = t[k] - 1
            assert w[at] == (1 if t[k] == tokens[first[d]] else before)
            seen = w[:at + 1][w[:at + 1] >= 0]
            assert len(seen) >= min(attention_lm.CONTEXT - attention_lm.STRIDE, t[k] - tokens[first[d]] + 1)


def test_attention_gradients_and_causality():
    rng = np.random.default_rng(0)
    net = attention_lm.Attention(rng.integers(1, 50, 70))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    tokens, lens = rng.integers(0, 70, 130), np.array([30, 100])
    inputs, targets, _ = attention_lm.windows(tokens, lens, 3)
    g, _ = net.gradients(inputs, targets)
    for name in net.p:
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        keep, e = net.p[name][i], 1e-5
        net.p[name][i] = keep + e
        up = net.gradients(inputs, targets)[1]
        net.p[name][i] = keep - e
        down = net.gradients(inputs, targets)[1]
        net.p[name][i] = keep
        assert g[name][i] == pytest.approx((up - down) / (2 * e), rel=1e-3, abs=1e-7)
    scores = net.log_probs(inputs, targets)[0]
    later = inputs.copy()
    later[:, -1] = np.where(later[:, -1] >= 0, (later[:, -1] + 1) % 70, -1)
    assert np.allclose(net.log_probs(later, targets)[0][:, :-1], scores[:, :-1])


def test_lm_words_are_encoded_together_as_alone():
    import tiktoken

    subwords = lm_scoring.Subwords()
    encoding = tiktoken.Encoding("alone", pat_str=lm_scoring.PATTERN, mergeable_ranks=subwords.ranks, special_tokens={})
    rng = np.random.default_rng(8)
    letters = ["a", "B", "1", "23", "'s", "'", "!?", "\u00e9", "\u6f22", "\u00a0", "\u2003", "\u0085", "\x1c", "\u3000", "\U0001f600", "ll"]
    words = ["".join(rng.choice(letters, rng.integers(1, 6))).encode() for _ in range(3000)] + [b"x" * 5000, "\u00a0".encode()]
    for some in (words, words[:1], [w for w in words if w.isascii()], ["\u00a0".encode()], []):
        flat, start, size = subwords.lists(some)
        assert [flat[s:s + n].tolist() for s, n in zip(start, size, strict=True)] == [encoding.encode_ordinary(" " + w.decode()) for w in some]


def slow_id_scores(model, ids):
    """Log probability of each id, and of a word beginning there: one window and
    one place at a time, every output summed in full."""
    net, p, lead = model.network, model.network.p, attention_lm.CONTEXT - attention_lm.STRIDE
    tokens = [model.end, *model.number[ids].tolist()]
    out = []
    for t in range(len(ids)):
        start = t // attention_lm.STRIDE * attention_lm.STRIDE - lead  # place of the window's first input
        seen = [(i, tokens[start + i]) for i in range(attention_lm.CONTEXT) if 0 <= start + i <= t]
        x = np.array([p["embed"][token] + p["place"][i] for i, token in seen], np.float64)
        q, k, v = x[-1] @ p["q"], x @ p["k"], x @ p["v"]
        weight = np.exp(k @ q / np.sqrt(attention_lm.WIDTH))
        h = x[-1] + (weight / weight.sum()) @ v @ p["o"]
        h = h + np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"]
        classes = np.exp(h @ p["c"] + p["cb"])
        inside = np.exp(np.einsum("d,cdk->ck", h, p["u"]) + p["ub"])
        every = (classes / classes.sum())[:, None] * inside / inside.sum(axis=1)[:, None]
        assert every.sum() == pytest.approx(1)
        own = int(model.number[ids[t]])
        out.append((np.log(every.ravel()[own]) + model.share[ids[t]], np.log(every.ravel()[:model.first_classes * attention_lm.CLASS].sum())))
    return np.array(out)


def small_model():
    rng = np.random.default_rng(4)
    counts = np.array([50, 30, 9, 2, 1, 40, 8, 3, 1, 1, 20])  # ids 0-4 begin a word, 5-9 go on, 10 ends
    model = lm_scoring.Model(counts, 10, np.arange(11) % 10 < 5)
    for name in ("q", "k", "v", "o", "w2", "c"):
        model.network.p[name] = (model.network.p[name] + rng.normal(0, 0.3, model.network.p[name].shape)).astype(np.float32)
    return model


def test_lm_ids_against_a_slow_scorer(monkeypatch):
    monkeypatch.setattr(lm_scoring, "MODELLED", 7)
    model, rng = small_model(), np.random.default_rng(5)
    texts_ = [np.append(rng.integers(0, 10, n), 10) for n in (0, 1, 23, 24, 25, 70)]
    own, begin = model.id_scores(np.concatenate(texts_), np.array([len(t) for t in texts_]))
    slow = np.concatenate([slow_id_scores(model, t) for t in texts_])
    assert np.allclose(own, slow[:, 0], atol=1e-4) and np.allclose(begin, slow[:, 1], atol=1e-4)


def test_lm_mass_of_all_words_is_one(monkeypatch):
    """All words of up to four ids behind a text's beginning, and the end."""
    monkeypatch.setattr(lm_scoring, "MODELLED", 7)
    model = small_model()
    for prefix in ([], [[0, 5]], [[1], [0, 6, 5], [2]]):
        words = [[b, *rest] for n in range(4) for rest in product(range(5, 10), repeat=n) for b in range(5)]
        mass, tail = 0.0, 0.0
        for w in [*words, None]:
            whole = [*prefix, *([w] if w else [])]
            ids = np.array([t for x in whole for t in x] + [10])
            length = np.array([*map(len, whole), 1])
            word = np.array([True] * len(whole) + [False])
            scores = model.word_scores(ids, np.array([len(ids)]), length, word)
            own = float(np.exp(scores[len(prefix)]))
            mass += own
            if w and len(w) == 4:  # what goes on behind four ids
                begin = model.id_scores(ids, np.array([len(ids)]))[1][-1]
                tail += own * (np.exp(-begin) - 1)
        assert mass <= 1 + 1e-4 and mass + tail == pytest.approx(1, abs=1e-3)


def test_lm_learns_from_long_texts_and_rows_without_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm_scoring.Model, "train", lambda self, texts, steps: seen.append((len(texts), sum(map(len, texts)), steps)))
    long = " ".join(f"word{i}" for i in range(30_000))
    lm_scoring.score(documents(spark, [(None, long), (None, "a b"), (None, "c")]), F.lit(False)).count()
    (n, size, _), = seen
    assert n == -(-len(long) // lm_scoring.PIECE) + 2 and size > 30_000


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_WORDS", 3000)
    rows = [(i, t if t is None or len(t) < 50_000 else t[:20_000]) for i, t in texts()]
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    got = lm_scoring.score(documents(spark, rows), held, steps=5).collect()
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    split = lambda t: (t or "").encode().lower().split()
    counts = Counter(w for i, t in rows if not is_held(i) for w in split(t))
    ends = sum(not is_held(i) for i, _ in rows)
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    want = []
    for i, t in rows:
        c = [counts[w] for w in split(t)] + [ends]
        want.append((i, is_held(i), len(c), sum(n > 0 for n in c), total, round(sum(np.log10((n + 1) / (total + distinct + 1)) for n in c), 6)))
    assert sorted(str((r[0], r[1], r[2], r[3], r[4], round(r[5], 6))) for r in got) == sorted(str((*w[:5], float(w[5]))) for w in want)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scoring.score(documents(spark).filter("false"), held, steps=5).count() == 0
    alone = lm_scoring.score(documents(spark, rows[:3]), F.lit(True), steps=5).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in alone)


def test_the_network_learns_from_every_piece(spark, monkeypatch):
    """More pieces than the driver takes: tasks learn from all of them."""
    seen, fit = [], lm_scoring.fit_all

    def watched(pieces, subwords, model):
        before = model.network.weights()
        seen.append((pieces.count(), fit(pieces, subwords, model), before, model.network.weights()))
        return seen[-1][1]

    monkeypatch.setattr(lm_scoring, "fit_all", watched)
    monkeypatch.setattr(lm_scoring, "SAMPLE", 4)
    monkeypatch.setattr(lm_scoring, "PIECE", 40)
    rows = [(i, f"word{i % 7} and more words of text {i} " * (1 + i % 9)) for i in range(60)] + [(61, None), (62, "")]
    got = lm_scoring.score(documents(spark, rows), F.col("doc_id") % 10 == 3, steps=3).collect()
    assert len(got) == len(rows) and np.isfinite([r["score"] for r in got]).all()
    texts = [t[s:s + 40] for i, t in rows if t and i % 10 != 3 for s in range(0, len(t), 40)]
    subwords = lm_scoring.Subwords()
    windows = sum(-(-len(lm_scoring._piece_ids(subwords, t)) // attention_lm.STRIDE) for t in texts)
    (pieces, learned, before, after), = seen
    assert (pieces, learned) == (len(texts), windows)
    assert np.isfinite(after).all() and not np.array_equal(before, after)


def test_sentencepiece_steps_and_cache_change_no_ids_and_decoding_ships_bytes_alone(monkeypatch):
    import pickle

    from civiq.llm import sentencepiece_codec as codec

    pieces = codec.Pieces()
    texts = ["der Hund the the  dog", None, "", "a\nb ▁ ☃ the dog"] * 3
    want = codec.Encoder(pieces).encode(texts)
    monkeypatch.setattr(codec, "ENCODE_STEP", 3)
    monkeypatch.setattr(codec, "CACHE", 4)
    assert codec.Encoder(pieces).encode(texts).equals(want)
    sent = pickle.dumps(pieces.bytes)
    assert len(sent) < len(pickle.dumps(pieces)) / 2
    ids = want.flatten().to_numpy()
    counts = [0 if x is None else len(x) for x in want.to_pylist()]
    assert list(pickle.loads(sent).decode_all(ids, counts)) == [t or "" for t in texts]
