"""Quality rules, conversation repair and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civiq.llm import conversation_repair, line_quality, merkle_manifest, queries, ranks
from tests.compare import compare, duck

from .data import SCHEMA, documents, texts, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_quality_rules", "op12_conversation_repair", "op13_merkle_manifest"])
def test_query_matches_sql(spark, name):
    r = compare(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF, duck(SF))
    assert r["ok"], r


def test_ranks_cross_partitions(spark):
    """A key that spans partitions, equal rows included."""
    rows = [("hot", i % 7) for i in range(900)] + [(f"k{i % 5}", i) for i in range(60)] + [("", 1)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    out = ranks.ranked(df, "k", [F.col("v")]).collect()
    for k, n in Counter(k for k, _ in rows).items():
        own = sorted((r["rank"], r.v) for r in out if r.k == k)
        assert [a for a, _ in own] == list(range(n)) and [v for _, v in own] == sorted(v for c, v in rows if c == k)


# -- quality rules ---------------------------------------------------------

def slow_quality(rows, limit, share):
    """rows: (id, text, host). Words are counted one window and line at a time."""
    def low(line):
        return " ".join("".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(line))

    split = [(t or "").split("\n") for _, t, _ in rows]
    hosts, seen = Counter(h for *_, h in rows), Counter()
    for (_, _, h), lines in zip(rows, split, strict=True):
        seen.update({(h, low(x)) for x in lines if low(x)})
    out = []
    for (i, t, h), lines in zip(rows, split, strict=True):
        w = WORD.findall(t or "")
        full = [x for x in lines if low(x)]
        windows = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
        again = {p for j in range(len(w) - 2) if windows[tuple(w[j:j + 3])] > 1 for p in range(j, j + 3)}
        gone = [n for n, x in enumerate(lines) if low(x) and seen[h, low(x)] > limit and seen[h, low(x)] * share > hosts[h]]
        lost = sum(len(WORD.findall(lines[n])) for n in gone)
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(full) - len(set(full)), len(again), tuple(gone), lost, failed, not failed and 2 * lost <= len(w)))
    return sorted(out, key=str)


def pages():
    rng = random.Random(5)
    rows = [(i, t, f"s{k % 2}" if k % 9 else None) for k, (i, t) in enumerate(texts())]
    footer = "Copyright 2020  |  All rights\treserved & more"
    for k in range(40):
        body = "\n".join(" ".join(words(rng, rng.randrange(0, 30), 3000)) for _ in range(6))
        rows.append((100 + k, body + ("\n" + footer.upper() + "\n\n" + footer if k % 3 == 0 else ""), "s0"))
    menu = " ".join(words(rng, 70, 4000))
    rows += [(200 + k, menu + "\nown line " + str(k), "s1") for k in range(9)]
    rows += [(300, "a b c " * 40, "s1"), (301, "x# y$ " + " ".join(words(rng, 60, 9000)), "s1")]
    return rows


@pytest.mark.parametrize("limit, share", [(5, 1000), (3, 8), (10**6, 1)])
def test_quality_rules(spark, limit, share):
    rows = pages()
    full = [(i, t, "en", h, 0, 7, "r", "m", "k", "i", 5, "h", "x") for i, t, h in rows]
    out = line_quality.judge(spark.createDataFrame(full, SCHEMA).repartition(3), limit=limit, share=share)
    cols = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_lines", "removed_words", "base_failed", "kept"]
    got = sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in out.select(cols).collect()), key=str)
    want = slow_quality(rows, limit, share)
    assert got == want
    if limit == 5:
        assert any(r[6] for r in want) and any(not r[9] and not r[8] for r in want)


def test_quality_sketch_keeps_every_listed_line():
    rng = random.Random(1)
    lines = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)]
    bits, blocks = 1 << 16, {}
    for x in lines:
        at = x % bits
        held = bytearray(blocks.get(at // 32768, bytes(4096)))
        held[at % 32768 // 8] |= 1 << at % 8
        blocks[at // 32768] = bytes(held)
    maybe = line_quality.Maybe(bits, blocks)
    assert all(maybe.holds(x % (1 << 64)) for x in lines)
    assert sum(maybe.holds(rng.randrange(1 << 64)) for _ in range(2000)) < 60


def test_quality_text_without_lines(spark):
    df = spark.createDataFrame([("a\nb\n\nc", [0, 3]), ("a", []), ("", [0]), (None, [])], "t string, gone array<int>")
    assert [r[0] for r in df.select(line_quality.without_lines(F.col("t"), F.col("gone"))).collect()] == ["b\n", "a", "", None]


def test_quality_empty_table(spark):
    assert line_quality.judge(documents(spark).limit(0)).collect() == []


# -- conversation repair ---------------------------------------------------

def slow_repair(rows):
    """rows: (role, text, gone, cut) of one conversation. Every cheapest edit
    string is formed; the least one wins."""
    after = [(0, "", ()), (10, "II", (("user", ""), ("assistant", ""))), (5, "I", (("assistant", ""),)), (0, "", ())]
    for role, text, gone, cut in reversed(rows):
        found = []
        for state in range(4):
            to = (2, 2, 3, 2)[state]
            options = [(after[state][0] + 2, "D" + after[state][1], after[state][2])]
            if not gone:
                name = "user" if to == 2 else "assistant"
                options.append((after[to][0] + 1 + 5 * cut, "R" + after[to][1], ((name, text), *after[to][2])))
                keep = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}][state].get(role[:1])
                if keep:
                    options.append((after[keep][0] + 5 * cut, "K" + after[keep][1], ((role, text), *after[keep][2])))
            found.append(min(options))
        for _ in range(3):  # inserted rows before this one
            for state, to in enumerate((2, 2, 3, 2)):
                c, a, o = found[to]
                found[state] = min(found[state], (c + 5, "I" + a, (("user" if to == 2 else "assistant", ""), *o)))
        after = found
    return after[0]


def slow_reports(rows):
    """rows: (conv, turn, role, text) -> report per conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:256].encode(), r[2][:256].encode(), hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        seen, marked, faults, illegal = set(), [], Counter(), 0
        for k, (_, role, text) in enumerate(own):
            blank, again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
            cut = not blank and not again and text.rstrip(" \t\n\v\f\r")[-1] not in ".!?"
            seen.add((role, text))
            faults.update({"blank": blank, "duplicate": again and not blank, "truncated": cut})
            marked.append((role, text, blank or again, cut))
            illegal += k > 0 and own[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, made = slow_repair(marked)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def talks(seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Hello there.", "so?", "é 漢!", "cut off", " \n", "", None, f"Turn {turn}. ", "well\n\t"])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    rows += [(77, t // 2, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No!", f"Line {t}", f"Line {t}."])) for t in range(400)]
    rows += [(78, None, "user", "Same."), (78, None, "user", "Same."), (79, 5, "assistant", "x" * 300 + "a."), (79, 5, "assistant", "x" * 300 + "b.")]
    return rows


@pytest.mark.parametrize("block", [3, 512])
def test_repair(spark, block):
    """With blocks of a few rows a conversation crosses many of them."""
    rows = talks()
    want = slow_reports(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, k int, audit string").repartition(5)
    cols = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    r = conversation_repair.Repair(df, *cols, block=block)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {None if not x.k else int(x.k[1:]): tuple(x[c] for c in names) for x in r.report().collect()}
    assert got == want
    edits = {}
    for x in r.edits().orderBy("k", "step").collect():
        edits.setdefault(None if not x.k else int(x.k[1:]), []).append(x)
    assert {c: "".join(x.edit for x in e) for c, e in edits.items()} == {c: w[6] for c, w in want.items()}
    for c, e in edits.items():
        kept = "\n".join(f"{x.role}:{x.text}" for x in e if x.edit != "D")
        assert hashlib.sha256(kept.encode()).hexdigest() == want[c][7]


def test_repair_of_parts_agrees_with_whole():
    rng = random.Random(2)
    for _ in range(3000):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), "t", rng.random() < .2, rng.random() < .3) for _ in range(rng.randrange(0, 10))]
        flags = bytes({"s": 1, "u": 2, "a": 3}.get(r[0][:1], 0) | (4 if r[2] else 0) | (8 if r[3] else 0) for r in rows)
        cost, audit, _ = slow_repair(rows)
        cut, end = rng.randrange(0, len(rows) + 1), conversation_repair.end_vector()
        middle = conversation_repair.through(conversation_repair.matrix(flags[cut:]), end)
        assert conversation_repair.through(conversation_repair.matrix(flags[:cut]), middle)[0] == cost
        left, state = conversation_repair.walk(flags[:cut], 0, middle)
        right, state = conversation_repair.walk(flags[cut:], state, end)
        assert left + right + conversation_repair.finish(state) == audit


def test_damage_and_lost_conversations(spark, scratch):
    """Conversations that lose every row are returned with zeros."""
    rows = [(c, t, "user", "A? b! c.") for c in range(60) for t in range(1)] + [(None, None, None, None), (7, None, "user", "x.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{scratch}/conversations.parquet")
    hurt = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else text if kind != 2 or text is None else re.sub("[.!?]", "", text))
        hurt += [] if kind == 0 else [row, row] if kind == 3 else [row]
    want = slow_reports(hurt)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, scratch).collect()}
    assert got == {c: want.get(c, nothing) for c, *_ in rows} and nothing in got.values()


def test_repair_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    r = conversation_repair.Repair(df, *[F.col(c) for c in df.columns])
    assert r.report().collect() == [] and r.edits().collect() == []


# -- Merkle manifest -------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_tree(leaves):
    paths, own, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        up, below = [], []
        for s in range(0, len(nodes), 3):
            run = nodes[s:s + 3]
            for j in range(len(run)):
                for i in own[s + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(digest("".join(run)))
            below.append([i for part in own[s:s + 3] for i in part])
        nodes, own = up, below
    return nodes[0], paths


def slow_manifest(rows, changed):
    """rows: (id, source, lang, n_chars, text)."""
    def leaf(r):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: slow_tree([leaf(r) for r in groups[s]]) for s in names}
    root, tops = slow_tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, tops, strict=True):
        for r, path in zip(groups[s], trees[s][1], strict=True):
            node = leaf(changed(r))
            for a, b in path + above:
                node = digest(a + node + b)
            out.append((r[0], leaf(r), trees[s][0], root, digest("".join(a + b for a, b in path + above)), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest(spark, height):
    """With low subtrees a tree takes many rounds."""
    rows = [(i, ["é", "b", None, "a", "hot"][k % 5], None if k % 4 else "en", k if k % 3 else None, t) for k, (i, t) in enumerate(texts())]
    rows += [(1000 + k, "hot", "en", k, f"line {k}\nmore") for k in range(130)] + [(5, "solo", "x", 1, "\n"), (1000, "hot", "en", 0, "line 0\nmore")]
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle_manifest.leaf(*fields, F.col("text"))
    changed = F.when(F.col("doc_id") % 2 == 0, merkle_manifest.leaf(*fields, F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, id int, leaf string").repartition(5)
    out = merkle_manifest.prove(df, F.col("doc_id"), F.col("source"), leaf, changed, height=height)
    got = sorted(map(tuple, out.collect()), key=str)
    want = slow_manifest(rows, lambda r: (*r[:4], r[4].replace("\n", "")) if r[0] is not None and r[0] % 2 == 0 and r[4] is not None else r)
    assert got == want and {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 8])
def test_van_emde_boas_addresses(levels):
    """Every place once; the upper half of the levels lies in front, and every
    lower subtree in one stretch."""
    places = [merkle_manifest.addresses(levels, d) for d in range(levels)]
    assert sorted(a for p in places for a in p) == list(range(merkle_manifest.size(levels)))
    if levels > 1:
        upper = levels // 2
        assert sorted(a for p in places[:upper] for a in p) == list(range(merkle_manifest.size(upper)))
        n = merkle_manifest.size(levels - upper)
        for s in range(3**upper):
            own = sorted(a for d in range(upper, levels) for a in places[d][s * 3**(d - upper):(s + 1) * 3**(d - upper)])
            assert own == list(range(own[0], own[0] + n))


def test_manifest_empty_table(spark):
    df = documents(spark).limit(0)
    out = merkle_manifest.prove(df, F.col("doc_id"), F.col("source"), merkle_manifest.leaf(F.col("text")), F.lit(None).cast("string"))
    assert out.collect() == []
