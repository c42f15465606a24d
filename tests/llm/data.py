"""Small tables with every awkward row: nulls, empty and long texts, repeated
rows and ids, ties, copies, and extra columns named like the operators' own."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, row string, mark string, "
          "kept string, items string, kept_id long, hits string, ids string")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" + rng.choice(["", "é", "X", ","]) for _ in range(n)]


def texts(seed=1):
    """(doc_id, text) rows."""
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.randrange(1, 90), 5000)) for _ in range(14)]
    passage = " ".join(words(rng, 60, 9000))
    rows = list(enumerate(base))
    n = len(rows)
    rows += [(n, base[3]), (n + 1, base[3]), (n + 2, base[5] + " tail\nof words"), (n + 3, "\t" + passage + " " + base[1]),
             (n + 4, base[2] + " \n" + passage), (n + 5, passage.upper()), (n + 6, None), (n + 7, ""), (n + 8, " \n\t "), (n + 9, "!!! 123 ..."),
             (n + 10, "one"), (n + 11, "a b c"), (2, base[2]), (2, "another text under the same id " + passage), (None, base[3]), (None, None),
             (n + 12, "tick tock " * 300), (n + 13, " ".join(words(rng, 20000, 100000)) + " " + passage), (n + 14, "漢字 é ▁x 🙂 a b " * 9)]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    langs = ["en", "fr", None]
    full = [(i, t, langs[k % 3], f"s{k % 2}", None if t is None else len(t), 7, "r", "m", "k", "i", 5, "h", "x") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(4)
