"""Awkward tables for the operators' tests."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, b string, component_id string, shard int, "
        "score string, lang_pred int, h string, rank int, __text string, asked int, kept string")
EXTRA = (7, "x", "y", 3, "z", 4, "h", 5, "t", 6, "k")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies, near copies, a hot line."""
    rng = random.Random(5)
    base = words(rng, 120)
    passage = words(rng, 70)
    line = "the same short line here"
    rows = [(0, base, "en"), (1, base, "en"), (1, base, "en"), (2, base.upper(), "fr"), (3, base + " tail", None), (4, None, "en"),
            (5, "", "de"), (6, "   \n\t ", "de"), (7, "one two", "en"), (8, "one  TWO", "en"), (9, "12 34 !!", "es"),
            (None, base, "en"), (None, None, None), (10, "é" * 60 + " ñandú " * 30, "es"), (11, "a" * 5000, "en"),
            (12, "ab" * 3000, "en"), (13, words(rng, 20000), "en"), (14, "x\u0000y ﻿ z w", "en"),
            (15, " ".join(base.split()[:60]) + " " + words(rng, 60), "de")]
    near = base.split()
    for k in range(20, 40):
        w = list(near)
        for at in rng.sample(range(len(w)), 3):
            w[at] = f"v{rng.randrange(10**6)}"
        rows.append((k, " ".join(w), "en"))
    for k in range(40, 60):
        rows.append((k, words(rng, 40) + "\n" + line + "\n" + words(rng, 30) + (" " + passage + " " if k % 3 == 0 else "\n") + words(rng, 50), "en"))
    return [(i, t, lang, "s", None if t is None else len(t), *EXTRA) for i, t, lang in rows]


def table(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS)


def plain(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 0, *EXTRA) for i, t in pairs], DOCS)
