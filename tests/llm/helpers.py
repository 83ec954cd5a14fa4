"""Small documents that hold the awkward cases: nulls, blanks, ties, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n int"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    pool = [a + b for a in "ba ke li mo nu ra se ti vo zu".split() for b in "dan fer gil hom jus".split()]
    anchors = "the of and is der la que".split()
    return " ".join(draw.choice(anchors) if draw.random() < 0.25 else draw.choice(pool) for _ in range(words))


def documents(spark, texts):
    """Frame of (id, text) pairs, or of texts numbered from 0."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "src0", None if t is None else len(t), "x", 7) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


def awkward() -> list:
    base = prose(1, 300)
    near = base.replace("badan", "kefer", 1)
    return [
        base, base, near, None, "", " \n\t ", "one two", prose(2, 120) + " é ñ 日本 😀 " + prose(3, 200),
        base[:900] + prose(4, 100), "tick " * 400, prose(5, 6000), "a", None, "x" * 5000,
    ]
