"""Shards and fingerprints."""

import hashlib

from siftwork.llm import sharding, spots

from .helpers import awkward, documents, prose


def test_shards_are_even_gapless_and_keep_groups(spark):
    texts = awkward() + [prose(i // 3, 20) for i in range(900)] + ["hot text"] * 500
    rows = sharding.shard_texts(documents(spark, texts), 24).toPandas()
    assert sorted(rows.doc_id) == list(range(len(texts)))
    sizes = rows.groupby("shard").size()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    for _, group in rows.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    for r in rows.itertuples():
        assert r.size == len((texts[r.doc_id] or "").encode()) + 8
    rows["text"] = [texts[i] for i in rows.doc_id]
    split = rows.dropna(subset=["text"]).groupby("text").shard.agg(["nunique", "size"])
    # Groups of three fill shards of 58 or 59: with even counts about every second shard must split one.
    assert (split[split["size"] < 10]["nunique"] == 1).mean() > 0.95
    assert split.loc["hot text", "nunique"] <= 2 + 500 // (len(texts) // 24)


def test_all_linked_rows_take_part_in_the_rounds(spark, monkeypatch):
    texts = ["hot text"] * 500 + ["warm text"] * 130 + [prose(i // 3, 20) for i in range(300)] + [f"own {i}" for i in range(70)]
    seen = {}
    rounds = sharding.propagate

    def propagate(state, caps, *rest):
        seen.update(rows=state.count(), links=state.select("link").distinct().count(), shards=len(caps))
        out = rounds(state, caps, *rest)
        seen.update(out=out.count())
        return out

    monkeypatch.setattr(sharding, "propagate", propagate)
    rows = sharding.shard_texts(documents(spark, texts), 10).toPandas()
    assert seen == {"rows": 930, "links": 102, "shards": 10, "out": 930}
    assert rows.groupby("shard").size().tolist() == [100] * 10
    rows["text"] = [texts[i] for i in rows.doc_id]
    split = rows.groupby("text").shard.nunique()
    assert split["hot text"] == 5 and split["warm text"] <= 3


def test_a_link_that_fills_all_shards(spark):
    rows = sharding.shard_texts(documents(spark, ["hot"] * 41), 4).toPandas()
    assert sorted(rows.doc_id) == list(range(41)) and sorted(rows.groupby("shard").size()) == [10, 10, 10, 11]


def test_few_rows_repeated_rows_and_none(spark):
    rows = sharding.shard_texts(documents(spark, [(5, "a"), (5, "a"), (None, None)]), 4).toPandas()
    assert len(rows) == 3 and rows.groupby("shard").size().max() == 1
    assert sharding.shard_texts(documents(spark, []), 4).count() == 0


def brute_marks(text):
    """Signatures as strings, straight from the definition."""
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    anchors = set(spots.ANCHORS)
    out = set()
    for i, w in enumerate(words):
        if w in anchors:
            content = [j for j in range(i + 1, len(words)) if words[j] not in anchors][: spots.CHAIN]
            if len(content) == spots.CHAIN:
                out.add(" ".join(words[i : content[-1] + 1]))
        elif len(words) - i >= spots.FREE and not anchors & set(words[i : i + spots.FREE]):
            out.add(" ".join(words[i : i + spots.FREE]))
    return out or ({" ".join(words)} if words else set())


def test_fingerprints_equal_brute_force(spark):
    texts = [t for t in awkward() if not t or "😀" not in t]
    rows = spots.edited_likeness(documents(spark, texts)).toPandas().sort_values("doc_id")
    assert len(rows) == len(texts)
    for r in rows.itertuples():
        text, after = texts[r.doc_id] or "", texts[(r.doc_id + 1) % len(texts)] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert r.n_chars == len(text)
        assert hashlib.sha256(edited.encode()).digest() == hashlib.sha256(r.edited.encode()).digest()
        own, changed, other = brute_marks(text), brute_marks(edited), brute_marks(after)
        assert len(r.marks) == len(own) and len(r.edited_marks) == len(changed)
        for value, a, b in ((r.near_edited, own, changed), (r.near_next, own, other)):
            expected = len(a & b) / len(a | b) if a | b else 1.0
            if min(len(a), len(b)) < spots.LEAST * max(len(a), len(b)):
                expected = 0.0
            assert abs(value - expected) < 1e-9


def test_equal_texts_and_edges(spark):
    rows = spots.edited_likeness(documents(spark, [(3, "the same old words here"), (9, "the same old words here")])).collect()
    assert rows[0]["marks"] == rows[1]["marks"] and rows[0]["near_next"] == 1.0
    assert spots.edited_likeness(documents(spark, [(1, "only one")])).count() == 1
    assert spots.edited_likeness(documents(spark, [])).count() == 0
    repeated = spots.edited_likeness(documents(spark, [(1, "a b"), (1, "a b"), (None, "c"), (2, None)])).collect()
    assert len(repeated) == 4
