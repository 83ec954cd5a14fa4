"""Near duplicates and repeated strings against brute force."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from siftwork.llm import neardup, repeats
from siftwork.llm.common import BATCH, BATCH_ROWS, Scratch
from siftwork.llm.components import components

from .helpers import awkward, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    low = list(range(len(texts)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = root(i), root(j)
                low[max(x, y)] = min(x, y)
    return [(i, len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def edited(text, draw, share):
    return " ".join("new%d" % draw.randrange(10**6) if draw.random() < share else w for w in text.split())


def many():
    draw = random.Random(3)
    passage = prose(99, 60)
    texts = awkward()
    for k in range(12):
        base = prose(100 + k, 150)
        texts += [base, edited(base, draw, 0.01), edited(base, draw, 0.03), edited(base, draw, 0.05)]
    hub = prose(500, 200)
    texts += [edited(hub, draw, 0.02) for _ in range(70)] + [hub] * 40
    texts += [passage + " " + prose(600 + k, 40) for k in range(70)]
    return texts


def test_components_equal_brute_force(spark):
    texts = many()
    found = neardup.near_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == brute_components(texts)


def test_one_document_of_each_group_stays_with_all_columns(spark):
    texts = many()
    docs = documents(spark, texts)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _, c, _ in brute_components(texts) if i == c]


def test_deep_paths_and_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "DEEPEST", 1)
    texts = many()
    found = neardup.near_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == brute_components(texts)


@pytest.mark.parametrize("own, shared", [(60, 28), (40, 10)])
def test_pairs_at_the_limit_inside_a_template_family(spark, own, shared):
    """A family of unlinked documents of similarity 0.6 to 0.74 with planted pairs just above 0.75."""
    draw = random.Random(own)
    template = prose(700, 180).split()

    def words(n):
        return ["own%d" % draw.randrange(10**9) for _ in range(n)]

    texts = [" ".join(template + words(own)) for _ in range(200)]
    for _ in range(80):
        common = words(shared)
        texts += [" ".join(template + common + words(own - shared)) for _ in range(2)]
    sets = [shingle_set(t) for t in texts]
    likeness = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in (0, 200)]
    assert 0.59 < likeness[0] < 0.74 and 0.75 <= likeness[1] < 0.79
    wanted = brute_components(texts)
    assert sum(not kept for *_, kept in wanted) == 80
    found = neardup.near_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == wanted


def test_full_comparison_copies_rows_by_blocks(spark, monkeypatch):
    """60 unlinked members of one path, in blocks of 30: all pairs are found, once each."""
    monkeypatch.setattr(neardup, "BLOCK", 30)
    sketch = bytearray(b"s" * neardup.SKETCH)
    rows = [(5, bytes([i]), 100, 100, sketch, bytes([i]), 60, bytes([0]), 59) for i in range(60)]
    names = "path long, node binary, n long, f long, sketch binary, comp binary, m long, main binary, others long"
    large = spark.createDataFrame(rows, names)
    found = {(bytes(a), bytes(b)) for a, b in neardup._pairs_in_full(large, 0).collect()}
    assert found == {(bytes([i]), bytes([j])) for i in range(60) for j in range(i + 1, 60)}


def test_full_comparison_returns_no_more_links_than_rows(spark, monkeypatch):
    """90 near copies on one path: links in blocks of 30 join what brute force joins."""
    monkeypatch.setattr(neardup, "BLOCK", 30)
    draw = random.Random(11)
    base = prose(700, 120)
    texts = [edited(base, draw, draw.choice((0.01, 0.02, 0.2))) for _ in range(90)]
    sketch = bytearray(b"s" * neardup.SKETCH)
    sizes = [len(shingle_set(t)) for t in texts]
    rows = [(5, bytes([i]), n, n, sketch, bytes([i]), 90, bytes([200]), 90) for i, n in enumerate(sizes)]
    names = "path long, node binary, n long, f long, sketch binary, comp binary, m long, main binary, others long"
    pairs = spark.createDataFrame([(bytearray([i]), t) for i, t in enumerate(texts)], "node binary, text string")
    found = neardup._pairs_in_full(spark.createDataFrame(rows, names), 0, pairs).collect()
    wanted = brute_components(texts)
    low = list(range(90))
    for a, b in ((bytes(a)[0], bytes(b)[0]) for a, b in found):
        low = [min(low[a], low[b]) if x in (low[a], low[b]) else x for x in low]
    assert low == [root for _, _, root, _ in wanted]
    assert 1 < len(set(low)) < 90 and len(found) < 3 * 90  # of over 900 linked pairs


def test_wide_paths_branch_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "WIDE", 8)
    levels = []
    plain = neardup._branches
    monkeypatch.setattr(neardup, "_branches", lambda wide, level: (levels.append(level), plain(wide, level))[1])
    draw = random.Random(12)
    parts = [prose(800 + k, 15) for k in range(20)]
    texts = [" ".join(parts[k] for k in sorted(draw.sample(range(20), 14))) for _ in range(60)]
    found = neardup.near_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == brute_components(texts)
    assert levels


def test_released_tables_go_in_one_write_and_kept_ones_stay(spark):
    scratch = Scratch(spark)
    numbers = scratch.store(spark.range(5))
    kept = scratch.store(spark.range(7), keep=True)
    folder = scratch.folder
    assert numbers.count() == 5
    scratch.release()
    assert spark.read.parquet(folder).count() == 0 and kept.count() == 7
    assert scratch.store(spark.range(3)).count() == 3


def test_small_batches_hold_few_rows_and_the_setting_is_put_back(spark):
    """What an executor and a worker hold of a wide frame is bounded where it is stored, not after."""

    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    was = spark.conf.get(BATCH_ROWS)
    seen = Scratch(spark, BATCH).store(spark.range(5000).coalesce(1).mapInArrow(size, "n long"))
    assert sorted(r["n"] for r in seen.collect()) == sorted([BATCH] * (5000 // BATCH) + [5000 % BATCH])
    assert spark.conf.get(BATCH_ROWS) == was


def test_operators_of_wide_rows_store_in_small_batches(spark, monkeypatch):
    made = []
    plain = Scratch.store
    monkeypatch.setattr(Scratch, "store", lambda self, *rest, **named: (made.append(self.batch), plain(self, *rest, **named))[1])
    docs = documents(spark, [prose(1, 200), prose(1, 200) + " end", prose(2, 200)])
    neardup.near_components(docs)
    repeats.without_repeats(docs)
    assert made and set(made) == {BATCH}


def test_a_passage_makes_no_pairs_of_unlike_documents(spark, monkeypatch):
    """Documents of one passage and own words, unlinked but for two: only like pairs are candidates."""
    seen = []
    plain = neardup.confirmed
    monkeypatch.setattr(neardup, "confirmed", lambda pairs, *rest: (seen.append(pairs.count()), plain(pairs, *rest))[1])
    draw = random.Random(8)
    passage = prose(900, 160).split()
    texts = [" ".join(passage + ["own%d" % draw.randrange(10**9) for _ in range(40)]) for _ in range(150)]
    texts.append(texts[70] + " end")
    found = neardup.near_components(documents(spark, texts)).collect()
    assert sorted(map(tuple, found)) == brute_components(texts)
    assert seen[-1] < 150  # of 11,325 pairs


@pytest.mark.parametrize("shape", ["path", "star", "cycle"])
def test_components_of_any_shape(spark, shape):
    ends = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 200)], "cycle": [(i, (i + 1) % 40) for i in range(40)]}
    links = spark.createDataFrame(ends[shape] + [(900, 901)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(links, Scratch(spark)).collect()}
    assert len({roots[n] for n in roots if n < 900}) == 1
    assert roots[900] == roots[901] and len(set(roots.values())) == 2


def brute_repeats(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            s = d[i : i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for i, d in enumerate(data):
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeating():
    passage, other = prose(77, 120), prose(78, 90)
    texts = awkward()[:10] + ["x" * 1500, "x" * 399, "x" * 400, "ab" * 500]
    texts += [prose(200 + k, 30) + " " + passage[: 420 + 7 * k] + " " + prose(300 + k, 30) for k in range(25)]
    texts += [prose(400, 50) + other + "ü" + other + prose(401, 20), prose(402, 10) + other[3:] + "é"]
    return texts


def hashed(rows):
    return sorted((*r[:4], hashlib.sha256(r["kept"]).hexdigest()) for r in rows)


@pytest.mark.parametrize("length", [400, 250, 61])
def test_removed_bytes_equal_brute_force(spark, length):
    texts = repeating()
    found = repeats.without_repeats(documents(spark, texts), length=length).collect()
    assert hashed(found) == brute_repeats(texts, length)


def test_kept_text_leaves_no_part_of_a_character():
    assert repeats.whole_characters("aüb".encode()[:2]) == b"a"
    assert repeats.whole_characters("aüb".encode()) == "aüb".encode()


def test_large_buckets_equal_brute_force(spark, monkeypatch):
    heavy = repeats._refine_heavy
    monkeypatch.setattr(repeats, "_refine", lambda rows, key, strings: heavy(rows, key, Scratch(spark), strings.length))
    texts = repeating()
    found = repeats.without_repeats(documents(spark, texts)).collect()
    assert hashed(found) == brute_repeats(texts)


def test_segments_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    text = prose(9, 900)
    one = [a.tolist() for a in next(repeats.anchors(text[:1399].encode()))]
    parts = list(repeats.anchors(text.encode()))
    assert len(parts) > 1 and [a.tolist() for a in parts[0]] == one
    starts = sorted(p - o for part in parts for _, p, lo, hi in zip(*map(list, part)) for o in range(lo, hi + 1))
    assert starts == list(range(len(text.encode()) - 399))


def test_repeated_rows_and_empty_tables(spark):
    base = prose(1, 200)
    found = repeats.without_repeats(documents(spark, [(1, base), (1, base), (2, None)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in found) == [(1, len(base)), (1, len(base)), (2, 0)]
    assert repeats.without_repeats(documents(spark, [])).count() == 0
    rows = neardup.near_components(documents(spark, [(1, base), (1, base), (2, None)])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (1, 1), (2, 2)]
    assert neardup.near_components(documents(spark, [])).count() == 0


def test_null_keys(spark):
    base = prose(1, 200)
    docs = documents(spark, [(None, base), (4, base), (5, prose(2, 100))])
    assert neardup.near_components(docs).count() == 3
    assert repeats.without_repeats(docs).count() == 3


def test_near_duplicates_of_repeated_and_null_keys(spark):
    """Rows that share a key are compared by their own texts, whichever comes first."""
    for swap in (False, True):
        rows = []
        for i in range(6):
            base = prose(100 + i, 120)
            pair = [(i, prose(200 + i, 120)), (i, base)]
            rows += (pair[::-1] if swap else pair) + [(50 + i, base + " end")]
        rows += [(None, prose(300, 100)), (None, prose(300, 100) + " more"), (None, prose(301, 100)), (70, None), (70, None)]
        rows += [(80, prose(302, 90))] * 3
        docs = documents(spark, rows)
        found = neardup.near_components(docs).collect()
        assert len(found) == len(rows)
        assert sorted(r["component_id"] for r in found if r["doc_id"] and 50 <= r["doc_id"] < 60) == list(range(6))
        stay = sorted(((r["doc_id"], r["text"]) for r in neardup.without_near_duplicates(docs).collect()), key=str)
        by_text = {t for _, t in stay}
        for i in range(6):
            assert prose(200 + i, 120) in by_text and prose(100 + i, 120) in by_text and prose(100 + i, 120) + " end" not in by_text
        assert sum(k is None for k, _ in stay) == 2 and prose(301, 100) in by_text
        assert stay.count((70, None)) == 2 and stay.count((80, prose(302, 90))) == 1


def test_repeat_removal_in_the_pipeline_keeps_both_texts_of_a_key(spark, tmp_path):
    shared = prose(400, 90)
    rows = [(1, prose(401, 40) + " " + shared), (1, prose(402, 60)), (2, shared + " " + prose(403, 40)), (None, prose(404, 30))]
    after = corpus_pipeline.repeated_strings(spark, documents(spark, rows), str(tmp_path)).collect()
    texts = [r["text"] for r in after]
    assert len(after) == 4 and prose(402, 60) in texts and prose(404, 30) in texts
    assert all(shared not in t for t in texts) and any(t.startswith(prose(401, 40)) for t in texts)
