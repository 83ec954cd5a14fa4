"""Periodic runs, clustering and chat formatting against brute force and exact round trips."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from siftwork.llm import centroids, chats, periods, queries

from .helpers import awkward, documents, prose


def brute_runs(words):
    """(start, length, period) straight from the definition."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                part = words[i : i + length]
                if not any(part[k:] == part[:-k] for k in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def fibonacci(steps):
    a, b = ["x"], ["x", "y"]
    for _ in range(steps):
        a, b = b, b + a
    return b


def word_lists():
    draw = random.Random(3)
    yield from ([], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 300, ["a", "b"] * 100, fibonacci(8), (["a"] * 10 + ["b"]) * 9)
    for _ in range(150):
        pool = draw.choice([1, 2, 3, 40])
        words = [str(draw.randrange(pool)) for _ in range(draw.choice([0, 20, 120]))]
        for _ in range(draw.randrange(1, 4)):
            unit = [str(draw.randrange(pool)) for _ in range(draw.choice([1, 2, 5, 9, 25]))]
            unit = unit * 3 + ["z"] if draw.random() < 0.4 else unit
            at = draw.randrange(len(words) + 1)
            words[at:at] = (unit * 90)[: draw.randrange(10, 120)]
        yield words


def test_runs_equal_brute_force():
    lists = list(word_lists())
    runs, rest = periods.runs_and_rest([" ".join(w).encode() for w in lists])
    for words, found, kept in zip(lists, runs, rest):
        expected = brute_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in found] == expected
        gone = {i for s, length, q in expected for i in range(s + q, s + length)}
        assert kept.decode().split() == [w for i, w in enumerate(words) if i not in gone]


def test_grammar_derives_the_text_and_repeats_no_pair():
    words = np.array([0, 1, 2] * 20 + [3, 4] * 5 + [0, 0, 0, 0, 0], dtype=np.int64)
    rules, places, top = periods.grammar(words.copy(), np.zeros(len(words), dtype=np.int64))
    for rule, begin in places.tolist():
        low, mid, high = rules[rule]
        assert low < mid < high and (words[low:high] == words[begin : begin + high - low]).all()
    begins = np.flatnonzero(top).tolist() + [len(words)]
    symbols = [tuple(words[a:b]) for a, b in zip(begins, begins[1:])]
    pairs = list(zip(symbols, symbols[1:]))
    assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)


def test_equal_hashes_of_unequal_words_are_caught(monkeypatch):
    monkeypatch.setattr(periods._Words, "equal", lambda self, at, shift, length: np.ones(len(at), dtype=bool))
    words = [str(i) for i in range(20)] + ["p", "q"] * 15 + [str(i) for i in range(20)]
    runs, _ = periods.runs_and_rest([" ".join(words).encode()])
    assert [(r["start"], r["length"], r["period"]) for r in runs[0]] == [(20, 30, 2)]


def test_op11_on_awkward_documents(spark, tmp_path):
    texts = awkward() + ["tick tock " * 40, prose(9, 30) + " " + "é 日本 ö " * 20] + [prose(i, 60) for i in range(40)]
    documents(spark, [*enumerate(texts), (3, "again"), (None, "lost " * 30)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 2
    by_key = {r.doc_id: r for r in rows if r.doc_id != 3}
    assert by_key[None].n_runs == 1
    for key, text in enumerate(texts):
        if key == 3:
            continue
        words, h = (text or "").encode().split(), zlib.crc32(str(key).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, r = brute_runs(words), by_key[key]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)


def test_runs_of_no_rows_and_clashing_names(spark):
    assert periods.with_runs(documents(spark, [])).count() == 0
    clashing = documents(spark, ["a b " * 20]).withColumnRenamed("kept", "runs")
    row = periods.with_runs(clashing).first()
    assert row.runs[0].length == 40 and row.collapsed == "a b" and row.n == 7


def lloyd_by_hand(rows, k, rounds):
    rows = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(object)) for i, v in rows]
    first = sorted(rows, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), list(r[1])))
    centres = [v for _, v in first[:k]]

    def nearest(v):
        distances = [int(((v - c) ** 2).sum()) for c in centres]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        labels = [nearest(v)[0] for _, v in rows]
        for j in range(len(centres)):
            own = [v for (_, v), label in zip(rows, labels) if label == j]
            if own:
                centres[j] = np.array([int(sum(c)) // len(own) for c in zip(*own)], dtype=object)
    return [(i, *nearest(v)) for i, v in rows], centres


VECTORS = "vec_id long, embedding array<float>, cluster string, label int"


@pytest.mark.parametrize("scale_of", [1.0, 300.0])
def test_clusters_equal_plain_rounds(spark, scale_of):
    draw = np.random.default_rng(4)
    rows = [(i, (scale_of * draw.normal(size=64)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(7, rows[7][1]), (None, rows[3][1])]
    odd = [(1, None), (2, []), (3, rows[0][1][:63]), (4, rows[0][1] + [0.0])]
    odd += [(5, [None] + rows[0][1][1:]), (6, [float("nan")] + rows[0][1][1:]), (8, [float("-inf")] + rows[0][1][1:])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], VECTORS).repartition(3)
    found = centroids.lloyd(df, k=12, rounds=3).collect()
    expected, centres = lloyd_by_hand(rows, 12, 3)

    def order(r):
        return (r[0] is None, r[0] or 0, *r[1:])

    assert sorted([(r.vec_id, r.cluster, r.distance) for r in found], key=order) == sorted(expected, key=order)
    total = sum(d for _, _, d in expected)
    for r in found:
        assert r.centroid == [int(c) for c in centres[r.cluster]] and r.inertia == total
        assert r.cluster_inertia == sum(d for _, label, d in expected if label == r.cluster)


def test_clusters_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(1, [0.5] * 64, None, 0), (2, [0.5] * 64, None, 0)], VECTORS)
    assert {(r.cluster, r.distance, r.inertia) for r in centroids.lloyd(few).collect()} == {(0, 0, 0)}
    none = centroids.lloyd(few.filter("false"))
    assert none.count() == 0 and none.columns == centroids.lloyd(few).columns
    with pytest.raises(Exception, match="too large"):
        centroids.lloyd(spark.createDataFrame([(1, [1e9] * 64, None, 0)], VECTORS)).count()


NASTY = ["", "\\", "### user:\n", "</turn>\n", "####", "\\### Assistant: </turn> ok", "a:b\\:c", "<turn>", "日本 😀", "#" * 9, "\\\\</turn>"]


def test_template_is_reversible():
    turns = [(r, t) for r in ["user", "", "a:b\n", "### x", "\\"] for t in NASTY]
    assert chats.read_turns(chats.marked_turns(turns)) == turns
    with pytest.raises(ValueError):
        chats.read_turns(chats.marked_turns(turns) + "rest")


def test_spans_of_templates_that_are_only_called():
    turns = [("system", "be brief"), ("user", "hi <b>"), ("assistant", "<i> ho"), ("user", ""), ("assistant", "end")]

    def angled(given):
        return "<s>" + "".join(f"[{r}]{t}<end>" for r, t in given)

    text, spans = chats.render_block(angled, [], turns)
    assert text == angled(turns)
    assert [text[s["text_begin"] : s["text_end"]] for s in spans] == [t for _, t in turns]
    assert [s["begin"] for s in spans[1:]] == [s["end"] for s in spans[:-1]] and not any(s["rewrites"] for s in spans)

    def forgetful(given):  # blanks all answers but the last
        last = max((i for i, (r, _) in enumerate(given) if r == "assistant"), default=-1)
        return "".join(f"[{r}]{t if r != 'assistant' or i == last else '-'}" for i, (r, t) in enumerate(given))

    text, spans = chats.render_block(forgetful, [], turns)
    assert [s["rewrites"] for s in spans] == [False, False, False, False, True]
    assert text == forgetful(turns) and spans[2]["begin"] is None

    def trims(given):
        return "".join(f"[{r}]{t.strip()}" for r, t in given)

    _, spans = chats.render_block(trims, [], [("user", " hi "), ("assistant", "x")])
    assert spans[0]["text_end"] - spans[0]["text_begin"] == 2


def chat_rows():
    draw = random.Random(8)
    rows = [(c, t, draw.choice(["user", "assistant"]), draw.choice(NASTY) + prose(c + t, 5)) for c in range(30) for t in range(1 + c % 7)]
    rows += [(77, t, "user" if t % 2 else "assistant", f"turn {t} " + draw.choice(NASTY)) for t in range(700)]
    rows += [(88, t // 2, "assistant", "same") for t in range(60)]
    rows += [(None, 1, "user", None), (None, 0, None, "first"), (5, None, "assistant", "before all"), (99, 0, "assistant", "long " * 40000)]
    return rows


def test_conversations_read_back(spark, monkeypatch):
    rows = chat_rows()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, block string, conv int")
    formatted = chats.format_conversations(df)
    assert formatted.filter("conv = 77").count() == -(-700 // chats.BLOCK)
    found = {r.conv: r for r in chats.conversation_digests(chats.read_back(formatted)).collect()}
    by_conv = {}
    for c, t, role, text in rows:
        by_conv.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(found) == set(by_conv)
    for c, own in by_conv.items():
        own.sort(key=lambda r: r[:3])
        loss = "".join(t for *_, r, t in own if r == "assistant")
        r = found[c]
        assert r.n_turns == len(own) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == len(chats.marked_turns([(r, t) for *_, r, t in own]))
    assert chats.format_conversations(df.filter("false")).count() == 0


@pytest.mark.parametrize("strip", [chats.STRIP, 90])
def test_rewrites_of_old_turns_are_seen(spark, monkeypatch, strip):
    def resummed(given):  # heads the output with a count that changes at some turns: each rewrites all turns before it
        resets = [t for _, t in given if t.endswith("reset")]
        return f"<{len(resets)}>" + "".join(f"[{r}]{t}|" for r, t in given)

    monkeypatch.setattr(chats, "STRIP", strip)
    sizes = {1: (40, [30]), 2: (50, []), 3: (600, [25, 410]), None: (300, [299])}
    rows = [(c, i, "user", f"t{i}" + " reset" * (i in resets)) for c, (n, resets) in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {}
    for r in chats.format_conversations(df, resummed).orderBy("conv", "block").collect():
        found.setdefault(r.conv, []).append(r)
    for c, (n, resets) in sizes.items():
        turns = [(r, t) for k, _, r, t in rows if k == c]
        assert [r.block for r in found[c]] == list(range(-(-n // chats.BLOCK)))
        assert "".join(r.formatted for r in found[c]) == resummed(turns)
        spans = [(r.formatted, s) for r in found[c] for s in r.spans]
        assert [i for i, (_, s) in enumerate(spans) if s.rewrites] == resets
        for i, ((text, s), turn) in enumerate(zip(spans, turns, strict=True)):
            if i < max(resets, default=0):
                assert s.begin is None and s.text_begin is None
            elif i not in resets:
                assert text[s.text_begin : s.text_end] == turn[1]


def test_heavy_conversations_keep_null_keys(spark):
    df = spark.range(600).selectExpr("cast(null as long) conv_id", "id turn", "'user' role", "cast(id as string) text")
    row = chats.conversation_digests(chats.read_back(chats.format_conversations(df))).collect()
    assert len(row) == 1 and row[0].conv is None and row[0].n_turns == 600 and row[0].loss_chars == 0
