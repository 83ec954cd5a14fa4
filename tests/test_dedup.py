import random
import tracemalloc
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwork.functions import minhash
from siftwork.functions.minhash import signature_column, with_signature
from siftwork.operators import dedup, vectors
from siftwork.operators.dedup import Plan, compare_rows, drop_near_duplicates, duplicate_matches
from siftwork.operators.vectors import drop_similar_vectors, similar_vectors
from siftwork.session import spread


def _signatures(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    return {r["id"]: r["signature"] for r in with_signature(rows, "text").collect()}


def _plain_signature(text):
    words = text.lower().split()
    grams = {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}
    return [
        min((int.from_bytes(md5(f"{h}:{g}".encode()).digest()[:4], "big") for g in grams), default=0xFFFFFFFF)
        for h in range(128)
    ]


def test_signature_values(spark):
    near = "write a row policy for the users table in the database with an authenticated role"
    texts = [near, near + " please", "Überlange " * 30 + "wörter hier", "hello world", "a", ""]
    signs = _signatures(spark, texts)
    assert [signs[i] for i in range(6)] == [_plain_signature(t) for t in texts]
    assert np.mean(np.array(signs[0]) == np.array(signs[1])) > 0.9
    assert set(signs[3]) == {0xFFFFFFFF}


def test_signature_forms_agree(spark):
    words = [f"wörd{i}" * (i % 9 + 1) for i in range(60)]
    rng = random.Random(1)
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(30)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    plain = {r[0]: [int(h, 16) for h in r[1]] for r in rows.select("id", signature_column(F.col("text"))).collect()}
    assert plain == _signatures(spark, texts)


def _greedy(signs, threshold):
    kept = []
    for i in sorted(signs):
        s = np.array(signs[i])
        if not any(np.mean(s == np.array(signs[k])) >= threshold for k in kept):
            kept.append(i)
    return kept


def _texts(seed, families=12, copies=14):
    """Families of ever more distant variants, exact copies and short texts."""
    rng = random.Random(seed)
    out = ["", "two words", "x"]
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(60)]
        for _ in range(copies):
            variant = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                variant[rng.randrange(60)] = f"r{rng.random()}"
            out.append(" ".join(variant))
    shared = [f"boiler{i}" for i in range(50)]
    for i in range(40):
        out.append(" ".join(shared + [f"own{i}_{j}" for j in range(40)]))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(
    "plan",
    [
        Plan(),
        Plan(rows_per_band=1),
        Plan(rows_per_band=3),
        Plan(pivots=3, hot_bucket=5),
        Plan(pivots=1, hot_bucket=2, range_rows=40),
        Plan(range_rows=10),
    ],
    ids=["default", "rows1", "rows3", "hot", "hot-rounds", "rounds"],
)
def test_greedy_matches_brute_force(spark, plan):
    texts = _texts(3, families=6, copies=8)
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(5)
    expected = _greedy(_signatures(spark, texts), plan.threshold)
    got = sorted(r["id"] for r in drop_near_duplicates(rows, "id", "text", plan).collect())
    assert got == expected


def test_matches_point_to_kept_rows(spark):
    texts = _texts(7)
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    signs = {i: np.array(s) for i, s in _signatures(spark, texts).items()}
    kept = set(_greedy(signs, 0.7))
    matches = duplicate_matches(rows, "id", "text").collect()
    assert {m["ord"] for m in matches} == set(signs) - kept
    for m in matches:
        assert m["kept"] in kept and m["kept"] < m["ord"]
        assert np.mean(signs[m["kept"]] == signs[m["ord"]]) == m["agreement"] >= 0.7


def test_greedy_is_not_components(spark):
    def span(a, b):
        return " ".join(f"w{i}" for i in range(a, b))

    rows = spark.createDataFrame([(0, span(0, 24)), (1, span(3, 27)), (2, span(6, 30))], "id bigint, text string")
    kept = drop_near_duplicates(rows, "id", "text").collect()
    assert sorted(r["id"] for r in kept) == [0, 2]


def test_short_texts(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b c", "", "d e f g"])], "id bigint, text string")
    assert sorted(r["id"] for r in drop_near_duplicates(rows, "id", "text").collect()) == [0, 3]
    kept = drop_near_duplicates(rows, "id", "text", short_text="keep")
    assert sorted(r["id"] for r in kept.collect()) == [0, 1, 2, 3]


def test_a_third_of_all_rows_resembles_one_another(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(300):
        if i % 3 == 0:
            variant = list(base)
            variant[rng.randrange(80)] = f"v{i}"
            texts.append(" ".join(variant))
        else:
            texts.append(" ".join(f"t{i}_{j}" for j in range(20)))
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    plan = Plan(pivots=4, hot_bucket=10)
    outcome = compare_rows(rows, "id", "text", plan)
    similar = 100 * 99 // 2
    assert outcome.edges.count() < similar / 2
    kept = sorted(r["id"] for r in drop_near_duplicates(rows, "id", "text", plan).collect())
    assert kept == _greedy(_signatures(spark, texts), 0.7)


def test_low_thresholds_narrow_the_bands(spark):
    plan = Plan(threshold=0.2)
    assert plan.width == 1 and Plan().width == 2
    texts = _texts(13, families=3, copies=5)
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = sorted(r["id"] for r in drop_near_duplicates(rows, "id", "text", plan).collect())
    assert got == _greedy(_signatures(spark, texts), 0.2)
    with pytest.raises(ValueError):
        Plan(threshold=0.0).prefix  # noqa: B018


def _resolved(spark, edges, n, range_rows):
    frame = spark.createDataFrame(sorted(edges), "src bigint, dst bigint").repartition(3)
    nodes = spark.range(n).select(F.col("id").alias("ord"), F.lit(False).alias("hidden"))
    return {r["ord"]: r["stays"] for r in dedup.resolve_in_ranges(frame, nodes, range_rows).collect()}


def _kept(edges, n):
    earlier = {}
    for src, dst in edges:
        earlier.setdefault(dst, set()).add(src)
    kept = set()
    for i in range(n):
        if not kept & earlier.get(i, set()):
            kept.add(i)
    return {i: i in kept for i in range(n)}


@pytest.mark.parametrize("range_rows", [20, 10_000])
def test_ranges_on_random_graphs(spark, range_rows):
    rng = random.Random(11)
    edges = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(110)}
    assert _resolved(spark, edges, 60, range_rows) == _kept(edges, 60)


def test_a_chain_of_5000_settles(spark):
    chain = [(i, i + 1) for i in range(4999)]
    assert _resolved(spark, chain, 5000, 2500) == {i: i % 2 == 0 for i in range(5000)}


def test_hidden_nodes_are_dropped_but_not_kept(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (3, 4), (5, 6)], "src bigint, dst bigint")
    hidden = F.col("id").isin(1, 3, 6)
    nodes = spark.range(7).select(F.col("id").alias("ord"), hidden.alias("hidden"))
    for rows in (2, 100):
        found = {r["ord"]: r["stays"] for r in dedup.resolve_in_ranges(edges, nodes, rows).collect()}
        assert found == {0: True, 1: False, 2: True, 5: True, 6: False}


def _largest_task(spark, df):
    """Rows of the fullest partition of ``df``."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_a_third_of_the_rows_on_one_key_is_dealt_out(spark):
    members = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), F.col("id").alias("ord")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = dedup.cut(members.groupBy("key").agg(F.count("*").alias("n")))
        met = dedup.join_groups(members.repartition(16), sizes, "key")
        assert met.count() == 30_000 and _largest_task(spark, met) < 8000
        pairs = spark.range(30_000).select(F.lit(1).alias("key"), F.col("id").alias("ord"), F.lit(30_000).alias("n"))
        plan = Plan(pivots=2, hot_bucket=1000)
        first = pairs.filter("ord < 2")
        met = dedup.candidate_pairs(pairs, first, 2, plan)
        assert met.count() == 29_999 + 29_998
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_copies_of_one_text_point_to_the_first(spark):
    texts = ["same old words again and again"] * 900 + [f"t{i} u{i} v{i} w{i}" for i in range(900)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    found = duplicate_matches(rows, "id", "text").collect()
    assert sorted(r["ord"] for r in found) == list(range(1, 900))
    assert {(r["kept"], r["agreement"]) for r in found} == {(0, 1.0)}


def _cosine(a, b):
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return 0.0 if n == 0 else float(a @ b / n)


@pytest.mark.parametrize("block", [None, 7])
def test_vectors_match_brute_force(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    items = [centres[i % 6] + 0.3 * rng.normal(size=16) for i in range(60)] + [np.zeros(16)] * 2
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id bigint, v array<double>")
    kept = []
    for i, v in enumerate(items):
        if not any(_cosine(v, items[k]) >= 0.92 for k in kept):
            kept.append(i)
    got = drop_similar_vectors(rows.repartition(3), "id", "v", 0.92, block).collect()
    assert sorted(r["id"] for r in got) == kept
    pairs = {(r["src"], r["dst"]) for r in similar_vectors(rows, "id", "v", 0.9, block).collect()}
    assert pairs == {
        (i, j) for i in range(62) for j in range(i + 1, 62) if _cosine(items[i], items[j]) >= 0.9
    }


def test_greedy_strips(monkeypatch):
    monkeypatch.setattr(vectors, "_ROWS", 5)
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(83, 3))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    kept = []
    for i in range(83):
        if not any(rows[i] @ rows[k] >= 0.9 for k in kept):
            kept.append(i)
    assert vectors._greedy(rows, 0.9).tolist() == kept


def test_small_vectors(spark):
    rows = spark.createDataFrame(
        [(0, [1.0, 0.0, 0.0]), (1, [0.999, 0.001, 0.0]), (2, [0.0, 1.0, 0.0])], "id bigint, v array<double>"
    )
    assert sorted(r["id"] for r in drop_similar_vectors(rows, "id", "v").collect()) == [0, 2]
    assert drop_similar_vectors(rows.limit(0), "id", "v").count() == 0
    mixed = rows.unionByName(spark.createDataFrame([(3, [1.0])], "id bigint, v array<double>"))
    with pytest.raises(Exception, match="length mismatch"):
        drop_similar_vectors(mixed, "id", "v").collect()


def test_the_bound_of_two_boxes_holds():
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.normal(size=(12, 4)))[0]
    for _ in range(50):
        a, b = (rng.normal(size=(8, 12)) + 2 * rng.normal(size=12) for _ in range(2))
        a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
        assert (a @ b.T).max() <= vectors._reach(vectors._box(a, axes), vectors._box(b, axes))


def test_many_vectors_without_the_driver(spark, monkeypatch):
    """Clusters, a third of all rows near one vector, exact copies; several blocks and parts."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8))
    items = centres[rng.integers(0, 40, 6000)] + 0.12 * rng.normal(size=(6000, 8))
    items[::3] = centres[0] + 0.02 * rng.normal(size=(2000, 8))
    items[1::60] = items[1]
    units = items / np.linalg.norm(items, axis=1, keepdims=True)
    expected = vectors._greedy(units, 0.97).tolist()
    skipped = []
    reach = vectors._reach
    own = reach(vectors._box(units[:1], np.eye(8)[:, :4]), vectors._box(-units[:1], np.eye(8)[:, :4]))
    skipped.append(own < 0.97)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id bigint, v array<double>")
    for name in ("toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(rows), name, lambda *_: pytest.fail("rows reach the driver"))
    got = drop_similar_vectors(rows, "id", "v", 0.97, 1500).select("id")
    assert sorted(r["id"] for r in got.collect()) == expected and all(skipped)


def test_rows_of_one_large_split_are_dealt(spark, tmp_path, monkeypatch):
    spark.range(2000).selectExpr("id", "concat('some words of row ', id) AS text").coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr("siftwork.session.SPLIT_BYTES", 1 << 10)  # the file is far beyond a split per core
    assert spread(rows, "id").rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_words_of_few_rows_are_python_strings_at_a_time():
    rows = 4000
    words = pa.array([[f"w{i}-{j}" for j in range(50)] for i in range(rows)])
    lists = minhash._word_lists(words)
    tracemalloc.start()
    counted = sum(1 for _ in lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counted == rows and peak < 2 << 20  # all at once are over 10 MB


def test_full_vectors_hold_shingles_of_like_length(monkeypatch):
    rng = random.Random(6)
    lists = [["".join(rng.choices("abc", k=rng.choice([1, 4, 9, 30]))) for _ in range(rng.randint(0, 60))] for _ in range(60)]
    full = []
    hashed = minhash.hash_strings

    def recorded(strings, num_hashes):
        if len(strings) == minhash._VECTOR:
            full.append({len(s) // 4 if len(s) < 64 else 16 for s in strings})
        return hashed(strings, num_hashes)

    monkeypatch.setattr(minhash, "_VECTOR", 40)
    monkeypatch.setattr(minhash, "_FEW", 20)  # both ways of hashing
    monkeypatch.setattr(minhash, "hash_strings", recorded)
    signs = minhash._signatures(lists, len(lists), 128, 3)
    assert signs.tolist() == [_plain_signature(" ".join(ws)) for ws in lists]
    assert len(full) > 10 and sum(len(sizes) > 1 for sizes in full) <= 3  # left-overs may fill a vector by chance
