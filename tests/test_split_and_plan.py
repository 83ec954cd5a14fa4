import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siftwork.functions.draws import hash_score, uniform, with_draws
from siftwork.operators import ordering, planning, quality, splitting


def test_uniform_stream_values(spark):
    wanted = {
        "jury-v1": [0.6482529051136225, 0.16182032995857298, 0.2757498184219003],
        "qa-gen-v1": [0.23534841067157686, 0.15283646760508418, 0.30092026432976127],
        "traj-v1": [0.35067790444009006, 0.040368301793932915],
    }
    for seed, values in wanted.items():
        rows = spark.range(1, len(values) + 1)
        assert [r[0] for r in rows.select(uniform(seed, F.col("id"))).collect()] == values
        staged = with_draws(rows, seed, u=F.col("id")).orderBy("id")
        assert [r["u"] for r in staged.collect()] == values


def test_uniform_matches_sequential_generator(spark):
    def stream(seed):
        state = int.from_bytes(hashlib.sha256(seed.encode()).digest()[:4], "big")
        while True:
            state = (state + 0x6D2B79F5) & 0xFFFFFFFF
            t = (state ^ state >> 15) * (1 | state) & 0xFFFFFFFF
            t = (t + ((t ^ t >> 7) * (61 | t) & 0xFFFFFFFF) & 0xFFFFFFFF) ^ t
            yield (t ^ t >> 14) / 4294967296

    draws = stream("any seed")
    expected = [next(draws) for _ in range(500)]
    rows = spark.range(1, 501).select("id", uniform("any seed", F.col("id")).alias("u")).orderBy("id")
    assert [r["u"] for r in rows.collect()] == expected


def _ids():
    counts = {"llms": 8, "cli": 6, "guides": 6}
    return [f"{s}.txt#{i:04d}" for s, n in counts.items() for i in range(1, n + 1)]


def test_split_of_twenty_chunks(spark):
    ids = spark.createDataFrame([(i,) for i in _ids()], "id string")
    score = ids.filter("id = 'llms.txt#0001'").select(hash_score("phase-4-v1", F.col("id"))).first()[0]
    assert score == 0.4022855709772557
    split = splitting.with_split(ids, "id")
    held = {r["id"] for r in split.filter("split = 'eval'").collect()}
    assert held == {"llms.txt#0006", "llms.txt#0007", "cli.txt#0003", "guides.txt#0004"}
    train = split.filter("split = 'train'")
    row = splitting.split_fingerprint(train, "id").first()
    assert row["ids"] == 16
    assert row["fingerprint"] == "28c6d895fff576faf1f87fb50b0289d47381f803dabca3ad0d06cf21d4de23e2"
    with pytest.raises(ValueError):
        splitting.split_fingerprint(train, "id", max_ids=15)
    again = train.repartition(7)
    tree = splitting.tree_fingerprint(train, "id").first()[0]
    assert tree == splitting.tree_fingerprint(again, "id").first()[0]
    assert tree != splitting.tree_fingerprint(ids, "id").first()[0]


def test_question_plan_first_rows(spark):
    chunks = spark.createDataFrame([(f"c{i:02d}",) for i in range(16)], "id string")
    rows = spark.range(4).withColumnRenamed("id", "index")
    plan = planning.qa_plan(rows, chunks, "id").orderBy("index").collect()
    got = [(r["persona"], r["difficulty"], [int(c[1:]) for c in r["chunk_ids"]]) for r in plan]
    assert got == [
        ("senior-backend", "easy", [4]),
        ("mobile-dev", "medium", [1, 2]),
        ("devops", "easy", [1]),
        ("indie-hacker", "medium", [14, 15]),
    ]


def test_ring_wraps(spark):
    chunks = spark.createDataFrame([("a",), ("b",)], "id string")
    rows = spark.range(60).withColumnRenamed("id", "index")
    for r in planning.qa_plan(rows, chunks, "id").collect():
        assert len(r["chunk_ids"]) == r["size"]
        assert all(x != y for x, y in zip(r["chunk_ids"], r["chunk_ids"][1:]))


def test_sample_of_twenty(spark):
    picked = spark.range(20).filter(quality.cross_check_sample(F.col("id"))).collect()
    assert [r["id"] for r in picked] == [1, 3]


def test_eval_plan_numbers_run_across_kinds(spark):
    chunks = spark.createDataFrame([(f"c{i}",) for i in range(5)], "id string")
    rows = spark.range(80).withColumnRenamed("id", "index")
    plan = planning.eval_plan(rows, chunks, "id", ["t0", "t1", "t2"]).orderBy("index").collect()
    assert len(plan) == 70
    assert plan[0]["item_id"] == "eval-factual-0" and plan[0]["chunk_ids"] == ["c0"]
    assert plan[41]["item_id"] == "eval-reasoning-41" and plan[41]["chunk_ids"] == ["c3", "c4", "c0"]
    assert plan[51]["tools"] == ["t1"] and plan[51]["chunk_ids"] == ["c1"]
    assert plan[69]["item_id"] == "eval-multi-turn-tool-69" and plan[69]["tools"] == ["t1", "t2"]


def test_dense_ordinal_is_order_insensitive(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(13)
    got = ordering.dense_ordinal(rows, "k").collect()
    assert all(r["k"] == r["ordinal"] for r in got) and len(got) == 1000


@pytest.mark.parametrize("n, train, valid", [(1, 1, 1), (2, 1, 1), (10, 9, 1), (25, 22, 3)])
def test_head_tail_split(spark, n, train, valid):
    sides = ordering.head_tail_split(spark.range(n), "id").groupBy("side").count().collect()
    assert {r["side"]: r["count"] for r in sides} == {"train": train, "valid": valid}


def test_inverse_frequency_prefers_rare(spark):
    items = spark.range(200).select("id", F.when(F.col("id") < 100, 0).otherwise(400).alias("n"))
    picked = planning.inverse_frequency_sample(items, "id", "n", "s", 50).collect()
    assert len({r["id"] for r in picked}) == 50
    assert sum(r["id"] < 100 for r in picked) > 45


def test_boundary_inputs(spark):
    params = spark.createDataFrame(
        [("t", "s", "string"), ("t", "n", "integer"), ("t", "x", "date"), ("t", "b", "boolean")],
        "tool string, param string, type string",
    )
    rows = {r["input_no"]: r["arguments"] for r in planning.boundary_inputs(params).collect()}
    assert len(rows) == 10
    assert rows[0] == '{"b":true,"n":0,"s":"","x":null}'
    assert rows[5] == '{"b":false,"n":2147483647,"s":"null","x":null}'


def test_flat_fingerprint_of_any_number_of_ids(spark):
    many = spark.range(1_000_002).select(F.col("id").cast("string").alias("id"))
    row = splitting.split_fingerprint(many.repartition(5), "id").first()
    text = splitting.SALT + ":" + ",".join(sorted(map(str, range(1_000_002))))
    assert tuple(row) == (1_000_002, hashlib.sha256(text.encode()).hexdigest())
    odd = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("",)], "id string")
    row = splitting.split_fingerprint(odd, "id").first()
    assert tuple(row) == (5, hashlib.sha256(f"{splitting.SALT}:,a,b,b".encode()).hexdigest())
    none = splitting.split_fingerprint(odd.filter("false"), "id").first()
    assert tuple(none) == (0, hashlib.sha256(f"{splitting.SALT}:".encode()).hexdigest())


def test_nested_boundary_inputs_equal_a_walk(spark):
    schemas = [
        {"type": "object", "properties": {"s": {"type": "string"}, "o": {"type": "object", "properties": {"n": {"type": "number"}, "p": {"type": "object", "properties": {"b": {"type": "boolean"}, "d": {"type": "date"}}}}}}},
        {"type": "object", "properties": {'q"uote': {"type": "integer"}, "list": {"type": "array", "items": {"type": "object"}}, "bare": {"type": "object"}}},
        {"type": "object"},
    ]

    def walk(schema, i):
        out = {}
        for key, inner in schema.get("properties", {}).items():
            kind = inner.get("type")
            values = planning.BOUNDARY.get(kind)
            out[key] = walk(inner, i) if kind == "object" else json.loads(values[i]) if values else None
        return out

    rows = [(n, json.dumps(s)) for n, s in enumerate(schemas)] + [(8, "no json"), (9, None)]
    found = planning.nested_boundary_inputs(spark.createDataFrame(rows, "tool int, parameters string")).collect()
    assert len(found) == 50
    for r in found:
        assert json.loads(r["arguments"]) == (walk(schemas[r["tool"]], r["input_no"]) if r["tool"] < 3 else {})
    deep = spark.createDataFrame(rows[:1], "tool int, parameters string")
    assert planning.nested_boundary_inputs(deep, 3).count() == 10
    with pytest.raises(Exception, match="deeper"):
        planning.nested_boundary_inputs(deep, 2).collect()


def test_nested_boundary_inputs_of_one_split_are_dealt(spark):
    schema = '{"properties": {"o": {"type": "object", "properties": {"n": {"type": "integer"}}}, "d": null, "": {"type": "date"}}}'
    tools = spark.createDataFrame([(1, schema)], "tool int, parameters string").coalesce(1)
    found = planning.nested_boundary_inputs(tools)
    assert found.rdd.getNumPartitions() > 1
    got = {r["input_no"]: r["arguments"] for r in found.collect()}
    numbers = planning.BOUNDARY["integer"]
    assert got == {i: '{"":null,"d":null,"o":{"n":%s}}' % numbers[i] for i in range(planning.BOUNDARY_INPUTS)}
