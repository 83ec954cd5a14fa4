import math
import random

import pytest
from pyspark.sql import functions as F

from siftwork.functions import jsons, text
from siftwork.operators.chunking import chunk_texts


def _one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_answer_normalise(spark):
    assert _one(spark, " Là ! B ", text.normalise_answer) == "l  b"
    assert _one(spark, "a ! b", text.normalise_answer) == "a  b"
    assert _one(spark, None, text.normalise_answer) == ""
    assert _one(spark, "   A B﻿", text.normalise_answer) == "a b"


def test_names_and_trim(spark):
    assert _one(spark, "My_Tool-Name", text.normalise_name) == "mytoolname"
    assert _one(spark, "　 x \n", text.trim_all) == "x"


def test_shingles(spark):
    assert _one(spark, "A b  c a b c", text.shingles) == ["a b c", "b c a", "c a b"]
    assert _one(spark, "one two", text.shingles) == []


@pytest.mark.parametrize(
    "raw, args, canonical",
    [
        ('{"b": 1, "a": {"d": [2, 1], "c": 1.0}}', '{"a":{"c":1,"d":[2,1]},"b":1}', '{"a":{"c":1,"d":[2,1]},"b":1}'),
        ("[1]", "{}", "[1]"),
        ("null", "{}", "null"),
        ("nope", "{}", "nope"),
        ('{"a": 1} trailing', "{}", '{"a": 1} trailing'),
        ('{"a": 1}}', "{}", '{"a": 1}}'),
        ("1],[2", "{}", "1],[2"),
        ('1,"w":2', "{}", '1,"w":2'),
        ("", "{}", ""),
        (None, "{}", None),
    ],
)
def test_json_values(spark, raw, args, canonical):
    assert _one(spark, raw, lambda c: F.to_json(jsons.tool_arguments(c))) == args
    assert _one(spark, raw, jsons.canonical_json) == canonical


def test_result_text(spark):
    def shown(c):
        return jsons.result_text(jsons.recorded_result(c))

    assert _one(spark, '"plain"', shown) == "plain"
    assert _one(spark, "not json", shown) == "not json"
    assert _one(spark, '{"b": 1, "a": 2}', shown) == '{"a":2,"b":1}'


def _chunks(spark, name, value, **options):
    rows = spark.createDataFrame([(name, value)], "source string, text string")
    return chunk_texts(rows, "source", "text", **options).orderBy("ordinal").collect()


def test_chunk_goldens(spark):
    sizes = [(len(c["text"]), c["token_count"]) for c in _chunks(spark, "llms", "abcd " * 1000)]
    assert sizes == [(1500, 375)] * 3 + [(949, 238)]
    body = "\n\n".join(["a" * 1200, "b" * 1200, "c" * 2400, "  ", "d"])
    got = _chunks(spark, "guides", body)
    assert [(len(c["text"]), c["token_count"]) for c in got] == [(1200, 300), (1402, 351), (2000, 500), (600, 150), (1, 1)]
    assert [c["id"] for c in got] == [f"guides.txt#{i:04d}" for i in range(5)]
    assert got[1]["text"] == "a" * 200 + "\n\n" + "b" * 1200


def _pack(paragraphs):
    def tokens(s):
        return math.ceil(len(s) / 4)

    out, buffer, count = [], "", 0
    for p in paragraphs:
        size = tokens(p)
        if size > 500:
            if buffer:
                out.append(buffer)
            buffer, count = "", 0
            unit = max(1, len(p) // size)
            out += [p[i : i + 500 * unit] for i in range(0, len(p), 450 * unit)]
        elif count + size > 500:
            out.append(buffer)
            buffer = buffer[-200:] + "\n\n" + p
            count = tokens(buffer)
        else:
            buffer = buffer + "\n\n" + p if buffer else p
            count += size
    return out + ([buffer] if buffer else [])


def test_packing_matches_sequential_twin(spark):
    rng = random.Random(5)
    texts = []
    for i in range(40):
        sizes = [rng.choice([1, 30, 400, 1500, 2000, 2001, 5000]) for _ in range(rng.randint(1, 25))]
        texts.append((str(i), "\n\n".join("".join(rng.choice("abc é🦄") for _ in range(n)).strip() or "x" for n in sizes)))
    rows = spark.createDataFrame(texts, "source string, text string")
    got = {}
    for c in chunk_texts(rows, "source", "text").collect():
        got.setdefault(c["source"], []).append((c["ordinal"], c["text"]))
    for name, body in texts:
        assert [t for _, t in sorted(got[name])] == _pack([p for p in body.split("\n\n") if p])
