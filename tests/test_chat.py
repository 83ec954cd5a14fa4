import json

import pytest
from pyspark.sql import functions as F

from siftwork.functions.jsons import strict_json
from siftwork.operators import catalog, frames, leakage, messages, prompts, quality, replay, scoring
from siftwork.plans import queries_chat
from siftwork.plans.curation import curate, question_examples, question_prompts
from siftwork.plans.discovery import discover, gated_tools
from siftwork.schemas import CALL, MESSAGES, MULTI_REPLY, PARALLEL_REPLY, QA_REPLY, SINGLE_REPLY


def _tool(name, properties, required=(), **more):
    parameters = {"type": "object", "properties": properties, "required": list(required), **more}
    return {"type": "function", "function": {"name": name, "description": f"The {name} tool.", "parameters": parameters}}


POLICY = _tool(
    "policy",
    {"table": {"type": "string"}, "role": {"type": "string", "enum": ["anon", "owner"]}},
    ["table", "role"],
    additionalProperties=False,
)
SELECT = _tool(
    "select",
    {
        "columns": {"type": "array", "items": {"type": "string"}},
        "filters": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {"column": {"type": "string"}, "op": {"type": "string", "enum": ["eq"]}, "value": {}},
                "required": ["column", "op", "value"],
                "additionalProperties": False,
            },
        },
    },
    ["columns", "filters"],
)


@pytest.mark.parametrize(
    "name, args, faults",
    [
        ("policy", '{"table": "t", "role": "anon"}', []),
        ("missing", "{}", ["unknown tool: missing"]),
        ("policy", '{"table": 1, "role": "x"}', ["/table must be string", "/role must be equal to one of the allowed values"]),
        ("policy", "{}", ["/ must have required property 'table'", "/ must have required property 'role'"]),
        ("policy", "not json", ["/ must have required property 'table'", "/ must have required property 'role'"]),
        ("policy", '{"table": "t", "role": "anon", "z": 1}', ["/ must NOT have additional properties"]),
        ("select", '{"columns": ["a"], "filters": []}', []),
        ("select", '{"columns": ["a", 2], "filters": {}}', ["/columns/1 must be string", "/filters must be array"]),
        (
            "select",
            '{"columns": [], "filters": [{"column": "c", "op": "eq", "value": null}, {"column": "c", "op": "no", "x": 1}, 5]}',
            [
                "/filters/1 must have required property 'value'",
                "/filters/1 must NOT have additional properties",
                "/filters/1/op must be equal to one of the allowed values",
                "/filters/2 must be object",
            ],
        ),
    ],
)
def test_schema_gate(spark, name, args, faults):
    calls = spark.createDataFrame([(name, args)], "name string, arguments string")
    row = catalog.gate_calls(calls, [POLICY, SELECT]).first()
    assert sorted(row["faults"]) == sorted(faults)
    assert row["valid"] == (not faults)


def test_integers_and_enums(spark):
    tool = _tool("t", {"n": {"type": "integer"}, "m": {"type": "number"}, "e": {"enum": [1, "a"]}})
    rows = [('{"n": 3, "m": 2.5, "e": "a"}', 0), ('{"n": 3.5, "m": "2", "e": 2}', 3), ('{"n": 3.0, "m": 1, "e": 1}', 0)]
    calls = spark.createDataFrame([("t", a, n) for a, n in rows], "name string, arguments string, n int")
    for r in catalog.gate_calls(calls, [tool]).collect():
        assert len(r["faults"]) == r["n"]


def test_gate_order_and_failures(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "id int, why string")
    result = catalog.gate_result({"fuzz": F.col("why"), "parse": F.col("why"), "trajectory": F.col("why")})
    got = {r["id"]: r["g"] for r in rows.select("id", result.alias("g")).collect()}
    assert got[1]["pass"] and got[2]["failed_gate"] == "parse"
    counts = {r["gate"]: r["failures"] for r in catalog.failures_per_gate(rows.select("id", result.alias("g")).select("g.*")).collect()}
    assert counts == {"schema": 0, "parse": 1, "sandbox": 0, "fuzz": 0, "trajectory": 0}


def test_deny_scan(spark):
    bodies = ["function a(x) { return x }", "return eval('1')", "Math . random()", "Date.now()", "prefetch(1)"]
    rows = spark.createDataFrame([(b,) for b in bodies], "b string")
    got = [r[0] for r in rows.select(catalog.deny_reason(F.col("b"))).collect()]
    assert got == [None, "banned identifier: eval", "banned access: Math.random", "banned access: Date.now", None]


@pytest.mark.parametrize("count, branch", [(0, "fallback"), (3, "fallback"), (4, "retry"), (7, "retry"), (8, "straight")])
def test_threshold_branch(count, branch):
    assert catalog.threshold_branch(count) == branch


def _candidates(spark, names):
    body = "function f(args) { return args.k }"
    schema = '{"type": "object", "properties": {"k": {"type": "string"}}}'
    return spark.createDataFrame(
        [(i, n, schema, body) for i, n in enumerate(names)], "ordinal int, tool string, parameters string, body string"
    )


def _logs(spark, names, slow=(), throwing=(), wrong=()):
    runs = [(n, "smoke", n not in slow, "worker timeout" if n in slow else None) for n in names]
    runs += [(n, "fuzz", not (n in throwing and i == 4), None) for n in names for i in range(10)]
    seen = [(n, i, '{"a": 1, "b": 2}', '{"b":2,"a":1}' if n not in wrong else "{}") for n in names for i in range(3)]
    return (
        spark.createDataFrame(runs, "tool string, kind string, ok boolean, error string"),
        spark.createDataFrame(seen, "tool string, run_no int, recorded string, observed string"),
    )


def test_gates_together(spark):
    names = ["fine", "slow", "throws", "wrong", "norun"]
    runs, seen = _logs(spark, names[:4], {"slow"}, {"throws"}, {"wrong"})
    gated = {r["tool"]: r for r in gated_tools(_candidates(spark, names), runs, seen).collect()}
    assert gated["fine"]["pass"]
    failed = {n: gated[n]["failed_gate"] for n in names[1:]}
    assert failed == {"slow": "sandbox", "throws": "fuzz", "wrong": "trajectory", "norun": "trajectory"}
    assert gated["throws"]["reason"] == "1/10 threw"
    assert gated["wrong"]["reason"] == "trajectory[0] mismatch"


def test_discovery_retries_and_caps(spark):
    names = [f"tool_{c}" for c in "abcdefghijklmnop"]
    runs, seen = _logs(spark, names, throwing={"tool_b"})

    def validate(rows):
        return gated_tools(rows, runs, seen)

    first = _candidates(spark, [*names[:6], "Tool-A"])
    retry = _candidates(spark, names).withColumn("ordinal", F.col("ordinal") + 100)
    fallback = _candidates(spark, ["spare"])
    found = discover(first, validate, fallback, retry)
    assert found.source == "swarm" and found.tools.count() == 12
    assert found.raw == 23 and found.deduped == 16
    assert {r["gate"]: r["failures"] for r in found.failures.collect()}["fuzz"] == 2
    few = _candidates(spark, names[:3])
    with pytest.raises(catalog.TooFewTools) as caught:
        discover(few, validate, fallback)
    assert [r["tool"] for r in caught.value.fallback.collect()] == ["spare"]
    assert discover(few, validate, fallback, strict=False).source == "fallback"


# --- messages ------------------------------------------------------------------


def _reply(spark, schema, value):
    rows = spark.createDataFrame([(json.dumps(value),)], "v string")
    return rows.select(F.from_json("v", schema).alias("r"))


def test_question_messages(spark):
    value = {"question": "Which?", "answer": "That.", "toolCalls": [{"name": "a", "arguments": '{"k": 1}'}, {"name": "b", "arguments": "bad"}]}
    built = messages.qa_messages(F.col("r"), F.lit(7), F.lit("sys"))
    got = _reply(spark, QA_REPLY, value).select(F.explode(built).alias("m")).select("m.*").collect()
    assert [m["role"] for m in got] == ["system", "user", "assistant", "tool", "tool", "assistant"]
    calls = got[2]["tool_calls"]
    assert [c["id"] for c in calls] == ["call_7_0", "call_7_1"]
    assert [c["function"]["arguments"] for c in calls] == ['{"k":1}', "{}"]
    assert got[3]["content"] == messages.STUB_RESULT and got[4]["name"] == "b"
    value["toolCalls"] = []
    assert _reply(spark, QA_REPLY, value).select(F.size(built)).first()[0] == 3


def test_single_and_parallel_messages(spark):
    single = {"userQuery": "q", "toolCall": {"name": "a", "arguments": "{}"}, "toolResult": '{"x": 1}', "assistantAnswer": "done"}
    got = _reply(spark, SINGLE_REPLY, single).select(messages.single_messages(F.col("r"), F.lit("s")).alias("m")).first()["m"]
    assert [m["role"] for m in got] == ["system", "user", "assistant", "tool", "assistant"]
    assert got[3]["content"] == '{"x": 1}' and got[3]["tool_call_id"] == "call_0"
    pair = {
        "userQuery": "q", "toolCalls": [{"name": "a", "arguments": "{}"}, {"name": "b", "arguments": "{}"}],
        "toolResults": ["1", "2"], "assistantAnswer": "done", "dependency": "parallel",
    }
    got = _reply(spark, PARALLEL_REPLY, pair).select(messages.parallel_messages(F.col("r"), F.lit("s")).alias("m")).first()["m"]
    assert [(m["tool_call_id"], m["name"], m["content"]) for m in got if m["role"] == "tool"] == [("call_0", "a", "1"), ("call_1", "b", "2")]


def test_multi_turn_messages(spark):
    call = {"name": "a", "arguments": "{}"}
    turns = [
        {"role": "user", "content": "hi", "toolCall": None, "toolCallId": None},
        {"role": "assistant", "content": "", "toolCall": call, "toolCallId": None},
        {"role": "tool", "content": "1", "toolCall": None, "toolCallId": None},
        {"role": "assistant", "content": "", "toolCall": call, "toolCallId": None},
        {"role": "tool", "content": "2", "toolCall": None, "toolCallId": "given"},
        {"role": "assistant", "content": "bye", "toolCall": None, "toolCallId": None},
    ]
    got = _reply(spark, MULTI_REPLY, {"turns": turns}).select(messages.multi_messages(F.col("r"), F.lit("s")).alias("m")).first()["m"]
    assert [m["role"] for m in got] == ["system", "user", "assistant", "tool", "assistant", "tool", "assistant"]
    assert [m["tool_calls"][0]["id"] for m in got if m["tool_calls"]] == ["call_0", "call_1"]
    assert [m["tool_call_id"] for m in got if m["role"] == "tool"] == ["call_0", "given"]


def _examples(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "v string").select(F.from_json("v", f"messages {MESSAGES}").alias("e")).select("e.*")


def test_prompt_answer(spark):
    call = {"id": "c", "type": "function", "function": {"name": "get_schema", "arguments": "{}"}}
    rows = [
        {"messages": [{"role": "user", "content": " Show it. "}, {"role": "assistant", "content": "", "tool_calls": [call]}, {"role": "assistant", "content": "later"}]},
        {"messages": [{"role": "user", "content": "old"}, {"role": "user", "content": "What?"}, {"role": "assistant", "content": "a"}, {"role": "assistant", "content": " This. "}]},
        {"messages": [{"role": "user", "content": "no answer"}, {"role": "assistant", "content": " "}]},
        {},
    ]
    got = [tuple(r) for r in messages.prompt_answer(_examples(spark, rows)).collect()]
    assert got == [("Show it.", "get_schema"), ("What?", "This.")]


def test_nesting_refuses_endless_conversations(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 5, "user", "b")], "c int, t int, r string, x string")
    assert messages.nest_turns(turns, "c", "t", "r", "x").count() == 1
    with pytest.raises(Exception, match="conversation too long"):
        messages.nest_turns(turns, "c", "t", "r", "x", max_turns=5).collect()


def test_retry_rounds(spark):
    base = spark.createDataFrame([(1, "s", "u"), (2, "s", "u")], "index int, system string, user string")
    rejected = spark.createDataFrame([(1, 1, "why"), (2, 2, "why")], "index int, attempt int, reason string")
    again, out = prompts.retry_round(base, rejected)
    row = again.first()
    assert (row["index"], row["attempt"]) == (1, 2)
    assert row["user"] == "u\n\n[PREVIOUS ATTEMPT REJECTED: why. Fix the issue.]"
    assert [r["index"] for r in out.collect()] == [2]
    again, _ = prompts.retry_round(base, rejected, kind="trajectory")
    assert again.first()["system"].endswith("Previous attempt was rejected: why. Fix the tool call arguments.")


def test_trajectory_and_eval_prompts(spark):
    plan = spark.createDataFrame(
        [(0, "singleTurn", "dba", "easy", ["policy"], None, "CTX"), (1, "multiTurn", "dba", "easy", ["policy", "select"], None, "CTX"),
         (2, "parallelDep", "dba", "hard", ["policy", "select"], "dependent", "CTX"), (3, "refusal", "dba", "hard", [], None, "CTX")],
        "index int, kind string, persona string, difficulty string, tools array<string>, dependency string, context string",
    )
    got = {r["kind"]: r for r in prompts.trajectory_prompts(plan, [POLICY, SELECT], "Acme").collect()}
    assert all("{" + hole + "}" not in r["system"] + r["user"] for r in got.values() for hole in ("product", "context", "tools", "name"))
    assert "the tool `policy`: The policy tool.." in got["singleTurn"]["system"]
    assert "both `policy` and `select`" in got["parallelDep"]["user"] and "DEPENDENT" in got["parallelDep"]["system"]
    assert "outside the Acme domain" in got["refusal"]["system"]
    assert all("[CONTEXT]\nCTX\n[/CONTEXT]" in r["user"] for r in got.values())
    items = plan.select("index", F.lit("i").alias("item_id"), F.lit("multi-turn-tool").alias("kind"), "tools", "context")
    shown = prompts.eval_prompts(items, [POLICY, SELECT]).filter("index = 1").first()
    assert "- policy: The policy tool. (params: {" in shown["system"] and shown["user"] == "CTX"


# --- frames, replay, scoring ----------------------------------------------------


@pytest.mark.parametrize(
    "output, expected",
    [
        ("hello there", [("text", "hello there", None, None)]),
        ('sure <|tool_call|>{"name":"add","args":{"b":3,"a":2}}<|tool_response|> ok', [("text", "sure ", None, None), ("call", None, "add", '{"a":2,"b":3}'), ("text", " ok", None, None)]),
        ("<|tool_call|>{not json<|tool_response|>", [("malformed", "{not json", None, None)]),
        ('prefix <|tool_call|>{"name":"x"}', [("text", "prefix ", None, None), ("malformed", '{"name":"x"}', None, None)]),
        ('<|tool_call|> add {"a": "}{"} tail}<|tool_response|>', [("call", None, "add", '{"a":"}{"}')]),
        ('<|tool_call|>{"a": 1}<|tool_response|>', [("malformed", '{"a": 1}', None, None)]),
        ('<|tool_call|>{"name": 5}<|tool_response|>', [("malformed", '{"name": 5}', None, None)]),
        ('a<|tool_call|>x<|tool_call|>{"name":"n","args":[1]}<|tool_response|>z<|tool_response|>', [("text", "a", None, None), ("call", None, "n", "{}"), ("text", "z<|tool_response|>", None, None)]),
        ('<|tool_call|>{"name":"q","args":{"s":"\\"}"}}<|tool_response|>', [("call", None, "q", '{"s":"\\"}"}')]),
        ("<|tool_call|>", [("malformed", "", None, None)]),
        ("", []),
    ],
)
def test_frames(spark, output, expected):
    rows = frames.tool_frames(spark.createDataFrame([(1, output)], "id int, t string"), "id", "t").orderBy("frame_no").collect()
    got = [(r["kind"], None if r["kind"] == "call" else r["text"], r["name"], r["args"]) for r in rows]
    assert got == expected


REPLAYS = [
    ("rls_policy_template", {"tableName": "posts", "role": "anon", "operation": "insert"}, {"policy": 'CREATE POLICY "posts_insert_anon" ON public.posts FOR INSERT TO anon USING (auth.uid() = user_id);'}),
    ("select_query_builder", {"table": "users", "columns": ["id", "email"], "filters": [{"column": "id", "op": "eq", "value": "1"}, {"column": "n", "op": "gt", "value": 2}]}, {"sql": "SELECT id, email FROM users WHERE id = $1 AND n > $2;"}),
    ("select_query_builder", {"table": "orders", "columns": [], "filters": []}, {"sql": "SELECT * FROM orders;"}),
    ("storage_path_builder", {"bucket": "b", "userId": "u", "filename": "f.png"}, {"path": "b/u/f.png"}),
    ("edge_function_name_validator", {"name": "hello-world"}, {"valid": True}),
    ("edge_function_name_validator", {"name": ""}, {"valid": False, "reason": replay.NAME_EMPTY}),
    ("edge_function_name_validator", {"name": "a" * 65}, {"valid": False, "reason": replay.NAME_LONG}),
    ("edge_function_name_validator", {"name": "Hello"}, {"valid": False, "reason": replay.NAME_SHAPE}),
    ("column_type_mapper", {"postgresType": "INT4"}, {"tsType": "number"}),
    ("column_type_mapper", {"postgresType": "point"}, {"tsType": "unknown"}),
    ("connection_string_parser", {"url": "postgres://user@localhost/testdb"}, {"host": "localhost", "port": 5432, "database": "testdb", "user": "user"}),
    ("connection_string_parser", {"url": "postgresql://a:s@h.example:6000/d"}, {"host": "h.example", "port": 6000, "database": "d", "user": "a"}),
    ("connection_string_parser", {"url": "no"}, {"host": "", "port": 5432, "database": "", "user": ""}),
    ("jwt_claims_extractor", {"jwt": "header.eyJzdWIiOiJzdmMtNzg5IiwiZXhwIjoxNjAwMDAwMDAwfQ.sig"}, {"sub": "svc-789", "role": None, "exp": 1600000000}),
    ("jwt_claims_extractor", {"jwt": "only.two"}, {"sub": None, "role": None, "exp": None}),
    ("jwt_claims_extractor", {"jwt": "a.!!!.c"}, {"sub": None, "role": None, "exp": None}),
    ("migration_filename", {"timestampMs": 1700000000000, "description": "Add users table"}, {"filename": "20231114221320_add_users_table.sql"}),
    ("migration_filename", {"timestampMs": 0, "description": "--"}, {"filename": "19700101000000_migration.sql"}),
]


def test_replay_of_recorded_runs(spark):
    rows = [(f"my_{t}", i, json.dumps(a), json.dumps(r)) for i, (t, a, r) in enumerate(REPLAYS)]
    calls = spark.createDataFrame(rows, "tool string, run_no int, arguments string, recorded string")
    done = replay.replay_calls(calls, replay.catalogue_functions("my_"))
    verdict = catalog.trajectory_gate(
        calls.select("tool", "run_no", F.col("recorded").alias("result")), done.select("tool", "run_no", "result"), minimum=1
    )
    bad = verdict.filter("reason is not null").join(done, "tool").select("tool", "arguments", "result").collect()
    assert bad == []


def test_scoring(spark):
    def calls(*pairs):
        return [{"id": "x", "type": "function", "function": {"name": n, "arguments": a}} for n, a in pairs]

    rows = [
        ("m", 1, "The Answer", None, "well, the  answer!", None, True),
        ("m", 2, "The Answer", None, "", None, False),
        ("m", 3, "!!", None, "anything", None, False),
        ("m", 4, None, calls(("a", '{"x": 1, "y": 2}')), "text", calls(("a", '{"y":2,"x":1.0}')), True),
        ("m", 5, None, calls(("a", "{}"), ("b", "{}")), None, calls(("b", "{}"), ("a", "{}")), False),
        ("m", 6, "t", calls(("a", "{}")), "t", None, False),
        ("m", 7, None, calls(("a", "{}")), None, calls(("a", "{}"), ("a", "{}")), False),
    ]
    schema = f"model string, item_id int, expected string, expected_calls array<{CALL}>, text string, calls array<{CALL}>, want boolean"
    table = spark.createDataFrame(rows, schema)
    items = table.select("item_id", "expected", "expected_calls")
    responses = table.withColumn("latency_ms", F.lit(10.0)).select("model", "item_id", "text", "calls", "latency_ms")
    got = {r["item_id"]: r["passed"] for r in scoring.scored_items(items, responses, ["m"]).collect()}
    assert got == {r[1]: r[6] for r in rows}
    summary = {r["model"]: r for r in scoring.model_summary(items, responses, {"m": True, "n": True, "off": False}).collect()}
    assert summary["m"]["passed"] == 2 and abs(summary["m"]["score"] - 200 / 7) < 1e-9 and summary["m"]["latency_ms"] == 10
    assert summary["n"]["passed"] == 0 and summary["n"]["score"] == 0.0
    assert summary["off"]["score"] is None and summary["off"]["total"] == 7
    empty = scoring.model_summary(items.limit(0), responses, {"m": True}).first()
    assert empty["score"] == 0.0 and empty["total"] == 0


# --- quality and flows --------------------------------------------------------------


def test_coverage_and_overlap(spark):
    rows = spark.createDataFrame([(["a", "a"],)] * 35 + [(["b"],)] * 10 + [(["x"],)], "tools array<string>")
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "tool string")
    got = {r["tool"]: (r["examples"], r["deficit"], r["surplus"], r["pass"]) for r in quality.tool_coverage(rows, known).collect()}
    assert got == {"a": (35, 0, 5, True), "b": (10, 20, 0, False), "c": (0, 30, 0, False), "x": (1, 29, 0, False)}
    train = spark.createDataFrame([(["s", "s"],), (["s"],)], "src array<string>")
    held = spark.createDataFrame([("s",), ("t",)], "id string")
    assert [r["id"] for r in leakage.overlap(train, "src", held, "id").collect()] == ["s"]
    assert leakage.overlap_check(train, "src", held.filter("id = 't'"), "id").first()["pass"]


def test_disagreements_beyond_one_point(spark):
    def scores(*values):
        return spark.createDataFrame([(1, *values)], ", ".join(["id int", *[f"{d} int" for d in quality.DIMENSIONS]]))

    got = quality.disagreements(scores(5, 5, 4, 3), scores(3, 4, 4, 5), "id").collect()
    assert sorted((r["dimension"], r["primary_score"], r["secondary_score"]) for r in got) == [("faithfulness", 5, 3), ("grounding", 3, 5)]


def test_question_flow(spark):
    texts = spark.createDataFrame([("doc", "\n\n".join(f"paragraph {i} " + "x " * 300 for i in range(40)))], "source string, text string")
    chunks, plan, asked = question_prompts(texts, "source", "text", [POLICY], "Acme", 12)
    assert asked.count() == 12
    good = {"question": "What is the policy?", "answer": "A long enough answer to pass.", "toolCalls": [{"name": "policy", "arguments": '{"table": "t", "role": "anon"}'}]}
    bad_call = {**good, "toolCalls": [{"name": "policy", "arguments": "{}"}]}
    short = {**good, "answer": "short"}
    replies = spark.createDataFrame([(i, json.dumps([good, bad_call, short][i % 3])) for i in range(12)], "index bigint, reply string")
    examples, rejected = question_examples(plan, replies, [POLICY], F.lit("sys"))
    assert examples.count() == 4
    reasons = {r["index"] % 3: r["reason"] for r in rejected.collect()}
    assert reasons[1].startswith("Tool call to 'policy' failed schema validation: ") and reasons[2] == "contract: answer"
    scores = examples.select("example_id", *[F.lit(5).alias(d) for d in quality.DIMENSIONS], F.lit(0).alias("disagreements"))
    held = chunks.filter("split = 'eval'").select("id")
    known = spark.createDataFrame([("policy",)], "tool string")
    done = curate(examples, scores, known, held)
    row = done.funnel.first()
    assert (row["generated"], row["accepted"], row["after_minhash"]) == (4, 4, 1)
    assert done.overlap.first()["pass"] and not done.coverage.first()["pass"]
    vectors = examples.select("example_id", F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    assert curate(examples, scores, known, held, vectors).funnel.first()["after_cosine"] == 1


def _gated(spark, schema, values):
    tool = {"type": "function", "function": {"name": "t", "description": "d", "parameters": {"type": "object", "properties": {"x": schema}}}}
    calls = spark.createDataFrame([(i, "t", json.dumps({"x": v})) for i, v in enumerate(values)], "id int, name string, arguments string")
    return [r["faults"] for r in catalog.gate_calls(calls, [tool]).orderBy("id").collect()]


def test_type_lists_and_limits(spark):
    assert _gated(spark, {"type": ["string", "null"]}, ["a", None, 3]) == [[], [], ["/x must be string,null"]]
    assert _gated(spark, {"minimum": 2, "maximum": 4}, [1, 3, 5, "no number"]) == [["/x must be >= 2"], [], ["/x must be <= 4"], []]
    assert _gated(spark, {"minLength": 2, "pattern": "^a"}, ["ab", "b"]) == [[], ["/x must NOT have fewer than 2 characters", '/x must match pattern "^a"']]
    assert _gated(spark, {"const": {"a": 1}}, [{"a": 1}, 2]) == [[], ["/x must be equal to constant"]]
    assert _gated(spark, {"type": "array", "maxItems": 1}, [[1], [1, 2]]) == [[], ["/x must NOT have more than 1 items"]]


@pytest.mark.parametrize("schema", [{"anyOf": []}, {"items": {"format": "x"}}, {"type": "text"}, {"additionalProperties": {}}])
def test_schemas_that_cannot_be_checked_are_refused(spark, schema):
    with pytest.raises(ValueError):
        _gated(spark, schema, [1])


def test_a_thousand_schemas_take_one_scan_and_one_parse(spark):
    schemas = [{"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": m}}} for m in range(1000)]
    tools = [{"type": "function", "function": {"name": f"t{m}", "description": "d", "parameters": p}} for m, p in enumerate(schemas)]
    calls = [(f"t{m}", '{"k": %d}' % v) for m in range(1000) for v in (m - 1, m)] + [("no", "{}"), (None, "{}")]
    gated = catalog.gate_calls(spark.createDataFrame(calls, "name string, arguments string"), tools)
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "Union" not in plan and "Exchange hash" not in plan
    faults = {(r["name"], r["arguments"]): r["faults"] for r in gated.collect()}
    for m in range(1000):
        assert faults[f"t{m}", '{"k": %d}' % (m - 1)] == [f"/k must be >= {m}"] and faults[f"t{m}", '{"k": %d}' % m] == []
    assert faults["no", "{}"] == ["unknown tool: no"] and faults[None, "{}"] == [None]


def test_faults_come_in_the_order_of_the_schema(spark):
    inner = {"type": "object", "properties": {"z": {"type": "string"}, "a/b": {"enum": ["x", {"q": 1, "b": 2}]}}, "required": ["z", "y"]}
    schema = {
        "type": "object",
        "properties": {"list": {"type": "array", "items": inner, "maxItems": 1}, "k[]": {"type": "null"}, "~": {"const": None}},
        "required": ["gone"],
        "additionalProperties": False,
    }
    tool = {"type": "function", "function": {"name": "t", "description": "d", "parameters": schema}}
    value = {"more": 1, "even": 2, "~": 0, "k[]": [], "list": [{"a/b": {"b": 2, "q": 1}, "z": 1, "y": None}, "no", {"a/b": "y", "z": None}]}
    row = catalog.gate_calls(spark.createDataFrame([("t", json.dumps(value))], "name string, arguments string"), [tool]).first()
    assert row["faults"] == [
        "/ must have required property 'gone'",
        "/ must NOT have additional properties",
        "/ must NOT have additional properties",
        "/list must NOT have more than 1 items",
        "/list/0/z must be string",
        "/list/1 must be object",
        "/list/2 must have required property 'y'",
        "/list/2/z must be string",
        "/list/2/a/b must be equal to one of the allowed values",
        "/k[] must be null",
        "/~ must be equal to constant",
    ]


def test_a_json_value_and_nothing_else(spark):
    good = ["1", '"a"', " [1] ", '{"k": [1, 2]}', "null", '"end of the one value"', '["x", "end of the one value"]']
    bad = ["", "1 2", "1,2", "1],[2", "1}", '{"k":1}]', "]", "[1", '1,"end of the one value"],[2', "1 //", "{} {}", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string")
    found = {r["i"]: r["v"] for r in rows.select("i", F.to_json(strict_json(F.col("t"))).alias("v")).collect()}
    assert [found[i] is not None for i in range(len(good + bad))] == [True] * len(good) + [False] * len(bad)
    assert json.loads(found[3]) == {"k": [1, 2]}


def test_deny_reason_follows_the_text(spark):
    cases = {
        "Date.now(); fetch(1)": "banned access: Date.now",
        "fetch(1); Date . now()": "banned identifier: fetch",
        "Math.floor(Math\n.random())": "banned access: Math.random",
        "xDate.now(); Date.nowish()": None,
        "return 1": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "b string").select("b", catalog.deny_reason(F.col("b")).alias("r")).collect()
    assert {r["b"]: r["r"] for r in rows} == cases


def test_catalogue_parts_are_dealt_and_their_log_is_judged_once(spark, tmp_path, monkeypatch):
    rows = [(i, i * 7 % 50 + 1, f"part {i}") for i in range(1, 60)]
    spark.createDataFrame(rows, "p_partkey long, p_size int, p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    judged, dealt = [], []
    gate, first = queries_chat.catalog.trajectory_gate, queries_chat.catalog.keep_first_by_name
    monkeypatch.setattr(queries_chat.catalog, "trajectory_gate", lambda *a: judged.append(1) or gate(*a))
    monkeypatch.setattr(
        queries_chat.catalog, "keep_first_by_name", lambda rows, *a: dealt.append(rows.rdd.getNumPartitions()) or first(rows, *a)
    )
    counts = {r["catalogue"]: r["raw"] for r in queries_chat.catalogue_counts(spark, str(tmp_path)).collect()}
    assert set(counts) == {0, 1, 2, 3} and len(judged) == 1 and dealt[0] > 1
