"""Queries on messages, the tool catalogue, quality filters and scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siftwork.functions import jsons
from siftwork.functions.draws import hash_score
from siftwork.operators import catalog, frames, leakage, messages, ordering, quality, replay, scoring
from siftwork.plans import discovery
from siftwork.plans.checks import answer_sql, greedy_sql, score_sql, text_sql, trim_sql, uniform_sql
from siftwork.plans.curation import curate
from siftwork.plans.queries_data import PRODUCT, SALT, TOOLS
from siftwork.plans.registry import query, table
from siftwork.schemas import CALL, MESSAGES, MULTI_REPLY
from siftwork.session import checkpoint_dir, cut, spread
from siftwork.sources import hooks, readers, sinks


def _nested(spark, d):
    turns = table(spark, d, "conversations")
    return messages.nest_turns(turns, "conv_id", "turn", "role", "text")


# --- messages ----------------------------------------------------------------------


@query(
    "dedup_texts",
    """SELECT conv_id, md5(string_agg(text, ' ' ORDER BY turn)) AS text,
    md5(substr(string_agg(text, ' ' ORDER BY turn), 1, 8000)) AS embed FROM conversations GROUP BY 1""",
)
def dedup_texts(spark, d):
    m = F.col("messages")
    return _nested(spark, d).select(
        "conv_id", F.md5(messages.dedup_text(m)).alias("text"), F.md5(messages.embed_text(m)).alias("embed")
    )


@query(
    "judge_transcripts",
    """SELECT conv_id, md5(string_agg('[' || role || ']: ' || text || CASE WHEN turn = 1 THEN
        e'\\n  tool_calls: [{"id":"call_' || conv_id || '","type":"function","function":{"name":"click","arguments":"{}"}}]' ELSE '' END,
        e'\\n' ORDER BY turn)) AS transcript FROM conversations GROUP BY 1""",
)
def judge_transcripts(spark, d):
    call = messages.tool_call(F.concat(F.lit("call_"), "conv_id"), F.lit("click"), F.lit("{}"))
    with_call = F.transform(
        "messages",
        lambda m, i: messages.message(m["role"], m["content"], F.when(i == 1, F.array(call))),
    )
    return _nested(spark, d).select("conv_id", F.md5(messages.transcript(with_call)).alias("transcript"))


@query(
    "prompt_answers",
    f"""SELECT conv_id, md5(p) AS prompt, md5(a) AS answer FROM (SELECT conv_id,
    {trim_sql("arg_max(text, turn) FILTER (role = 'user')")} AS p, {trim_sql("arg_max(text, turn) FILTER (role = 'assistant')")} AS a
    FROM conversations GROUP BY 1) WHERE p <> '' AND a <> ''""",
)
def prompt_answers(spark, d):
    turns = table(spark, d, "conversations")
    pairs = messages.prompt_answer_of_turns(turns, "conv_id", "turn", "role", "text")
    return pairs.select("conv_id", F.md5("prompt").alias("prompt"), F.md5("answer").alias("answer"))


@query(
    "prompt_answers_with_calls",
    f"""SELECT conv_id, md5(p) AS prompt, CASE WHEN conv_id % 3 = 0 AND c THEN 'click' ELSE md5(a) END AS answer FROM (SELECT conv_id,
    {trim_sql("arg_max(text, turn) FILTER (role = 'user')")} AS p, {trim_sql("arg_max(text, turn) FILTER (role = 'assistant')")} AS a,
    bool_or(role = 'assistant') AS c FROM conversations GROUP BY 1) WHERE p <> '' AND a <> ''""",
)
def prompt_answers_with_calls(spark, d):
    call = messages.tool_call(F.lit("call_0"), F.lit("click"), F.lit("{}"))
    calling = F.transform(
        "messages",
        lambda m: messages.message(
            m["role"], m["content"], F.when((F.col("conv_id") % 3 == 0) & (m["role"] == "assistant"), F.array(call))
        ),
    )
    rows = messages.prompt_answer(_nested(spark, d).withColumn("messages", calling), ["conv_id"])
    answer = F.when(F.col("answer") == "click", F.col("answer")).otherwise(F.md5("answer"))
    return rows.select("conv_id", F.md5("prompt").alias("prompt"), answer.alias("answer"))


@query(
    "ends_by_role",
    """SELECT conv_id, role, md5(arg_min(text, turn)) AS first_text, md5(arg_max(text, turn)) AS last_text
    FROM conversations GROUP BY 1, 2""",
)
def ends_by_role(spark, d):
    ends = messages.ends_by_role(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")
    return ends.withColumn("first_text", F.md5("first_text")).withColumn("last_text", F.md5("last_text"))


@query(
    "prompt_answer_sides",
    f"""WITH p AS (SELECT conv_id, {trim_sql("arg_max(text, turn) FILTER (role = 'user')")} AS p,
        {trim_sql("arg_max(text, turn) FILTER (role = 'assistant')")} AS a FROM conversations GROUP BY 1),
    n AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS i, count(*) OVER () AS n FROM p WHERE p <> '' AND a <> '')
    SELECT CASE WHEN i < greatest(1, floor(n * 0.9)) THEN 'train' ELSE 'valid' END AS side, md5(p) AS prompt, md5(a) AS answer FROM n""",
)
def prompt_answer_sides(spark, d):
    pairs = messages.prompt_answer_of_turns(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")
    sided = ordering.head_tail_split(pairs, "conv_id")
    path = f"{checkpoint_dir(spark)}/pairs-{uuid.uuid4().hex}"
    sinks.write_prompt_answers(sided, path)
    read = [
        readers.read_jsonl(spark, f"{path}/{side}", "prompt string, answer string").withColumn("side", F.lit(side))
        for side in ("train", "valid")
    ]
    return read[0].unionByName(read[1]).select("side", F.md5("prompt").alias("prompt"), F.md5("answer").alias("answer"))


@query(
    "multi_turn_messages",
    """WITH t AS (SELECT conv_id, turn, role, text, role = 'assistant' AND turn % 4 = 1 AS asks FROM conversations),
    r AS (SELECT *, count(*) FILTER (asks) OVER (PARTITION BY conv_id ORDER BY turn) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM t)
    SELECT conv_id, n::INT AS position, CASE WHEN role = 'system' THEN 'tool' ELSE role END AS role, md5(text) AS content,
        CASE WHEN asks THEN 'call_' || (c - 1) END AS call, CASE WHEN role = 'system' THEN 'call_' || (c - 1) END AS answers
    FROM r UNION ALL SELECT conv_id, 0, 'system', md5('system'), NULL, NULL FROM conversations GROUP BY 1""",
)
def multi_turn_messages(spark, d):
    fields = MULTI_REPLY.removeprefix("turns ")
    turn = F.transform(
        "messages",
        lambda m, i: F.struct(
            F.when(m["role"] == "system", "tool").otherwise(m["role"]).alias("role"),
            m["content"].alias("content"),
            F.when(
                (m["role"] == "assistant") & (i % 4 == 1),
                F.struct(F.lit("click").alias("name"), F.lit("{}").alias("arguments")),
            ).alias("toolCall"),
            F.lit(None).cast("string").alias("toolCallId"),
        ),
    )
    built = _nested(spark, d).select("conv_id", F.struct(turn.cast(fields).alias("turns")).alias("r"))
    out = built.select("conv_id", F.posexplode(messages.multi_messages(F.col("r"), F.lit("system"))).alias("position", "m"))
    return out.select(
        "conv_id",
        "position",
        "m.role",
        F.md5("m.content").alias("content"),
        F.get("m.tool_calls", F.lit(0))["id"].alias("call"),
        F.col("m.tool_call_id").alias("answers"),
    )


@query(
    "assembled_examples",
    f"""SELECT doc_id, CASE doc_id % 4
        WHEN 0 THEN 'system user assistant' WHEN 1 THEN 'system user assistant tool tool assistant'
        WHEN 2 THEN 'system user assistant tool assistant' ELSE 'system user assistant' END AS roles,
    CASE doc_id % 4 WHEN 1 THEN 'call_' || doc_id || '_0 call_' || doc_id || '_1' WHEN 2 THEN 'call_0' ELSE '' END AS ids,
    md5(text) AS last_content FROM documents""",
)
def assembled_examples(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    simple = F.struct(F.lit("click").alias("name"), F.lit('{"k": 1}').alias("arguments"))
    none = F.array().cast("array<struct<name:string,arguments:string>>")
    kind = F.col("doc_id") % 4
    qa = F.struct(
        F.lit("question").alias("question"),
        F.col("text").alias("answer"),
        F.when(kind == 1, F.array(simple, simple)).otherwise(none).alias("toolCalls"),
        F.lit(None).cast("string").alias("reasoning"),
    )
    single = F.struct(
        F.lit("query").alias("userQuery"), simple.alias("toolCall"), F.lit("{}").alias("toolResult"),
        F.col("text").alias("assistantAnswer"),
    )
    refusal = F.struct(F.lit("query").alias("userQuery"), F.col("text").alias("refusalResponse"))
    system = F.lit(messages.QA_SYSTEM_LINE.format(product=PRODUCT, voice="v"))
    made = (
        F.when(kind < 2, messages.qa_messages(qa, F.col("doc_id"), system))
        .when(kind == 2, messages.single_messages(single, system))
        .otherwise(messages.refusal_messages(refusal, system))
    )
    out = docs.select("doc_id", made.alias("m"))
    ids = F.flatten(F.transform("m", lambda m: F.coalesce(F.transform(m["tool_calls"], lambda c: c["id"]), F.array())))
    return out.select(
        "doc_id",
        F.array_join(F.transform("m", lambda m: m["role"]), " ").alias("roles"),
        F.array_join(ids, " ").alias("ids"),
        F.md5(F.element_at("m", -1)["content"]).alias("last_content"),
    )


@query(
    "training_sink",
    "SELECT conv_id::VARCHAR AS id, count(*) AS messages, md5(string_agg(text, ' ' ORDER BY turn)) AS text FROM conversations GROUP BY 1",
)
def training_sink(spark, d):
    path = f"{checkpoint_dir(spark)}/training-{uuid.uuid4().hex}"
    named = F.transform(
        "messages",
        lambda m: messages.message(m["role"], m["content"], F.array(), F.lit(""), F.col("conv_id").cast("string")),
    )
    sinks.write_training(_nested(spark, d).withColumn("messages", named), path)
    back = readers.read_examples(spark, path)
    return back.select(
        F.get("messages", F.lit(0))["name"].alias("id"),
        F.size("messages").cast("bigint").alias("messages"),
        F.md5(messages.dedup_text(F.col("messages"))).alias("text"),
    )


@query(
    "eval_sink",
    """SELECT 'eval-factual-' || item_id AS id, 'factual' AS kind, md5('What follows? ' || text) AS prompt, md5(text) AS expected,
    item_id::VARCHAR AS chunks FROM benchmark""",
)
def eval_sink(spark, d):
    path = f"{checkpoint_dir(spark)}/eval-{uuid.uuid4().hex}"
    items = table(spark, d, "benchmark").select(
        F.concat(F.lit("eval-factual-"), "item_id").alias("id"),
        F.lit("factual").alias("kind"),
        F.concat(F.lit("What follows? "), "text").alias("prompt"),
        F.col("text").alias("expected"),
        F.lit(None).cast(f"array<{CALL}>").alias("expectedToolCalls"),
        F.array(F.col("item_id").cast("string")).alias("sourceChunks"),
    )
    sinks.write_eval(items, path)
    return readers.read_eval_items(spark, path).select(
        "id", "kind", F.md5("prompt").alias("prompt"), F.md5("expected").alias("expected"),
        F.array_join("sourceChunks", ",").alias("chunks"),
    )


# --- JSON values -----------------------------------------------------------------------

_RAW = """CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '[' || props || ']' WHEN 2 THEN props || '}'
    WHEN 3 THEN 'null' WHEN 4 THEN '"' || event_type || '"' ELSE '{"z": ' || event_id || ', "a": {"y": [2, 1], "b": ' || props || '}}' END"""
_MINI = "replace(props, ' ', '')"


def _raw():
    props, kind = F.col("props"), F.col("event_id") % 6
    nested = F.concat(F.lit('{"z": '), "event_id", F.lit(', "a": {"y": [2, 1], "b": '), props, F.lit("}}"))
    return (
        F.when(kind == 0, props)
        .when(kind == 1, F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == 2, F.concat(props, F.lit("}")))
        .when(kind == 3, F.lit("null"))
        .when(kind == 4, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .otherwise(nested)
    )


_NEST = f"""'{{"a":{{"b":' || {_MINI} || ',"y":[2,1]}},"z":' || event_id || '}}'"""


@query(
    "json_values",
    f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN {_MINI} WHEN 5 THEN {_NEST} ELSE '{{}}' END AS arguments,
    CASE event_id % 6 WHEN 0 THEN {_MINI} WHEN 1 THEN '[' || {_MINI} || ']' WHEN 2 THEN props || '}}' WHEN 3 THEN 'null'
        WHEN 4 THEN event_type ELSE {_NEST} END AS result,
    CASE event_id % 6 WHEN 0 THEN {_MINI} WHEN 1 THEN '[' || {_MINI} || ']' WHEN 2 THEN props || '}}' WHEN 3 THEN 'null'
        WHEN 4 THEN '"' || event_type || '"' ELSE {_NEST} END AS canonical FROM events""",
)
def json_values(spark, d):
    rows = table(spark, d, "events", "event_id", "event_type", "props").withColumn("raw", _raw())
    raw = F.col("raw")
    return rows.select(
        "event_id",
        F.to_json(jsons.tool_arguments(raw)).alias("arguments"),
        messages.recorded_text(raw).alias("result"),
        jsons.canonical_json(raw).alias("canonical"),
    )


# --- catalogue -----------------------------------------------------------------------------


def _gate_tools() -> list[dict]:
    def spec(name, parameters):
        return {"type": "function", "function": {"name": name, "description": f"Record a {name}.", "parameters": parameters}}

    number = {"type": "integer"}
    return [
        spec("click", {"type": "object", "properties": {"k": number}, "required": ["k"], "additionalProperties": False}),
        spec("view", {"type": "object", "properties": {"k": {"type": "integer", "enum": list(range(50))}}, "required": ["k"]}),
        spec("purchase", {"type": "object", "properties": {"k": number, "currency": {"type": "string"}}, "required": ["k", "currency"]}),
        spec("signup", {"type": "object", "properties": {"k": {"type": "string"}, "tags": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": False}),
    ]


_K = "regexp_extract(props, '\\d+')::INT"
_FAULTS = f"""CASE event_type WHEN 'click' THEN CASE WHEN event_id % 7 = 0 THEN '/ must NOT have additional properties' ELSE '' END
    WHEN 'view' THEN CASE WHEN {_K} < 50 THEN '' ELSE '/k must be equal to one of the allowed values' END
    WHEN 'purchase' THEN '/ must have required property ''currency'''
    WHEN 'signup' THEN CASE WHEN event_id % 7 = 0 THEN '/k must be string; /tags/1 must be string' ELSE '/k must be string' END
    ELSE 'unknown tool: ' || event_type END"""


def _gated(spark, d):
    events = table(spark, d, "events", "event_id", "user_id", "event_type", "props")
    body = F.rtrim(F.translate("props", "}", ""))
    extra = F.when(F.col("event_id") % 7 == 0, F.concat(body, F.lit(', "tags": ["a", 1]}'))).otherwise(F.col("props"))
    calls = events.select("event_id", "user_id", F.col("event_type").alias("name"), extra.alias("arguments"))
    return catalog.gate_calls(calls, _gate_tools())


@query("schema_gate", f"SELECT event_id, {_FAULTS} AS faults, {_FAULTS} = '' AS valid FROM events")
def schema_gate(spark, d):
    return _gated(spark, d).select("event_id", F.array_join("faults", "; ").alias("faults"), "valid")


@query(
    "gated_examples",
    f"SELECT event_id // 3 AS example FROM events GROUP BY 1 HAVING bool_and({_FAULTS} = '')",
)
def gated_examples(spark, d):
    calls = _gated(spark, d).withColumn("example", F.floor(F.col("event_id") / 3))
    return catalog.passing_examples(calls, "example")


_GATES_SQL = """CASE WHEN event_id % 11 = 0 THEN 'schema' WHEN event_id % 7 = 0 THEN 'parse' WHEN event_id % 5 = 0 THEN 'sandbox'
    WHEN event_id % 3 = 0 THEN 'fuzz' WHEN event_id % 13 = 0 THEN 'trajectory' END"""


def _gate_rows(spark, d):
    reasons = {
        gate: F.when(F.col("event_id") % step == 0, F.lit(f"every {step}"))
        for gate, step in zip(catalog.GATES, (11, 7, 5, 3, 13))
    }
    events = table(spark, d, "events", "event_id", "user_id")
    return events.select("event_id", (F.col("user_id") % 2).alias("round"), catalog.gate_result(reasons).alias("g")).select(
        "event_id", "round", F.col("g.pass").alias("passed"), "g.failed_gate", "g.reason"
    )


@query(
    "gate_funnel",
    f"""SELECT event_id, user_id % 2 AS round, g IS NULL AS passed, g AS failed_gate,
    'every ' || CASE g WHEN 'schema' THEN '11' WHEN 'parse' THEN '7' WHEN 'sandbox' THEN '5' WHEN 'fuzz' THEN '3' WHEN 'trajectory' THEN '13' END AS reason
    FROM (SELECT *, {_GATES_SQL} AS g FROM events)""",
)
def gate_funnel(spark, d):
    return _gate_rows(spark, d)


@query(
    "gate_failures",
    f"""WITH g AS (SELECT user_id % 2 AS round, {_GATES_SQL} AS g FROM events), r AS (SELECT DISTINCT round FROM g),
    n AS (SELECT unnest(['schema', 'parse', 'sandbox', 'fuzz', 'trajectory']) AS gate)
    SELECT r.round, gate, (SELECT count(*) FROM g WHERE g.round = r.round AND g.g = gate) AS failures FROM r, n""",
)
def gate_failures(spark, d):
    return catalog.failures_per_gate(_gate_rows(spark, d), group="round")


_DECLARED = [
    ('{"type": "object", "properties": {"k": {"type": "integer"}}, "required": ["k"]}', None),
    ('{"type": "objekt", "properties": {}}', "type must be known"),
    ('{"type": "object", "patternX": 1}', "unknown keyword: patternX"),
    ("not json", "not JSON"),
    ('[{"type": "object"}]', "schema must be object"),
    ('{"type": "object", "properties": {"k": {"type": "array", "items": {"type": "strin"}}}}', "type must be known"),
]


@query(
    "declared_schemas",
    "SELECT p_partkey, "
    + "CASE p_size % 6 "
    + " ".join(f"WHEN {i} THEN {text_sql(f) if f else 'NULL'}" for i, (_, f) in enumerate(_DECLARED))
    + " END AS fault FROM part",
)
def declared_schemas(spark, d):
    options = F.array(*[F.lit(s) for s, _ in _DECLARED])
    parameters = F.element_at(options, F.col("p_size") % 6 + 1)
    return table(spark, d, "part", "p_partkey", "p_size").select(
        "p_partkey", catalog.declared_schema_fault(parameters).alias("fault")
    )


_DENIED = [*catalog.BANNED_IDENTIFIERS, "the", "le", "der"]
_DENY_LIST = ", ".join(f"'{w}'" for w in _DENIED)


@query(
    "deny_scan",
    f"""SELECT doc_id, 'banned identifier: ' || list_filter(regexp_extract_all(text, '[A-Za-z_$][A-Za-z0-9_$]*'),
        lambda w: list_contains([{_DENY_LIST}], w))[1] AS reason FROM documents""",
)
def deny_scan(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", catalog.deny_reason(F.col("text"), _DENIED).alias("reason"))


@query(
    "execution_gate",
    """SELECT user_id, count(*) AS runs, count(*) FILTER (value >= 250) AS threw, count(*) FILTER (value < 250) AS good,
    CASE WHEN count(*) FILTER (value >= 250) > 0 THEN count(*) FILTER (value >= 250) || '/10 threw'
        WHEN count(*) FILTER (value < 250) < 65 THEN count(*) FILTER (value < 250) || '/10 serializable (need >=65)' END AS reason
    FROM events GROUP BY 1""",
)
def execution_gate(spark, d):
    runs = table(spark, d, "events", "user_id", "value").withColumn("ok", F.col("value") < 250)
    return catalog.execution_gate(runs, "user_id", "ok", min_good=65)


@query(
    "trajectory_gate",
    """WITH m AS (SELECT user_id, event_id, event_id % 50 = 0 AND user_id % 2 = 0 AS bad FROM events)
    SELECT user_id AS tool, count(*) AS runs, min(event_id) FILTER (bad) AS first_mismatch,
    CASE WHEN count(*) < 3 THEN '<3' WHEN bool_or(bad) THEN 'trajectory[' || min(event_id) FILTER (bad) || '] mismatch' END AS reason
    FROM m GROUP BY 1""",
)
def trajectory_gate(spark, d):
    events = table(spark, d, "events", "event_id", "user_id", "props")
    runs = events.select(F.col("user_id").alias("tool"), F.col("event_id").alias("run_no"), F.col("props").alias("result"))
    wrong = (F.col("run_no") % 50 == 0) & (F.col("tool") % 2 == 0)
    seen = runs.withColumn("result", F.when(wrong, F.lit("{}")).otherwise(F.translate("result", " ", "")))
    return catalog.trajectory_gate(runs, seen)


@query(
    "record_contract",
    """SELECT doc_id, concat_ws(',', CASE WHEN length(lang || source) NOT BETWEEN 10 AND 500 THEN 'question' END,
        CASE WHEN length(text) NOT BETWEEN 20 AND 2000 THEN 'answer' END) AS broken FROM documents""",
)
def record_contract(spark, d):
    docs = table(spark, d, "documents", "doc_id", "lang", "source", "text")
    contract = catalog.qa_contract(F.concat("lang", "source"), F.col("text"))
    return docs.select("doc_id", F.array_join(catalog.violations(contract), ",").alias("broken"))


@query(
    "offline_policy",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'not_found' WHEN event_type = 'purchase' AND value > 50 THEN 'offline_blocked' ELSE 'run' END AS decision,
    CASE WHEN event_type = 'purchase' AND value > 50 THEN '{"error":"This tool requires network. Device is offline."}' END AS payload FROM events""",
)
def offline_policy(spark, d):
    specs = [
        {"function": {"name": t}, "meta": {"requiresNetwork": t == "purchase"}} for t in TOOLS if t != "error"
    ]
    known = catalog.Catalogue(specs).frame(spark)
    calls = table(spark, d, "events", "event_id", "event_type", "value").withColumnRenamed("event_type", "tool")
    return catalog.call_policy(calls, known, F.col("value") <= 50).select("event_id", "decision", "payload")


@query(
    "first_per_name",
    """SELECT p_partkey, p_name, p_brand FROM part QUALIFY row_number() OVER (PARTITION BY regexp_replace(lower(p_name), '[_-]', '', 'g') ORDER BY p_partkey) = 1""",
)
def first_per_name(spark, d):
    return catalog.keep_first_by_name(table(spark, d, "part", "p_partkey", "p_name", "p_brand"), "p_name", "p_partkey")


@query(
    "retry_candidates",
    """WITH n AS (SELECT p_partkey, p_name || '_' || p_brand AS name, p_size FROM part),
    m AS (SELECT *, row_number() OVER (PARTITION BY regexp_replace(lower(name), '[_-]', '', 'g') ORDER BY p_partkey) AS r FROM n)
    SELECT p_partkey, name FROM m WHERE r = 1 AND name NOT IN (SELECT name FROM n WHERE p_size > 40 AND p_partkey % 2 = 0)""",
)
def retry_candidates(spark, d):
    parts = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size").select(
        "p_partkey", F.concat_ws("_", "p_name", "p_brand").alias("name"), "p_size"
    )
    first, retry = parts.filter("p_partkey % 2 = 0"), parts.filter("p_partkey % 2 = 1")
    left = catalog.merge_retry(first, retry, first.filter("p_size > 40"), "name", "p_partkey")
    return left.select("p_partkey", "name")


@query("capped_catalogue", "SELECT p_partkey, p_name FROM part WHERE p_size > 10 ORDER BY p_partkey LIMIT 12")
def capped_catalogue(spark, d):
    survivors = table(spark, d, "part", "p_partkey", "p_name", "p_size").filter("p_size > 10")
    chosen, _ = readers.survivors_or_fallback(survivors, survivors.limit(0))
    return catalog.final_catalogue(chosen, "p_partkey").select("p_partkey", "p_name")


# Catalogues of 18 parts each: two thirds are first candidates, the others wait for a retry. All five
# gates judge real schemas, bodies and logs, which the size of a part decides.
_FALLBACK = ["list_tables", "describe_table", "run_query", "explain_query", "list_roles", "list_buckets", "read_logs", "get_time"]
_NORM = "regexp_replace(lower(tool), '[_-]', '', 'g')"
_FUNNEL = f"""p AS MATERIALIZED (SELECT p_partkey // 18 AS catalogue, p_partkey % 3 = 0 AS later, p_size,
        (p_partkey % 3 = 0)::BIGINT * 1000000000 + p_partkey AS ordinal,
        p_partkey // 18 || '/' || CASE p_partkey % 2 WHEN 0 THEN 'Tool_' ELSE 'tool' END || p_partkey % 17 AS tool FROM part),
    g AS MATERIALIZED (SELECT *, {_NORM} AS norm, CASE WHEN p_size % 10 = 0 THEN 'schema' WHEN p_size % 9 = 1 THEN 'parse' WHEN p_size % 16 = 2 THEN 'sandbox'
        WHEN p_size % 7 = 3 THEN 'fuzz' WHEN p_size % 11 = 5 OR p_size % 6 = 4 THEN 'trajectory' END AS gate FROM p),
    one AS MATERIALIZED (SELECT * FROM g WHERE NOT later QUALIFY row_number() OVER (PARTITION BY norm ORDER BY ordinal) = 1),
    n1 AS (SELECT catalogue, count(*) FILTER (gate IS NULL) AS n, count(*) AS m FROM one GROUP BY 1),
    both_ AS MATERIALIZED (SELECT g.* FROM g JOIN n1 USING (catalogue) WHERE n BETWEEN 4 AND 7 QUALIFY row_number() OVER (PARTITION BY norm ORDER BY ordinal) = 1),
    two AS (SELECT * FROM both_ WHERE tool NOT IN (SELECT tool FROM one WHERE gate IS NULL)),
    judged AS MATERIALIZED (SELECT 1 AS round, * FROM one UNION ALL SELECT 2, * FROM two),
    n2 AS MATERIALIZED (SELECT n1.catalogue, n, m, coalesce(k, 0) AS k, CASE WHEN coalesce(k, 0) < 4 THEN 'fallback' WHEN n < 8 THEN 'retry' ELSE 'straight' END AS branch
        FROM n1 LEFT JOIN (SELECT catalogue, count(*) AS k FROM judged WHERE gate IS NULL GROUP BY 1) USING (catalogue))"""


def _discovered(spark, d):
    key, size = F.col("p_partkey"), F.col("p_size")
    name = F.concat(F.when(key % 2 == 0, F.lit("Tool_")).otherwise(F.lit("tool")), (key % 17).cast("string"))
    schema = '{"type": "%s", "properties": {"k": {"type": "integer"}}}'
    # A part of few bytes stands for a tool with a log, so parts are dealt out, once, before the log is made.
    tools = cut(spread(table(spark, d, "part", "p_partkey", "p_size"))).select(
        F.floor(key / 18).alias("catalogue"),
        (key % 3 == 0).alias("later"),
        ((key % 3 == 0).cast("bigint") * 1000000000 + key).alias("ordinal"),
        F.concat(F.floor(key / 18).cast("string"), F.lit("/"), name).alias("tool"),
        F.when(size % 10 == 0, F.lit(schema % "objekt")).otherwise(F.lit(schema % "object")).alias("parameters"),
        F.when(size % 9 == 1, F.lit("fetch(k)")).otherwise(F.lit("return k + 1")).alias("body"),
        "p_size",
    )
    smoke = tools.select(
        "tool", F.lit("smoke").alias("kind"), (size % 8 != 2).alias("ok"),
        F.when(size % 16 == 2, "timed out").when(size % 8 == 2, "TypeError: k is undefined").alias("error"),
    )
    tenth = tools.select("tool", "p_size", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i"))
    fuzz = tenth.select(
        "tool", F.lit("fuzz").alias("kind"), (~((size % 7 == 3) & (F.col("i") == 4))).alias("ok"), F.lit(None).cast("string").alias("error")
    )
    last = F.when(size % 11 == 5, 1).otherwise(2)
    runs = tools.select("tool", "p_size", F.explode(F.sequence(F.lit(0), last)).alias("run_no"))
    result = F.concat(F.lit('{"k": '), "run_no", F.lit(', "l": [1]}'))
    seen = F.when((size % 6 == 4) & (F.col("run_no") == 1), F.lit("{}")).otherwise(F.concat(F.lit('{"l":[1],"k":'), "run_no", F.lit("}")))
    observed = runs.select("tool", "run_no", result.alias("recorded"), seen.alias("observed"))
    columns = ["catalogue", "ordinal", "tool", "parameters", "body"]
    log = discovery.log_verdicts(smoke.unionByName(fuzz), observed)
    log = discovery.Verdicts(cut(log.smoke), cut(log.fuzz), cut(log.replayed))  # both rounds read it
    return discovery.discover_many(
        tools.filter("not later").select(*columns),
        tools.filter("later").select(*columns),
        lambda rows: discovery.judged_tools(rows, log),
        _FALLBACK,
    )


@query(
    "catalogue_branches",
    f"""WITH {_FUNNEL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY catalogue ORDER BY round, ordinal) AS r FROM judged WHERE gate IS NULL)
    SELECT catalogue, branch, round, ordinal, tool FROM ranked JOIN n2 USING (catalogue) WHERE branch <> 'fallback' AND r <= 12
    UNION ALL SELECT catalogue, branch, NULL, unnest(range(0, {len(_FALLBACK)})), unnest([{", ".join(f"'{n}'" for n in _FALLBACK)}]) FROM n2 WHERE branch = 'fallback'""",
)
def catalogue_branches(spark, d):
    return _discovered(spark, d).tools


@query(
    "catalogue_counts",
    f"""WITH {_FUNNEL}, d AS (SELECT catalogue, count(*) AS d FROM both_ GROUP BY 1),
    r AS (SELECT catalogue, count(*) AS raw, count(*) FILTER (NOT later) AS raw_first FROM p GROUP BY 1)
    SELECT catalogue, CASE WHEN n BETWEEN 4 AND 7 THEN raw ELSE raw_first END AS raw, coalesce(d, m) AS deduped,
        n AS first_survivors, k AS survivors, branch FROM n2 JOIN r USING (catalogue) LEFT JOIN d USING (catalogue)""",
)
def catalogue_counts(spark, d):
    return _discovered(spark, d).counts


@query(
    "catalogue_failures",
    f"""WITH {_FUNNEL}, gates AS (SELECT unnest(['schema', 'parse', 'sandbox', 'fuzz', 'trajectory']) AS gate)
    SELECT catalogue, gates.gate, count(judged.tool) AS failures FROM n2 CROSS JOIN gates LEFT JOIN judged USING (catalogue, gate) GROUP BY 1, 2""",
)
def catalogue_failures(spark, d):
    return catalog.failures_per_gate(_discovered(spark, d).gated, group="catalogue")


# --- quality -----------------------------------------------------------------------------------

_DIMS = """1 + 4 * quality AS faithfulness, 5 - 4 * toxic AS "toolCorrectness", (3 + doc_id % 3)::INT AS naturalness, 4 AS grounding"""


def _scores(spark, d):
    doc = F.col("doc_id")
    return table(spark, d, "labels").select(
        "doc_id",
        (1 + 4 * F.col("quality")).alias("faithfulness"),
        (5 - 4 * F.col("toxic")).alias("toolCorrectness"),
        (3 + doc % 3).cast("int").alias("naturalness"),
        F.lit(4).alias("grounding"),
    )


@query(
    "judge_acceptance",
    f"""SELECT doc_id, least(faithfulness, "toolCorrectness", naturalness, grounding) >= 4 AS accepted FROM (SELECT doc_id, {_DIMS} FROM labels)""",
)
def judge_acceptance(spark, d):
    dims = [F.col(x) for x in quality.DIMENSIONS]
    return _scores(spark, d).select("doc_id", quality.accepted(*dims).alias("accepted"))


@query("cross_check_sample", f"SELECT doc_id FROM documents WHERE {uniform_sql('jury-v1', 'doc_id + 1')} < 0.2")
def cross_check_sample(spark, d):
    return table(spark, d, "documents", "doc_id").filter(quality.cross_check_sample(F.col("doc_id")))


_SECOND = {
    dim: f"(1 + floor(5 * {score_sql(dim, 'doc_id')}))::INT" for dim in quality.DIMENSIONS
}


@query(
    "judge_disagreements",
    f"""WITH p AS (SELECT doc_id, {_DIMS} FROM labels WHERE {uniform_sql('jury-v1', 'doc_id + 1')} < 0.2),
    a AS (UNPIVOT p ON faithfulness, "toolCorrectness", naturalness, grounding INTO NAME dimension VALUE primary_score),
    b AS (SELECT doc_id, dimension, primary_score, CASE dimension """
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _SECOND.items())
    + """ END AS secondary_score FROM a)
    SELECT doc_id, dimension, primary_score, secondary_score FROM b WHERE abs(primary_score - secondary_score) > 1""",
)
def judge_disagreements(spark, d):
    primary = _scores(spark, d)
    second = primary.filter(quality.cross_check_sample(F.col("doc_id"))).select(
        "doc_id",
        *[(1 + F.floor(5 * hash_score(x, F.col("doc_id")))).cast("int").alias(x) for x in quality.DIMENSIONS],
    )
    return quality.disagreements(primary, second, "doc_id")


def _coverage(spark, d):
    events = table(spark, d, "events", "user_id", "event_type")
    used = events.groupBy("user_id").agg(F.collect_set("event_type").alias("tools"))
    known = spark.createDataFrame([(t,) for t in ["click", "view", "purchase", "refund"]], "tool string")
    return quality.tool_coverage(used, known, minimum=20)


_COVERAGE = """WITH u AS (SELECT event_type AS tool, count(DISTINCT user_id) AS n FROM events GROUP BY 1),
    a AS (SELECT tool FROM u UNION SELECT unnest(['click', 'view', 'purchase', 'refund'])),
    c AS (SELECT tool, coalesce(n, 0) AS examples FROM a LEFT JOIN u USING (tool))
    SELECT tool, examples, greatest(0, 20 - examples) AS deficit, greatest(0, examples - 20) AS surplus, examples >= 20 AS pass FROM c"""


@query("tool_coverage", _COVERAGE)
def tool_coverage(spark, d):
    return _coverage(spark, d)


@query("coverage_flag", f"SELECT bool_and(pass) AS pass FROM ({_COVERAGE})")
def coverage_flag(spark, d):
    return quality.coverage_passes(_coverage(spark, d))


@query(
    "counts_by_type",
    """SELECT t AS kind, (SELECT count(*) FROM events WHERE event_type = t AND value < 100) AS rows FROM (SELECT unnest(['click', 'view', 'refund']) AS t)
    UNION ALL SELECT 'rejected', count(*) FROM events WHERE NOT value < 100""",
)
def counts_by_type(spark, d):
    rows = table(spark, d, "events", "event_type", "value").withColumn("ok", F.col("value") < 100)
    return quality.counts_by_type(rows, "event_type", "ok", ["click", "view", "refund"])


@query(
    "strata_union",
    """SELECT 0 AS stratum, doc_id AS id FROM documents UNION ALL SELECT 1, item_id FROM benchmark UNION ALL SELECT 2, conv_id FROM conversations""",
)
def strata_union(spark, d):
    return quality.concatenated(
        table(spark, d, "documents").select(F.col("doc_id").alias("id")),
        table(spark, d, "benchmark").select(F.col("item_id").alias("id")),
        table(spark, d, "conversations").select(F.col("conv_id").alias("id")),
    )


_SIDE = score_sql(SALT, "doc_id")
_LEAK = f"""WITH used AS (SELECT DISTINCT doc_id + unnest([0, 1, 2]) AS id FROM documents WHERE {_SIDE} < 0.7),
    held AS (SELECT doc_id AS id FROM documents WHERE {_SIDE} >= 0.7)"""


def _leak_sides(spark, d):
    docs = table(spark, d, "documents", "doc_id").withColumn("train", hash_score(SALT, F.col("doc_id")) < 0.7)
    sources = F.array(*[F.col("doc_id") + i for i in range(3)])
    train = docs.filter("train").select(sources.alias("source_chunks"))
    return train, docs.filter("not train").select(F.col("doc_id").alias("id"))


@query("overlap_ids", f"{_LEAK} SELECT id FROM used WHERE id IN (SELECT id FROM held)")
def overlap_ids(spark, d):
    train, held = _leak_sides(spark, d)
    return leakage.overlap(train, "source_chunks", held, "id")


@query(
    "overlap_check",
    f"{_LEAK} SELECT count(*) AS overlap, count(*) = 0 AS pass FROM used WHERE id IN (SELECT id FROM held)",
)
def overlap_check(spark, d):
    train, held = _leak_sides(spark, d)
    return leakage.overlap_check(train, "source_chunks", held, "id")


_CONV = """conv AS MATERIALIZED (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations WHERE conv_id % 7 <> 3 GROUP BY 1)"""


def _curated(spark, d, embeddings=None, cosine=0.92):
    examples = _nested(spark, d).select(
        F.col("conv_id").alias("example_id"), "messages", F.array("conv_id").alias("source_chunks")
    )
    id_ = F.col("example_id")
    scores = examples.select(
        "example_id",
        *[F.when(id_ % 7 == 3, 3).otherwise(5).alias(x) for x in quality.DIMENSIONS],
        (id_ % 2).cast("int").alias("disagreements"),
    )
    known = spark.createDataFrame([("click",)], "tool string")
    held = table(spark, d, "benchmark").select(F.col("item_id").alias("id"))
    return curate(examples, scores, known, held, embeddings, cosine=cosine)


@query(
    "curation_funnel",
    f"""WITH {greedy_sql('conv', 'conv_id', 'text').replace('RECURSIVE ', 'RECURSIVE ' + _CONV + ', ', 1)}
    SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS generated,
        (SELECT count(*) FROM conv) AS accepted,
        (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id % 7 = 3) AS rejected,
        (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id % 2 = 1) AS disagreements,
        (SELECT count(*) FROM kept) AS after_minhash, (SELECT count(*) FROM kept) AS after_cosine""",
)
def curation_funnel(spark, d):
    return _curated(spark, d).funnel


@query(
    "curated_examples",
    f"""WITH {greedy_sql('conv', 'conv_id', 'text').replace('RECURSIVE ', 'RECURSIVE ' + _CONV + ', ', 1)}
    SELECT ord AS example_id FROM kept""",
)
def curated_examples(spark, d):
    return _curated(spark, d).training.select("example_id")


_CLOSE = 0.3  # the embeddings of the tables resemble each other little
_GREEDY_CONV = greedy_sql("conv", "conv_id", "text").replace("RECURSIVE ", "RECURSIVE " + _CONV + ", ", 1)


@query(
    "curation_with_embeddings",
    f"""WITH {_GREEDY_CONV}, v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IN (SELECT ord FROM kept)),
    near AS MATERIALIZED (SELECT a.vec_id AS src, b.vec_id AS dst FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= {_CLOSE}),
    turn AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM v),
    pace AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS k UNION ALL
        SELECT turn.n, CASE WHEN EXISTS (SELECT 1 FROM near WHERE near.dst = turn.vec_id AND list_contains(pace.k, near.src))
            THEN pace.k ELSE list_append(pace.k, turn.vec_id) END FROM pace JOIN turn ON turn.n = pace.n + 1),
    apart AS (SELECT unnest(k) AS ord FROM (SELECT k FROM pace ORDER BY n DESC LIMIT 1)),
    final AS (SELECT ord FROM kept WHERE ord NOT IN (SELECT vec_id FROM v) OR ord IN (SELECT ord FROM apart))
    SELECT c.conv_id AS example_id, c.conv_id % 7 <> 3 AS accepted, (c.conv_id % 2)::INT AS disagreements,
        c.conv_id IN (SELECT ord FROM kept) AS kept_minhash, c.conv_id IN (SELECT ord FROM final) AS kept_cosine
    FROM (SELECT DISTINCT conv_id FROM conversations) c""",
)
def curation_with_embeddings(spark, d):
    """Both near-duplicate filters in one flow: cosine sees what MinHash kept."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("example_id"), "embedding")
    return _curated(spark, d, vectors, _CLOSE).flags


# --- frames, replay, scoring -----------------------------------------------------------------

_O, _C = frames.OPEN_TAG, frames.CLOSE_TAG
_OUTPUT_KINDS = 6


@query(
    "tool_frames",
    f"""WITH o AS (SELECT conv_id * 100 + turn AS id, md5(text) AS t, turn % 6 AS k FROM conversations)
    SELECT id, 0 AS frame_no, 'text' AS kind, t AS text, NULL AS name, NULL AS args FROM o
    UNION ALL SELECT id, 1, CASE WHEN k IN (3, 4) THEN 'malformed' ELSE 'call' END, NULL, CASE WHEN k NOT IN (3, 4) THEN 'look' END,
        CASE WHEN k IN (0, 5) THEN '{{"a":1,"t":"{{}}"}}' WHEN k = 1 THEN '{{}}' WHEN k = 2 THEN '{{"b":[1,2]}}' END FROM o
    UNION ALL SELECT id, 2, 'text', md5(' tail'), NULL, NULL FROM o WHERE k IN (0, 1, 2, 3)
    UNION ALL SELECT id, 2, 'malformed', NULL, NULL, NULL FROM o WHERE k = 5""",
)
def tool_frames(spark, d):
    rows = table(spark, d, "conversations", "conv_id", "turn", "text")
    kind = F.col("turn") % 6
    named = '{"name": "look", "args": {"t": "{}", "a": 1}}'
    body = (
        F.when(kind == 0, F.lit(f"{_O}{named}{_C} tail"))
        .when(kind == 1, F.lit(f'{_O}{{"name": "look", "args": 3}} and more }}{_C} tail'))
        .when(kind == 2, F.lit(f'{_O} look {{"b": [1, 2]}}{_C} tail'))
        .when(kind == 3, F.lit(f"{_O}{{not json{_C} tail"))
        .when(kind == 4, F.lit(f"{_O}{named}"))
        .otherwise(F.lit(f"{_O}{named}{_C}{_O}"))
    )
    outputs = rows.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.concat("text", body).alias("output")
    )
    found = frames.tool_frames(outputs, "id", "output")
    return found.withColumn("text", F.when(F.col("kind") == "text", F.md5("text")))


@query(
    "replayed_calls",
    """SELECT p_partkey, CASE p_size % 5
    WHEN 0 THEN '{"path":"' || p_type || '/' || p_partkey || '/' || p_name || '"}'
    WHEN 1 THEN '{"tsType":"' || CASE WHEN p_partkey % 3 = 0 THEN 'string' WHEN p_partkey % 3 = 1 THEN 'number' ELSE 'unknown' END || '"}'
    WHEN 2 THEN CASE WHEN regexp_full_match(p_type, '[a-z][a-z0-9_-]*') THEN '{"valid":true}' ELSE '{"valid":false,"reason":"name must start with lowercase letter and contain only a-z, 0-9, hyphens, underscores"}' END
    WHEN 3 THEN '{"filename":"' || strftime(make_timestamp(p_partkey * 1000000000), '%Y%m%d%H%M%S') || '_' || regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') || '.sql"}'
    ELSE '{"policy":"CREATE POLICY \\"' || p_type || '_select_anon\\" ON public.' || p_type || ' FOR SELECT TO anon USING (auth.uid() = user_id);"}' END AS result
    FROM part""",
)
def replayed_calls(spark, d):
    parts = table(spark, d, "part", "p_partkey", "p_name", "p_type", "p_size")
    names = ["storage_path_builder", "column_type_mapper", "edge_function_name_validator", "migration_filename", "rls_policy_template"]
    kind = F.col("p_size") % 5
    key = F.col("p_partkey")
    sql_type = F.element_at(F.array(F.lit("UUID"), F.lit("int8"), F.lit("blob")), (key % 3 + 1).cast("int"))
    args = F.struct(
        F.col("p_type").alias("bucket"), key.cast("string").alias("userId"), F.col("p_name").alias("filename"),
        sql_type.alias("postgresType"), F.col("p_type").alias("name"), (key * 1000000).alias("timestampMs"),
        F.col("p_name").alias("description"), F.col("p_type").alias("tableName"), F.lit("anon").alias("role"),
        F.lit("select").alias("operation"),
    )
    calls = parts.select(
        "p_partkey",
        F.element_at(F.array(*[F.lit(n) for n in names]), kind + 1).alias("tool"),
        F.to_json(args).alias("arguments"),
    )
    return replay.replay_calls(calls, replay.catalogue_functions()).select("p_partkey", "result")


def _evaluation(spark, d):
    bench = table(spark, d, "benchmark")
    call = F.struct(
        F.lit("id").alias("id"), F.lit("function").alias("type"),
        F.struct(F.lit("click").alias("name"), F.lit('{"b": 1, "a": [2]}').alias("arguments")).alias("function"),
    )
    other = F.struct(
        F.lit("x").alias("id"), F.lit("function").alias("type"),
        F.struct(F.lit("click").alias("name"), F.when(F.col("item_id") % 8 == 0, '{"a":[2],"b":1}').otherwise('{"a":[2]}').alias("arguments")).alias("function"),
    )
    wants_call = F.col("item_id") % 4 == 0
    items = bench.select("item_id", F.col("text").alias("expected"), F.when(wants_call, F.array(call)).alias("expected_calls"))
    model = F.explode(F.array(F.lit("base"), F.lit("tuned"))).alias("model")
    rows = bench.select("item_id", "text", model)
    good = hash_score("eval", F.concat("model", F.col("item_id"))) < F.when(F.col("model") == "base", 0.4).otherwise(0.9)
    text = F.when(good, F.concat(F.lit("Well: "), "text", F.lit(" ?"))).otherwise(F.lit("no idea"))
    responses = rows.filter("item_id % 9 <> 1").select(
        "model", "item_id", text.alias("text"), F.when(wants_call, F.array(other)).alias("calls"),
        (F.col("item_id") * 3).cast("double").alias("latency_ms"),
    )
    return items, responses


_PASSED = f"""items AS (SELECT item_id, text, unnest(['base', 'tuned']) AS model FROM benchmark),
    s AS (SELECT *, item_id % 9 <> 1 AS answered, ('0x' || substr(sha256('eval:' || model || item_id), 1, 8))::BIGINT / 4294967296.0 < CASE model WHEN 'base' THEN 0.4 ELSE 0.9 END AS good FROM items),
    p AS (SELECT model, item_id, CASE WHEN answered THEN item_id * 3.0 END AS latency_ms,
        answered AND CASE WHEN item_id % 4 = 0 THEN item_id % 8 = 0
            ELSE good AND contains({answer_sql("'Well: ' || text || ' ?'")}, {answer_sql('text')}) AND {answer_sql('text')} <> '' END AS passed FROM s)"""


@query("scored_items", f"WITH {_PASSED} SELECT model, item_id, latency_ms::DOUBLE AS latency_ms, passed FROM p")
def scored_items(spark, d):
    items, responses = _evaluation(spark, d)
    return scoring.scored_items(items, responses, ["base", "tuned"])


@query(
    "model_summary",
    f"""WITH {_PASSED}
    SELECT model, true AS available, 100.0 * count(*) FILTER (passed) / count(*) AS score, count(*) FILTER (passed) AS passed,
        count(*) AS total, round(avg(latency_ms))::BIGINT AS latency_ms FROM p GROUP BY 1
    UNION ALL SELECT 'teacher', false, NULL, 0, (SELECT count(*) FROM benchmark), NULL""",
)
def model_summary(spark, d):
    items, responses = _evaluation(spark, d)
    return scoring.model_summary(items, responses, {"base": True, "tuned": True, "teacher": False})


@query("hooked_lengths", "SELECT doc_id, length(text)::BIGINT AS chars FROM documents")
def hooked_lengths(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    done = hooks.map_batches(docs, "text", lambda texts: [len(t) for t in texts], "chars", "bigint")
    return done.select("doc_id", "chars")
