"""Queries on splitting, planning, chunking, text functions and near-duplicates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siftwork.functions import minhash, text
from siftwork.functions.draws import hash_score, uniform, with_draws
from siftwork.functions.vectors import agreement, cosine
from siftwork.operators import catalog, chunking, dedup, messages, ordering, planning, prompts, splitting, vectors
from siftwork.plans.checks import (
    answer_sql,
    greedy_sql,
    pick_sql,
    score_sql,
    signature_sql,
    text_sql,
    trim_sql,
    uniform_sql,
    words_sql,
)
from siftwork.plans.registry import query, table
from siftwork.session import checkpoint_dir, cut
from siftwork.sources import readers, sinks

SALT = splitting.SALT
TOOLS = ["click", "view", "purchase", "signup", "error"]
PRODUCT = "Acme"
_SCORE = score_sql(SALT, "doc_id")
_SPLIT = f"CASE WHEN {_SCORE} < 0.7 THEN 'train' ELSE 'eval' END"


def documents(spark, d, *columns):
    return table(spark, d, "documents", *columns)


# --- splitting -----------------------------------------------------------------


@query("split_sides", f"SELECT doc_id, round({_SCORE}, 9) AS score, {_SPLIT} AS split FROM documents")
def split_sides(spark, d):
    docs = splitting.with_split(documents(spark, d, "doc_id"), "doc_id")
    return docs.select("doc_id", F.round(hash_score(SALT, F.col("doc_id")), 9).alias("score"), "split")


@query(
    "split_counts",
    f"""SELECT count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'eval') AS eval,
    round(count(*) FILTER (s = 'train') / count(*), 9) AS train_share FROM (SELECT {_SPLIT} AS s FROM documents)""",
)
def split_counts(spark, d):
    counts = splitting.split_counts(splitting.with_split(documents(spark, d, "doc_id"), "doc_id"))
    return counts.withColumn("train_share", F.round("train_share", 9))


@query(
    "split_fingerprint",
    f"""SELECT count(*) AS ids, sha256('{SALT}:' || string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id::VARCHAR)) AS fingerprint
    FROM documents WHERE {_SCORE} < 0.7""",
)
def split_fingerprint(spark, d):
    docs = splitting.with_split(documents(spark, d, "doc_id"), "doc_id").filter("split = 'train'")
    return splitting.split_fingerprint(docs, "doc_id")


def _tree(levels: str, source: str) -> str:
    return f"""SELECT substr(node, 1, {levels}) AS node,
    sha256('{SALT}:' || string_agg(digest, ',' ORDER BY digest)) AS digest FROM {source} GROUP BY 1"""


@query(
    "split_tree_fingerprint",
    f"""WITH leaf AS (SELECT sha256(doc_id::VARCHAR) AS node, doc_id::VARCHAR AS digest FROM documents WHERE {_SCORE} < 0.7),
    a AS ({_tree('4', 'leaf')}), b AS ({_tree('2', 'a')}), c AS ({_tree('0', 'b')})
    SELECT digest AS fingerprint FROM c""",
)
def split_tree_fingerprint(spark, d):
    docs = splitting.with_split(documents(spark, d, "doc_id"), "doc_id").filter("split = 'train'")
    return splitting.tree_fingerprint(docs, "doc_id")


@query(
    "split_completeness",
    f"""SELECT doc_id, CASE WHEN doc_id % 101 = 0 THEN 'lost' ELSE 'both sides' END AS fault FROM documents
    WHERE doc_id % 101 = 0 OR (doc_id % 97 = 0 AND {_SCORE} < 0.7)
    UNION ALL SELECT doc_id, 'repeated' FROM documents WHERE doc_id % 97 = 0 AND doc_id % 101 <> 0 AND {_SCORE} >= 0.7
    UNION ALL SELECT -1 - doc_id, 'added' FROM documents WHERE doc_id % 89 = 0""",
)
def split_completeness(spark, d):
    docs = documents(spark, d, "doc_id")
    split = splitting.with_split(docs, "doc_id").filter("doc_id % 101 <> 0")
    again = split.filter("doc_id % 97 = 0").withColumn("split", F.lit("eval"))
    strange = docs.filter("doc_id % 89 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("eval").alias("split"))
    return splitting.split_faults(docs, split.unionByName(again).unionByName(strange), "doc_id")


@query(
    "split_manifest_sink",
    f"SELECT doc_id, {_SPLIT} AS split FROM documents",
)
def split_manifest_sink(spark, d):
    path = f"{checkpoint_dir(spark)}/split-{uuid.uuid4().hex}"
    sinks.write_split(splitting.with_split(documents(spark, d, "doc_id"), "doc_id"), "doc_id", path)
    return readers.read_split(spark, path, "doc_id")


# --- order, limits, samples ------------------------------------------------------


@query(
    "source_ordinals",
    "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ordinal FROM documents",
)
def source_ordinals(spark, d):
    return ordering.position_within(documents(spark, d, "doc_id", "source"), "source", "doc_id", "ordinal")


@query(
    "round_robin_slices",
    "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 4)::INT AS slice FROM documents",
)
def round_robin_slices(spark, d):
    numbered = ordering.dense_ordinal(documents(spark, d, "doc_id"), "doc_id")
    return numbered.select("doc_id", ordering.slice_of(F.col("ordinal"), 4).alias("slice"))


@query(
    "head_tail_split",
    """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
    SELECT doc_id, CASE WHEN i < greatest(1, floor(n * 0.9)) THEN 'train' ELSE 'valid' END AS side FROM n""",
)
def head_tail_split(spark, d):
    return ordering.head_tail_split(documents(spark, d, "doc_id"), "doc_id")


@query("first_items", "SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 12")
def first_items(spark, d):
    return ordering.first_rows(table(spark, d, "benchmark"), "item_id", 12)


@query(
    "seeded_draws",
    f"SELECT doc_id, round({uniform_sql('jury-v1', 'doc_id + 1')}, 12) AS draw FROM documents",
)
def seeded_draws(spark, d):
    return documents(spark, d, "doc_id").select(
        "doc_id", F.round(uniform("jury-v1", F.col("doc_id") + 1), 12).alias("draw")
    )


@query(
    "persona_draws",
    f"""SELECT doc_id, {pick_sql('qa-gen-v1', '2 * doc_id + 1', planning.PERSONA_IDS)} AS persona,
    {pick_sql('qa-gen-v1', '2 * doc_id + 2', planning.DIFFICULTIES)} AS difficulty FROM documents""",
)
def persona_draws(spark, d):
    n = F.col("doc_id") * 2
    drawn = with_draws(documents(spark, d, "doc_id"), "qa-gen-v1", p=n + 1, q=n + 2)
    return drawn.select(
        "doc_id",
        planning.draw_persona(F.col("p")).alias("persona"),
        planning.draw_difficulty(F.col("q")).alias("difficulty"),
    )


@query(
    "inverse_frequency_sample",
    f"""WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT user_id, n, round(-ln((('0x' || substr(sha256('traj-v1:' || user_id), 1, 8))::BIGINT + 1) / 4294967297.0) * (n + 1), 6) AS race
    FROM c ORDER BY race LIMIT 25""",
)
def inverse_frequency_sample(spark, d):
    counts = table(spark, d, "events", "user_id").groupBy("user_id").agg(F.count("*").alias("n"))
    picked = planning.inverse_frequency_sample(counts, "user_id", "n", "traj-v1", 25)
    return picked.withColumn("race", F.round("race", 6))


_TOOL_LIST = ", ".join(f"'{t}'" for t in TOOLS)


@query(
    "distinct_picks",
    f"""WITH t AS (SELECT doc_id, unnest([{_TOOL_LIST}]) AS tool FROM documents),
    r AS (SELECT doc_id, tool, row_number() OVER (PARTITION BY doc_id ORDER BY sha256('traj-v1:' || doc_id || ':' || tool)) AS n FROM t)
    SELECT doc_id, string_agg(tool, ',' ORDER BY n) AS tools FROM r WHERE n <= 3 GROUP BY 1""",
)
def distinct_picks(spark, d):
    picked = planning.distinct_picks(F.col("doc_id"), TOOLS, 3, "traj-v1")
    return documents(spark, d, "doc_id").select("doc_id", F.array_join(picked, ",").alias("tools"))


# --- plans -------------------------------------------------------------------------

_TRAIN = f"""ring AS MATERIALIZED (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS o, count(*) OVER () AS n
    FROM documents WHERE {_SCORE} < 0.7),
size AS MATERIALIZED (SELECT count(*) AS n FROM ring)"""
_EVAL = _TRAIN.replace("< 0.7", ">= 0.7")


def _ids(plan: str, key: str = "idx") -> str:
    return f"""slots AS (SELECT {key}, unnest(range(0, size_)) AS j, start_ FROM {plan}),
got AS (SELECT s.{key}, string_agg(ring.doc_id::VARCHAR, ',' ORDER BY s.j) AS chunk_ids, string_agg(ring.text, e'\\n---\\n' ORDER BY s.j) AS context
    FROM slots s, size JOIN ring ON ring.o = (s.start_ + s.j) % size.n GROUP BY 1)"""


_QA_PLAN = f"""{_TRAIN},
plan AS MATERIALIZED (SELECT doc_id AS idx, {pick_sql('qa-gen-v1', '3 * doc_id + 1', planning.PERSONA_IDS)} AS persona,
    {pick_sql('qa-gen-v1', '3 * doc_id + 2', planning.DIFFICULTIES)} AS difficulty,
    floor({uniform_sql('qa-gen-v1', '3 * doc_id + 3')} * size.n)::BIGINT AS start_ FROM documents, size),
sized AS (SELECT *, CASE difficulty WHEN 'easy' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END AS size_ FROM plan),
{_ids('sized')}"""


def _train_docs(spark, d, *columns):
    return splitting.with_split(documents(spark, d, "doc_id", *columns), "doc_id").filter("split = 'train'")


def _qa_plan(spark, d):
    rows = documents(spark, d, "doc_id").withColumnRenamed("doc_id", "index")
    return planning.qa_plan(rows, _train_docs(spark, d), "doc_id")


@query(
    "question_plan",
    f"""WITH {_QA_PLAN} SELECT sized.idx AS index, persona, difficulty, start_ AS start, size_ AS size, chunk_ids
    FROM sized JOIN got USING (idx)""",
)
def question_plan(spark, d):
    return _qa_plan(spark, d).withColumn("chunk_ids", F.array_join("chunk_ids", ","))


def _tool_specs() -> list[dict]:
    names = {"click": "k", "view": "k", "purchase": "k", "signup": "k"}
    return [
        {
            "type": "function",
            "function": {
                "name": name,
                "description": f"Record one {name} event.",
                "parameters": {"type": "object", "properties": {key: {"type": "integer"}}, "required": [key]},
            },
        }
        for name, key in names.items()
    ]


def _case(column: str, values: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {text_sql(v)}" for k, v in values.items())
    return f"CASE {column} {whens} END"


def _qa_prompt_sql() -> str:
    label = _case("persona", {p[0]: p[1] for p in planning.PERSONAS})
    voice = _case("persona", {p[0]: p[2].replace("{product}", PRODUCT) for p in planning.PERSONAS})
    head, rest = prompts.QA_SYSTEM.split("{label}")
    mid, tail = rest.split("{voice}")
    tail = tail.replace("{product}", PRODUCT).replace("{tools}", prompts.tool_lines(_tool_specs()))
    system = f"{text_sql(head)} || {label} || {text_sql(mid)} || {voice} || {text_sql(tail)}"
    frame = _case("difficulty", prompts.QA_FRAMES)
    _, after = prompts.QA_USER.split("{frame}")
    before, end = after.split("{context}")
    user = f"{frame} || {text_sql(before)} || context || {text_sql(end)}"
    return f"""WITH {_QA_PLAN} SELECT sized.idx AS index, md5({system}) AS system, length({user}) AS user_chars, md5({user}) AS user
    FROM sized JOIN got USING (idx)"""


@query("question_prompts", _qa_prompt_sql())
def question_prompts(spark, d):
    plan = prompts.with_context(_qa_plan(spark, d), _train_docs(spark, d, "text"), "doc_id", "text")
    made = prompts.qa_prompts(plan, _tool_specs(), PRODUCT)
    return made.select(
        "index", F.md5("system").alias("system"), F.length("user").cast("bigint").alias("user_chars"), F.md5("user").alias("user")
    )


_LONGEST = 2000  # a reply that quotes more of its context is refused by the gate


@query(
    "retry_prompts",
    f"""WITH {_QA_PLAN} SELECT sized.idx AS index, CASE WHEN sized.idx % 3 < 2 THEN (sized.idx % 3 + 1)::INT END AS attempt,
    CASE WHEN sized.idx % 3 < 2 THEN length(context) + {len(prompts.RETRY_QA) - len('{reason}') + len(f'/quoted must be <= {_LONGEST}')} END AS grown
    FROM sized JOIN got USING (idx) WHERE length(context) > {_LONGEST}""",
)
def retry_prompts(spark, d):
    """Every reply is gated by its tool's schema; what the gate refuses is asked again with the fault."""
    plan = prompts.with_context(_qa_plan(spark, d), _train_docs(spark, d, "text"), "doc_id", "text")
    plan = cut(plan)  # the prompt table is handed to the generator, so it is stored once
    first = plan.select("index", F.lit("system").alias("system"), F.col("context").alias("user"))
    schema = {"type": "object", "properties": {"quoted": {"type": "integer", "maximum": _LONGEST}}, "required": ["quoted"]}
    tool = {"type": "function", "function": {"name": "answer", "description": "answer", "parameters": schema}}
    reply = F.to_json(F.struct(F.length("context").alias("quoted")))
    gated = catalog.gate_calls(plan.select("index", F.lit("answer").alias("name"), reply.alias("arguments")), [tool])
    rejected = gated.filter("not valid").select(
        "index", (F.col("index") % 3).cast("int").alias("attempt"), F.array_join("faults", "; ").alias("reason")
    )
    again, out = prompts.retry_round(first, rejected)
    return again.select("index", "attempt", F.length("user").cast("bigint").alias("grown")).unionByName(
        out.select("index"), allowMissingColumns=True
    )


_KIND = "['singleTurn', 'multiTurn', 'parallelDep', 'refusal'][doc_id % 4 + 1]"


_TRAJECTORY = f"""{_TRAIN},
    plan AS MATERIALIZED (SELECT doc_id AS idx, {_KIND} AS kind,
        {pick_sql('traj-v1', '8 * doc_id + 1', planning.PERSONA_IDS)} AS persona,
        {pick_sql('traj-v1', '8 * doc_id + 2', planning.DIFFICULTIES)} AS difficulty,
        floor({uniform_sql('traj-v1', '8 * doc_id + 3')} * size.n)::BIGINT AS start_,
        [3, 4, 3, 2][doc_id % 4 + 1] AS size_,
        CASE WHEN doc_id % 4 = 1 THEN 2 + floor({uniform_sql('traj-v1', '8 * doc_id + 5')} * 2) ELSE 2 END AS tools_n,
        CASE WHEN doc_id % 4 = 2 THEN CASE WHEN {uniform_sql('traj-v1', '8 * doc_id + 4')} < 0.5 THEN 'parallel' ELSE 'dependent' END END AS dependency
        FROM documents, size),
    t AS (SELECT idx, tools_n, unnest([{_TOOL_LIST}]) AS tool FROM plan),
    r AS (SELECT idx, tools_n, tool, row_number() OVER (PARTITION BY idx ORDER BY sha256('traj-v1:' || idx || ':' || tool)) AS n FROM t),
    picked AS (SELECT idx, string_agg(tool, ',' ORDER BY n) AS tools FROM r WHERE n <= tools_n GROUP BY 1),
    {_ids('plan')},
    named AS MATERIALIZED (SELECT plan.*, CASE kind WHEN 'singleTurn' THEN [{_TOOL_LIST}][plan.idx % 5 + 1] WHEN 'refusal' THEN '' ELSE picked.tools END AS tools
        FROM plan JOIN picked USING (idx))"""


@query(
    "trajectory_plan",
    f"""WITH {_TRAJECTORY}
    SELECT idx AS index, kind, persona, difficulty, start_ AS start, size_ AS size, tools, dependency, chunk_ids FROM named JOIN got USING (idx)""",
)
def trajectory_plan(spark, d):
    plan = _trajectory_plan(spark, d)
    return plan.withColumn("tools", F.array_join("tools", ",")).withColumn("chunk_ids", F.array_join("chunk_ids", ","))


def _trajectory_plan(spark, d):
    kinds = F.array(*[F.lit(k) for k in planning.TRAJECTORY_COUNTS])
    rows = documents(spark, d, "doc_id").select(
        F.col("doc_id").alias("index"), F.element_at(kinds, (F.col("doc_id") % 4 + 1).cast("int")).alias("kind")
    )
    return planning.trajectory_plan(rows, _train_docs(spark, d), "doc_id", TOOLS)


def _filled_sql(template: str, **values: str) -> str:
    """``template`` as SQL, with SQL expressions in its holes."""
    parts, rest = [], template.replace("{product}", PRODUCT)
    while rest:
        hits = [(rest.find("{%s}" % n), n) for n in values if "{%s}" % n in rest]
        if not hits:
            parts.append(text_sql(rest))
            break
        at, name = min(hits)
        parts += [text_sql(rest[:at]), values[name]]
        rest = rest[at + len(name) + 2 :]
    return "(" + " || ".join(parts) + ")"


_SCHEMA = '{"type":"object","properties":{"k":{"type":"integer"}},"required":["k"]}'


def _tools_sql(pattern: str, glue: str) -> str:
    one = pattern.format(name="@", description="Record one @ event.", schema=_SCHEMA)
    listed = f"list_transform(string_split(tools, ','), lambda t: replace({text_sql(one)}, '@', t))"
    return f"array_to_string({listed}, {text_sql(glue)})"


def _trajectory_prompt_sql() -> str:
    summaries = _tools_sql(prompts.TOOL_SUMMARY, "\n\n")
    explanation = _case("dependency", prompts.PARALLEL_EXPLANATION)
    names = "'`' || replace(tools, ',', '` and `') || '`'"
    system = {
        "singleTurn": _filled_sql(
            prompts.SINGLE_SYSTEM, name="tools", description="'Record one ' || tools || ' event.'", schema=text_sql(_SCHEMA)
        ),
        "multiTurn": _filled_sql(prompts.MULTI_SYSTEM, tools=summaries),
        "parallelDep": _filled_sql(
            prompts.PARALLEL_SYSTEM, tools=summaries, dependency="dependency", explanation=explanation
        ),
        "refusal": _filled_sql(prompts.REFUSAL_SYSTEM),
    }
    user = {
        "singleTurn": _filled_sql(prompts.SINGLE_USER, name="tools", context="context"),
        "multiTurn": _filled_sql(prompts.MULTI_USER, context="context"),
        "parallelDep": _filled_sql(prompts.PARALLEL_USER, names=names, context="context", dependency="dependency"),
        "refusal": _filled_sql(prompts.REFUSAL_USER, context="context"),
    }
    voice = _case("persona", {p[0]: p[2].replace("{product}", PRODUCT) for p in planning.PERSONAS})
    suffix = _filled_sql(prompts.DRAW_SUFFIX, voice=voice, difficulty="difficulty")

    def by_kind(texts: dict[str, str]) -> str:
        return "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in texts.items()) + " END"

    return f"""WITH {_TRAJECTORY} SELECT idx AS index, kind, md5({by_kind(system)}) AS system, md5({suffix}) AS suffix,
    md5({by_kind(user)}) AS user FROM named JOIN got USING (idx)"""


def _all_tool_specs() -> list[dict]:
    parameters = {"type": "object", "properties": {"k": {"type": "integer"}}, "required": ["k"]}
    return [
        {"type": "function", "function": {"name": n, "description": f"Record one {n} event.", "parameters": parameters}}
        for n in TOOLS
    ]


@query("trajectory_prompts", _trajectory_prompt_sql())
def trajectory_prompts(spark, d):
    plan = prompts.with_context(_trajectory_plan(spark, d), _train_docs(spark, d, "text"), "doc_id", "text")
    made = prompts.trajectory_prompts(plan, _all_tool_specs(), PRODUCT)
    return made.select("index", "kind", *[F.md5(c).alias(c) for c in ("system", "suffix", "user")])


_EVAL_SHARES = {"factual": 4, "reasoning": 1, "single-turn-tool": 2, "multi-turn-tool": 1}


_EVAL_PLAN = f"""{_EVAL}, total AS (SELECT count(*) // 8 AS u FROM documents),
    rows_ AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents),
    k AS (SELECT idx, u, CASE WHEN idx < 4*u THEN 'factual' WHEN idx < 5*u THEN 'reasoning' WHEN idx < 7*u THEN 'single-turn-tool'
        ELSE 'multi-turn-tool' END AS kind,
        CASE WHEN idx < 4*u THEN idx WHEN idx < 5*u THEN idx - 4*u WHEN idx < 7*u THEN idx - 5*u ELSE idx - 7*u END AS local FROM rows_, total),
    plan AS MATERIALIZED (SELECT idx, kind, CASE kind WHEN 'reasoning' THEN local * 3 ELSE local END % size.n AS start_,
        CASE kind WHEN 'reasoning' THEN 3 WHEN 'multi-turn-tool' THEN 2 ELSE 1 END AS size_,
        CASE kind WHEN 'single-turn-tool' THEN [{_TOOL_LIST}][local % 5 + 1]
            WHEN 'multi-turn-tool' THEN [{_TOOL_LIST}][local % 5 + 1] || ',' || [{_TOOL_LIST}][(local + 1) % 5 + 1] ELSE '' END AS tools
        FROM k, size),
    {_ids('plan')}"""


@query(
    "eval_plan",
    f"""WITH {_EVAL_PLAN}
    SELECT plan.idx AS index, 'eval-' || kind || '-' || plan.idx AS item_id, kind, start_ AS start, size_ AS size, tools, chunk_ids
    FROM plan JOIN got USING (idx)""",
)
def eval_plan(spark, d):
    plan = _eval_plan(spark, d)
    return plan.withColumn("tools", F.array_join("tools", ",")).withColumn("chunk_ids", F.array_join("chunk_ids", ","))


def _eval_docs(spark, d, *columns):
    return splitting.with_split(documents(spark, d, "doc_id", *columns), "doc_id").filter("split = 'eval'")


def _eval_plan(spark, d):
    docs = documents(spark, d, "doc_id")
    total = docs.count()
    rows = ordering.dense_ordinal(docs, "doc_id", out="index").select("index")
    counts = {k: s * (total // 8) for k, s in _EVAL_SHARES.items()}
    counts["multi-turn-tool"] += total % 8  # the rest, so that every row has a kind
    return planning.eval_plan(rows, _eval_docs(spark, d), "doc_id", TOOLS, counts)


_EVAL_SYSTEMS = "CASE kind " + " ".join(
    f"WHEN '{k}' THEN {_filled_sql(t, tools=_tools_sql(prompts.TOOL_EVAL_LINE, chr(10)))}"
    for k, t in prompts.EVAL_SYSTEM.items()
) + " END"


@query(
    "eval_prompts",
    f"""WITH {_EVAL_PLAN} SELECT plan.idx AS index, 'eval-' || kind || '-' || plan.idx AS item_id, kind,
    md5({_EVAL_SYSTEMS}) AS system, md5(context) AS user FROM plan JOIN got USING (idx)""",
)
def eval_prompts(spark, d):
    plan = prompts.with_context(_eval_plan(spark, d), _eval_docs(spark, d, "text"), "doc_id", "text")
    made = prompts.eval_prompts(plan, _all_tool_specs())
    return made.withColumn("system", F.md5("system")).withColumn("user", F.md5("user"))


_TYPES = list(planning.BOUNDARY) + ["date"]
_TYPE_LIST = ", ".join(f"'{t}'" for t in _TYPES)
_BOUNDARY = (
    "MAP {"
    + ", ".join(
        f"'{k}': [" + ", ".join(text_sql(v) for v in values) + "]" for k, values in planning.BOUNDARY.items()
    )
    + "}"
)


@query(
    "boundary_inputs",
    f"""WITH p AS (SELECT p_brand AS tool, p_type AS param, [{_TYPE_LIST}][min(p_size) % {len(_TYPES)} + 1] AS type FROM part GROUP BY 1, 2),
    r AS (SELECT tool, param, type, unnest(range(0, 10)) AS input_no FROM p)
    SELECT tool, input_no::INT AS input_no,
        '{{' || string_agg('"' || param || '":' || coalesce(({_BOUNDARY})[type][input_no + 1], 'null'), ',' ORDER BY param) || '}}' AS arguments
    FROM r GROUP BY 1, 2""",
)
def boundary_inputs(spark, d):
    kinds = F.array(*[F.lit(t) for t in _TYPES])
    params = (
        table(spark, d, "part", "p_brand", "p_type", "p_size")
        .groupBy(F.col("p_brand").alias("tool"), F.col("p_type").alias("param"))
        .agg(F.element_at(kinds, F.min("p_size") % len(_TYPES) + 1).alias("type"))
    )
    return planning.boundary_inputs(params)


def _design_sql():
    head, rest = prompts.DESIGN_CHUNK.split("{id}")
    middle, rest = rest.split("{source}")
    before, after = rest.split("{text}")
    chunk = f"{text_sql(head)} || doc_id || {text_sql(middle)} || source || {text_sql(before)} || text || {text_sql(after)}"
    first, rest = prompts.DESIGN_USER.replace("{product}", PRODUCT).split("{worker}")
    second, rest = rest.split("{n}")
    third, last = rest.split("{chunks}")
    user = f"""{text_sql(first)} || worker || {text_sql(second)} || count(*) || {text_sql(third)}
        || string_agg({chunk}, e'\\n\\n' ORDER BY doc_id) || {text_sql(last)}"""
    return f"""SELECT worker, length({user}) AS user_chars, md5({user}) AS user
        FROM (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS worker FROM documents) GROUP BY worker"""


@query("design_prompts", _design_sql())
def design_prompts(spark, d):
    """Eight chunks a worker, in key order."""
    numbered = ordering.dense_ordinal(documents(spark, d, "doc_id", "source", "text"), "doc_id")
    chunks = numbered.select(F.floor(F.col("ordinal") / 8).alias("worker"), "ordinal", F.col("doc_id").alias("id"), "source", "text")
    made = prompts.design_prompts(chunks, "worker", "ordinal", "Design tools.", PRODUCT)
    return made.select("worker", F.length("user").cast("bigint").alias("user_chars"), F.md5("user").alias("user"))


# Schemas three objects deep, with types that vary from part to part.
def _nested_sql():
    def value(step):
        return f"coalesce(({_BOUNDARY})[[{_TYPE_LIST}][(p_partkey + {step}) % {len(_TYPES)} + 1]][i + 1], 'null')"

    inner = f"""'{{"c":' || {value(2)} || '}}'"""
    middle = f"""'{{"b":' || {value(1)} || ',"inner":' || {inner} || '}}'"""
    return f"""'{{"a":' || {value(0)} || ',"outer":' || {middle} || '}}'"""


@query(
    "nested_boundary_inputs",
    f"SELECT p_partkey AS tool, i::INT AS input_no, {_nested_sql()} AS arguments FROM part, range(0, 10) r(i)",
)
def nested_boundary_inputs(spark, d):
    kinds = F.array(*[F.lit(t) for t in _TYPES])

    def member(name, step):
        kind = F.element_at(kinds, ((F.col("p_partkey") + step) % len(_TYPES) + 1).cast("int"))
        return F.concat(F.lit(f'"{name}": {{"type": "'), kind, F.lit('"}'))

    def nest(name, members):
        return F.concat(F.lit(f'"{name}": {{"type": "object", "properties": {{'), members, F.lit("}}"))

    comma = F.lit(", ")
    inner = nest("inner", member("c", 2))
    outer = nest("outer", F.concat(inner, comma, member("b", 1)))
    schema = F.concat(F.lit('{"type": "object", "properties": {'), outer, comma, member("a", 0), F.lit("}}"))
    parts = table(spark, d, "part", "p_partkey")
    return planning.nested_boundary_inputs(parts.select(F.col("p_partkey").alias("tool"), schema.alias("parameters")))


@query(
    "eval_expected_calls",
    f"""WITH {_EVAL_PLAN}, named AS (SELECT idx, kind, CASE WHEN tools = '' THEN []::VARCHAR[] ELSE string_split(tools, ',') END AS names FROM plan)
    SELECT 'eval-' || kind || '-' || idx AS item_id, 'eval_call_' || idx || '_' || (k - 1) AS call_id, names[k] AS name,
        CASE WHEN (idx + k) % 3 = 0 THEN '{{}}' ELSE '{{"k":' || idx || '}}' END AS arguments
    FROM (SELECT *, unnest(range(1, len(names) + 1)) AS k FROM named)""",
)
def eval_expected_calls(spark, d):
    """Replies name the planned tools; every third call has arguments that do not parse."""
    index = F.col("index")

    def reply(name, i):
        good = F.concat(F.lit('{ "k": '), index.cast("string"), F.lit(" }"))
        raw = F.when((index + i + 1) % 3 == 0, F.lit("{ k")).otherwise(good)
        return F.struct(name.alias("name"), raw.alias("arguments"))

    plan = _eval_plan(spark, d).withColumn("calls", F.transform("tools", reply))
    items = plan.select("item_id", F.explode(messages.expected_calls(F.col("calls"), index)).alias("call"))
    return items.select("item_id", F.col("call.id").alias("call_id"), "call.function.name", "call.function.arguments")


# --- chunks and text -------------------------------------------------------------


def _pack_sql(table_sql: str) -> str:
    """Recursive packing: one paragraph of every text per step."""
    t = "ceil(length({0}) / 4.0)::INT".format
    windows = (
        "[substr(p, i + 1, 500 * u) for i in range(0, length(p), 450 * u)]"
    )
    return f"""RECURSIVE txt AS ({table_sql}),
    para AS MATERIALIZED (SELECT id, list_filter(list_transform(string_split_regex(text, '\\n+'), lambda x: {trim_sql('x')}), lambda x: x <> '') AS ps FROM txt),
    item AS MATERIALIZED (SELECT id, unnest(ps) AS p, unnest(range(1, len(ps) + 1)) AS n, len(ps) AS m FROM para),
    sized AS MATERIALIZED (SELECT *, {t('p')} AS pt, greatest(1, length(p) // greatest(1, {t('p')})) AS u FROM item),
    fold AS (
        SELECT id, 0::BIGINT AS n, ''::VARCHAR AS buf, 0 AS tok, []::VARCHAR[] AS done FROM para
        UNION ALL
        SELECT f.id, s.n,
            CASE WHEN pt > 500 THEN '' WHEN tok + pt > 500 THEN right(buf, 200) || e'\\n\\n' || p
                WHEN buf = '' THEN p ELSE buf || e'\\n\\n' || p END,
            CASE WHEN pt > 500 THEN 0 WHEN tok + pt > 500 THEN {t("(right(buf, 200) || e'\\n\\n' || p)")} ELSE tok + pt END,
            CASE WHEN pt > 500 THEN list_concat(CASE WHEN buf = '' THEN []::VARCHAR[] ELSE [buf] END, {windows})
                WHEN tok + pt > 500 THEN [buf] ELSE []::VARCHAR[] END
        FROM fold f JOIN sized s ON s.id = f.id AND s.n = f.n + 1),
    last AS (SELECT id, max(n) AS n FROM fold GROUP BY 1),
    outs AS (SELECT id, n, 0 AS z, done FROM fold UNION ALL
        SELECT f.id, f.n, 1, [buf] FROM fold f JOIN last USING (id, n) WHERE buf <> ''),
    flat AS (SELECT id, n, z, unnest(done) AS text, unnest(range(0, len(done))) AS j FROM outs),
    chunk AS (SELECT id AS source, text, (row_number() OVER (PARTITION BY id ORDER BY n, z, j) - 1)::INT AS ordinal FROM flat)"""


@query(
    "chunk_packing",
    f"""WITH {_pack_sql("SELECT 'doc' || doc_id AS id, text FROM documents")}
    SELECT source || '.txt#' || CASE WHEN ordinal < 10000 THEN lpad(ordinal::VARCHAR, 4, '0') ELSE ordinal::VARCHAR END AS id,
        source, md5(text) AS text, ceil(length(text) / 4.0)::INT AS token_count, ordinal FROM chunk""",
)
def chunk_packing(spark, d):
    docs = documents(spark, d, "doc_id", "text").withColumn("source", F.concat(F.lit("doc"), "doc_id"))
    chunks = chunking.chunk_texts(docs, "source", "text", separator="\n+")
    return chunks.withColumn("text", F.md5("text"))


_ALL_TEXTS = """SELECT 'documents/' || doc_id AS id, text FROM documents UNION ALL
    SELECT 'benchmark/' || item_id, text FROM benchmark UNION ALL SELECT 'pages/' || page_id, html FROM pages"""


@query(
    "corpus_build",
    f"""WITH {_pack_sql(_ALL_TEXTS)},
    c AS (SELECT string_split(source, '/')[1] AS kind, count(*) AS chunks, sum(ceil(length(text) / 4.0)::INT)::BIGINT AS tokens FROM chunk GROUP BY 1),
    s AS (SELECT string_split(id, '/')[1] AS kind, sum(length(text))::BIGINT AS source_chars FROM txt GROUP BY 1)
    SELECT kind, chunks, tokens, source_chars FROM c JOIN s USING (kind)""",
)
def corpus_build(spark, d):
    def named(name, key, text_column):
        return table(spark, d, name, key, text_column).select(
            F.concat(F.lit(f"{name}/"), F.col(key)).alias("source"), F.col(text_column).alias("text")
        )

    texts = named("documents", "doc_id", "text").unionByName(named("benchmark", "item_id", "text"))
    texts = texts.unionByName(named("pages", "page_id", "html"))
    kind = F.split("source", "/")[0].alias("kind")
    chunks = chunking.chunk_texts(texts, "source", "text", separator="\n+")
    counted = chunks.groupBy(kind).agg(F.count("*").alias("chunks"), F.sum("token_count").alias("tokens"))
    return counted.join(texts.groupBy(kind).agg(F.sum(F.length("text")).alias("source_chars")), "kind")


@query(
    "oversize_windows",
    """WITH s AS (SELECT doc_id, text, greatest(1, length(text) // ceil(length(text) / 4.0)::INT) AS u FROM documents WHERE length(text) > 2000),
    w AS (SELECT doc_id, text, u, unnest(range(0, length(text), 450 * u)) AS i FROM s)
    SELECT doc_id, (i // (450 * u))::INT AS n, md5(substr(text, i + 1, 500 * u)) AS part FROM w""",
)
def oversize_windows(spark, d):
    docs = documents(spark, d, "doc_id", "text").filter(F.length("text") > 2000)
    parts = F.posexplode(chunking.oversize_windows(F.col("text"))).alias("n", "part")
    return docs.select("doc_id", parts).withColumn("part", F.md5("part"))


@query(
    "paragraphs",
    f"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\\n+'), lambda x: {trim_sql('x')}), lambda x: x <> '') AS ps FROM documents)
    SELECT doc_id, unnest(range(0, len(ps)))::INT AS n, md5(unnest(ps)) AS paragraph FROM p""",
)
def paragraphs(spark, d):
    parts = F.posexplode(text.paragraphs(F.col("text"), "\n+")).alias("n", "paragraph")
    return documents(spark, d, "doc_id", "text").select("doc_id", parts).withColumn("paragraph", F.md5("paragraph"))


@query(
    "source_sizes",
    """SELECT source, count(*) AS texts, sum(length(text))::BIGINT AS chars, sum(ceil(length(text) / 4.0)::INT)::BIGINT AS tokens
    FROM documents GROUP BY 1""",
)
def source_sizes(spark, d):
    return chunking.source_sizes(documents(spark, d, "source", "text"), "source", "text")


@query(
    "token_counts", "SELECT doc_id, ceil(length(text) / 4.0)::INT AS tokens FROM documents"
)
def token_counts(spark, d):
    return documents(spark, d, "doc_id", "text").select("doc_id", text.token_count(F.col("text")).alias("tokens"))


@query(
    "answer_normalise",
    f"SELECT doc_id, md5({answer_sql('text')}) AS answer, length({answer_sql('text')}) AS chars FROM documents",
)
def answer_normalise(spark, d):
    answer = text.normalise_answer(F.col("text"))
    return documents(spark, d, "doc_id", "text").select(
        "doc_id", F.md5(answer).alias("answer"), F.length(answer).cast("bigint").alias("chars")
    )


@query("truncated_texts", "SELECT doc_id, md5(left(text, 400)) AS head FROM documents")
def truncated_texts(spark, d):
    return documents(spark, d, "doc_id", "text").select("doc_id", F.md5(text.truncate(F.col("text"))).alias("head"))


@query(
    "word_shingles",
    f"""WITH w AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
    g AS (SELECT doc_id, CASE WHEN len(w) < 3 THEN []::VARCHAR[] ELSE list_distinct(
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w)
    SELECT doc_id, len(g)::INT AS shingles, md5(list_min(list_transform(g, lambda x: md5(x)))) AS lowest FROM g""",
)
def word_shingles(spark, d):
    grams = documents(spark, d, "doc_id", "text").select("doc_id", text.shingles(F.col("text")).alias("g"))
    return grams.select(
        "doc_id",
        F.size("g").alias("shingles"),
        F.md5(F.array_min(F.transform("g", lambda g: F.md5(g)))).alias("lowest"),
    )


# --- near-duplicates ---------------------------------------------------------------


@query(
    "minhash_signatures",
    f"WITH {signature_sql('documents', 'doc_id', 'text')} SELECT ord AS doc_id, md5(list_aggregate(s, 'string_agg', '')) AS signature FROM sig",
)
def minhash_signatures(spark, d):
    signed = minhash.with_signature(dedup.spread(documents(spark, d, "doc_id", "text"), "doc_id", "text"), "text")
    hexes = F.transform("signature", lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))
    return signed.select("doc_id", F.md5(F.array_join(hexes, "")).alias("signature"))


@query(
    "near_duplicates",
    f"WITH {greedy_sql('documents', 'doc_id', 'text')} SELECT doc_id, source, lang FROM documents JOIN kept ON kept.ord = doc_id",
)
def near_duplicates(spark, d):
    docs = documents(spark, d, "doc_id", "text", "source", "lang")
    return dedup.drop_near_duplicates(docs, "doc_id", "text").select("doc_id", "source", "lang")


@query(
    "duplicate_matches",
    f"""WITH {greedy_sql('documents', 'doc_id', 'text')},
    hit AS (SELECT dst, min(src) AS kept_, arg_min(agree, src) AS agree FROM edge
        WHERE src IN (SELECT ord FROM kept) AND dst NOT IN (SELECT ord FROM kept) GROUP BY 1)
    SELECT ord, coalesce(kept_, first) AS kept, coalesce(agree / 128.0, 1.0)::DOUBLE AS agreement
    FROM copies LEFT JOIN hit ON hit.dst = first WHERE ord <> first OR kept_ IS NOT NULL""",
)
def duplicate_matches(spark, d):
    return dedup.duplicate_matches(documents(spark, d, "doc_id", "text"), "doc_id", "text")


def _vector_sql(threshold: float) -> str:
    return f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    edge AS MATERIALIZED (SELECT a.vec_id AS src, b.vec_id AS dst FROM v a JOIN v b ON a.vec_id < b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= {threshold}),
    line AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM v),
    walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS k UNION ALL
        SELECT line.n, CASE WHEN EXISTS (SELECT 1 FROM edge WHERE edge.dst = line.vec_id AND list_contains(walk.k, edge.src))
            THEN walk.k ELSE list_append(walk.k, line.vec_id) END FROM walk JOIN line ON line.n = walk.n + 1)
    SELECT vec_id, label FROM embeddings WHERE vec_id IN (SELECT unnest(k) FROM (SELECT k FROM walk ORDER BY n DESC LIMIT 1))"""


@query("similar_vectors_dropped", _vector_sql(0.92))
def similar_vectors_dropped(spark, d):
    rows = table(spark, d, "embeddings")
    return vectors.drop_similar_vectors(rows, "vec_id", "embedding").select("vec_id", "label")


@query("similar_vectors_dropped_loose", _vector_sql(0.4))
def similar_vectors_dropped_loose(spark, d):
    rows = table(spark, d, "embeddings")
    return vectors.drop_similar_vectors(rows, "vec_id", "embedding", 0.4).select("vec_id", "label")


@query(
    "similar_vectors",
    """WITH v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
    SELECT a.vec_id AS src, b.vec_id AS dst, round(list_cosine_similarity(a.e, b.e), 6) AS cosine
    FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.4""",
)
def similar_vectors(spark, d):
    pairs = vectors.similar_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", 0.4)
    return pairs.withColumn("cosine", F.round("cosine", 6))


@query(
    "vector_scalars",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_transform(embedding, lambda x: x > 0) AS s FROM embeddings)
    SELECT a.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS cosine,
        round(len(list_filter(list_zip(a.s, b.s), lambda z: z[1] = z[2])) / 64.0, 6) AS agreement
    FROM v a JOIN v b ON b.vec_id = a.vec_id + 1""",
)
def vector_scalars(spark, d):
    signs = F.transform("embedding", lambda x: x > 0)
    rows = table(spark, d, "embeddings", "vec_id", "embedding").withColumn("signs", signs)
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("e2"), F.col("signs").alias("s2"))
    return rows.join(after, "vec_id").select(
        "vec_id",
        F.round(cosine(F.col("embedding"), F.col("e2")), 6).alias("cosine"),
        F.round(agreement(F.col("signs"), F.col("s2")), 6).alias("agreement"),
    )
