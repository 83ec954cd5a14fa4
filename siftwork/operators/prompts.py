"""Prompt tables for an external batch generator.

A plan row and the texts of its chunks give one ``(system, user)`` pair. The
wording is fixed; ``product`` names the documented product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators.planning import PERSONAS

CHUNK_RULE = "\n---\n"

# Prompt wording. The generator's output depends on every word.
QA_SYSTEM = """Persona: {label}. {voice}

You are generating training data for a {product} specialist model.
Ground every answer in the provided documentation.

Available tools:
{tools}

If the question naturally involves one of the listed tools, include a toolCalls array
with the tool name and arguments as a JSON string containing one object (keys/values per the tool schema).
NEVER invent tool names or argument fields not in the schema.
If no tool is relevant, omit toolCalls entirely."""
QA_NO_TOOLS = "  (no tools available)"
QA_FRAMES = {
    "easy": "Generate a straightforward factual question answerable from one paragraph in the context below.",
    "medium": "Generate a question that requires synthesizing information from multiple paragraphs below.",
    "hard": "Generate a multi-hop reasoning question that requires connecting concepts across the context below, possibly involving tool usage.",
}
QA_USER = """{frame}

[CONTEXT]
{context}
[/CONTEXT]

Respond with the question and answer. Ground every claim in the context."""
EVAL_SYSTEM = {
    "factual": "Generate a factual question answerable from the documentation below. Include the expected answer.",
    "reasoning": "Generate a multi-hop reasoning question requiring synthesis across the documentation below. Include the expected answer.",
    "single-turn-tool": "Generate a user query that requires calling exactly one of these tools with correct arguments:\n{tools}\nInclude the expected tool call.",
    "multi-turn-tool": "Generate a multi-turn user scenario (2-4 turns) that requires calling 2+ of these tools:\n{tools}\nInclude all expected tool calls in order.",
}
SINGLE_SYSTEM = """You are generating a training example for a {product} specialist model.
The model will learn to use the tool `{name}`: {description}.
Schema: {schema}

Rules:
- The tool call arguments MUST conform exactly to the parameter schema above.
- Use ONLY valid enum values where specified.
- The assistant answer must be helpful, grounded, and reference the tool result.
- Do NOT invent tools or argument names that are not in the schema."""
SINGLE_USER = """Generate a realistic user query that requires invoking `{name}` with valid arguments.
Ground the scenario in the following documentation context:

[CONTEXT]
{context}
[/CONTEXT]

Respond with:
1. A natural user query (userQuery)
2. The exact tool call: name plus arguments as a JSON string (toolCall)
3. A plausible tool result as a JSON string (toolResult)
4. The assistant's final answer incorporating the result (assistantAnswer)"""
MULTI_SYSTEM = """You are generating a multi-turn conversation training example for a {product} specialist model.
The model will learn to use tools across multiple conversation turns.

Available tools:
{tools}

Rules:
- Generate a 2-6 turn conversation with interleaved tool calls and user follow-ups.
- Each tool call MUST conform to its parameter schema exactly.
- Use ONLY valid enum values where specified.
- Tool responses should be plausible results.
- Each turn must have role, content, toolCall, and toolCallId.
- If a field is not used in that turn, set it to null. Never omit keys.
- Assistant turns that call a tool must include a toolCall object and toolCallId must be null.
- Assistant turns that do not call a tool must set toolCall to null.
- Tool turns must include toolCallId matching the previous assistant call and set toolCall to null.
- User turns must set both toolCall and toolCallId to null.
- The conversation should feel natural, not forced."""
MULTI_USER = """Generate a realistic multi-turn conversation where the user asks follow-up questions
that require different tool invocations. Use 2-3 of the available tools across the conversation.

Ground the conversation in:

[CONTEXT]
{context}
[/CONTEXT]

Return an array of turns. Each turn MUST include role, content, toolCall, and toolCallId.
Use null for unused fields. toolCall is only for assistant tool-call turns. toolCallId is only for tool response turns."""
PARALLEL_SYSTEM = """You are generating a training example for a {product} specialist model that needs to invoke MULTIPLE tools in a single turn.

Available tools:
{tools}

Dependency type: {dependency}
{explanation}

Rules:
- The user query must naturally require BOTH tools.
- Each tool call MUST conform to its parameter schema exactly.
- Use ONLY valid enum values where specified.
- Provide plausible results for each tool call.
- The assistant answer must synthesize results from both tool calls."""
PARALLEL_EXPLANATION = {
    "parallel": "The two tool calls are INDEPENDENT — they can be executed in parallel with separate arguments.",
    "dependent": "The two tool calls are DEPENDENT — the second call's arguments should reference or depend on the first call's result.",
}
PARALLEL_USER = """Generate a realistic user query that requires invoking both {names}.

Ground the scenario in:

[CONTEXT]
{context}
[/CONTEXT]

Return:
1. A natural user query (userQuery)
2. An array of 2 tool calls; each arguments field is a JSON string (serialized object) (toolCalls)
3. An array of 2 tool results as JSON strings (toolResults, same order as toolCalls)
4. The assistant's final answer synthesizing both results (assistantAnswer)
5. The dependency type: "{dependency}\""""
REFUSAL_SYSTEM = """You are generating a training example for a {product} specialist model.
In this scenario, the model must NOT call any tools. It must politely decline or answer from knowledge alone.

Scenarios that require refusal:
- Questions requiring live network data (API status, real-time metrics, current prices)
- Questions completely outside the {product} domain
- Ambiguous or unclear requests that need clarification before any action
- Requests for dangerous operations (DROP DATABASE, etc.) without confirmation

Rules:
- The response must NOT include any tool calls.
- The refusal should be polite, explain WHY no tool is appropriate, and suggest alternatives if possible.
- Keep the refusal concise but helpful."""
REFUSAL_USER = """Generate a user query where NO tool should be called.
The model must decline or answer from knowledge alone.

Context for grounding the scenario:

[CONTEXT]
{context}
[/CONTEXT]

Return:
1. A natural user query that should NOT trigger a tool call (userQuery)
2. A polite, helpful refusal or knowledge-only answer (refusalResponse)"""
DESIGN_USER = "Worker id: {worker}. Slice of {size} chunks below. Design 3–6 tools that could answer {product} developer questions grounded in these chunks.\n\n{context}"
RETRY_QA = "\n\n[PREVIOUS ATTEMPT REJECTED: {reason}. Fix the issue.]"
RETRY_TRAJECTORY = "\n\nPrevious attempt was rejected: {reason}. Fix the tool call arguments."
DRAW_SUFFIX = "\n\nPersona: {voice}\nDifficulty: {difficulty}"


def fill(template: str, **values: Column | str) -> Column:
    """``template`` with each ``{name}`` replaced by the column or text of that name."""
    parts: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.find("{%s}" % n), n) for n in values if "{%s}" % n in rest]
        if not hits:
            parts.append(F.lit(rest))
            break
        at, name = min(hits)
        if at:
            parts.append(F.lit(rest[:at]))
        value = values[name]
        parts.append(F.lit(value) if isinstance(value, str) else value)
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key)


def persona_field(persona: Column, field: int, product: str) -> Column:
    return lookup({p[0]: p[field].replace("{product}", product) for p in PERSONAS}, persona)


def with_context(plan: DataFrame, chunks: DataFrame, chunk_id: str, text: str) -> DataFrame:
    """Add ``context``: the chunk texts of ``chunk_ids`` in order, joined by a rule.

    Plan windows are at most a few chunks long, so each group stays small.
    """
    slots = plan.select("*", F.posexplode("chunk_ids").alias("_slot", "_id"))
    texts = chunks.select(F.col(chunk_id).cast("string").alias("_id"), F.col(text).alias("_text"))
    gathered = F.array_sort(F.collect_list(F.struct("_slot", "_text")))
    return (
        slots.join(texts, "_id")
        .groupBy(*plan.columns)
        .agg(F.array_join(F.transform(gathered, lambda s: s["_text"]), CHUNK_RULE).alias("context"))
    )


def tool_lines(tools: list[dict]) -> str:
    lines = [f"  - {t['function']['name']}: {t['function']['description']}" for t in tools]
    return "\n".join(lines) if lines else QA_NO_TOOLS


def qa_prompts(plan: DataFrame, tools: list[dict], product: str) -> DataFrame:
    """``(index, system, user)`` for a question plan with ``context``."""
    persona = F.col("persona")
    return plan.select(
        "index",
        fill(
            QA_SYSTEM,
            label=persona_field(persona, 1, product),
            voice=persona_field(persona, 2, product),
            product=product,
            tools=tool_lines(tools),
        ).alias("system"),
        fill(QA_USER, frame=lookup(QA_FRAMES, F.col("difficulty")), context=F.col("context")).alias("user"),
    )


def _summaries(tools: list[dict], names: Column, pattern: str, glue: str) -> Column:
    import json

    table = {
        t["function"]["name"]: pattern.format(
            name=t["function"]["name"],
            description=t["function"]["description"],
            schema=json.dumps(t["function"]["parameters"], separators=(",", ":"), ensure_ascii=False),
        )
        for t in tools
    }
    return F.array_join(F.transform(names, lambda n: lookup(table, n)), glue)


# How a tool is listed.
TOOL_SUMMARY = "Tool `{name}`: {description}\nParameter schema: {schema}"
TOOL_EVAL_LINE = "- {name}: {description} (params: {schema})"


def trajectory_prompts(plan: DataFrame, tools: list[dict], product: str) -> DataFrame:
    """``(index, kind, system, suffix, user)`` for a trajectory plan with ``context``.

    The generator is sent ``system`` (with any retry reason) and ``suffix``;
    ``system`` alone becomes the first message of the example.
    """
    context, names, kind = F.col("context"), F.col("tools"), F.col("kind")
    first = F.get(names, F.lit(0))
    suffix = fill(
        DRAW_SUFFIX,
        voice=persona_field(F.col("persona"), 2, product),
        difficulty=F.col("difficulty"),
    )
    summaries = _summaries(tools, names, TOOL_SUMMARY, "\n\n")
    dependency = F.col("dependency")
    system = (
        F.when(
            kind == "singleTurn",
            fill(
                SINGLE_SYSTEM,
                product=product,
                name=first,
                description=_summaries(tools, F.array(first), "{description}", ""),
                schema=_summaries(tools, F.array(first), "{schema}", ""),
            ),
        )
        .when(kind == "multiTurn", fill(MULTI_SYSTEM, product=product, tools=summaries))
        .when(
            kind == "parallelDep",
            fill(
                PARALLEL_SYSTEM,
                product=product,
                tools=summaries,
                dependency=dependency,
                explanation=lookup(PARALLEL_EXPLANATION, dependency),
            ),
        )
        .otherwise(fill(REFUSAL_SYSTEM, product=product))
    )
    pair = F.array_join(F.transform(names, lambda n: F.concat(F.lit("`"), n, F.lit("`"))), " and ")
    user = (
        F.when(kind == "singleTurn", fill(SINGLE_USER, name=first, context=context))
        .when(kind == "multiTurn", fill(MULTI_USER, context=context))
        .when(
            kind == "parallelDep",
            fill(PARALLEL_USER, names=pair, context=context, dependency=dependency),
        )
        .otherwise(fill(REFUSAL_USER, context=context))
    )
    return plan.select("index", "kind", system.alias("system"), suffix.alias("suffix"), user.alias("user"))


def eval_prompts(plan: DataFrame, tools: list[dict]) -> DataFrame:
    """``(index, item_id, kind, system, user)`` for an evaluation plan with ``context``."""
    lines = _summaries(tools, F.col("tools"), TOOL_EVAL_LINE, "\n")
    kind = F.col("kind")
    system = F.lit(None).cast("string")
    for name, template in EVAL_SYSTEM.items():
        system = F.when(kind == name, fill(template, tools=lines)).otherwise(system)
    return plan.select("index", "item_id", "kind", system.alias("system"), F.col("context").alias("user"))


def design_prompt(size: Column, worker: Column, context: Column, product: str) -> Column:
    """User prompt of one tool-design worker over its slice of chunks."""
    return fill(DESIGN_USER, worker=worker, size=size.cast("string"), product=product, context=context)


# Fixed value: the wrapper of a chunk in the tool-design prompt.
DESIGN_CHUNK = '<chunk id="{chunk}" source="{source}">\n{text}\n</chunk>'


def design_chunk(chunk: Column, source: Column, text: Column) -> Column:
    """One chunk in the tool-design prompt's wrapper."""
    return fill(DESIGN_CHUNK, chunk=chunk, source=source, text=text)


def retry_round(
    prompts: DataFrame, rejected: DataFrame, kind: str = "qa", max_retries: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Prompts to issue again, and plan rows that are out of retries.

    ``prompts`` has the first-attempt ``(index, system, user)`` and ``rejected``
    ``(index, attempt, reason)``. A rejected reply is never repaired: the row
    is generated again with the latest reason appended (to the user prompt for
    questions, to the system prompt otherwise), ``max_retries`` times at most.
    """
    joined = prompts.join(rejected, "index")
    system, user = F.col("system"), F.col("user")
    if kind == "qa":
        user = F.concat(user, fill(RETRY_QA, reason=F.col("reason")))
    else:
        system = F.concat(system, fill(RETRY_TRAJECTORY, reason=F.col("reason")))
    again = joined.filter(F.col("attempt") < max_retries).select(
        "index", (F.col("attempt") + 1).alias("attempt"), system.alias("system"), user.alias("user")
    )
    out = joined.filter(F.col("attempt") >= max_retries).select("index", "reason")
    return again, out


def eval_items(kind: Column, index: Column) -> Column:
    """``eval-{kind}-{index}``."""
    return F.concat_ws("-", F.lit("eval"), kind, index.cast("string"))


# How a slice of chunks is put to a tool designer. ``{product}`` is filled in by the caller.
DESIGN_USER = (
    "Worker id: {worker}. Slice of {n} chunks below. Design 3–6 tools that could answer {product} developer questions"
    " grounded in these chunks.\n\n{chunks}"
)
DESIGN_CHUNK = '<chunk id="{id}" source="{source}">\n{text}\n</chunk>'


def design_prompts(chunks: DataFrame, worker: str, order: str, system: str, product: str) -> DataFrame:
    """``(worker, system, user)`` per worker from chunks ``(worker, order, id, source, text)``.

    Workers hold slices of bounded size. The system prompt is the caller's, as it names
    the rules of the target device.
    """
    head, rest = DESIGN_CHUNK.split("{id}")
    middle, rest = rest.split("{source}")
    before, after = rest.split("{text}")
    wrapped = F.concat(F.lit(head), F.col("id").cast("string"), F.lit(middle), "source", F.lit(before), "text", F.lit(after))
    slices = chunks.groupBy(worker).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), wrapped.alias("c")))).alias("those")
    )
    first, rest = DESIGN_USER.replace("{product}", product).split("{worker}")
    second, rest = rest.split("{n}")
    third, last = rest.split("{chunks}")
    body = F.array_join(F.transform("those", lambda x: x["c"]), "\n\n")
    user = F.concat(F.lit(first), F.col(worker).cast("string"), F.lit(second), F.col("n").cast("string"), F.lit(third), body, F.lit(last))
    return slices.select(worker, F.lit(system).alias("system"), user.alias("user"))
