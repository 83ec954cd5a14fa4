"""Chat examples: assembling, cleaning, rendering and reshaping messages.

All functions on a nested ``messages`` column are projections: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.jsons import recorded_result, result_text, tool_arguments
from siftwork.functions.text import bind, trim_all
from siftwork.schemas import CALL, MESSAGES

# Content of the stub tool message, and the system line of QA examples.
STUB_RESULT = '{"result":"See answer below"}'
QA_SYSTEM_LINE = "You are a {product} specialist assistant. {voice}"


def message(
    role: Column | str,
    content: Column,
    calls: Column | None = None,
    call_id: Column | None = None,
    name: Column | None = None,
) -> Column:
    """One message struct; absent fields are null."""
    null = F.lit(None)
    return F.struct(
        (F.lit(role) if isinstance(role, str) else role).alias("role"),
        content.alias("content"),
        (null if calls is None else calls).cast(f"array<{CALL}>").alias("tool_calls"),
        (null if call_id is None else call_id).cast("string").alias("tool_call_id"),
        (null if name is None else name).cast("string").alias("name"),
    )


def tool_call(call_id: Column, name: Column, raw_arguments: Column) -> Column:
    return F.struct(
        call_id.alias("id"),
        F.lit("function").alias("type"),
        F.struct(
            name.alias("name"), F.to_json(tool_arguments(raw_arguments)).alias("arguments")
        ).alias("function"),
    )


def numbered_calls(calls: Column, prefix: Column) -> Column:
    """Call structs of ``array<struct<name,arguments>>`` with ids ``{prefix}{k}``."""
    return F.transform(
        calls,
        lambda c, k: tool_call(F.concat(prefix, k.cast("string")), c["name"], c["arguments"]),
    )


def expected_calls(calls: Column, index: Column) -> Column:
    """Expected calls of an evaluation item, in order, as ``eval_call_{index}_{k}``."""
    return numbered_calls(calls, F.concat(F.lit("eval_call_"), index.cast("string"), F.lit("_")))


def qa_messages(reply: Column, index: Column, system: Column) -> Column:
    """Messages of a question reply, with a stub tool message per call."""
    opening = F.array(message("system", system), message("user", reply["question"]))
    closing = F.array(message("assistant", reply["answer"]))
    prefix = F.concat(F.lit("call_"), index.cast("string"), F.lit("_"))

    def with_calls(calls: Column) -> Column:
        stubs = F.transform(
            calls, lambda c: message("tool", F.lit(STUB_RESULT), None, c["id"], c["function"]["name"])
        )
        asking = F.array(message("assistant", F.coalesce(reply["reasoning"], F.lit("")), calls))
        return F.concat(opening, asking, stubs, closing)

    has_calls = F.size(F.coalesce(reply["toolCalls"], F.array())) > 0
    return F.when(has_calls, bind(numbered_calls(reply["toolCalls"], prefix), with_calls)).otherwise(
        F.concat(opening, closing)
    )


def call_messages(
    system: Column, query: Column, calls: Column, results: Column, answer: Column
) -> Column:
    """One assistant message with all calls, their results by position, the answer."""

    def body(made: Column) -> Column:
        replies = F.transform(
            made,
            lambda c, k: message("tool", F.get(results, k), None, c["id"], c["function"]["name"]),
        )
        return F.concat(
            F.array(
                message("system", system),
                message("user", query),
                message("assistant", F.lit(""), made),
            ),
            replies,
            F.array(message("assistant", answer)),
        )

    return bind(numbered_calls(calls, F.lit("call_")), body)


def single_messages(reply: Column, system: Column) -> Column:
    return call_messages(
        system,
        reply["userQuery"],
        F.array(reply["toolCall"]),
        F.array(reply["toolResult"]),
        reply["assistantAnswer"],
    )


def parallel_messages(reply: Column, system: Column) -> Column:
    return call_messages(
        system, reply["userQuery"], reply["toolCalls"], reply["toolResults"], reply["assistantAnswer"]
    )


def multi_messages(reply: Column, system: Column) -> Column:
    """Turns with a running call number.

    A tool turn takes the id it names, else that of the last call.
    """

    def state(calls: Column, out: Column) -> Column:
        return F.struct(calls.cast("int").alias("calls"), out.alias("out"))

    def step(s: Column, turn: Column) -> Column:
        asks = (turn["role"] == "assistant") & turn["toolCall"].isNotNull()
        call_id = F.concat(F.lit("call_"), s["calls"].cast("string"))
        last_id = F.concat(F.lit("call_"), (s["calls"] - 1).cast("string"))
        made = F.array(
            tool_call(call_id, turn["toolCall"]["name"], turn["toolCall"]["arguments"])
        )
        entry = (
            F.when(asks, message("assistant", turn["content"], made))
            .when(
                turn["role"] == "tool",
                message("tool", turn["content"], None, F.coalesce(turn["toolCallId"], last_id)),
            )
            .otherwise(message(turn["role"], turn["content"]))
        )
        return state(s["calls"] + F.when(asks, 1).otherwise(0), F.concat(s["out"], F.array(entry)))

    start = state(F.lit(0), F.array(message("system", system)).cast(MESSAGES))
    return F.aggregate(reply["turns"], start, step, lambda s: s["out"])


def refusal_messages(reply: Column, system: Column) -> Column:
    return F.array(
        message("system", system),
        message("user", reply["userQuery"]),
        message("assistant", reply["refusalResponse"]),
    )


def recorded_text(raw: Column) -> Column:
    """Tool message text of a recorded result: strings stay, JSON is compacted."""
    return result_text(recorded_result(raw))


def clean_messages(messages: Column) -> Column:
    """Empty call lists, ids and names become null, so ``to_json`` leaves them out."""
    return F.transform(
        messages,
        lambda m: F.struct(
            m["role"].alias("role"),
            m["content"].alias("content"),
            F.when(F.size(m["tool_calls"]) > 0, m["tool_calls"]).alias("tool_calls"),
            F.nullif(m["tool_call_id"], F.lit("")).alias("tool_call_id"),
            F.nullif(m["name"], F.lit("")).alias("name"),
        ),
    )


def clean_tools(tools: Column) -> Column:
    """Tool specs without their ``meta``."""
    return F.transform(
        tools,
        lambda t: F.struct(
            t["type"].alias("type"),
            F.struct(
                t["function"]["name"].alias("name"),
                t["function"]["description"].alias("description"),
                t["function"]["parameters"].alias("parameters"),
            ).alias("function"),
        ),
    )


def dedup_text(messages: Column) -> Column:
    """Contents in order, joined by one blank; a missing content counts as empty."""
    return F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), " ")


def embed_text(messages: Column, limit: int = 8000) -> Column:
    return F.substring(dedup_text(messages), 1, limit)


def transcript(messages: Column) -> Column:
    """``[role]: content`` lines; calls follow as JSON on an indented line."""

    def line(m: Column) -> Column:
        head = F.concat(F.lit("["), m["role"], F.lit("]: "), m["content"])
        calls = F.concat(F.lit("\n  tool_calls: "), F.to_json(m["tool_calls"]))
        return F.concat(head, F.when(m["tool_calls"].isNotNull(), calls).otherwise(F.lit("")))

    return F.array_join(F.transform(messages, line), "\n")


def tool_names(messages: Column) -> Column:
    """Distinct names called anywhere in the example, in order of first use."""
    names = F.transform(
        F.filter(messages, lambda m: m["tool_calls"].isNotNull()),
        lambda m: F.transform(m["tool_calls"], lambda c: c["function"]["name"]),
    )
    return F.array_distinct(F.flatten(names))


def prompt_answer(examples: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``(prompt, answer)`` of nested examples; rows with an empty side are dropped.

    The prompt is the last user message. The answer is the name of the first
    call of the first assistant message with calls, else the last assistant
    message.
    """
    messages = F.coalesce(F.col("messages"), F.array().cast(MESSAGES))
    users = F.filter(messages, lambda m: m["role"] == "user")
    assistants = F.filter(messages, lambda m: m["role"] == "assistant")
    calling = F.filter(assistants, lambda m: F.size(m["tool_calls"]) > 0)
    called = F.get(calling, F.lit(0))["tool_calls"][0]["function"]["name"]
    spoken = trim_all(F.try_element_at(assistants, F.lit(-1))["content"])
    pairs = examples.select(
        *(keep or []),
        F.coalesce(trim_all(F.try_element_at(users, F.lit(-1))["content"]), F.lit("")).alias("prompt"),
        F.coalesce(called, spoken, F.lit("")).alias("answer"),
    )
    return pairs.filter("prompt <> '' and answer <> ''")


def prompt_answer_of_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The same from one row per turn (without calls).

    Last-of-role is a combinable aggregate, so a conversation of any length is
    reduced before the shuffle.
    """

    def last_of(name: str) -> Column:
        return F.max_by(F.col(text), F.when(F.col(role) == name, F.col(turn)))

    last = turns.groupBy(conv).agg(
        last_of("user").alias("prompt"), last_of("assistant").alias("answer")
    )
    cut = last.select(conv, trim_all(F.col("prompt")).alias("prompt"), trim_all(F.col("answer")).alias("answer"))
    return cut.filter("prompt <> '' and answer <> ''")


def ends_by_role(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """First and last message of every role in every conversation."""
    return turns.groupBy(conv, role).agg(
        F.min_by(text, turn).alias("first_text"), F.max_by(text, turn).alias("last_text")
    )


def nest_turns(
    turns: DataFrame, conv: str, turn: str, role: str, text: str, max_turns: int = 100_000
) -> DataFrame:
    """``(conv, messages)`` from one row per turn.

    An example is one row of the data model, so its turns meet in one place.
    ``turn`` counts from 0, which bounds the group: a turn number at or past
    ``max_turns`` fails the job instead of building a row that cannot be held.
    """
    checked = F.when(F.col(turn) < max_turns, F.col(turn)).otherwise(
        F.raise_error(F.concat(F.lit("conversation too long: "), F.col(conv).cast("string")))
    )
    gathered = turns.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(checked.alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")))).alias("_turns")
    )
    return gathered.select(
        conv,
        F.transform("_turns", lambda t: message(t["role"], t["content"])).alias("messages"),
    )
