"""Dataset flow: chunks to split to plan, and replies to a curated training set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators import catalog, messages, quality
from siftwork.operators.chunking import chunk_texts
from siftwork.operators.dedup import Plan, drop_near_duplicates
from siftwork.operators.leakage import overlap_check
from siftwork.operators.planning import qa_plan
from siftwork.operators.prompts import qa_prompts, with_context
from siftwork.operators.splitting import with_split
from siftwork.operators.vectors import drop_similar_vectors
from siftwork.schemas import QA_REPLY
from siftwork.session import cut


def question_prompts(
    texts: DataFrame, source: str, text: str, tools: list[dict], product: str, count: int,
    separator: str = r"\n{2,}",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(split chunks, plan, prompts)`` for an external generator."""
    chunks = with_split(chunk_texts(texts, source, text, separator), "id")
    train = chunks.filter("split = 'train'")
    rows = texts.sparkSession.range(count).withColumnRenamed("id", "index")
    plan = qa_plan(rows, train, "id")
    prompts = qa_prompts(with_context(plan, train, "id", "text"), tools, product)
    return chunks, plan, prompts


def question_examples(
    plan: DataFrame, replies: DataFrame, tools: list[dict], system: Column
) -> tuple[DataFrame, DataFrame]:
    """Examples from generator replies ``(index, reply)``, and the rejected ``(index, reason)``.

    A reply that breaks its contract, or whose calls fail the schema gate, is
    rejected and never repaired.
    """
    parsed = replies.select("index", F.from_json("reply", QA_REPLY).alias("r")).join(plan, "index")
    reply = F.col("r")
    broken = catalog.violations(catalog.qa_contract(reply["question"], reply["answer"]))
    calls = parsed.select("index", F.posexplode("r.toolCalls").alias("k", "c")).select(
        "index", "k", "c.name", "c.arguments"
    )
    bad_calls = (
        catalog.gate_calls(calls, tools)
        .filter("not valid")
        .groupBy("index")
        .agg(
            F.min_by(
                F.concat(
                    F.lit("Tool call to '"), F.col("name"), F.lit("' failed schema validation: "),
                    F.array_join("faults", "; "),
                ),
                "k",
            ).alias("_call_fault")
        )
    )
    reason = F.when(F.size("_broken") > 0, F.concat(F.lit("contract: "), F.array_join("_broken", ", "))).otherwise(
        F.col("_call_fault")
    )
    checked = parsed.withColumn("_broken", broken).join(bad_calls, "index", "left").withColumn("reason", reason)
    good = checked.filter("reason is null").select(
        F.col("index").alias("example_id"),
        messages.qa_messages(reply, F.col("index"), system).alias("messages"),
        "persona",
        "difficulty",
        F.col("chunk_ids").alias("source_chunks"),
    )
    return good, checked.filter("reason is not null").select("index", "reason")


@dataclass(frozen=True)
class Curated:
    """``flags`` has one row per example; ``training`` the examples that stay."""

    flags: DataFrame
    training: DataFrame
    funnel: DataFrame
    coverage: DataFrame
    overlap: DataFrame


def curate(
    examples: DataFrame,
    scores: DataFrame,
    known_tools: DataFrame,
    eval_ids: DataFrame,
    embeddings: DataFrame | None = None,
    plan: Plan = Plan(),
    cosine: float = 0.92,
    minimum: int = quality.MIN_PER_TOOL,
) -> Curated:
    """Judge filter, both near-duplicate filters, coverage and leakage checks.

    ``examples`` has a unique bigint ``example_id`` (the order of preference),
    ``messages`` and ``source_chunks``; ``scores`` one primary score row per
    example and optionally ``disagreements``; ``embeddings`` ``(example_id,
    embedding)``, where an example without one resembles none. Everything an
    example carries stays on its row.
    """
    dims = [F.col(d) for d in quality.DIMENSIONS]
    judged = scores.select("example_id", quality.accepted(*dims).alias("accepted"), "disagreements")
    passed = examples.join(judged.filter("accepted").select("example_id"), "example_id", "left_semi")
    texts = passed.select("example_id", messages.dedup_text(F.col("messages")).alias("text"))
    unlike = cut(drop_near_duplicates(texts, "example_id", "text", plan).select("example_id"))
    if embeddings is None:
        final = unlike
    else:
        left = cut(embeddings.join(unlike, "example_id", "left_semi").select("example_id", "embedding"))
        apart = drop_similar_vectors(left, "example_id", "embedding", cosine).select("example_id")
        lost = left.select("example_id").join(apart, "example_id", "left_anti")
        final = cut(unlike.join(lost, "example_id", "left_anti"))
    mark = F.lit(True)
    flags = (
        judged.join(unlike.withColumn("_m", mark), "example_id", "left")
        .join(final.withColumn("_c", mark), "example_id", "left")
        .select(
            "example_id",
            "accepted",
            "disagreements",
            F.coalesce("_m", F.lit(False)).alias("kept_minhash"),
            F.coalesce("_c", F.lit(False)).alias("kept_cosine"),
        )
    )
    training = examples.join(final, "example_id", "left_semi")
    names = training.select(messages.tool_names(F.col("messages")).alias("tools"))
    return Curated(
        flags,
        training,
        quality.funnel(flags),
        quality.tool_coverage(names, known_tools, minimum=minimum),
        overlap_check(training, "source_chunks", eval_ids, "id"),
    )
