"""Scoring model responses against expected answers and tool calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.jsons import canonical_json
from siftwork.functions.text import normalise_answer


def calls_match(expected: Column, actual: Column) -> Column:
    """Same number of calls and, position by position, same name and arguments."""

    def same(call: Column, i: Column) -> Column:
        got = F.get(actual, i)["function"]
        want = call["function"]
        return F.coalesce(
            (want["name"] == got["name"])
            & (canonical_json(want["arguments"]) == canonical_json(got["arguments"])),
            F.lit(False),
        )

    equal = F.forall(F.transform(expected, same), lambda ok: ok)
    return (F.size(expected) == F.coalesce(F.size(actual), F.lit(0))) & equal


def text_matches(expected: Column, actual: Column) -> Column:
    """Normalised answer contains the normalised expectation; neither may be empty."""
    want, got = normalise_answer(expected), normalise_answer(actual)
    return (want != "") & (got != "") & F.contains(got, want)


def passes(expected: Column, expected_calls: Column, text: Column, calls: Column) -> Column:
    """Calls decide when any are expected, else the text does."""
    return F.coalesce(
        F.when(F.size(expected_calls) > 0, calls_match(expected_calls, calls)).otherwise(
            text_matches(expected, text)
        ),
        F.lit(False),
    )


def scored_items(items: DataFrame, responses: DataFrame, models: list[str]) -> DataFrame:
    """``(model, item_id, latency_ms, passed)`` for every item and model.

    ``items``: (item_id, expected, expected_calls). ``responses``: (model,
    item_id, text, calls, latency_ms), one per model and item. A response that
    is missing counts as failed. ``models`` is the short list under comparison.
    """
    wanted = items.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    joined = wanted.join(responses, ["model", "item_id"], "left")
    verdict = passes(F.col("expected"), F.col("expected_calls"), F.col("text"), F.col("calls"))
    return joined.select("model", "item_id", "latency_ms", verdict.alias("passed"))


def model_summary(items: DataFrame, responses: DataFrame, models: dict[str, bool]) -> DataFrame:
    """``(model, available, score, passed, total, latency_ms)`` per model.

    ``models`` says which endpoints exist. One that does not has no score and
    no passes; an empty item set scores 0.
    """
    live = [m for m, available in models.items() if available]
    spark = items.sparkSession
    total = items.agg(F.count("*").alias("total"))
    wanted = total.withColumn(
        "_m",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("model"), F.lit(a).alias("available")) for m, a in models.items()])
        ),
    ).select("_m.*", "total")
    if not live:
        scored = spark.createDataFrame([], "model string, _passed bigint, _latency double")
    else:
        scored = (
            scored_items(items, responses, live)
            .groupBy("model")
            .agg(F.count_if("passed").alias("_passed"), F.avg("latency_ms").alias("_latency"))
        )
    passed = F.coalesce("_passed", F.lit(0))
    share = F.when(F.col("total") > 0, passed * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    return wanted.join(scored, "model", "left").select(
        "model",
        "available",
        F.when(F.col("available"), share).alias("score"),
        passed.alias("passed"),
        "total",
        F.when(F.col("available"), F.round("_latency").cast("bigint")).alias("latency_ms"),
    )
