"""Catalogue flow: candidates to gates to a capped catalogue, one at a time or many at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwork.operators import catalog
from siftwork.session import cut
from siftwork.sources.readers import survivors_or_fallback


@dataclass(frozen=True)
class Discovered:
    tools: DataFrame
    source: str
    failures: DataFrame
    raw: int
    deduped: int


@dataclass(frozen=True)
class Verdicts:
    """What a log says of its tools, a row for each: ``smoke`` (tool, _sandbox), ``fuzz``
    (tool, _fuzz) and ``replayed`` (tool, _trajectory, _replayed)."""

    smoke: DataFrame
    fuzz: DataFrame
    replayed: DataFrame


def log_verdicts(runs: DataFrame, observed: DataFrame) -> Verdicts:
    """Verdicts on every tool of a log, for :func:`judged_tools`.

    ``runs``: the execution log (tool, kind smoke or fuzz, ok, error). ``observed``:
    recorded and observed results (tool, run_no, recorded, observed).
    """
    smoke = (
        runs.filter("kind = 'smoke'")
        .filter(catalog.resource_failure(F.col("ok"), F.col("error")))
        .groupBy("tool")
        .agg(F.min("error").alias("_sandbox"))
    )
    fuzz = catalog.execution_gate(runs.filter("kind = 'fuzz'"), "tool", "ok").select(
        "tool", F.col("reason").alias("_fuzz")
    )
    replayed = catalog.trajectory_gate(
        observed.select("tool", "run_no", F.col("recorded").alias("result")),
        observed.select("tool", "run_no", F.col("observed").alias("result")),
    ).select("tool", F.col("reason").alias("_trajectory"), F.lit(True).alias("_replayed"))
    return Verdicts(smoke, fuzz, replayed)


def judged_tools(candidates: DataFrame, log: Verdicts) -> DataFrame:
    """Add ``pass``, ``failed_gate`` and ``reason`` to candidates (ordinal, tool, parameters, body)."""
    joined = candidates
    for part in (log.smoke, log.fuzz, log.replayed):
        joined = joined.join(part, "tool", "left")
    none_run = F.when(F.col("_replayed").isNull(), F.lit("<3 trajectories (have 0)"))
    result = catalog.gate_result(
        {
            "schema": catalog.declared_schema_fault(F.col("parameters")),
            "parse": catalog.deny_reason(F.col("body")),
            "sandbox": F.col("_sandbox"),
            "fuzz": F.col("_fuzz"),
            "trajectory": F.coalesce(F.col("_trajectory"), none_run),
        }
    )
    return joined.select(*candidates.columns, result.alias("gate")).select("*", "gate.*").drop("gate")


def gated_tools(candidates: DataFrame, runs: DataFrame, observed: DataFrame) -> DataFrame:
    """:func:`judged_tools` for one round; a log that serves more rounds is judged once, and cut."""
    return judged_tools(candidates, log_verdicts(runs, observed))


def discover(
    first: DataFrame,
    validate: Callable[[DataFrame], DataFrame],
    fallback: DataFrame,
    retry: DataFrame | None = None,
    cap: int = 12,
    floor_min: int = 8,
    kill_min: int = 4,
    strict: bool = True,
) -> Discovered:
    """Deduplicate, validate, retry once when survivors are few, cap.

    ``first`` and ``retry`` are candidate rounds with a common ``ordinal``
    order; ``validate`` adds the gate columns. Failures are counted once per
    round.
    """
    deduped = catalog.keep_first_by_name(first, "tool", "ordinal")
    gated = cut(validate(deduped).withColumn("round", F.lit(1)))
    survivors = gated.filter("pass")
    raw = first.count()
    if retry is not None and catalog.threshold_branch(survivors.count(), floor_min, kill_min) == "retry":
        again = catalog.merge_retry(first, retry, survivors, "tool", "ordinal")
        second = cut(validate(again).withColumn("round", F.lit(2)))
        gated = gated.unionByName(second)
        survivors = gated.filter("pass")
        raw += retry.count()
        deduped = catalog.keep_first_by_name(first.unionByName(retry), "tool", "ordinal")
    failures = catalog.failures_per_gate(gated)
    chosen, branch = survivors_or_fallback(survivors, fallback, floor_min, kill_min, strict)
    source = "fallback" if branch == "fallback" else "swarm"
    tools = chosen if source == "fallback" else chosen.orderBy("round", "ordinal").limit(cap)
    return Discovered(tools, source, failures, raw, deduped.count())


@dataclass(frozen=True)
class DiscoveredMany:
    """``tools``: (catalogue, branch, round, ordinal, tool) with null round for the fallback.

    ``gated``: all judged candidates with their round. ``counts``: (catalogue, raw, deduped,
    first_survivors, survivors, branch).
    """

    tools: DataFrame
    gated: DataFrame
    counts: DataFrame


def discover_many(
    first: DataFrame,
    retry: DataFrame,
    validate: Callable[[DataFrame], DataFrame],
    fallback: list[str],
    catalogue: str = "catalogue",
    cap: int = 12,
    floor_min: int = 8,
    kill_min: int = 4,
) -> DiscoveredMany:
    """As :func:`discover` for every catalogue at once, without a count on the driver.

    The branch is data: survivors are counted per catalogue, and the counts are joined
    to the candidates. A catalogue below ``kill_min`` survivors takes the fallback, one
    from there to below ``floor_min`` is judged once more with its retry candidates,
    any other goes straight on. ``tool`` must tell catalogues apart
    (``catalogue/name``); retry ordinals follow those of the first round.
    """
    once = catalog.keep_first_by_name(first, "tool", "ordinal")
    one = cut(validate(once).withColumn("round", F.lit(1)))  # judged once, read by every branch
    guard = one.groupBy(catalogue).agg(F.count_if("pass").alias("first_survivors"))
    short = guard.filter((F.col("first_survivors") >= kill_min) & (F.col("first_survivors") < floor_min)).select(catalogue)

    def again(rows: DataFrame) -> DataFrame:
        return rows.join(short, catalogue, "left_semi")

    left = catalog.merge_retry(again(first), again(retry), one.filter("pass"), "tool", "ordinal")
    gated = one.unionByName(cut(validate(left).withColumn("round", F.lit(2))))
    alive = gated.filter("pass")
    merged = catalog.keep_first_by_name(again(first).unionByName(again(retry)), "tool", "ordinal")
    raw = first.groupBy(catalogue).agg(F.count("*").alias("raw_first"))
    more = again(retry).groupBy(catalogue).agg(F.count("*").alias("raw_retry"))
    deduped = merged.groupBy(catalogue).agg(F.count("*").alias("deduped_both"))
    deduped_first = once.groupBy(catalogue).agg(F.count("*").alias("deduped_first"))
    total = alive.groupBy(catalogue).agg(F.count("*").alias("survivors"))
    counts = guard.join(raw, catalogue).join(deduped_first, catalogue)
    for part in (more, deduped, total):
        counts = counts.join(part, catalogue, "left")
    survivors = F.coalesce("survivors", F.lit(0))
    branch = (
        F.when(survivors < kill_min, "fallback").when(F.col("first_survivors") < floor_min, "retry").otherwise("straight")
    )
    counts = counts.select(
        catalogue,
        (F.col("raw_first") + F.coalesce("raw_retry", F.lit(0))).alias("raw"),
        F.coalesce("deduped_both", "deduped_first").alias("deduped"),
        "first_survivors",
        survivors.alias("survivors"),
        branch.alias("branch"),
    )
    order = Window.partitionBy(catalogue).orderBy("round", "ordinal")
    capped = alive.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= cap)
    chosen = capped.join(counts.filter("branch <> 'fallback'").select(catalogue, "branch"), catalogue)
    names = F.posexplode(F.array(*[F.lit(name) for name in fallback])).alias("ordinal", "tool")
    spare = counts.filter("branch = 'fallback'").select(catalogue, "branch", names)
    columns = [catalogue, "branch", "round", "ordinal", "tool"]
    spare = spare.withColumn("round", F.lit(None).cast("int")).withColumn("ordinal", F.col("ordinal").cast("bigint"))
    tools = chosen.withColumn("ordinal", F.col("ordinal").cast("bigint")).select(*columns).unionByName(spare.select(*columns))
    return DiscoveredMany(tools, gated, counts)
