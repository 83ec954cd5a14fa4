"""Judge scores, acceptance, cross-judge disagreement, coverage and funnel counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.draws import uniform

# Score dimensions, acceptance level, cross-check rate and seed.
DIMENSIONS = ["faithfulness", "toolCorrectness", "naturalness", "grounding"]
ACCEPT_AT = 4
SAMPLE_RATE = 0.2
SAMPLE_SEED = "jury-v1"
MIN_PER_TOOL = 30


def accepted(*scores: Column) -> Column:
    """All primary scores reach the acceptance level."""
    return F.least(*scores) >= ACCEPT_AT


def cross_check_sample(index: Column, rate: float = SAMPLE_RATE, seed: str = SAMPLE_SEED) -> Column:
    """Whether the example at ``index`` (from 0) is scored by the second judge too."""
    return uniform(seed, index + 1) < rate


def disagreements(
    primary: DataFrame, secondary: DataFrame, example: str, dimensions: list[str] = DIMENSIONS
) -> DataFrame:
    """``(example, dimension, primary_score, secondary_score)`` more than one point apart."""
    long_primary = primary.unpivot(example, dimensions, "dimension", "primary_score")
    long_secondary = secondary.unpivot(example, dimensions, "dimension", "secondary_score")
    return long_primary.join(long_secondary, [example, "dimension"]).filter(
        F.abs(F.col("primary_score") - F.col("secondary_score")) > 1
    )


def tool_coverage(
    names: DataFrame, known: DataFrame, tool: str = "tool", minimum: int = MIN_PER_TOOL
) -> DataFrame:
    """``(tool, examples, deficit, surplus, pass)`` per tool.

    ``names`` has an array ``tools`` per example; an example counts once per
    distinct tool. Known tools without examples and unknown tools that occur
    are listed too.
    """
    used = (
        names.select(F.explode(F.array_distinct("tools")).alias(tool))
        .groupBy(tool)
        .agg(F.count("*").alias("_n"))
    )
    n = F.coalesce("_n", F.lit(0))
    return known.select(tool).distinct().join(used, tool, "full_outer").select(
        tool,
        n.alias("examples"),
        F.greatest(F.lit(0), minimum - n).alias("deficit"),
        F.greatest(F.lit(0), n - minimum).alias("surplus"),
        (n >= minimum).alias("pass"),
    )


def coverage_passes(coverage: DataFrame) -> DataFrame:
    return coverage.agg(F.coalesce(F.bool_and("pass"), F.lit(True)).alias("pass"))


def counts_by_type(results: DataFrame, kind: str, ok: str, kinds: list[str]) -> DataFrame:
    """Successful rows per kind with every kind present, and rejected rows."""
    counted = results.agg(
        *[F.count_if((F.col(kind) == k) & F.col(ok)).alias(k) for k in kinds],
        F.count_if(~F.col(ok)).alias("rejected"),
    )
    return counted.unpivot([], [*kinds, "rejected"], "kind", "rows")


def funnel(flags: DataFrame) -> DataFrame:
    """One row of stage counts from per-example flags.

    ``flags`` has booleans accepted, kept_minhash, kept_cosine (each implies
    the one before) and an integer disagreements.
    """
    return flags.agg(
        F.count("*").alias("generated"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
        F.coalesce(F.sum("disagreements"), F.lit(0)).alias("disagreements"),
        F.count_if("kept_minhash").alias("after_minhash"),
        F.count_if("kept_cosine").alias("after_cosine"),
    )


def concatenated(*strata: DataFrame) -> DataFrame:
    """Bag union that remembers the stratum, so (stratum, index) orders the whole."""
    result = None
    for number, part in enumerate(strata):
        tagged = part.withColumn("stratum", F.lit(number))
        result = tagged if result is None else result.unionByName(tagged)
    return result
