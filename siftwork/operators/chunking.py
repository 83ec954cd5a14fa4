"""Greedy packing of paragraphs into overlapping, token-capped chunks.

Each text row is folded by a higher-order function, so the work stays in the
JVM and runs in parallel over texts; a large input is not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import bind, paragraphs, token_count
from siftwork.session import spread

TARGET_TOKENS = 500
OVERLAP_TOKENS = 50
OVERLAP_CHARS = OVERLAP_TOKENS * 4

Counter = Callable[[Column], Column]


def oversize_windows(text: Column, counter: Counter = token_count) -> Column:
    """Overlapping character windows of a paragraph above the token cap."""
    per_token = F.greatest(F.lit(1), F.floor(F.length(text) / counter(text)).cast("int"))

    def cut(unit: Column) -> Column:
        starts = F.sequence(
            F.lit(0), F.length(text) - 1, unit * (TARGET_TOKENS - OVERLAP_TOKENS)
        )
        return F.transform(starts, lambda i: F.substring(text, i + 1, unit * TARGET_TOKENS))

    return bind(per_token, cut)


def packed(paras: Column, counter: Counter = token_count) -> Column:
    """Chunk texts of one paragraph array, in order."""

    def state(buffer: Column, tokens: Column, done: Column) -> Column:
        return F.struct(
            buffer.alias("buffer"), tokens.cast("int").alias("tokens"), done.alias("done")
        )

    def flush(s: Column) -> Column:
        return F.when(s["buffer"] == "", s["done"]).otherwise(
            F.concat(s["done"], F.array(s["buffer"]))
        )

    def step(s: Column, para: Column) -> Column:
        size = counter(para)
        seeded = F.concat(F.right(s["buffer"], F.lit(OVERLAP_CHARS)), F.lit("\n\n"), para)
        grown = F.when(s["buffer"] == "", para).otherwise(
            F.concat(s["buffer"], F.lit("\n\n"), para)
        )
        return (
            F.when(
                size > TARGET_TOKENS,
                state(F.lit(""), F.lit(0), F.concat(flush(s), oversize_windows(para, counter))),
            )
            .when(
                s["tokens"] + size > TARGET_TOKENS,
                state(seeded, counter(seeded), F.concat(s["done"], F.array(s["buffer"]))),
            )
            .otherwise(state(grown, s["tokens"] + size, s["done"]))
        )

    start = state(F.lit(""), F.lit(0), F.array().cast("array<string>"))
    return F.aggregate(paras, start, step, flush)


def chunk_id(source: Column, ordinal: Column) -> Column:
    """``{source}.txt#{ordinal}``, zero-padded to four digits and never truncated."""
    return F.format_string("%s.txt#%04d", source, ordinal)


def chunk_texts(
    texts: DataFrame,
    source: str,
    text: str,
    separator: str = r"\n{2,}",
    counter: Counter = token_count,
) -> DataFrame:
    """``(id, source, text, token_count, ordinal)``: one row per chunk."""
    rows = spread(texts.select(F.col(source).cast("string").alias("source"), F.col(text).alias("_t")))
    folded = rows.select(
        "source",
        F.posexplode(packed(paragraphs(F.col("_t"), separator), counter)).alias("ordinal", "text"),
    )
    return folded.select(
        chunk_id(F.col("source"), F.col("ordinal")).alias("id"),
        "source",
        "text",
        counter(F.col("text")).alias("token_count"),
        "ordinal",
    )


def source_sizes(texts: DataFrame, source: str, text: str) -> DataFrame:
    """Number of texts and total length and tokens per source."""
    return texts.groupBy(source).agg(
        F.count("*").alias("texts"),
        F.sum(F.length(text)).alias("chars"),
        F.sum(token_count(F.col(text))).alias("tokens"),
    )
