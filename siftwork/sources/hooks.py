"""Hooks for caller-supplied batch functions: generator, judge, embedder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_batches(
    rows: DataFrame,
    column: str,
    function: Callable[[list[str]], list],
    out: str,
    out_type: str,
    batch: int = 256,
) -> DataFrame:
    """Add ``out = function(batch of column values)``, ``batch`` values per call.

    The function runs in Python workers on Arrow batches; it gets a list and
    returns one value per entry.
    """
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(f"{out} {out_type}").fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                values = function(part[column].tolist())
                if len(values) != len(part):
                    raise ValueError("the batch function must return one value per row")
                yield part.assign(**{out: list(values)})

    return rows.mapInPandas(run, schema)


def embed(rows: DataFrame, text: str, embedder: Callable[[list[str]], list]) -> DataFrame:
    """Add ``embedding`` from a batch embedder."""
    return map_batches(rows, text, embedder, "embedding", "array<float>")


def judge(rows: DataFrame, transcript: str, judge_batch: Callable[[list[str]], list], tag: str) -> DataFrame:
    """Add ``scores`` (array of ints, in the order of the score dimensions) and ``judge``."""
    scored = map_batches(rows, transcript, judge_batch, "scores", "array<int>")
    return scored.withColumn("judge", F.lit(tag))


def generate(prompts: DataFrame, generator: Callable[[list[str]], list]) -> DataFrame:
    """Add ``reply`` (JSON text) for the concatenated system and user prompt."""
    whole = prompts.withColumn("_prompt", F.concat("system", F.lit("\n\n"), "user"))
    return map_batches(whole, "_prompt", generator, "reply", "string").drop("_prompt")
