"""Train/eval overlap through the chunks that examples were made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap(train: DataFrame, sources: str, eval_ids: DataFrame, key: str) -> DataFrame:
    """Distinct eval ids that training examples refer to (array column ``sources``).

    Ids are made distinct before the join, so a chunk that most examples share
    is sent once per task.
    """
    used = train.select(F.explode(sources).alias(key)).distinct()
    return used.join(eval_ids.select(key).distinct(), key, "left_semi")


def overlap_check(train: DataFrame, sources: str, eval_ids: DataFrame, key: str) -> DataFrame:
    """One row: number of overlapping ids and whether the check passes."""
    found = overlap(train, sources, eval_ids, key)
    return found.agg(F.count("*").alias("overlap"), (F.count("*") == 0).alias("pass"))
