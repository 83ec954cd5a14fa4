"""Sinks. All write in parallel, one file per task."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftwork.operators.catalog import tool_contract, violations
from siftwork.operators.messages import clean_messages, clean_tools
from siftwork.operators.splitting import SALT, TRAIN_RATIO, tree_fingerprint


def training_rows(examples: DataFrame) -> DataFrame:
    """``(messages, tools)`` as emitted: no tool meta, no empty fields."""
    columns = [clean_messages(F.col("messages")).alias("messages")]
    if "tools" in examples.columns:
        columns.append(clean_tools(F.col("tools")).alias("tools"))
    return examples.select(*columns)


def write_training(examples: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per line; absent keys are left out."""
    training_rows(examples).write.mode(mode).option("ignoreNullFields", True).json(path)


def write_eval(items: DataFrame, path: str, mode: str = "error") -> None:
    items.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_split(
    split: DataFrame,
    key: str,
    path: str,
    salt: str = SALT,
    ratio: float = TRAIN_RATIO,
) -> None:
    """Ids by side (readers prune by side) and one metadata row."""
    split.select(key, "split").write.partitionBy("split").parquet(f"{path}/ids")
    mark = tree_fingerprint(split.filter("split = 'train'"), key, salt)
    made = datetime.datetime.now(datetime.timezone.utc).isoformat()
    mark.select(
        F.lit(salt).alias("salt"),
        F.lit(ratio).alias("trainRatio"),
        "fingerprint",
        F.lit(made).alias("generatedAt"),
    ).write.json(f"{path}/meta")


def write_prompt_answers(sided: DataFrame, path: str) -> None:
    """Prompt/answer rows with ``side``: one folder per side."""
    for side in ("train", "valid"):
        rows = sided.filter(F.col("side") == side).select("prompt", "answer")
        rows.write.json(f"{path}/{side}")


def broken_tools(tools: DataFrame) -> DataFrame:
    """Tools that break the record contract, with the names of the broken rules."""
    contract = tool_contract(
        F.col("function.name"),
        F.col("function.description"),
        F.col("meta.jsBody"),
        F.col("meta.trajectories"),
    )
    broken = violations(contract)
    return tools.select(F.col("function.name").alias("tool"), broken.alias("broken")).filter(
        F.size("broken") > 0
    )


def write_manifest(
    tools: DataFrame, path: str, source: str, failures: DataFrame, raw: int, deduped: int
) -> None:
    """Tools and one metadata row; nothing is written if a tool breaks its contract."""
    bad = broken_tools(tools).take(5)
    if bad:
        raise ValueError(f"tools break the record contract: {bad}")
    tools.write.json(f"{path}/tools")
    made = datetime.datetime.now(datetime.timezone.utc).isoformat()
    counts = failures.agg(F.map_from_entries(F.collect_list(F.struct("gate", "failures"))).alias("f"))
    counts.select(
        F.lit(source).alias("source"),
        F.lit(tools.count()).alias("count"),
        F.lit(made).alias("generatedAt"),
        F.struct(
            F.lit(raw).alias("rawCandidates"),
            F.lit(deduped).alias("dedupedCandidates"),
            F.col("f").alias("gateFailures"),
        ).alias("meta"),
    ).write.json(f"{path}/meta")


def commit_batch(batch: DataFrame, number: int, path: str) -> None:
    """Write one micro-batch under its number; the same number again replaces it."""
    batch.write.mode("overwrite").json(f"{path}/batch={number}")


def start_checkpoint_stream(examples: DataFrame, path: str, checkpoint: str):
    """Append finished examples as they arrive, with their meta in the same row.

    A micro-batch is a folder named by its number. One that fails halfway, or was written
    but not yet noted as done, is replayed under the same number after a restart and replaces
    what it left, so nothing is lost or written twice. Read it with :func:`read_checkpointed`.
    """
    return (
        examples.writeStream.foreachBatch(lambda batch, number: commit_batch(batch, number, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_checkpointed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The examples of all micro-batches of :func:`start_checkpoint_stream`."""
    return spark.read.schema(schema).json(path).drop("batch")


def append_checkpoint(examples: DataFrame, path: str, start: bool = False) -> None:
    """Batch form: append a finished block; ``start`` begins anew."""
    mode = "overwrite" if start else "append"
    examples.write.mode(mode).json(path)
