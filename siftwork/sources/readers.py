"""Readers: every one returns a DataFrame and reads no more than it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions.text import trim_all
from siftwork.operators.catalog import TooFewTools, threshold_branch
from siftwork.operators.ordering import dense_ordinal
from siftwork.operators.splitting import tree_fingerprint
from siftwork.schemas import EVAL_ITEM, MESSAGES, TOOL

_CACHED = (
    "chunks array<struct<id:string,source:string,text:string,tokenCount:int,ordinal:int>>, "
    "byTopic map<string,array<string>>, fetchedAt string, sourceBytes bigint"
)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_corpus(spark: SparkSession, path: str) -> DataFrame | None:
    """Chunks of a cached corpus, or None when there is no cache.

    A folder is taken as chunk rows in Parquet, a file as one JSON document.
    """
    if not exists(spark, path):
        return None
    if not path.endswith(".json"):
        return spark.read.parquet(path)
    cached = spark.read.schema(_CACHED).json(path, multiLine=True)
    chunk = F.explode("chunks").alias("c")
    return cached.select(chunk).select(
        "c.id", "c.source", "c.text", F.col("c.tokenCount").alias("token_count"), "c.ordinal"
    )


def corpus_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(fetched_at, source_chars, by_topic)`` of a cached corpus file."""
    cached = spark.read.schema(_CACHED).json(path, multiLine=True)
    return cached.select(
        F.to_timestamp("fetchedAt").alias("fetched_at"),
        F.col("sourceBytes").alias("source_chars"),
        F.col("byTopic").alias("by_topic"),
    )


def read_tools(spark: SparkSession, path: str) -> DataFrame:
    """One row per tool of a manifest; parameters, arguments and results are variants."""
    manifest = spark.read.schema(f"tools array<{TOOL}>").json(path, multiLine=True)
    return manifest.select(F.posexplode("tools").alias("ordinal", "tool")).select("ordinal", "tool.*")


def tool_parameters(tools: DataFrame) -> DataFrame:
    """``(tool, param, type, required)``: the declared top-level parameters."""
    spec = F.col("function.parameters")
    props = F.try_variant_get(spec, "$.properties", "map<string,variant>")
    required = F.coalesce(
        F.try_variant_get(spec, "$.required", "array<string>"), F.array().cast("array<string>")
    )
    rows = tools.select(F.col("function.name").alias("tool"), required.alias("_req"), F.explode(props).alias("param", "_v"))
    return rows.select(
        "tool",
        "param",
        F.try_variant_get(F.col("_v"), "$.type", "string").alias("type"),
        F.array_contains("_req", F.col("param")).alias("required"),
    )


def tool_runs(tools: DataFrame) -> DataFrame:
    """``(tool, run_no, arguments, result)``: the recorded runs, as JSON text."""
    runs = tools.select(
        F.col("function.name").alias("tool"), F.posexplode("meta.trajectories").alias("run_no", "_t")
    )
    return runs.select(
        "tool",
        "run_no",
        F.to_json("_t.call.arguments").alias("arguments"),
        F.to_json("_t.result").alias("result"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, at, value)`` of text files, blank lines dropped.

    Big files are read in splits; (file, block, at) is the line order: the
    byte offset of the split, then the position Spark reads the line at.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    return rows.filter(trim_all(F.col("value")) != "")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a fixed schema; blank lines give no row."""
    return spark.read.schema(schema).json(path)


def read_eval_items(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Evaluation items; the first ``limit`` in line order when it is positive."""
    if not (limit and limit > 0):
        return read_jsonl(spark, path, EVAL_ITEM)
    head = read_lines(spark, path).orderBy("file", "block", "at").limit(limit)
    return head.select(F.from_json("value", EVAL_ITEM).alias("item")).select("item.*")


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, f"messages {MESSAGES}")


def read_log_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """Streaming log lines: ``(run_id, seq, value)``.

    One JSON-lines file per part of a run, with fields ``run_id``, ``seq`` and
    ``value``: text files alone have no line order across files.
    """
    reader = spark.readStream.schema("run_id string, seq bigint, value string")
    return reader.option("maxFilesPerTrigger", max_files).json(folder)


LOG_PART = r"([^/]+?)(?:\.(\d+))?\.[^./]+$"  # run.log, or run.0.log, run.1.log, ...


def read_log_parts(spark: SparkSession, folder: str, max_files: int = 100, pattern: str = LOG_PART) -> DataFrame:
    """Streaming text logs: ``(run_id, part, lines)``, a row per file.

    The run and the number of the part (0 if none) are the groups of ``pattern`` in the
    file's path. A part is read whole, so its lines keep their order; rotate logs
    into parts that fit a task. Spark does not list files of no bytes: a part without
    lines needs a line feed, or the parts after it wait.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    files = reader.text(folder, wholetext=True, recursiveFileLookup=True)
    path = F.col("_metadata.file_path")
    return files.select(
        F.regexp_extract(path, pattern, 1).alias("run_id"),
        F.coalesce(F.regexp_extract(path, pattern, 2).try_cast("bigint"), F.lit(0)).alias("part"),
        F.split("value", r"\r\n|\n|\r").alias("lines"),
    )


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch log lines, one file per run: ``(run_id, seq, value)``."""
    numbered = dense_ordinal(read_lines(spark, path), "file", "block", "at", out="seq")
    name = F.regexp_extract("file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return numbered.select(name.alias("run_id"), "seq", "value")


def read_split(spark: SparkSession, path: str, key: str, verify: bool = True) -> DataFrame | None:
    """``(key, split)`` of a stored split, or None; the fingerprint is recomputed."""
    if not exists(spark, path):
        return None
    stored = spark.read.parquet(f"{path}/ids")
    if verify:
        meta = spark.read.json(f"{path}/meta").first()
        train = stored.filter("split = 'train'")
        found = tree_fingerprint(train, key, meta["salt"]).first()["fingerprint"]
        if found != meta["fingerprint"]:
            raise ValueError("split fingerprint does not match its ids")
    return stored


def survivors_or_fallback(
    survivors: DataFrame, fallback: DataFrame, floor_min: int = 8, kill_min: int = 4, strict: bool = True
) -> tuple[DataFrame, str]:
    """Survivors and the branch taken; with too few, the fallback catalogue.

    ``strict`` raises after choosing the fallback; the exception carries it.
    """
    count = survivors.limit(floor_min).count()
    branch = threshold_branch(count, floor_min, kill_min)
    if branch != "fallback":
        return survivors, branch
    if strict:
        error = TooFewTools(f"only {count} survivors")
        error.fallback = fallback
        raise error
    return fallback, branch
