"""Deterministic train/eval split with verifiable fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.draws import hash_score

SALT = "phase-4-v1"
TRAIN_RATIO = 0.7
RUN = 1000  # ids that are joined to one text at a time


def split_side(key: Column, salt: str = SALT, ratio: float = TRAIN_RATIO) -> Column:
    return F.when(hash_score(salt, key) < ratio, "train").otherwise("eval")


def with_split(
    df: DataFrame, key: str, salt: str = SALT, ratio: float = TRAIN_RATIO
) -> DataFrame:
    """Add ``split``; a projection, so no shuffle and no state."""
    return df.withColumn("split", split_side(F.col(key), salt, ratio))


def split_counts(split: DataFrame) -> DataFrame:
    """Train and eval row counts with the train share, in one row."""
    return split.agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "eval").alias("eval"),
        (F.count_if(F.col("split") == "train") / F.count("*")).alias("train_share"),
    )


def split_fingerprint(
    train_ids: DataFrame, key: str, salt: str = SALT, max_ids: int | None = None
) -> DataFrame:
    """sha256 over the salt and all sorted train ids joined by commas, for any number of ids.

    Ids are sorted and joined to runs of text in parallel. SHA-256 goes through its
    text in order, so one task reads the runs in turn and holds one at a time; it does
    nothing but hash. ``max_ids`` refuses more ids, if given. Stored splits
    use :func:`tree_fingerprint`, always.
    """
    if max_ids is not None and train_ids.select(key).limit(max_ids + 1).count() > max_ids:
        raise ValueError(f"more than {max_ids} ids: use tree_fingerprint")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for at in range(0, len(ids), RUN):
                run = [x for x in ids[at : at + RUN] if x is not None]
                text = None if not run else ",".join(run)
                n = len(ids[at : at + RUN])
                yield pa.RecordBatch.from_pydict(
                    {"low": run[:1] or [None], "high": run[-1:] or [None], "n": [n], "run": [text]},
                    schema=pa.schema([("low", pa.string()), ("high", pa.string()), ("n", pa.int64()), ("run", pa.string())]),
                )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, total, first = hashlib.sha256(f"{salt}:".encode()), 0, True
        for batch in batches:
            for n, run in zip(batch.column("n").to_pylist(), batch.column("run")):
                total += n
                if run.is_valid:
                    state.update(b"" if first else b",")
                    state.update(run.as_py().encode())
                    first = False
        yield pa.RecordBatch.from_pydict({"ids": pa.array([total], pa.int64()), "fingerprint": [state.hexdigest()]})

    ids = train_ids.select(F.col(key).cast("string").alias("id")).orderBy("id")
    runs = ids.mapInArrow(joined, "low string, high string, n long, run string")
    none = "string(null) AS low", "string(null) AS high", "0L AS n", "string(null) AS run"
    runs = runs.unionByName(train_ids.sparkSession.range(1).selectExpr(*none))  # a row for no ids too
    runs = runs.repartition(1).sortWithinPartitions("low", "high")
    return runs.mapInArrow(hashed, "ids long, fingerprint string")


def tree_fingerprint(
    train_ids: DataFrame, key: str, salt: str = SALT, levels: tuple[int, ...] = (4, 2)
) -> DataFrame:
    """Fingerprint for splits of any size: digests of digests over a hash tree.

    Ids fall into buckets by the first ``levels[0]`` hex digits of their
    sha256; every bucket is digested over its sorted ids, buckets are digested
    by shorter prefixes, and so on. No step sees more than one bucket.
    """
    ident = F.col(key).cast("string")
    nodes = train_ids.select(F.sha2(ident, 256).alias("node"), ident.alias("digest"))
    for digits in (*levels, 0):
        joined = F.array_join(F.array_sort(F.collect_list("digest")), ",")
        nodes = nodes.groupBy(F.substring("node", 1, digits).alias("node")).agg(
            F.sha2(F.concat(F.lit(salt + ":"), joined), 256).alias("digest")
        )
    return nodes.select(F.col("digest").alias("fingerprint"))


def split_faults(ids: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Ids that the manifest misses, adds, or lists on other than exactly one side."""
    sides = manifest.groupBy(key).agg(
        F.count_distinct("split").alias("sides"), F.count("*").alias("entries")
    )
    wanted = ids.select(key).distinct().withColumn("wanted", F.lit(True))
    joined = wanted.join(sides, key, "full_outer")
    fault = (
        F.when(F.col("sides").isNull(), "lost")
        .when(F.col("wanted").isNull(), "added")
        .when(F.col("sides") > 1, "both sides")
        .when(F.col("entries") > 1, "repeated")
    )
    return joined.select(key, fault.alias("fault")).filter("fault is not null")
