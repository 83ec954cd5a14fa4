"""Helpers the operators of this subpackage share: reading, storing, hot keys."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.operators.skew import FEW, HEAVY_KEYS, join_groups  # noqa: F401
from siftwork.session import checkpoint_dir


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


BATCH = 1024  # rows that an executor and its Python worker hold at once, where a row may be a list or two texts
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH) -> Iterator[None]:
    """What runs meanwhile meets Python in Arrow batches of at most ``rows`` rows.

    Slicing a batch in the worker comes too late: the executor has built all of it outside
    its heap, and the worker has read all of it, before the first slice.
    """
    was = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(was)) if int(was) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, was)


class Scratch:
    """Tables in the shared checkpoint folder, emptied once nothing needs them.

    A stored table is on reliable storage: it cuts lineage, and a lost executor
    costs a re-read. ``release`` overwrites the folder of the tables handed out so far with
    nothing, in one write, and lets Spark free the shuffles of frames that are gone; tables
    stored with ``keep`` back a returned frame, lie outside that folder and stay. With ``batch``
    tables are made in Arrow batches of at most so many rows.
    """

    def __init__(self, spark: SparkSession, batch: int | None = None):
        self.spark = spark
        self.batch = batch
        self.folder: str | None = None

    def store(self, df: DataFrame, keep: bool = False, by: str | None = None) -> DataFrame:
        top = checkpoint_dir(self.spark)
        if not keep:
            top = self.folder = self.folder or f"{top}/scratch-{uuid.uuid4().hex}"
        path = f"{top}/llm-{uuid.uuid4().hex}"
        with small_batches(self.spark, self.batch) if self.batch else nullcontext():
            df.write.parquet(path, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        if self.folder:
            self.spark.createDataFrame([], "none int").coalesce(1).write.mode("overwrite").parquet(self.folder)
        self.folder = None
        free_shuffles(self.spark)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files live until the JVM collects the plan that made them; long jobs ask for it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what Python holds of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def together(df: DataFrame, splits: int = 4) -> DataFrame:
    """Read a few file splits per task, so that what a task remembers pays off.

    Every core still has at least three tasks. Only for frames that read files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    return df.coalesce(max(parts // splits, min(parts, 3 * cores)))
