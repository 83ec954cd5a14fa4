"""Session helpers shared by operators, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftwork")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only where neither that
    setting nor the context has one, and the master is local, a temporary
    folder is taken.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="siftwork-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    The copy is on reliable storage, so a lost executor costs a re-read, not a
    recomputation.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Workspace:
    """Tables in the shared checkpoint folder, emptied once nothing reads them.

    A stored table cuts lineage and survives a lost executor, and unlike a
    checkpoint its columns are read one by one. ``release`` empties all tables but
    those stored with ``keep``, which back a returned frame.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def store(self, df: DataFrame, keep: bool = False) -> DataFrame:
        path = f"{checkpoint_dir(self.spark)}/table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if not keep:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        nothing = self.spark.createDataFrame([], "none int").coalesce(1)
        for path in self.paths:
            nothing.write.mode("overwrite").parquet(path)
        self.paths.clear()

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.release()


SPLIT_BYTES = 128 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of CPU-heavy work out evenly, over tasks for all cores.

    How many splits a file makes says nothing about where its rows are: a file with
    one large row group leaves all of them in one task. So the input is
    always dealt, into more parts the larger the optimizer estimates it. Only that estimate
    is read; nothing runs. Rows that agree in ``keys`` stay together; without keys they go round.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # An unknown size is estimated beyond any file.
    parts = estimate // SPLIT_BYTES if estimate < 1 << 50 else 0
    return df.repartition(max(3 * cores, parts), *keys)


def broadcast_if_small(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting at most ``limit`` narrow rows.

    Beyond the limit the join stays an ordinary shuffle join, whose skewed
    partitions adaptive execution splits.
    """
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df
