"""Global order without a single-partition window: dense ordinals and slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.session import broadcast_if_small, cut

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low bits


def dense_ordinal(df: DataFrame, *order: str | Column, out: str = "ordinal") -> DataFrame:
    """Number rows 0..n-1 in the given order.

    Rows are range-partitioned and sorted, written to the checkpoint folder so
    that partition and position are fixed, and shifted by the row counts of
    the partitions before. The offset table has one row per partition.
    Number narrow frames (keys) and join wide columns back afterwards.
    """
    placed = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + position)
        .drop("_at", "_part", "_offset")
    )


def running_counts(df: DataFrame, group: str, order: str, **flags: Column) -> DataFrame:
    """Add, per flag, how many earlier rows of the same group carry it.

    One placement serves all flags, and a group of any size is spread over
    range partitions: counts run within a partition and are shifted by those
    of the group's partitions before (one small row per group and partition).
    """
    placed = cut(
        df.repartitionByRange(group, order)
        .sortWithinPartitions(group, order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    marks = {name: F.coalesce(flag, F.lit(False)).cast("bigint") for name, flag in flags.items()}
    sizes = placed.groupBy(group, "_part").agg(*[F.sum(m).alias(n) for n, m in marks.items()])
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        group, "_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in flags]
    )
    inside = Window.partitionBy(group, "_part").orderBy("_at")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumns(
        {n: F.coalesce(F.sum(m).over(inside), F.lit(0)) for n, m in marks.items()}
    )
    joined = running.join(broadcast_if_small(offsets), [group, "_part"])
    return joined.withColumns({n: F.col(n) + F.col(f"_{n}") for n in flags}).drop(
        "_at", "_part", *[f"_{n}" for n in flags]
    )


def position_within(df: DataFrame, group: str, order: str, out: str = "at") -> DataFrame:
    """Dense position from 0 within each group, also for one huge group."""
    return running_counts(df, group, order, **{out: F.lit(True)})


def slice_of(ordinal: Column, slices: int) -> Column:
    """Round-robin slice: ordinal mod ``slices``."""
    return F.pmod(ordinal, F.lit(slices)).cast("int")


def first_rows(df: DataFrame, order: str, limit: int | None) -> DataFrame:
    """First ``limit`` rows in order when it is positive, else everything."""
    return df.orderBy(order).limit(limit) if limit and limit > 0 else df


def head_tail_split(df: DataFrame, *order: str, ratio: float = 0.9) -> DataFrame:
    """Add ``side``: train for the first max(1, floor(ratio * n)) rows, else valid.

    When nothing is left for valid, the last train row appears on both sides.
    """
    numbered = dense_ordinal(df, *order, out="_i")
    total = numbered.count()
    cutoff = max(1, int(total * ratio))
    sided = numbered.withColumn("side", F.when(F.col("_i") < cutoff, "train").otherwise("valid"))
    if cutoff >= total:
        last = numbered.filter(F.col("_i") == total - 1).withColumn("side", F.lit("valid"))
        sided = sided.unionByName(last)
    return sided.drop("_i")
