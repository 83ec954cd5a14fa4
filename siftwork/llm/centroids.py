"""Centroid clustering with the dimensions dealt out: Lloyd's rounds over column blocks.

Vectors are cut once into groups of rows and blocks of columns, stored one folder per
block. In a round

1. tasks of one column block compute the exact partial distances of their groups to
   that block's slice of the centroids, the only slice they load;
2. the blocks of a group are added by its number, and the least sum is the cluster
   (ties: the smaller number);
3. the labels, a few bytes a vector, meet the blocks again, and every block sums its
   columns per cluster: exact floors of sum / count are its new slice. An empty cluster
   keeps its centroid.

Vectors are integers: floor(scale * x) of each component x as a double. Partial
distances travel in the narrowest integers that hold them, and all sums are exact.
Groups are of equal size, so no vector or cluster, however common, is a hot key. The
driver sees the centroids alone: clusters times dimensions, whatever the rows.

Kept are vectors of exactly ``dims`` components, none null or non-finite; a null or
other vector has no row in the result, and an empty table gives none. Rows are told
apart by place: repeated keys are clustered one by one, a null key counts as an empty
text where keys are hashed. The first centroids are the vectors of smallest
SHA-256 of ``<salt>:<key>`` (ties: by components), all of them if there are fewer. A
scaled component beyond +-2^27 is an error, since a squared distance could then
pass a long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import Scratch, slices

GROUP = 128  # vectors that travel together
BLOCK = 16  # dimensions of a column block
LARGEST = 1 << 27
_EXACT = 1 << 21  # below this, sums of BLOCK products are exact in doubles


def _narrow(values: np.ndarray) -> bytes:
    """Non-negative or signed integers as one byte of width and their least form."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return kind[2:].encode() + values.astype(kind).tobytes()


def _wide(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<i{data[:1].decode()}", offset=1).reshape(-1, width).astype(np.int64)


def integer_vectors(df: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``(key, cells)`` of the vectors that are kept, as integers."""
    x = F.col(vector)
    usable = (F.size(x) == dims) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v):
        scaled = v.cast("double") * scale
        held = F.abs(scaled) <= LARGEST
        return F.when(held, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is too large")).cast("long"))

    return df.filter(x.isNotNull() & usable).select(F.col(key).alias("key"), F.transform(x, whole).alias("cells"))


def _cut_in_blocks(vectors: DataFrame, dims: int, width: int) -> DataFrame:
    """Rows (grp, block, cells) of all groups and blocks; block -1 has the group's keys."""
    keys = T.ArrayType(vectors.schema["key"].dataType)
    schema = T.StructType().add("grp", "long").add("block", "integer").add("cells", "binary").add("keys", keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, GROUP):
                part = batch.slice(low, GROUP)
                matrix = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                blocks = [_narrow(matrix[:, at : at + width]) for at in range(0, dims, width)]
                own = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
                rows = len(blocks) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * rows, pa.int64()),
                        pa.array(range(-1, len(blocks)), pa.int32()),
                        pa.array([None, *blocks], pa.binary()),
                        pa.concat_arrays([own, pa.nulls(len(blocks), own.type)]),
                    ],
                    names=["grp", "block", "cells", "keys"],
                )
                number += 1

    return vectors.mapInArrow(cut, schema)


def _distances(cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    small = max(int(np.abs(cells).max(initial=0)), int(np.abs(centroids).max(initial=0))) < _EXACT
    kind = np.float64 if small else np.int64
    a, c = cells.astype(kind), centroids.astype(kind)
    out = (a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)
    return out.astype(np.int64)


def _partial(cells: DataFrame, block: int, slice_of: Broadcast) -> DataFrame:
    width = slice_of.value.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = slice_of.value
        for batch in slices(batches):
            found = [_narrow(_distances(_wide(x, width), own)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["grp", "part"])

    return cells.filter(F.col("block") == block).select("grp", "cells").mapInArrow(measure, "grp long, part binary")


def _labels(parts: DataFrame, k: int) -> DataFrame:
    """``(grp, label, distance)`` by adding the blocks of each group."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(_wide(x, k) for x in group.column("part").to_pylist())
        label = total.argmin(axis=1)
        least = total[np.arange(len(total)), label]
        cells = [[group.column("grp")[0].as_py()], [_narrow(label)], [_narrow(least)]]
        return pa.table([pa.array(c, t) for c, t in zip(cells, (pa.int64(), pa.binary(), pa.binary()))], ["grp", "label", "distance"])

    return parts.groupBy("grp").applyInArrow(add, "grp long, label binary, distance binary")


def _sums(cells: DataFrame, labels: DataFrame, block: int, width: int, k: int) -> DataFrame:
    """``(cluster, dim, total, rows)`` of one column block, a row per cluster and column from each task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for data, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _wide(label, 1)[:, 0]
                np.add.at(total, own, _wide(data, width))
                rows += np.bincount(own, minlength=k)
        cluster, dim = np.divmod(np.arange(k * width), width)
        met = rows[cluster] > 0
        columns = [cluster[met], dim[met] + block * BLOCK, total.ravel()[met], rows[cluster][met]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "dim", "total", "rows"])

    met = cells.filter(F.col("block") == block).select("grp", "cells").join(labels.select("grp", "label"), "grp")
    return met.select("cells", "label").mapInArrow(add, "cluster long, dim long, total long, rows long")


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _place(rows: DataFrame, k: int) -> DataFrame:
    """``(key, cluster, distance)`` of stored labels met with the keys of their groups."""
    key = rows.schema["keys"].dataType.elementType
    schema = T.StructType().add("key", key).add("cluster", "integer").add("distance", "long")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                label, distance = (_wide(batch.column(i)[at].as_py(), 1)[:, 0] for i in (1, 2))
                own = batch.column(0).slice(at, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(label.astype(np.int32)), pa.array(distance)], names=["key", "cluster", "distance"]
                )

    return rows.select("keys", "label", "distance").mapInArrow(spread, schema)


def lloyd(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    salt: str = "2",
) -> DataFrame:
    """Cluster of every kept vector after ``rounds`` rounds and a last assignment.

    Returns ``key``, ``cluster`` (int), ``distance`` (squared), ``cluster_inertia`` and
    ``inertia`` (its sums over the cluster and over all, long) and ``centroid``
    (array<bigint>).
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    vectors = integer_vectors(df, key, vector, dims, scale)
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.select(hashed.alias("h"), "cells").orderBy("h", "cells").limit(k).collect()
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)])
    schema.add("cluster", "integer").add("distance", "long").add("cluster_inertia", "long").add("inertia", "long")
    schema.add("centroid", T.ArrayType(T.LongType()))
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["cells"] for r in first], dtype=np.int64)
    k, blocks = len(centroids), range(-(-dims // BLOCK))
    cells = scratch.store(_cut_in_blocks(vectors, dims, BLOCK), keep=True, by="block")
    for number in range(rounds + 1):
        sent = [spark.sparkContext.broadcast(centroids[:, b * BLOCK : (b + 1) * BLOCK]) for b in blocks]
        labels = _labels(_all([_partial(cells, b, sent[b]) for b in blocks]), k)
        labels = scratch.store(labels, keep=number == rounds)
        if number < rounds:
            sums = _all([_sums(cells, labels, b, sent[b].value.shape[1], k) for b in blocks])
            new = sums.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
            centroids = centroids.copy()
            for r in new.collect():  # clusters times dimensions
                centroids[r["cluster"], r["dim"]] = r["total"] // r["rows"]
    placed = _place(cells.filter("block = -1").select("grp", "keys").join(labels, "grp"), k)
    found = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(found.values())
    about = spark.createDataFrame(
        [(c, found[c], total, centroids[c].tolist()) for c in sorted(found)],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    scratch.release()
    return placed.join(F.broadcast(about), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
