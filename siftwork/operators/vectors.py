"""Near-duplicate removal by cosine similarity, keeping the first of each set.

The rule is greedy in row order, and exact: high-dimensional vectors leave no
bucket that is sure to hold every pair above the threshold.

1. Unit vectors are packed into tiles of neighbours: rows are range-partitioned by a
   curve through their coordinates on a few leading axes.
2. The next block of rows in order, of bounded size, is resolved by one task. Its
   survivors, packed the same way, are copied to every part of the tiles.
3. A part removes what resembles them. A pair of tile and pack is left out if
   its vectors cannot reach the threshold: with p, q the coordinates on the axes and
   r, s the norms of what is left of two vectors, x . y <= p . q + r s, bounded over
   the tiles' boxes.

No row passes the driver: it sees the axes and the rows per block. Copies of a
vector leave in the first pass, a pass shuffles the open rows once, and rows
that left make the next block longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.operators.ordering import dense_ordinal
from siftwork.session import Workspace

BLOCK_BYTES = 16 << 20
PART_BYTES = 64 << 20
AXES = 4
MOST_DIMS = 512  # above, the axes are the first coordinates: still exact, less pruned
_ROWS = 2048  # rows per matrix product
_TILE = 512
_SLACK = 1e-9  # for rounding in the bound
_TILES = "part int, tile binary, ords binary, blocks binary"


def _unit(batch: pa.RecordBatch | pa.Table, width: int, name: str = "v") -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if flat.size != len(column) * width:
        raise ValueError("vector length mismatch")
    vectors = flat.reshape(-1, width)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _greedy(units: np.ndarray, threshold: float) -> np.ndarray:
    """Indexes kept when rows are taken in order.

    A strip of rows is resolved one by one, then its survivors meet all later
    rows in one matrix product.
    """
    free = np.ones(len(units), dtype=bool)
    for start in range(0, len(units), _ROWS):
        strip = start + np.flatnonzero(free[start : start + _ROWS])
        close = units[strip] @ units[strip].T >= threshold
        for i, row in enumerate(strip):
            if free[row]:
                free[strip[i + 1 :][close[i, i + 1 :]]] = False
        leaders = units[strip[free[strip]]].T
        for later in range(start + _ROWS, len(units), _ROWS):
            part = slice(later, later + _ROWS)
            if leaders.size:
                free[part] &= (units[part] @ leaders).max(axis=1) < threshold
    return np.flatnonzero(free)


def leading_axes(units: DataFrame, width: int) -> np.ndarray:
    """(width, AXES) orthonormal axes of most weight, from sums of width x width products."""
    few = min(AXES, width)
    if width > MOST_DIMS:
        return np.eye(width)[:, :few]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _unit(batch, width)
            total += rows.T @ rows
        i, j = np.divmod(np.arange(width * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "x"])

    sums = units.select("v").mapInArrow(products, "i bigint, j bigint, x double").groupBy("i", "j").agg(F.sum("x"))
    matrix = np.zeros((width, width))
    for i, j, x in sums.collect():
        matrix[i, j] = x
    return np.linalg.eigh(matrix)[1][:, ::-1][:, :few].copy()


def _coordinates(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the axes, and the norm of what is left."""
    own = units @ axes
    rest = np.sqrt(np.maximum((units * units).sum(axis=1) - (own * own).sum(axis=1), 0.0))
    return np.column_stack([own, rest])


def _along_curve(coordinates: np.ndarray) -> np.ndarray:
    """Codes that put vectors with like coordinates near each other (bits interleaved)."""
    cells = np.clip((coordinates[:, :-1] + 1) * 128, 0, 255).astype(np.int64)
    code = np.zeros(len(cells), dtype=np.int64)
    for bit in range(7, -1, -1):
        for axis in range(cells.shape[1]):
            code = code << 1 | (cells[:, axis] >> bit & 1)
    return code


def _box(units: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = _coordinates(units, axes)
    return found.min(axis=0), found.max(axis=0)


def _reach(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The most that x . y can be for x in box a and y in box b."""
    ends = [x * y for x in a for y in b]
    return float(np.max(ends, axis=0)[:-1].sum() + a[1][-1] * b[1][-1]) + _SLACK


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(-1, width)


def _tiles(placed: DataFrame, width: int, axes: np.ndarray, parts: int) -> DataFrame:
    """Packs of up to _TILE neighbouring rows: (part, tile, ords, blocks)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                units = _unit(part, width)
                rows = pa.array([u.tobytes() for u in units], pa.binary())
                curve = pa.array(_along_curve(_coordinates(units, axes)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), curve, rows], names=["ord", "block", "code", "row"]
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def tile() -> pa.RecordBatch:
            ords, blocks, rows = zip(*held)
            cells = [
                pa.array([hash(ords) % parts], pa.int32()),
                pa.array([b"".join(rows)], pa.binary()),
                pa.array([np.array(ords, dtype=np.int64).tobytes()], pa.binary()),
                pa.array([np.array(blocks, dtype=np.int64).tobytes()], pa.binary()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(cells, names=["part", "tile", "ords", "blocks"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) == _TILE:
                    yield tile()
        if held:
            yield tile()

    coded = placed.select("ord", "v", "block").mapInArrow(code, "ord bigint, block bigint, code bigint, row binary")
    sorted_rows = coded.repartitionByRange(parts, "code", "ord").sortWithinPartitions("code", "ord")
    return sorted_rows.select("ord", "block", "row").mapInArrow(pack, _TILES)


def _in_one_block(narrow: DataFrame, width: int, threshold: float) -> DataFrame:
    """``(ord)`` of the rows that stay, of no more rows than a block holds."""

    def resolve(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        kept = _greedy(_unit(table, width), threshold)
        return pa.table([table.column("ord").take(pa.array(kept))], names=["ord"])

    return narrow.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(resolve, "ord bigint")


def _measured(rows: DataFrame, order: str, vector: str, block_rows: int | None) -> tuple[DataFrame, int, int, int]:
    """``(ord, v)``, its rows, the vectors' width and the rows of a block."""
    narrow = rows.select(
        F.col(order).cast("bigint").alias("ord"), F.col(vector).cast("array<double>").alias("v")
    ).filter("ord is not null")
    total, width = narrow.agg(F.count("*"), F.max(F.size("v"))).first()
    return narrow, total, width or 0, block_rows or max(1, BLOCK_BYTES // (8 * max(1, width or 0)))


class _Store:
    """The open rows of one run, in tiles."""

    def __init__(self, space: Workspace, narrow: DataFrame, total: int, width: int, size: int):
        self.space, self.width, self.size = space, width, size
        cores = narrow.sparkSession.sparkContext.defaultParallelism
        self.parts = max(1, -(-total * 8 * self.width // PART_BYTES), min(cores, -(-total // _TILE)))
        placed = dense_ordinal(narrow, "ord", out="_i")
        placed = placed.select("ord", "v", F.floor(F.col("_i") / self.size).alias("block"))
        self.axes = leading_axes(placed, self.width) if self.width else np.zeros((0, 0))
        self.open = space.store(_tiles(placed, self.width, self.axes, self.parts))

    def counts(self) -> list[tuple[int, int]]:
        """(block, open rows): a row per block, not per row."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [np.frombuffer(b, dtype=np.int64) for b in batch.column(0).to_pylist()]
                blocks, n = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(n)], names=["block", "n"])

        found = self.open.select("blocks").mapInArrow(count, "block bigint, n bigint")
        return sorted(map(tuple, found.groupBy("block").agg(F.sum("n")).collect()))

    def packs(self, first: int, last: int, threshold: float | None) -> DataFrame:
        """Rows of blocks first..last in packs (tile, ords); with a threshold only those greedy keeps."""
        width, axes = self.width, self.axes

        def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tile, ords, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                    own = np.frombuffer(blocks, dtype=np.int64)
                    hit = (own >= first) & (own <= last)
                    if hit.any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([0], pa.int32()),
                                pa.array([_matrix(tile, width)[hit].tobytes()], pa.binary()),
                                pa.array([np.frombuffer(ords, dtype=np.int64)[hit].tobytes()], pa.binary()),
                            ],
                            names=["one", "tile", "ords"],
                        )

        def resolve(table: pa.Table) -> pa.Table:
            units = np.concatenate([_matrix(t, width) for t in table.column("tile").to_pylist()])
            ords = np.concatenate([np.frombuffer(o, dtype=np.int64) for o in table.column("ords").to_pylist()])
            order = np.argsort(ords)
            units, ords = units[order], ords[order]
            if threshold is not None:
                kept = _greedy(units, threshold)
                units, ords = units[kept], ords[kept]
            near = np.argsort(_along_curve(_coordinates(units, axes)), kind="stable")
            units, ords = units[near], ords[near]
            at = range(0, len(ords), _TILE)
            return pa.table(
                [
                    pa.array([units[i : i + _TILE].tobytes() for i in at], pa.binary()),
                    pa.array([ords[i : i + _TILE].tobytes() for i in at], pa.binary()),
                ],
                names=["tile", "ords"],
            )

        chosen = self.open.select("tile", "ords", "blocks").mapInArrow(rows_of, "one int, tile binary, ords binary")
        return self.space.store(chosen.groupBy("one").applyInArrow(resolve, "tile binary, ords binary"))

    def _beside(self, packs: DataFrame):
        """The open tiles of every part, grouped with a copy of all packs."""
        part = F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))).alias("part")
        return self.open.groupBy("part").cogroup(packs.select(part, "tile", "ords").groupBy("part"))

    def remove_like(self, packs: DataFrame, last: int, threshold: float) -> None:
        """Close the blocks up to ``last`` and all rows that resemble a row of ``packs``."""
        width, axes = self.width, self.axes

        def survivors(left: pa.Table, right: pa.Table) -> pa.Table:
            leaders = [_matrix(t, width) for t in right.column("tile").to_pylist()]
            boxes = [_box(x, axes) for x in leaders]
            out: list[tuple] = []
            columns = (left.column(c).to_pylist() for c in ("part", "tile", "ords", "blocks"))
            for part, tile, ords, blocks in zip(*columns):
                units, number = _matrix(tile, width), np.frombuffer(blocks, dtype=np.int64)
                alive = np.flatnonzero(number > last)
                own = _box(units, axes)
                for other, box in zip(leaders, boxes):
                    if len(alive) and _reach(own, box) >= threshold:
                        alive = alive[(units[alive] @ other.T).max(axis=1) < threshold]
                if len(alive):
                    kept = np.frombuffer(ords, dtype=np.int64)[alive]
                    out.append((part, units[alive].tobytes(), kept.tobytes(), number[alive].tobytes()))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            cells = list(zip(*out)) or [()] * 4
            return pa.table([pa.array(c, t) for c, t in zip(cells, kinds)], names=["part", "tile", "ords", "blocks"])

        self.open = self.space.store(self._beside(packs).applyInArrow(survivors, _TILES))

    def pairs_with(self, packs: DataFrame, threshold: float) -> DataFrame:
        """``(src, dst, cosine)`` of rows of ``packs`` with later open rows."""
        width, axes = self.width, self.axes

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            heads = [(_matrix(t, width), np.frombuffer(o, dtype=np.int64)) for t, o in zip(*_columns(right))]
            boxes = [_box(x, axes) for x, _ in heads]
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for tile, ords in zip(*_columns(left)):
                units, tails = _matrix(tile, width), np.frombuffer(ords, dtype=np.int64)
                own = _box(units, axes)
                for (other, first), box in zip(heads, boxes):
                    if _reach(own, box) >= threshold:
                        close = units @ other.T
                        row, col = np.nonzero((close >= threshold) & (tails[:, None] > first[None, :]))
                        found.append((first[col], tails[row], close[row, col]))
            return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], names=["src", "dst", "cosine"])

        def _columns(table: pa.Table) -> tuple[list, list]:
            return table.column("tile").to_pylist(), table.column("ords").to_pylist()

        return self._beside(packs).applyInArrow(meet, "src bigint, dst bigint, cosine double")


def _ords(packs: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ords in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ords, dtype=np.int64))], names=["ord"])

    return packs.select("ords").mapInArrow(read, "ord bigint")


def _next_blocks(counts: list[tuple[int, int]], size: int) -> int:
    """As many next blocks as hold ``size`` rows together; rows that left made room."""
    last, rows = counts[0]
    for block, n in counts[1:]:
        if rows + n > size:
            break
        last, rows = block, rows + n
    return last


def drop_similar_vectors(
    rows: DataFrame, order: str, vector: str, threshold: float = 0.92, block_rows: int | None = None
) -> DataFrame:
    """Rows of ``rows`` that stay; ``order`` is a unique bigint.

    A zero vector resembles nothing (unless the threshold is 0 or less), and
    vectors of different lengths are an error.
    """
    spark = rows.sparkSession
    stays = spark.createDataFrame([], "ord bigint")
    narrow, total, width, size = _measured(rows, order, vector, block_rows)
    if total <= size:
        stays = _in_one_block(narrow, width, threshold)
        return rows.join(stays, rows[order].cast("bigint") == stays["ord"], "left_semi")
    with Workspace(spark) as space:
        store = _Store(space, narrow, total, width, size)
        while counts := store.counts():
            last = _next_blocks(counts, store.size)
            packs = store.packs(0, last, threshold)
            stays = stays.unionByName(space.store(_ords(packs), keep=True))
            if last == counts[-1][0]:
                break
            store.remove_like(packs, last, threshold)
    return rows.join(stays, rows[order].cast("bigint") == stays["ord"], "left_semi")


def similar_vectors(
    rows: DataFrame, order: str, vector: str, threshold: float = 0.92, block_rows: int | None = None
) -> DataFrame:
    """``(src, dst, cosine)``, src < dst, of all pairs at or above the threshold.

    One block of bounded size meets all rows per pass; only qualifying pairs
    are written. The result has as many rows as there are similar pairs.
    """
    spark = rows.sparkSession
    found = spark.createDataFrame([], "src bigint, dst bigint, cosine double")
    with Workspace(spark) as space:
        store = _Store(space, *_measured(rows, order, vector, block_rows))
        for block, _ in store.counts():
            packs = store.packs(block, block, None)
            found = found.unionByName(space.store(store.pairs_with(packs, threshold), keep=True))
    return found
