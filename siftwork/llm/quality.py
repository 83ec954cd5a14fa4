"""Quality rules: boosted trees over document statistics, with base rules first.

``with_statistics`` measures every whole text in one pass. ``fit`` grows
gradient-boosted trees on quantile bins of the statistics of labelled rows, on
the driver and from at most ``MAX_FIT_ROWS`` of them (a documented bound: the
rows of smallest key hash, so the sample does not depend on their order). Some
statistics are monotonic: more repetition or more symbols never raises a score;
a split that breaks the direction is refused and leaf values stay between the
bounds handed down. The trees are flattened into plain numpy node arrays, and
a batch of documents walks all of them level by level.

Null and empty texts have all statistics 0 and fail the base rules. Without
labelled rows of both kinds every document passes the method. Columns that
share a name with an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import slices, text_bytes

MAX_FIT_ROWS = 20_000
TREES, DEPTH, RATE, BINS, SMALLEST_LEAF = 60, 4, 0.2, 64, 20
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BLANKS = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"

# Statistic, and the direction a score may take when it rises (0: any).
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "repeated_lines": -1,
    "repeated_words": -1,
    "distinct_words": 0,
    "top_word": -1,
    "upper": 0,
    "digits": 0,
    "marks": 0,
    "stops_per_word": 0,
    "exclaims_per_word": -1,
    "lines_per_word": 0,
    "non_ascii": 0,
    "longest_word": 0,
}

_BYTES = np.arange(256)
_GROUPS = np.stack(
    [
        np.isin(_BYTES, list(SYMBOLS)),
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 97) & (_BYTES <= 122),
        (_BYTES >= 48) & (_BYTES <= 57),
        np.isin(_BYTES, list(b".,;:?!'\"()-")),
        np.isin(_BYTES, list(b".?!")),
        _BYTES == ord("!"),
        _BYTES == ord("\n"),
        _BYTES >= 128,
        np.isin(_BYTES, list(BLANKS)),
        (_BYTES & 0xC0) != 0x80,
    ]
).astype(np.int64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """Base counts and features of one whole text."""
    words = text.split()
    n = len(words)
    per_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    symbols, upper, lower, digits, marks, stops, exclaims, breaks, wide, blanks, points = (_GROUPS @ per_byte).tolist()
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    repeated_lines = len(lines) - len(set(lines))
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    repeated_words = 0
    if n >= 3:
        windows = ids[:-2] * _MIX[0] + ids[1:-1] * _MIX[1] + ids[2:] * _MIX[2]
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        again = np.zeros(n - 2, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        edge = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(again)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + 3, -1)
        repeated_words = int((np.cumsum(edge[:-1]) > 0).sum())
    base = [n, points - blanks, symbols, repeated_lines, repeated_words]
    if not n:
        return base, [0.0] * len(FEATURES)
    size = max(points - blanks, 1)
    counts = np.unique(ids, return_counts=True)[1]
    return base, [
        float(np.log1p(n)),
        size / n,
        symbols / n,
        repeated_lines / max(len(lines), 1),
        repeated_words / n,
        len(counts) / n,
        float(counts.max()) / n,
        upper / max(upper + lower, 1),
        digits / size,
        marks / n,
        stops / n,
        exclaims / n,
        breaks / n,
        wide / len(text),
        float(np.log1p(max(map(len, words)))),
    ]


def with_statistics(df: DataFrame, text: str = "text", features: str = "features") -> DataFrame:
    """Replace ``text`` by the base counts and the array of features."""
    keep = [c for c in df.columns if c not in (text, features, *BASE)]
    schema = T.StructType(
        [
            *[df.schema[c] for c in keep],
            *[T.StructField(c, T.LongType()) for c in BASE],
            T.StructField(features, T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure(t) for t in text_bytes(batch.column(text))]
            counts = np.array([r[0] for r in rows], np.int64).reshape(len(rows), len(BASE))
            values = np.array([r[1] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            lists = pa.ListArray.from_arrays(ends, pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *map(pa.array, counts.T.copy()), lists],
                names=[*keep, *BASE, features],
            )

    return df.select(*keep, text).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass
class Trees:
    """Flattened trees: a leaf points at itself, so a walk may go on at it."""

    start: float
    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        at = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            below = x[rows, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(below, self.left[trees, at], self.right[trees, at])
        return self.start + self.value[trees, at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, directions: list[int]) -> Trees | None:
    """Boosted trees for labels 0/1; None without both."""
    if not 0 < y.sum() < len(y):
        return None
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(q, c, "left") for q, c in zip(cuts, x.T)], axis=1)
    nodes = 2 ** (DEPTH + 1) - 1
    shape = (TREES, nodes)
    feature, value = np.zeros(shape, np.int64), np.zeros(shape)
    threshold = np.full(shape, np.inf)
    left, right = np.tile(np.arange(nodes), (TREES, 1)), np.tile(np.arange(nodes), (TREES, 1))
    margin = np.zeros(len(y))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = weight * (p - y), weight * p * (1 - p)
        todo = [(0, np.arange(len(y)), -np.inf, np.inf)]
        while todo:
            node, rows, low, high = todo.pop()
            g, h = slope[rows].sum(), curve[rows].sum()
            value[t, node] = RATE * np.clip(-g / (h + 1), low, high)
            best = _best_split(binned, cuts, rows, slope, curve, directions, low, high) if node < nodes // 2 else None
            if best is None:
                margin[rows] += value[t, node]
                continue
            j, cut, middle = best
            feature[t, node], threshold[t, node] = j, cuts[j][cut]
            left[t, node], right[t, node] = 2 * node + 1, 2 * node + 2
            goes = binned[rows, j] <= cut
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            (a, b), (c, d) = bounds[directions[j]]
            todo += [(2 * node + 1, rows[goes], a, b), (2 * node + 2, rows[~goes], c, d)]
    return Trees(0.0, feature, threshold, left, right, value)


def _best_split(binned, cuts, rows, slope, curve, directions, low, high):
    """(feature, cut, middle of the two values) of the largest gain that is allowed."""
    best, choice = 1e-6, None
    g, h = slope[rows], curve[rows]
    total_g, total_h = g.sum(), h.sum()
    for j, direction in enumerate(directions):
        if not len(cuts[j]):
            continue
        bins, size = binned[rows, j], len(cuts[j]) + 1
        lg, lh, ln = (np.cumsum(np.bincount(bins, w, size))[:-1] for w in (g, h, None))
        rg, rh = total_g - lg, total_h - lh
        a, b = np.clip(-lg / (lh + 1), low, high), np.clip(-rg / (rh + 1), low, high)
        gain = lg**2 / (lh + 1) + rg**2 / (rh + 1) - total_g**2 / (total_h + 1)
        allowed = (ln >= SMALLEST_LEAF) & (len(rows) - ln >= SMALLEST_LEAF) & (direction * (b - a) >= 0)
        gain = np.where(allowed, gain, -1)
        cut = int(gain.argmax())
        if gain[cut] > best:
            best, choice = gain[cut], (j, cut, (a[cut] + b[cut]) / 2)
    return choice


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = MAX_FIT_ROWS,
) -> Trees | None:
    """Trees from labelled documents, at most ``max_rows`` by hash of the key."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key).agg(F.max(label).alias("_label"))
        .orderBy(F.xxhash64(key), key).limit(max_rows)
    )
    rows = with_statistics(df.select(key, text).join(F.broadcast(chosen), key), text)
    found = rows.select(key, "features", "_label").toPandas().sort_values(key)
    if found.empty:
        return None
    x = np.array(found["features"].tolist(), np.float64)
    return grow(x, found["_label"].to_numpy(np.float64), list(FEATURES.values()))


def with_verdict(
    measured: DataFrame, trees: Trees | None, features: str = "features", threshold: float = 0.5
) -> DataFrame:
    """Add ``score`` and ``kept``: the base rules and the trees both have to pass."""
    schema = T.StructType(
        [*[f for f in measured.schema.fields if f.name != "score"], T.StructField("score", T.DoubleType())]
    )
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(features).flatten().to_numpy()
            x = flat.reshape(batch.num_rows, len(FEATURES))
            score = trees.score(x) if trees else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(score)], names=[*names, "score"])

    scored = measured.select(*names).mapInArrow(run, schema)
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
