"""Near-duplicate documents by a chosen-path set-similarity join.

A document is its set of shingles. Equal sets are one node from the start. Every
node draws minwise tokens: one per tree, and a sketch of 128 more. In each of
``TREES`` independent trees a node begins on the path of that tree's token, so a
pair of similarity s shares a path with probability s per tree, and misses all
of them with (1 - s) ** TREES, 6e-8 at 0.75, where no path has to branch.

On every path the members are first compared with one pivot, the same one in
all trees, which joins most groups of copies; in ``STARS`` - 1 more rounds with
two, one of the path's largest component and one of the others. Between rounds a
component goes by the name of a linked node; components in full are made once, last. Then a path is small if no more
than ``SMALL`` of its members are outside its largest component: these are
compared with all members. Members of any other path, as passages and templates make
them, go two ways, split by which shingles are common in a sample of such members:

* Pairs that share a rare shingle meet on paths of rare ones: of ``RARE_TREES`` trees
  each, and where over ``RICH`` of a set is common of its first rare ones, as many as a linked
  pair must have one of. A pair of which either is below ``RICH`` has at least 0.58 of the union
  of their rare shingles in common, so all trees miss it with 8e-7.
* Pairs that share common shingles only are linked only if 175 * the smaller number of
  common ones >= 75 * the sum of sizes. Members that can fit this with another stay on the path. With over
  ``WIDE`` of them outside its largest component it branches: each goes on to the paths of two further minwise
  tokens, at distinct places chosen by a hash of the path, until none is as wide. A pair at 0.75 so has 1.5 expected
  meetings a level for each one before: in one tree it is kept at any depth with probability 8/9, and missed by
  all trees with (1 - 0.75 * 8/9) ** TREES, 1.9e-6, if places are taken as independent.

Where over half of those outside the largest component go the same way, two ways
cost more than they divide: such paths, those still wide at ``DEEPEST``, those up to ``WIDE`` and large paths of
rare shingles are compared in full, by blocks of ``BLOCK`` on either side, on full sets; what leaves a pair of blocks is
at most one link for each component it joins, however many pairs are alike. Comparisons still grow with
the square of such a path, rows with the square over ``BLOCK``.

Sketches decide only what is looked at (a pair at the limit is overlooked with
probability 1e-7); every link is confirmed on the full sets. A path, pivot or
group of copies may hold any share of the rows: members meet their path's row
through ``join_groups``, and a document compared with many is dealt out in
salted copies. Numbers of rows and at most ``COMMON`` hashes of common shingles reach the driver.

Null and empty texts, and texts of white space, have an empty set and are linked
with nothing. Rows that repeat a key, and rows of a null key, count as documents of
their own: a row is known by its key and a hash of its text, and only rows equal in both
share one answer. A component without any key has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import BATCH, Scratch, free_shuffles, join_groups, slices, text_bytes
from siftwork.llm.components import components

SHINGLE, SHARED, OF = 5, 75, 100  # words; 100 * intersection >= 75 * union
TREES, SKETCH = 12, 128
SMALL, DEEPEST = 24, 12
WIDE = 4096  # members outside the largest component up to which a path is compared in full and not divided
STARS = 2
RARE_TREES = 16  # further trees over rare shingles, for members of large paths
RICH = 0.4  # share of common shingles from which all rare ones up to a quarter of the set are taken
SAMPLE, SEEN, COMMON = 16384, 4, 1 << 17  # texts that show what is common; least times seen; most shingles
BLOCK = 1024  # members of a path that one task compares with as many others
JUMPS = 2  # pointers followed to name a component between rounds
SKETCH_LIMIT = 70  # agreeing sketch places; 96 are expected at 0.75, 5.3 deviations above
PER_COPY = 64  # comparisons that one copy of a document serves

_random = np.random.default_rng(6)
_PLACES = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _random.integers(0, 1 << 63, TREES + SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RARE = _random.integers(0, 1 << 63, RARE_TREES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


class Shingles:
    """Sorted 64-bit hashes of the distinct shingles of texts."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if len(self.words) > 300_000:
            self.words.clear()
        known = self.words
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(ids) - SHINGLE + 1
        if n > 0:
            total = sum(ids[i : n + i] * _PLACES[i] for i in range(SHINGLE))
            return np.unique(_scramble(total))
        if len(ids):
            return _scramble((ids * _SHORT[: len(ids)]).sum(keepdims=True) + np.uint64(len(ids)))
        return np.empty(0, np.uint64)


def signed_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, mark, node, n, tokens, sketch); ``mark`` is a hash of the text, ``node`` a 16-byte digest of the set."""
    added = "mark long, node binary, n long, tokens array<int>, sketch binary"
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches):
            sets = [shingles.of(t) for t in text_bytes(batch.column(text))]
            size = np.array(list(map(len, sets)))
            full = np.flatnonzero(size)
            lows = np.zeros((len(sets), TREES + SKETCH), np.uint32)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.cumsum(size[full]) - size[full]
                for j, times in enumerate(_TIMES):
                    values = ((flat * times) >> np.uint64(32)).astype(np.uint32)
                    lows[full, j] = np.minimum.reduceat(values, starts)
            ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * TREES)
            tokens = pa.ListArray.from_arrays(ends, pa.array(lows[:, :TREES].astype(np.int32).ravel()))
            sketch = (_scramble(lows[:, TREES:].astype(np.uint64)) & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    batch.column("mark"),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array(size, pa.int64()),
                    tokens,
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                ],
                names=[key, "mark", "node", "n", "tokens", "sketch"],
            )

    return df.select(key, text, F.xxhash64(text).alias("mark")).mapInArrow(run, schema)


def _may_link(na, fa, sa, nb, fb, sb) -> np.ndarray:
    """Sizes n, the most that each can share (f, at most n) and sketches allow a link; arguments broadcast."""
    fits = (OF + SHARED) * np.minimum(fa, fb) >= SHARED * (na + nb)
    return fits & ((sa == sb).sum(axis=-1) >= SKETCH_LIMIT)


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _candidate_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of members (node, n, f, sketch, comp, out) with those in ``those`` of other components.

    Two members that are both ``out`` meet twice, each among the other's ``those``, and count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            if not batch.num_rows:
                continue
            lists = batch.column("those")
            count = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), count)
            flat = lists.flatten()
            other = {f: flat.field(f) for f in ("node", "n", "f", "sketch", "comp")}
            near = _may_link(
                batch.column("n").to_numpy()[row], batch.column("f").to_numpy()[row], _sketches(batch.column("sketch"))[row],
                other["n"].to_numpy(), other["f"].to_numpy(), _sketches(other["sketch"]),
            ) if len(row) else np.empty(0, bool)
            at = np.flatnonzero(near)
            mine, comp, out = (batch.column(c).to_pylist() for c in ("node", "comp", "out"))
            theirs, comps = other["node"].to_pylist(), other["comp"].to_pylist()
            pairs = {
                (min(mine[i], theirs[k]), max(mine[i], theirs[k]))
                for i, k in zip(row[at].tolist(), at.tolist())
                if comp[i] != comps[k] and (mine[i] < theirs[k] or (mine[i] != theirs[k] and not out[i]))
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[s] for p in pairs], pa.binary()) for s in (0, 1)], names=["a", "b"]
            )

    return met.select("node", "n", "f", "sketch", "comp", "out", "those").mapInArrow(run, "a binary, b binary").distinct()


def _pairs_of_small(small: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate pairs of paths with few outside the largest component: these meet all members."""
    those = small.filter("comp != main").groupBy("path").agg(
        F.first("m").alias("m"), F.collect_list(F.struct("node", "n", "f", "sketch", "comp")).alias("those")
    )
    met = join_groups(small.drop("m"), scratch.store(those), "path", "m")
    return _candidate_pairs(met.withColumn("out", F.col("comp") != F.col("main")))


class _Block:
    """Members of a path, held to be compared with others, and the components that links found here join."""

    def __init__(self, shingles: Shingles):
        self.shingles = shingles
        self.rows: list[tuple] = []
        self.names: dict[bytes, int] = {}
        self.up: list[int] = []

    def label(self, comp: bytes) -> int:
        if comp not in self.names:
            self.names[comp] = len(self.up)
            self.up.append(len(self.up))
        at = self.names[comp]
        while self.up[at] != at:
            at = self.up[at]
        return at

    def close(self) -> None:
        """No more members come; sets are numbered by the shingles of this block."""
        self.nodes, comps, n, f, sketches, texts = zip(*self.rows)
        self.n, self.f, self.sketch = np.array(n), np.array(f), np.stack(sketches)
        self.head = np.array([int.from_bytes(x[:8]) for x in self.nodes], np.uint64)
        self.labels = np.array([self.label(c) for c in comps])
        if texts[0] is not None:
            sets = [self.shingles.of(t) for t in texts]
            self.starts = np.cumsum([0, *map(len, sets)])
            self.known, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.rows = []

    def shared(self, one: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many shingles of ``one`` each of the members ``at`` has."""
        place = np.minimum(np.searchsorted(self.known, one), len(self.known) - 1)
        held = np.zeros(len(self.known), np.int32)
        held[place[self.known[place] == one]] = 1
        if len(at) > len(self.nodes) // 8:
            return np.add.reduceat(held[self.flat], self.starts[:-1])[at]
        return np.array([held[self.flat[self.starts[k] : self.starts[k + 1]]].sum() for k in at.tolist()])

    def met(self, node: bytes, comp: bytes, n: int, f: int, sketch: np.ndarray, text: bytes | None, out: bool) -> Iterator[bytes]:
        """Members that may link with ``node``; with texts, a linked one of each component not yet joined with its own.

        Two that are both outside meet twice, and are compared where the lower is held.
        """
        label = self.label(comp)
        fits = (self.labels != label) & ((OF + SHARED) * np.minimum(self.f, f) >= SHARED * (self.n + n))
        if out:
            fits &= self.head <= int.from_bytes(node[:8])
        at = np.flatnonzero(fits)
        at = at[_may_link(self.n[at], self.f[at], self.sketch[at], n, f, sketch)]
        if text is None:
            yield from (self.nodes[k] for k in at.tolist())
        elif len(at):
            shared = self.shared(self.shingles.of(text), at)
            for k in at[OF * shared >= SHARED * (self.n[at] + n - shared)].tolist():
                other = int(self.labels[k])
                if other != label:
                    self.up[other] = label
                    self.labels[self.labels == other] = label
                    yield self.nodes[k]


def _pairs_in_full(large: DataFrame, level: int, texts: DataFrame | None = None) -> DataFrame:
    """Candidate pairs of all members with those outside the largest component, for paths of any size.

    Both sides are cut into blocks by hash and a task holds one block of those
    outside while a block of members goes by: a row is copied once for every
    ``BLOCK`` rows of the other side. Given ``texts`` (node, text), full sets are compared there, and of the
    links those that join two components are returned, fewer than the rows of the cell.
    """
    blocks, parts = (F.ceil(F.col(c) / BLOCK).cast("long") for c in ("others", "m"))
    zero = F.lit(0).cast("long")
    place = F.xxhash64("node", F.lit(level))
    columns = ["node", "n", "f", "sketch", "comp", "text"]
    large = large.join(texts, "node") if texts is not None else large.withColumn("text", F.lit(None).cast("string"))
    large = large.withColumn("out", F.col("comp") != F.col("main"))
    held = large.filter("out").select(
        "path", F.pmod(place, blocks).alias("block"), F.explode(F.sequence(zero, parts - 1)).alias("part"),
        F.lit(0).alias("side"), *columns, "out",
    )
    passing = large.select(
        "path", F.explode(F.sequence(zero, blocks - 1)).alias("block"), F.pmod(place, parts).alias("part"),
        F.lit(1).alias("side"), *columns, "out",
    )
    dealt = held.unionByName(passing).withColumn("cell", F.xxhash64("path", "block", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        cell, block = None, _Block(shingles)
        for batch in slices(batches):
            found: list[tuple[bytes, bytes]] = []
            names = ("cell", "side", "node", "comp", "n", "f", "out", "text")
            columns = (batch.column(c).cast(pa.binary() if c == "text" else batch.column(c).type).to_pylist() for c in names)
            for (its, side, node, comp, n, f, out, text), sketch in zip(zip(*columns), _sketches(batch.column("sketch"))):
                if its != cell:
                    cell, block = its, _Block(shingles)
                if side == 0:
                    block.rows.append((node, comp, n, f, sketch, text))
                    continue
                if block.rows:
                    block.close()
                if block.names:
                    found += [(min(node, k), max(node, k)) for k in block.met(node, comp, n, f, sketch, text, out)]
            yield pa.RecordBatch.from_arrays([pa.array([p[s] for p in found], pa.binary()) for s in (0, 1)], names=["a", "b"])

    ordered = dealt.drop("path", "block", "part").repartition("cell").sortWithinPartitions("cell", "side")
    return ordered.select("cell", "side", *columns, "out").mapInArrow(run, "a binary, b binary").distinct()


def _common(crowd: DataFrame, scratch: Scratch) -> np.ndarray:
    """The most frequent shingles of a sample of ``crowd`` (node, text), no more than ``COMMON``.

    Any choice gives the same links: it decides only which of two ways finds them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches):
            for text in text_bytes(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(shingles.of(text).view(np.int64))], names=["shingle"])

    every = max(1, crowd.count() // SAMPLE)
    some = crowd.filter(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(every)) == 0)
    seen = some.select("text").mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    seen = scratch.store(seen.filter(F.col("n") >= SEEN))
    least, total = SEEN, 0
    for n, k in sorted(map(tuple, seen.groupBy("n").agg(F.count("*")).collect()), reverse=True):
        total += k
        if total > COMMON:
            least = n + 1
            break
    frequent = seen.filter(F.col("n") >= least).select("shingle").toArrow()
    return np.sort(frequent["shingle"].to_numpy().view(np.uint64))


def _rare_paths(crowd: DataFrame, common: np.ndarray) -> DataFrame:
    """Rows (node, n, f, paths): the size of the set, how many of it are common, and paths of rare ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches):
            sizes, shares, paths = [], [], []
            for text in text_bytes(batch.column("text")):
                one = shingles.of(text)
                rare = one[~np.isin(one, common, assume_unique=True)] if len(common) else one
                n, f = len(one), len(one) - len(rare)
                made = []
                if len(rare):
                    lows = [((rare * times) >> np.uint64(32)).min() for times in _RARE]
                    made.append(_scramble(np.array(lows, np.uint64) + (np.arange(1, RARE_TREES + 1, dtype=np.uint64) << np.uint64(32))))
                if f > RICH * n:
                    made.append(_scramble(rare[: n - -(-SHARED * n // OF) + 1]))
                sizes.append(n)
                shares.append(f)
                paths.append(np.concatenate(made).view(np.int64) if made else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sizes, pa.int64()), pa.array(shares, pa.int64()), pa.array(paths, pa.list_(pa.int64()))],
                names=["node", "n", "f", "paths"],
            )

    return crowd.select("node", "text").mapInArrow(run, "node binary, n long, f long, paths array<long>")


def _linked_by_common(large: DataFrame, rich: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of large paths that may have a link by common shingles alone.

    Two sets that share common ones only share at most the smaller f, so a link takes
    175 * min(f) >= 75 * (n + n'). Of two such members one, at least, has 175 * f >= 150 * n itself;
    another is left only if it fits the smallest of these on its path.
    """
    most, pure = (OF + SHARED) * F.col("f"), (OF + SHARED) * F.col("f") >= 2 * SHARED * F.col("n")
    held = large.select("path", "node", "comp", "m").join(rich.select("node", "n", "f"), "node")
    held = scratch.store(held.filter(F.col("f") * OF >= F.col("n") * SHARED))
    least = held.filter(pure).groupBy("path").agg(F.min("n").alias("least"), F.first("m").alias("m"))
    met = join_groups(held.drop("m"), scratch.store(least), "path", "m")
    return met.filter(pure | (most >= SHARED * (F.col("n") + F.col("least")))).select("path", "node", "n", "f", "comp")


def confirmed(pairs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs whose full sets are alike enough; ``texts`` has (node, text)."""
    counts = scratch.store(pairs.groupBy("a").agg(F.count("*").alias("n")))
    copies = F.ceil(F.col("n") / PER_COPY).cast("int")
    dealt = join_groups(pairs, counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), copies).alias("copy"))
    ones = counts.join(texts.withColumnRenamed("node", "a"), "a").select(
        "a", F.col("text").alias("text_a"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy")
    )
    others = dealt.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    met = others.join(ones, ["a", "copy"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        last, one = None, np.empty(0, np.uint64)
        for batch in slices(batches):
            keep = []
            first, texts_a, texts_b = (batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
            for i, (a, text_a, text_b) in enumerate(zip(first, texts_a, texts_b)):
                if a != last:
                    last, one = a, shingles.of(text_a)
                two = shingles.of(text_b)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                if OF * shared >= SHARED * (len(one) + len(two) - shared):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return met.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def near_components(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_shingles, component_id, kept), one per row of ``df``."""
    return marked_components(df, key, text).drop("mark", "stands")


def marked_components(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`near_components`, with the ``mark`` of the text, and whether the row
    ``stands`` for its component: of the rows with its least key the one of least mark."""
    scratch = Scratch(df.sparkSession, BATCH)
    signed = scratch.store(signed_sets(df, key, text))
    nodes = scratch.store(
        signed.filter("n > 0").groupBy("node").agg(
            F.count("*").alias("copies"), F.min(key).alias("first"), F.first("n").alias("n"),
            F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "mark")).alias("low"),
            F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"),
        )
    )
    # Level 0: the paths of the trees' own tokens, where a path with one member is over.
    rooted = nodes.select("node", F.posexplode("tokens").alias("tree", "token"))
    rooted = rooted.select("node", F.xxhash64("tree", "token").alias("path"))
    order = F.struct(F.xxhash64("node").alias("h"), "node")
    paths = rooted.groupBy("path").agg(F.count("*").alias("m"), F.min(order).alias("low")).filter("m > 1")
    paths = scratch.store(paths.select("path", "m", F.col("low.node").alias("pivot")))
    met = scratch.store(join_groups(rooted, paths, "path", "m").select("path", "node", "pivot"))
    involved = scratch.store(met.select("node").distinct().join(nodes, "node").select("node", "low", "n", "sketch"))
    wanted = involved.select("node", F.col("low.key").alias("_key"), F.col("low.mark").alias("_mark"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark"))
    whole = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    texts = scratch.store(whole.join(wanted, same).select("node", "text").dropDuplicates(["node"]))
    involved = involved.drop("low")
    free_shuffles(df.sparkSession)
    stars = met.filter("node != pivot").select("node", "pivot").distinct()
    links = scratch.store(confirmed(_star_pairs(stars, involved, scratch), texts, scratch))
    free_shuffles(df.sparkSession)
    for number in range(1, STARS):
        mixed = _mixed(_placed(met, _named(links, scratch), scratch), scratch)
        order = F.struct(F.xxhash64("node", F.lit(number)).alias("h"), "node", "comp")
        pivots = mixed.groupBy("path").agg(
            F.first("m").alias("m"),
            F.min(F.when(F.col("comp") == F.col("main"), order)).alias("inner"),
            F.min(F.when(F.col("comp") != F.col("main"), order)).alias("outer"),
        )
        pivots = scratch.store(pivots.select("path", "m", F.array("inner", "outer").alias("pivots")))
        stars = join_groups(mixed.select("path", "node", "comp"), pivots, "path", "m")
        stars = stars.select("node", "comp", F.explode("pivots").alias("pivot")).filter("comp != pivot.comp")
        pairs = _star_pairs(stars.select("node", "pivot.node").toDF("node", "pivot").distinct(), involved, scratch)
        links = scratch.store(links.unionByName(confirmed(pairs, texts, scratch)).distinct())
        free_shuffles(df.sparkSession)
    named = _named(links, scratch)
    mixed = _mixed(_placed(met, named, scratch), scratch)
    sets = involved.withColumn("f", F.col("n"))
    small = mixed.filter(F.col("others") <= SMALL).join(sets, "node")
    large = mixed.filter(F.col("others") > SMALL)
    if large.isEmpty():
        found = _pairs_of_small(scratch.store(small), scratch)
    else:
        found, sure = _large_paths(large, small, named, sets, texts, scratch)
        links = links.unionByName(sure)
        free_shuffles(df.sparkSession)
    extra = confirmed(scratch.store(found.distinct()), texts, scratch)
    comps = components(links.unionByName(scratch.store(extra)), scratch)
    sizes = nodes.join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = scratch.store(sizes.select("node", "first", "low", "copies", "root"))
    lowest = sizes.groupBy("root").agg(F.min("first").alias("component_id"), F.min("low").alias("lowest"), F.count("*").alias("k"))
    named = join_groups(sizes, scratch.store(lowest), "root", "k").select("node", "copies", "component_id", "lowest")
    named = scratch.store(named)
    rows = signed.select(key, "mark", "node", "n")
    linked = join_groups(rows.filter("n > 0"), named, "node", "copies")
    stands = F.col("lowest.key").eqNullSafe(F.col(key)) & (F.col("lowest.mark") == F.col("mark"))
    alone = rows.filter("n = 0").select(key, "mark", "n", F.col(key).alias("component_id"), F.lit(True).alias("stands"))
    answer = linked.select(key, "mark", "n", "component_id", stands.alias("stands")).unionByName(alone)
    is_first = F.col(key).eqNullSafe(F.col("component_id")).alias("kept")
    answer = scratch.store(
        answer.select(key, F.col("n").alias("n_shingles"), "component_id", is_first, "mark", "stands"), keep=True
    )
    scratch.release()
    return answer


def _large_paths(
    large: DataFrame, small: DataFrame, named: DataFrame, sets: DataFrame, texts: DataFrame, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs, and links, of the members of large paths (path, node, comp, m, main, others) and of ``small`` ones."""
    crowd = scratch.store(texts.join(large.select("node").distinct(), "node"))
    rich = scratch.store(_rare_paths(crowd, _common(crowd, scratch)))
    rare = rich.select("node", F.explode("paths").alias("path"))
    paths = scratch.store(rare.groupBy("path").agg(F.count("*").alias("m")).filter("m > 1"))
    rare = _placed(join_groups(rare, paths, "path", "m"), named, scratch).join(sets, "node")
    alike = _linked_by_common(large, rich, scratch).join(sets.select("node", "sketch"), "node")
    members = rare.withColumn("rare", F.lit(True)).unionByName(alike.withColumn("rare", F.lit(False)))
    members = scratch.store(members.withColumn("was", F.lit(None).cast("long")))
    found, sure, level = [], [], 0
    before = Scratch(large.sparkSession, BATCH)
    while True:
        here = Scratch(large.sparkSession, BATCH)
        mixed = _mixed(members, here)
        before.release()
        few = mixed.filter(F.col("others") <= SMALL)
        few = few if level else few.select(*small.columns).unionByName(small)
        found.append(scratch.store(_pairs_of_small(here.store(few), here)))
        wide = mixed.filter(F.col("others") > SMALL)
        much = F.coalesce(2 * F.col("others") > F.col("was"), F.lit(False))
        full = F.lit(level >= DEEPEST) | F.col("rare") | (F.col("others") <= WIDE) | much
        sure.append(scratch.store(_pairs_in_full(wide.filter(full), level, crowd)))
        wide = wide.filter(~full)
        if wide.isEmpty():
            break
        level += 1
        members = _branches(wide, level)
        before = here
    here.release()
    return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, sure)


def _named(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (node, comp) of linked nodes: ``comp`` is a node that ``node`` is connected with, its
    linked node of lowest hash, followed ``JUMPS`` times. Equal names mean connected;
    connected nodes may still differ, which costs comparisons and no link."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), "b")).alias("low"))
    lower = F.col("low.h") < F.xxhash64("node")
    named = scratch.store(best.select("node", F.when(lower, F.col("low.b")).otherwise(F.col("node")).alias("comp")))
    for _ in range(JUMPS):
        sizes = named.groupBy("comp").agg(F.count("*").alias("n"))
        tops = scratch.store(sizes.join(named.select(F.col("node").alias("comp"), F.col("comp").alias("up")), "comp"))
        named = scratch.store(join_groups(named, tops, "comp").select("node", F.col("up").alias("comp")))
    return named


def _placed(met: DataFrame, named: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (path, node, comp) of members of paths; a node without links is a component of its own."""
    placed = met.select("path", "node").join(named, "node", "left")
    return scratch.store(placed.select("path", "node", F.coalesce("comp", "node").alias("comp")))


def _mixed(members: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of paths with more than one component; per path its size, largest
    component and how many members are outside it. ``members`` is read twice."""
    parts = members.groupBy("path", "comp").agg(F.count("*").alias("c"))
    stats = parts.groupBy("path").agg(F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"))
    stats = stats.select("path", "m", F.col("top.comp").alias("main"), (F.col("m") - F.col("top.c")).alias("others"))
    return scratch.store(join_groups(members, scratch.store(stats.filter("others > 0")), "path", "m"))


def _star_pairs(stars: DataFrame, involved: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate pairs of members with pivots (node, pivot), which may have any number of them."""
    stars = scratch.store(stars)
    pivots = stars.groupBy("pivot").agg(F.count("*").alias("k"))
    pivots = scratch.store(
        pivots.join(involved.select(F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("sketch").alias("ps")), "pivot")
    )
    met = join_groups(stars, pivots, "pivot", "k").join(involved, "node")
    those = F.array(F.struct(F.col("pivot").alias("node"), F.col("pn").alias("n"), F.col("pn").alias("f"), F.col("ps").alias("sketch"), F.col("pivot").alias("comp")))
    met = met.select("node", "n", F.col("n").alias("f"), "sketch", F.col("node").alias("comp"), F.lit(False).alias("out"), those.alias("those"))
    return scratch.store(_candidate_pairs(met))


def _branches(large: DataFrame, level: int) -> DataFrame:
    """Members on the paths two tokens further, at distinct places of the sketch.

    ``was`` is how many were outside the largest component of the path before.
    """
    ways = F.explode(F.array(F.lit(0), F.lit(1))).alias("way")
    spread = large.select("path", "node", "n", "f", "sketch", "comp", "rare", F.col("others").alias("was"), ways)
    first = F.xxhash64("path", F.lit(level))
    apart = F.col("way") * (1 + F.pmod(F.xxhash64("path", F.lit(-level)), F.lit(SKETCH - 1)))
    place = F.pmod(F.pmod(first, F.lit(SKETCH)) + apart, F.lit(SKETCH)).cast("int")
    token = F.substring(F.col("sketch"), place + 1, F.lit(1))
    path = F.xxhash64("path", "way", place, token).alias("path")
    return spread.select(path, "node", "n", "f", "sketch", "comp", "rare", "was")


def without_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` for each component, with all columns.

    Rows without words are linked with nothing and all stay.
    """
    found = marked_components(df, key, text).filter("stands")
    sets = F.when(F.col("n_shingles") > 0, F.count("*")).otherwise(1).alias("_copies")
    found = found.groupBy(F.col(key).alias("_key"), F.col("mark").alias("_mark"), "n_shingles").agg(sets)
    same = F.col(key).eqNullSafe(F.col("_key")) & F.xxhash64(text).eqNullSafe(F.col("_mark"))
    met = df.join(found, same)
    once = met.filter("_copies = 1").select(*df.columns)
    if found.filter("_copies > 1").isEmpty():
        return once
    order = Window.partitionBy("_key", "_mark").orderBy(F.monotonically_increasing_id())
    first = met.filter("_copies > 1").withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    return once.unionByName(first.select(*df.columns))
