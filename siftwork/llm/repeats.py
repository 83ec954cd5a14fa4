"""Removal of long byte strings that occur anywhere else, without a suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts at
another place of the corpus, in the same document or not. Strings of that length
are told apart by refining q-gram buckets, by hashes of what lies around a
q-gram and not, as bucket pointers would be, by the buckets of later offsets:

* Every start falls into the bucket of a q-gram of its string, a quarter as long:
  the one with the lowest hash, leftmost if tied. Equal strings have it at the
  same offset, so only members of one bucket can be equal. Neighbouring starts
  share their q-gram; one row stands for all starts of an anchor (the place of
  the q-gram), about one in 130 bytes at 400.
* A bucket is refined by the identifiers of what lies around the anchor. Anchors
  that agree in their whole window are settled together: all their starts
  repeat. A bucket with a single member is done as well.
* What is left, mostly the borders of repeats, is refined start by start: at
  each offset, members are put in buckets by a hash of the bytes from there on,
  computed from running sums over the window. The sums are reused for all
  offsets, and a start repeats if its bucket has another member.

Buckets of more than 1/1024 of all rows are refined by combined counts over
blocks of offsets instead of in one task, joined back through ``join_groups``;
rows of one document are collapsed before any shuffle. Texts are shuffled once, and those
with open borders (a small part) once more.

Null and short texts have no string of that length. Rows that repeat key and
text are documents of their own, so they repeat each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import BATCH, HEAVY_KEYS, Scratch, join_groups, slices, text_bytes

LENGTH = 400
LONGEST = 1 << 14
SEGMENT = 1 << 20  # starts of a document that are worked on together
PLACE_BITS = np.uint64((1 << 24) - 1)
ROWS = 4096

_random = np.random.default_rng(20)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, factor = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(factor)
        factor = factor * factor % (1 << 64)
        done += more
    return out


_UP, _DOWN = _powers(_STEP, SEGMENT + LONGEST), _powers(_BACK, SEGMENT + LONGEST)


class Strings:
    """The length of the strings and of their q-grams, and what follows from them."""

    def __init__(self, length: int = LENGTH):
        if not 8 <= length <= LONGEST:
            raise ValueError(f"strings of 8 to {LONGEST} bytes, not {length}")
        self.length, self.gram = length, length // 4
        self.spread = length - self.gram  # largest offset of an anchor in a string
        self.width = length + self.spread  # bytes around an anchor that any of its strings may cover
        draw = np.random.default_rng(21)
        self.places = draw.integers(0, 1 << 63, (self.width, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = draw.integers(0, 1 << 63, self.spread + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def anchors(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(q-gram hash, place, lowest and highest offset of its starts) by segment.

    The starts of an anchor at place p are p - highest to p - lowest.
    """
    gram, spread = length // 4, length - length // 4
    starts = len(text) - length + 1
    for begin in range(0, starts, SEGMENT):
        count = min(SEGMENT, starts - begin)
        data = np.frombuffer(text, np.uint8, count + length - 1, begin)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _UP[: len(data)], out=sums[1:])
        grams = (sums[gram:] - sums[:-gram]) * _DOWN[: len(data) - gram + 1]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        ranked = (grams & ~PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
        width = spread + 1
        blocks = np.full(-(-len(ranked) // width) * width, np.iinfo(np.uint64).max)
        blocks[: len(ranked)] = ranked
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        lowest = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        place = (lowest & PLACE_BITS).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], count] - 1
        place = place[first]
        yield grams[place].view(np.int64), place + begin, place - last, place - first


_ANCHORS = "gram long, window long, places binary, n long, low int, high int"


def _anchor_rows(df: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """One row per document, q-gram and window: how often and where."""
    schema = T.StructType([df.schema[key], df.schema["_crc"], *T.StructType.fromDDL(_ANCHORS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, rows = [], []
            for i, data in enumerate(text_bytes(batch.column(text))):
                found: dict[tuple, list[int]] = {}
                for part in anchors(data, length):
                    for gram, place, low, high in zip(*(a.tolist() for a in part)):
                        window = xxhash.xxh3_64_intdigest(data[place - high : place - low + length], low << 32 | high)
                        found.setdefault((gram, window - (1 << 63), low, high), []).append(place)
                owner += [i] * len(found)
                rows += found.items()
            keys = list(zip(*(k for k, _ in rows))) or [[]] * 4
            places = [np.array(p, "<i4").tobytes() for _, p in rows]
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(at),
                    batch.column("_crc").take(at),
                    pa.array(keys[0], pa.int64()),
                    pa.array(keys[1], pa.int64()),
                    pa.array(places, pa.binary()),
                    pa.array([len(p) // 4 for p in places], pa.int64()),
                    pa.array(keys[2], pa.int32()),
                    pa.array(keys[3], pa.int32()),
                ],
                names=[key, "_crc", "gram", "window", "places", "n", "low", "high"],
            )

    return df.select(key, "_crc", text).mapInArrow(run, schema)


def _window_sums(windows: list[bytes], high: np.ndarray, strings: Strings) -> np.ndarray:
    """Hash of the string at every offset: rows x offsets, highest offset first."""
    data = np.zeros((len(windows), strings.width), np.uint8)
    inside = np.zeros((len(windows), strings.width), bool)
    for i, (window, h) in enumerate(zip(windows, high.tolist())):
        at = strings.spread - h
        data[i, at : at + len(window)] = np.frombuffer(window, np.uint8)
        inside[i, at : at + len(window)] = True
    sums = np.zeros((len(windows), strings.width + 1), np.uint64)
    hashed = strings.places[np.arange(strings.width)[None, :], data]
    np.cumsum(np.where(inside, hashed, np.uint64(0)), axis=1, out=sums[:, 1:])
    return sums[:, strings.length :] - sums[:, : strings.spread + 1]


def _start_hashes(gram: np.ndarray, low: np.ndarray, high: np.ndarray, windows: list[bytes], strings: Strings):
    """(row, column, hash) of all own starts; column spread - offset."""
    hashes = _window_sums(windows, high, strings)
    column = np.arange(strings.spread + 1)[None, :]
    row, column = np.nonzero((column >= strings.spread - high[:, None]) & (column <= strings.spread - low[:, None]))
    mixed = (hashes[row, column] ^ gram.view(np.uint64)[row]) * strings.offsets[column]
    return row, column, mixed ^ (mixed >> np.uint64(31))


def _runs(place: int, columns: np.ndarray, strings: Strings) -> list[int]:
    """Removed bytes [begin, end, begin, end, ...] of repeated starts."""
    if not len(columns):
        return []
    cut = np.flatnonzero(np.diff(columns) > 1)
    first, last = columns[np.r_[0, cut + 1]], columns[np.r_[cut, len(columns) - 1]]
    return np.c_[first, last + strings.length].ravel().__add__(place - strings.spread).tolist()


_ARROW = {
    "gram": pa.int64(), "place": pa.int32(), "low": pa.int32(), "high": pa.int32(), "is_open": pa.bool_(),
    "base": pa.int32(), "part": pa.int64(), "whole": pa.int64(), "bytes": pa.binary(),
}
_OPEN = "gram long, place int, low int, high int, is_open boolean, bytes binary"


def _refine(rows: DataFrame, key: str, strings: Strings) -> DataFrame:
    """Removed runs of open anchors; whole buckets are worked on together."""
    schema = T.StructType([rows.schema[key], rows.schema["_crc"], T.StructField("runs", T.ArrayType(T.IntegerType()))])
    names = rows.columns

    def settle(table: pa.Table) -> pa.RecordBatch:
        high, place = table["high"].to_numpy(), table["place"].to_numpy()
        row, column, mixed = _start_hashes(
            table["gram"].to_numpy(), table["low"].to_numpy(), high, table["bytes"].to_pylist(), strings
        )
        _, where, count = np.unique(mixed, return_inverse=True, return_counts=True)
        again = count[where] > 1
        row, column = row[again], column[again]
        edge = np.searchsorted(row, np.arange(table.num_rows + 1))
        chosen = [i for i in np.flatnonzero(table["is_open"].to_numpy(zero_copy_only=False)) if edge[i + 1] > edge[i]]
        runs = [_runs(int(place[i]), column[edge[i] : edge[i + 1]], strings) for i in chosen]
        at = pa.array(chosen, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                table[key].combine_chunks().take(at),
                table["_crc"].combine_chunks().take(at),
                pa.array(runs, pa.list_(pa.int32())),
            ],
            names=[key, "_crc", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            if held.num_rows >= ROWS:
                grams = held["gram"].to_numpy()
                whole = int(np.searchsorted(grams, grams[-1]))  # the last bucket may go on
                if whole:
                    yield settle(held.slice(0, whole))
                    held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield settle(held)

    return rows.repartition("gram").sortWithinPartitions("gram").select(*names).mapInArrow(run, schema)


def _refine_heavy(rows: DataFrame, key: str, scratch: Scratch, length: int) -> DataFrame:
    """The same for buckets of any size, by combined counts over blocks of offsets.

    A block's strings share what all of them cover, its ``part``, and lie in what
    any of them covers, its ``whole``. If the part has no second place, no
    start of the block repeats; if the whole has one, all do. Other blocks are
    split in eight, down to single offsets. Of blocks with one whole, one goes
    on as a partner for blocks that their anchor covers only in part.
    """
    own = [rows.schema[key], rows.schema["_crc"]]
    fields = "gram long, place int, low int, high int, is_open boolean, base int, part long, whole long, bytes binary"
    schema = T.StructType([*own, *T.StructType.fromDDL(fields).fields])
    names = _names(fields)

    def split(size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 64):  # a row makes up to a row for each of its offsets
                owner, made = [], []
                columns = (batch.column(c).to_pylist() for c in ("gram", "place", "low", "high", "is_open", "top", "bytes"))
                for i, (gram, place, low, high, is_open, top, data) in enumerate(zip(*columns)):
                    for base in range(low // size * size, high + 1, size):
                        last, first = base + size - 1, max(low, base)
                        seed = (gram ^ (base << 16 | size)) & ((1 << 64) - 1)
                        # data begins at offset top, that is top bytes before the anchor
                        part = xxhash.xxh3_64_intdigest(data[top - base : top - last + length], seed)
                        full = low <= base and last <= high
                        inside = data[top - min(high, last) : top - first + length]
                        whole = xxhash.xxh3_64_intdigest(inside, seed ^ 1 << 40) - (1 << 63) if full else None
                        owner.append(i)
                        made.append((gram, place, first, min(high, last), is_open, base, part - (1 << 63), whole, inside))
                at = pa.array(owner, pa.int64())
                values = list(zip(*made)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(at), batch.column("_crc").take(at)]
                    + [pa.array(v, _ARROW[c]) for v, c in zip(values, names)],
                    names=[key, "_crc", *names],
                )

        return run

    valid = None
    level = rows.withColumn("top", F.col("high"))
    for size in (64, 8, 1):
        staged = level.select(key, "_crc", "gram", "place", "low", "high", "is_open", "top", "bytes")
        blocks = scratch.store(staged.mapInArrow(split(size), schema))
        parts = scratch.store(blocks.groupBy("part").agg(F.count("*").alias("n")).filter("n > 1"))
        alive = scratch.store(join_groups(blocks, parts, "part").drop("n"))
        wholes = scratch.store(
            alive.filter("whole IS NOT NULL").groupBy("whole").agg(F.count("*").alias("n")).filter("n > 1")
        )
        met = join_groups(alive, wholes, "whole", how="left")
        done = met.filter("n IS NOT NULL" if size > 1 else "true")
        ranges = done.filter("is_open").select(key, "_crc", "place", "low", "high")
        valid = ranges if valid is None else valid.unionByName(ranges)
        if size > 1:
            partners = done.drop("n").dropDuplicates(["whole"]).withColumn("is_open", F.lit(False))
            level = met.filter("n IS NULL").drop("n").unionByName(partners).withColumn("top", F.col("high"))
    runs = F.array(F.col("place") - F.col("high"), F.col("place") - F.col("low") + length)
    return valid.select(key, "_crc", runs.alias("runs"))


def cut_runs(text: bytes, runs: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left) for rows of begin and end."""
    if not len(runs):
        return 0, 0, text
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    new = np.flatnonzero(np.r_[True, runs[1:, 0] > reach[:-1]])
    begin, end = runs[new, 0], reach[np.r_[new[1:], len(runs)] - 1]
    kept, at = [], 0
    for b, e in zip(begin.tolist(), end.tolist()):
        kept.append(text[at:b])
        at = e
    kept.append(text[at:])
    return int((end - begin).sum()), len(begin), b"".join(kept)


def whole_characters(kept: bytes) -> bytes:
    """What is left, without the parts of characters that were cut in two."""
    return kept.decode("utf-8", "ignore").encode()


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
    finish: Callable[[bytes], bytes] = bytes,
) -> DataFrame:
    """Columns key, n_bytes, n_removed, n_spans and ``kept``: the bytes that are left, through ``finish``."""
    out, strings = "kept", Strings(length)
    scratch = Scratch(df.sparkSession, BATCH)
    texts = df.select(key, F.col(text).alias("_text")).withColumn(
        "_crc", F.crc32(F.coalesce("_text", F.lit("")).cast("binary"))
    )
    found = scratch.store(_anchor_rows(texts, key, "_text", length))
    buckets = found.groupBy("gram").agg(
        F.sum("n").alias("total"), F.count("*").alias("n"), F.min("window").alias("a"), F.max("window").alias("b")
    )
    buckets = scratch.store(buckets.filter("total > 1").select("gram", "n", (F.col("a") != F.col("b")).alias("mixed")))
    met = scratch.store(join_groups(found.withColumnRenamed("n", "own"), buckets, "gram"))
    windows = met.filter("mixed").groupBy("gram", "window").agg(
        F.sum("own").alias("total"), F.count("*").alias("n"),
        F.min(F.struct(key, "_crc", F.substring("places", 1, 4).alias("place"), "low", "high")).alias("first"),
    )
    windows = scratch.store(windows.withColumn("pair", F.xxhash64("gram", "window")))
    # Two windows of one bucket share a pair hash about never; then their rows meet here and are told apart.
    in_mixed = met.filter("mixed").withColumn("pair", F.xxhash64("gram", "window")).drop("n", "mixed")
    again = windows.filter("total > 1").groupBy("pair").agg(F.sum("n").alias("n"), F.collect_set("window").alias("those"))
    settled = join_groups(in_mixed, scratch.store(again), "pair").filter(F.array_contains("those", F.col("window")))
    columns = [key, "_crc", "places", "low", "high"]
    settled = met.filter("NOT mixed").select(*columns).unionByName(settled.select(*columns))
    members = windows.groupBy("gram").agg(F.count("*").alias("members"))
    large = max(64, windows.count() // HEAVY_KEYS)
    heavy = F.broadcast(members.filter(F.col("members") > large).select("gram", F.lit(True).alias("heavy")))
    border = windows.select("gram", "first.*", (F.col("total") == 1).alias("is_open")).join(heavy, "gram", "left")
    lists = settled.withColumns({"gram": F.lit(0).cast("long"), "is_open": F.lit(None).cast("boolean"), "heavy": F.lit(None).cast("boolean")})
    lists = lists.unionByName(border.withColumnRenamed("place", "places"))
    lists = scratch.store(
        lists.groupBy(key, "_crc").agg(F.collect_list(F.struct("places", "low", "high", "gram", "is_open", "heavy")).alias("list"))
        .withColumnsRenamed({key: "_key", "_crc": "_crc2"})
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_crc") == F.col("_crc2"))
    stage = texts.join(lists, same, "left").drop("_key", "_crc2")
    done = scratch.store(_first_pass(stage, key, out, finish, length))
    light = done.filter("gram IS NOT NULL AND NOT heavy").select(key, "_crc", *_names(_OPEN))
    dense = done.filter("gram IS NOT NULL AND heavy").select(key, "_crc", *_names(_OPEN))
    runs = _refine(light.dropDuplicates([key, "_crc", "place", "low"]), key, strings).unionByName(
        _refine_heavy(dense.dropDuplicates([key, "_crc", "place", "low"]), key, scratch, length)
    )
    more = runs.groupBy(key, "_crc").agg(F.flatten(F.collect_list("runs")).alias("more")).withColumnsRenamed(
        {key: "_key", "_crc": "_crc2"}
    )
    waiting = done.filter("text IS NOT NULL").select(key, "_crc", "text", "runs").join(more, same, "left")
    finished = _second_pass(waiting, key, out, finish)
    answer = scratch.store(
        done.filter("n_bytes IS NOT NULL").select(key, "n_bytes", "n_removed", "n_spans", out).unionByName(finished), keep=True
    )
    scratch.release()
    return answer


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def _first_pass(
    stage: DataFrame, key: str, out: str, finish: Callable[[bytes], bytes], length: int
) -> DataFrame:
    """Per document its answer, or its text and settled runs if borders are open;
    and a row with the window of every anchor that takes part in refinement."""
    fields = f"{_OPEN}, heavy boolean, text binary, runs array<int>, n_bytes long, n_removed long, n_spans long, {out} binary"
    schema = T.StructType([stage.schema[key], stage.schema["_crc"], *T.StructType.fromDDL(fields).fields])
    columns = _names(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner: list[int] = []
            made: dict[str, list] = {c: [] for c in columns}

            def put(i: int, **values) -> None:
                owner.append(i)
                for c in columns:
                    made[c].append(values.get(c))

            for i, (data, entries) in enumerate(zip(text_bytes(batch.column("_text")), batch.column("list").to_pylist())):
                runs, waits = [], False
                for e in entries or []:
                    places = np.frombuffer(e["places"], "<i4")
                    if e["is_open"] is None:
                        runs.append(np.c_[places - e["high"], places - e["low"] + length])
                        continue
                    waits |= e["is_open"]
                    place = int(places[0])
                    put(
                        i, gram=e["gram"], place=place, low=e["low"], high=e["high"], is_open=e["is_open"],
                        heavy=bool(e["heavy"]), bytes=data[place - e["high"] : place - e["low"] + length],
                    )
                spans = np.concatenate(runs) if runs else np.empty((0, 2), np.int64)
                if waits:
                    put(i, text=data, runs=spans.ravel().tolist())
                else:
                    removed, n, kept = cut_runs(data, spans)
                    put(i, n_bytes=len(data), n_removed=removed, n_spans=n, **{out: finish(kept)})
            at = pa.array(owner, pa.int64())
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.bool_(), pa.binary(),
                     pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(at), batch.column("_crc").take(at)]
                + [pa.array(made[c], t) for c, t in zip(columns, types)],
                names=[key, "_crc", *columns],
            )

    return stage.select(key, "_crc", "_text", "list").mapInArrow(run, schema)


def _second_pass(waiting: DataFrame, key: str, out: str, finish: Callable[[bytes], bytes]) -> DataFrame:
    schema = T.StructType(
        [waiting.schema[key], *T.StructType.fromDDL(f"n_bytes long, n_removed long, n_spans long, {out} binary").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            answers = []
            for data, a, b in zip(*(batch.column(c).to_pylist() for c in ("text", "runs", "more"))):
                removed, n, kept = cut_runs(data, np.array((a or []) + (b or []), np.int64).reshape(-1, 2))
                answers.append((len(data), removed, n, finish(kept)))
            columns = list(zip(*answers)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=[key, "n_bytes", "n_removed", "n_spans", out],
            )

    return waiting.select(key, "text", "runs", "more").mapInArrow(run, schema)
