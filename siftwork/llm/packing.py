"""Packing of token pieces into sequences by exact complements, then best fit.

A document's ids and an end token are cut into pieces of at most ``capacity``
tokens. Packing itself needs only how many pieces there are of each length, a
table of at most ``capacity`` rows, however large the corpus. From the longest
length down, the gap it leaves is looked up among single lengths, sums of two
and sums of three that are still available; a combination that fills the gap
exactly is consumed as often as the counts allow. Where none fits, the largest
length that still fits is put in, again and again (best fit).

The outcome is a list of patterns, each with a number of sequences. Pieces are
then ranked within their length, spread over range partitions so that a length
shared by any number of pieces is not gathered, and the rank says which
sequence and offset a piece has.

Null and empty texts are a piece of the end token alone. An empty table gives
an empty result. Columns besides the ones named do not take part.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.bpe import byte_symbols
from siftwork.llm.common import BATCH, Scratch, slices, together
from siftwork.operators.ordering import position_within

CAPACITY = 4096
END_ID = 1
REMEMBERED = 600_000
# The tokenizer's pre-token pattern; characters that are composed
# already, where white space is ASCII's; runs of marks away from an apostrophe,
# which may be part of a contraction.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
PLAIN = regex.compile(r"[\t-\r -~\u00a1-\u024f\u2010-\u2027\u20ac]*").fullmatch
AROUND_MARKS = re.compile(r"(?<![^\w\s]|_)(?:[^\w\s']|_)++(?!')").sub


class WordIds:
    """Ids of texts by the tokenizers library, each pre-token encoded once.

    The tokenizer lower-cases, drops white space and never merges across a
    pre-token. A text of plain Latin characters is therefore cut at white space
    and around runs of marks, and the library's model encodes every new token,
    which is then remembered. Any other text goes to the library whole.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def _token(self, token: str) -> bytes:
        """Ids of what stands between two cuts: one pre-token, or a few."""
        ids: list[int] = []
        for part in (token,) if token.isalpha() else PRE_TOKENS(token):
            symbols = part if part.isascii() else "".join(map(self.symbols.__getitem__, part.encode()))
            ids += [t.id for t in self.model.tokenize(symbols)]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as unsigned 32-bit integers."""
        if not PLAIN(text) or any(s in text for s in self.specials):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        tokens = AROUND_MARKS(r" \g<0> ", text.lower()).split()
        ids = list(map(self.known.get, tokens))
        if None in ids:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for i, token in enumerate(tokens):
                if ids[i] is None:
                    ids[i] = self.known.get(token)
                    if ids[i] is None:
                        ids[i] = self.known[token] = self._token(token)
        return b"".join(ids)


def token_pieces(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of every document: key, piece, start, length and the ids (binary)."""
    file = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(file.value)
        for batch in slices(batches):
            row, piece, data = [], [], []
            for i, value in enumerate(batch.column(text).to_pylist()):
                ids = words.encode(value or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    row.append(i)
                    piece.append(k)
                    data.append(ids[at : at + 4 * capacity])
            pieces = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(row, pa.int64())),
                    pa.array(pieces),
                    pa.array(pieces.astype(np.int64) * capacity),
                    pa.array([len(d) // 4 for d in data], pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                schema=pa.schema([batch.schema.field(key), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]),
            )

    return together(df.select(key, text)).mapInArrow(run, schema)


def solve(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Patterns (number of sequences, lengths) that use up ``counts[length]``."""
    left = counts.copy()
    patterns: list[tuple[int, list[int]]] = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            left[longest] -= 1
            rest = _complement(left, capacity - longest) or _best_fit(left, capacity - longest)
            left[longest] += 1
            pattern = [longest, *rest]
            uses = np.bincount(pattern)
            used = np.flatnonzero(uses)
            times = int((left[used] // uses[used]).min())
            left[used] -= times * uses[used]
            patterns.append((times, pattern))
    return patterns


def _complement(left: np.ndarray, gap: int) -> list[int]:
    """One, two or three available lengths that sum to the gap exactly."""
    if gap <= 0:
        return []
    if left[gap]:
        return [gap]
    have = np.flatnonzero(left[:gap])[::-1]
    if not len(have):
        return []
    other = gap - have
    for a in have[(left[other] > (other == have)) & (other <= have)]:
        return [int(a), int(gap - a)]
    for part in np.array_split(have, -(-len(have) // 64)):
        third = gap - part[:, None] - have[None, :]
        fits = (third > 0) & (have[None, :] <= part[:, None]) & (third <= have[None, :])
        same = 1 + (have[None, :] == part[:, None]).astype(int)
        third[~fits] = 0
        fits &= left[third] > 0
        fits &= (left[part][:, None] >= same) & (left[third] >= 1 + (third == have) + (third == part[:, None]))
        if fits.any():
            i, j = np.unravel_index(int(fits.argmax()), fits.shape)
            return [int(part[i]), int(have[j]), int(third[i, j])]
    return []


def _best_fit(left: np.ndarray, gap: int) -> list[int]:
    taken: list[int] = []
    left = left[: gap + 1].copy()
    while gap > 0 and len(have := np.flatnonzero(left[: gap + 1])):
        length = int(have[-1])
        times = min(int(left[length]), gap // length)
        taken += [length] * times
        gap -= times * length
        left[length] -= times
    return taken


def _slots(patterns: list[tuple[int, list[int]]], capacity: int) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in order of rank."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for length in lengths:
            slots.setdefault(length, []).append((int(taken[length]), sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces that have a ``length``."""
    histogram = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in histogram:
        counts[r["length"]] = r["count"]
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(solve(counts, capacity), capacity))
    ranked = position_within(pieces, "length", key, "_rank")
    names = pieces.columns
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for value in np.unique(length):
                rows = np.flatnonzero(length == value)
                table = slots.value[int(value)]
                at = np.searchsorted(table[:, 0], rank[rows], "right") - 1
                sequence[rows] = table[at, 1] + rank[rows] - table[at, 0]
                offset[rows] = table[at, 2]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    return ranked.select(*names, "_rank").mapInArrow(run, schema)


def packed_documents(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Place of every piece, with the CRC-32 of its ids instead of the ids."""
    pieces = token_pieces(df, path, key, text, capacity, end_id)
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(Scratch(df.sparkSession, BATCH).store(narrow, keep=True), key, capacity)

