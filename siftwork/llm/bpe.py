"""Byte-level BPE: encoding by a contiguous rank array, and decoding.

A text is cut at special tokens, then by the pre-token pattern, and each
pre-token is merged alone. A short pre-token is held as the parts between its
boundaries next to a contiguous array of the ranks of adjacent parts: the lowest
rank is looked up by a scan, its boundary is deleted, and the two ranks beside
it are refreshed; the new words of a batch do this in lockstep. Above ``SHORT`` bytes the scans would be quadratic, so a heap
over linked parts makes the same merges in the same order.

A piece of text from one single space to the next is encoded once and then
remembered; the memory is cleared at ``REMEMBERED`` pieces. Map-only, with the
tokenizer file's bytes (fixed size) as the only broadcast.

Null texts encode as empty. Empty texts have no ids and decode to the empty
text. Other columns pass through.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siftwork.llm.common import slices, together

# Fixed value: the public pre-token pattern, with white space spelled out.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SHORT = 96
REMEMBERED = 250_000
TOGETHER = 256  # texts learnt from at once
LOCKSTEP = 8192  # words merged at once
NO_RANK = 1 << 30


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file, given as its bytes."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {s: b for b, s in symbols.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = [vocab[symbols[b]] for b in range(256)]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            self.ranks.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.merged.append(vocab[left + right])
        self.merged_ids = np.array(self.merged, np.int32)
        self.pairs = np.array(sorted(self.ranks) + [1 << 62], np.int64)
        self.pair_rank = np.array([*map(self.ranks.__getitem__, self.pairs[:-1].tolist()), NO_RANK], np.int64)
        self.pieces = {i: bytes(back[c] for c in token) for token, i in vocab.items() if i not in self.specials.values()}
        self.pieces |= {i: content.encode() for content, i in self.specials.items()}
        self.by_id = pa.array([self.pieces.get(i) for i in range(max(self.pieces) + 1)], pa.large_binary())
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[at] == pairs, self.pair_rank[at], NO_RANK)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids of short words, all merged in lockstep.

        A row holds the parts of one word side by side, and next to them the
        ranks of adjacent parts. Each step finds the lowest rank of every row,
        deletes the boundary there and refreshes the ranks on both sides. Rows
        without a rank left are done.
        """
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), LOCKSTEP):
            self._merge_rows([order[i] for i in range(at, min(at + LOCKSTEP, len(order)))], words, out)
        return out

    def _merge_rows(self, rows: list[int], words: list[bytes], out: list[bytes]) -> None:
        width = len(words[rows[-1]])
        flat = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in rows), np.uint8)
        parts = np.asarray(self.byte_ids, np.int32)[flat].reshape(len(rows), width)
        size = np.array([len(words[i]) for i in rows])
        ranks = self.pair_ranks(parts[:, :-1], parts[:, 1:])
        ranks[np.arange(1, width)[None, :] >= size[:, None]] = NO_RANK
        ids = np.array(rows)
        while len(ids):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            low = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), NO_RANK)
            done = low == NO_RANK
            for i in np.flatnonzero(done):
                out[ids[i]] = parts[i, : size[i]].tobytes()
            go = ~done
            ids, parts, ranks, size, at, low = ids[go], parts[go], ranks[go], size[go] - 1, at[go], low[go]
            each = np.arange(len(ids))
            parts[each, at] = self.merged_ids[low]
            columns = np.arange(parts.shape[1] - 1)[None, :]
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            columns = columns[:, :-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            for side in (at - 1, at):
                has = np.flatnonzero((side >= 0) & (side + 1 < size))
                ranks[has, side[has]] = self.pair_ranks(parts[has, side[has]], parts[has, side[has] + 1])

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges through a heap of (rank, place) over linked parts."""
        find = self.ranks.get
        parts: list[int] = [self.byte_ids[b] for b in word]
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i in range(size - 1) if (r := find(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if parts[at] < 0 or right >= size or find(parts[at] << 20 | parts[right]) != rank:
                continue
            parts[at], parts[right] = self.merged[rank], -1
            after[at] = after[right]
            if after[at] < size:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < size:
                    fresh = find(parts[left] << 20 | parts[after[left]])
                    if fresh is not None:
                        heapq.heappush(heap, (fresh, left))
        return [p for p in parts if p >= 0]

    def learn(self, pieces: set[str], firsts: list[str]) -> None:
        """Encode the new pieces of a batch, which follow a space, and remember them."""
        if len(self.known) > REMEMBERED or len(self.known_words) > REMEMBERED:
            self.known.clear()
            self.known_words.clear()
        cut = {p: self.words.findall(" " + p) for p in pieces.difference(self.known) if len(p) <= SHORT}
        words = {w for some in cut.values() for w in some}
        words.update(w for p in firsts for w in self.words.findall(p))
        self.learn_words(words)
        for piece, some in cut.items():
            self.known[piece] = b"".join(map(self.known_words.__getitem__, some))

    def learn_words(self, words: set[str]) -> None:
        fresh = list(words.difference(self.known_words))
        data = [w.encode() for w in fresh]
        short = [i for i, d in enumerate(data) if len(d) <= SHORT]
        if short:
            self.known_words.update(zip((fresh[i] for i in short), self.merge_short([data[i] for i in short])))

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece of text, as 32-bit integers."""
        words = self.words.findall(piece)
        known = self.known_words
        self.learn_words({w for w in words if w not in known})
        return b"".join(known[w] if w in known else array("i", self.merge_long(w.encode())).tobytes() for w in words)

    def encode_pieces(self, pieces: list[str]) -> bytes:
        """Ids of a text cut at its spaces, none of which has white space beside it."""
        ids = list(map(self.known.get, pieces))
        ids[0] = self.encode_piece(pieces[0])
        if None in ids:
            ids = [self.encode_piece(" " + p) if x is None else x for p, x in zip(pieces, ids)]
        return b"".join(ids)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text.

        No pre-token goes across a single space between two other characters,
        so a text is taken from one space to the next where all are like that.
        """
        out = []
        for at in range(0, len(texts), TOGETHER):
            rows: list[list[str | list[str]]] = []
            pieces, firsts = set(), []
            for text in texts[at : at + TOGETHER]:
                marked = self.cut is not None and any(s in text for s in self.specials)
                rows.append([])
                for part in self.cut.split(text) if marked else [text]:
                    split = part.split(" ")
                    if part in self.specials or "" in split or " ".join(map(str.strip, split)) != part:
                        rows[-1].append(part)
                    else:
                        rows[-1].append(split)
                        pieces.update(split[1:])
                        firsts.append(split[0])
            self.learn(pieces, firsts)
            out += [np.frombuffer(b"".join(map(self._part, row)), "<i4") for row in rows]
        return out

    def _part(self, part: str | list[str]) -> bytes:
        if isinstance(part, list):
            return self.encode_pieces(part)
        if part in self.specials:
            return array("i", [self.specials[part]]).tobytes()
        return self.encode_piece(part)

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of ids that lie one behind the other; text i ends before ``ends[i + 1]``."""
        taken = self.by_id.take(pa.array(ids, pa.int32()))
        if taken.null_count:
            raise KeyError("an id that the vocabulary does not have")
        _, offsets, data = taken.buffers()
        cuts = np.frombuffer(offsets, np.int64, len(ids) + 1)[ends].tolist() if len(ids) else [0] * len(ends)
        joined = memoryview(data) if data is not None else memoryview(b"")
        return [str(joined[a:b], "utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


def _file(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())


def _encoded(codec: Codec, texts: pa.Array) -> pa.ListArray:
    rows = codec.encode_batch([t or "" for t in texts.to_pylist()])
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _decoded(codec: Codec, lists: pa.ListArray) -> pa.Array:
    count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.r_[0, np.cumsum(count, dtype=np.int64)]
    return pa.array(codec.decode_batch(lists.flatten().to_numpy(zero_copy_only=False), ends), pa.string())


def _mapped(df: DataFrame, path: str, source: str, made: T.StructType, work: Callable) -> DataFrame:
    """Replace ``source`` by the columns of ``made``, which ``work`` takes from it."""
    file = _file(df, path)
    keep = [c for c in df.columns if c != source and c not in made.names]
    schema = T.StructType([*[df.schema[c] for c in keep], *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(file.value)
        for batch in slices(batches):
            columns = [*[batch.column(c) for c in keep], *work(codec, batch.column(source))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made.names])

    return df.select(*keep, source).mapInArrow(run, schema)


def _ids_field(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType()))


def encode_texts(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Replace ``text`` by its token ids, ``array<int>`` in ``out``."""
    return _mapped(together(df), path, text, T.StructType([_ids_field(out)]), lambda codec, texts: [_encoded(codec, texts)])


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Replace ``ids`` by the text they stand for; null ids give the empty text."""
    made = T.StructType([T.StructField(out, T.StringType())])
    return _mapped(df, path, ids, made, lambda codec, lists: [_decoded(codec, lists)])


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Replace ``text`` by its token ids and the text decoded from them, in one pass."""
    made = T.StructType([_ids_field(ids), T.StructField(out, T.StringType())])

    def work(codec: Codec, texts: pa.Array) -> list[pa.Array]:
        lists = _encoded(codec, texts)
        return [lists, _decoded(codec, lists)]

    return _mapped(together(df), path, text, made, work)
