"""Toxicity by a subsequence string kernel with landmarks and a linear machine.

The kernel of two words is the normalised, gap-weighted count of shared
subsequences of three letters, word ends included, raised to ``POWER``: a letter
put in, left out or changed lowers it a little, and unrelated words are near 0.
Marks and digits inside a word are dropped and runs of single letters joined
first, so ``i.d.i.o.t`` and ``i d i o t`` are words too.

Landmarks are the words most tied to toxic rows. A document has, per landmark,
the largest kernel value among its words; Nystrom's map (the inverse root of
the landmarks' own kernel matrix) turns these into coordinates, and a linear
support vector machine with squared hinge loss separates them. A logistic
curve makes scores of the margins.

Fitting takes at most ``MAX_FIT_ROWS`` labelled rows, by hash of the key (a
documented bound); scoring is map-only over whole texts. Null and empty texts
have no words and the score of a document that resembles no landmark. Without
labels of both kinds all scores are the share of toxic labels, or 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import slices, together

MAX_FIT_ROWS = 24_000
CANDIDATES, LANDMARKS, ALIKE = 600, 64, 0.6
SPAN, DECAY, POWER = 6, 0.7, 4
SURE, FEW = 15.0, 16  # log-likelihood gain that chance alone does not give; landmarks taken without it
LONGEST = 40  # a longer word is read as overlapping windows of this size
LEAST = 0.03  # kernel values below this are as good as none
REMEMBERED = 300_000
LETTERS = 29  # a to z, others, and the two ends
PAIRS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]

_MARKS = re.compile(r"[^\w\s]+|[\d_]+")
_SINGLES = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_FOLD = {
    code: folded
    for code in range(128, 0x250)
    if (folded := unicodedata.normalize("NFKD", chr(code))[0].lower()) != chr(code)
}
_CODES = np.full(256, 27, np.int64)
_CODES[97:123] = np.arange(1, 27)


# ASCII characters that go: all but letters and white space.
_DROP = bytes(c for c in range(128) if not (chr(c).isalpha() or chr(c).isspace()))
_CHANGED: dict[str, str] = {}  # what becomes of other characters, as far as seen


def _changed(char: str) -> str:
    to = _CHANGED.get(char)
    if to is None:
        to = _CHANGED[char] = _MARKS.sub("", char).translate(_FOLD)
    return to


def words(text: str) -> set[str]:
    """Distinct words in folded letters."""
    plain = text.lower()
    if plain.isascii():
        plain = plain.encode().translate(None, _DROP).decode()
    else:  # one pass per distinct character that changes, those that go first: a superscript becomes a digit that stays
        chars = {char: to for char in set(plain) if (to := _changed(char)) != char}
        for char in sorted(chars, key=chars.get):
            plain = plain.replace(char, chars[char])
    found = plain.split()
    if b"\1\1\1" in bytes([len(w) == 1 for w in found]):  # a spelled word has three letters or more
        found = _SINGLES.sub(lambda m: m.group().replace(" ", ""), plain).split()
    out = set(found)
    for word in [w for w in out if len(w) > LONGEST]:
        out.discard(word)
        out.update(word[i : i + LONGEST] for i in range(0, len(word), LONGEST // 2))
    return out


def subsequences(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (word, subsequence, weight) of all words, one per place."""
    data = [w.encode("latin-1", "replace") for w in some]
    width = max(map(len, data), default=0) + 2
    flat = np.frombuffer(b"".join(d.ljust(width - 2, b"\0") for d in data), np.uint8).reshape(len(data), -1)
    size = np.array([len(d) for d in data])
    codes = np.zeros((len(data), width), np.int64)
    codes[:, 1:-1] = _CODES[flat]
    codes[np.arange(len(data)), size + 1] = 28
    row, code, weight = [], [], []
    for a, b in PAIRS:
        if width <= b:
            continue
        triple = (codes[:, :-b] * LETTERS + codes[:, a : width - b + a]) * LETTERS + codes[:, b:]
        at, place = np.nonzero(np.arange(width - b)[None, :] + b <= size[:, None] + 1)
        row.append(at)
        code.append(triple[at, place])
        weight.append(np.full(len(at), DECAY ** (b + 1), np.float32))
    if not row:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
    return np.concatenate(row), np.concatenate(code), np.concatenate(weight)


def norms(row: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    key, at = np.unique(row * LETTERS**3 + code, return_inverse=True)
    squares = np.bincount(at, weight, len(key)) ** 2
    return np.sqrt(np.maximum(np.bincount(key // LETTERS**3, squares, n), 1e-12))


class Kernel:
    """Kernel values of words against the landmarks, each word computed once."""

    def __init__(self, landmarks: list[str]):
        row, code, weight = subsequences(landmarks)
        size = norms(row, code, weight, len(landmarks))
        self.table = np.zeros((LETTERS**3, len(landmarks)), np.float32)
        np.add.at(self.table, (code, row), weight / size[row])
        self.top = self.table.max(axis=1)
        self.known: dict[str, int] = {}
        self.values = [np.zeros((1, len(landmarks)), np.float32)]
        self.stacked = self.values[0]

    def of(self, some: list[str]) -> np.ndarray:
        """Kernel values; those that a cheap bound shows to be below ``LEAST`` are 0.

        The bound takes each entry at its best landmark, and a norm without
        repeated subsequences, which is never above the true one.
        """
        row, code, weight = subsequences(some)
        out = np.zeros((len(some), self.table.shape[1]), np.float32)
        least = np.sqrt(np.maximum(np.bincount(row, weight**2, len(some)), 1e-12))
        bound = np.bincount(row, weight * self.top[code], len(some)) / least
        near = np.flatnonzero(bound**POWER >= LEAST)
        if not len(near):
            return out
        place = np.full(len(some), -1)
        place[near] = np.arange(len(near))
        mine = place[row] >= 0
        row, code, weight = place[row[mine]], code[mine], weight[mine]
        size = norms(row, code, weight, len(near))
        seen = self.top[code] > 0
        row, code, weight = row[seen], code[seen], weight[seen]
        order = np.argsort(row, kind="stable")
        row, code, weight = row[order], code[order], weight[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        sums = np.add.reduceat(weight[:, None] * self.table[code], first, axis=0)
        values = (sums / size[row[first], None].astype(np.float32)) ** POWER
        out[near[row[first]]] = np.where(values >= LEAST, values, 0)
        return out

    def learn(self, some: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.values = self.values[:1]
        fresh = sorted(some.difference(self.known), key=len)
        at = sum(map(len, self.values))
        for i in range(0, len(fresh), 4096):
            part = fresh[i : i + 4096]
            values = self.of(part)
            near = values.any(axis=1)
            places = np.where(near, at + np.cumsum(near) - 1, 0)
            self.known.update(zip(part, places.tolist()))
            self.values.append(values[near])
            at += int(near.sum())
        self.stacked = np.concatenate(self.values)
        self.values = [self.stacked]

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Per text, the largest value of each landmark among its words."""
        out = np.zeros((len(texts), self.table.shape[1]), np.float32)
        for at in range(0, len(texts), 512):
            rows = [words(t) for t in texts[at : at + 512]]
            self.learn(set().union(*rows))
            for i, row in enumerate(rows):
                places = {self.known[w] for w in row}
                places.discard(0)
                if places:
                    out[at + i] = self.stacked[list(places)].max(axis=0)
        return out


@dataclass
class Machine:
    landmarks: list[str]
    weights: np.ndarray  # over pooled kernel values, Nystrom's map folded in
    bias: float
    slope: float
    shift: float

    def score(self, pooled: np.ndarray) -> np.ndarray:
        margin = pooled @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def word_counts(df: DataFrame, text: str, label: str) -> DataFrame:
    """Documents and toxic documents per word, counted per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, bad = Counter(), Counter()
            for t, y in zip(batch.column(text).to_pylist(), batch.column(label).to_pylist()):
                some = words(t or "")
                found.update(some)
                if y:
                    bad.update(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()), pa.array([bad[w] for w in found], pa.int64())],
                names=["word", "n", "bad"],
            )

    counted = df.select(text, label).mapInArrow(run, "word string, n long, bad long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def choose_landmarks(candidates: list[str]) -> list[str]:
    """In order, those that no earlier choice is too like."""
    if not candidates:
        return []
    values = Kernel(candidates).of(candidates) ** (1 / POWER)
    chosen: list[int] = []
    for i in range(len(candidates)):
        if len(chosen) < LANDMARKS and (not chosen or values[i, chosen].max() < ALIKE):
            chosen.append(i)
    return [candidates[i] for i in chosen]


def train(pooled: np.ndarray, label: np.ndarray, landmarks: list[str]) -> Machine:
    """Squared-hinge machine in Nystrom's coordinates, by Newton steps."""
    own = Kernel(landmarks).of(landmarks).astype(np.float64)
    size, turn = np.linalg.eigh((own + own.T) / 2)
    root = turn @ np.diag(1 / np.sqrt(np.maximum(size, 1e-3))) @ turn.T
    x = np.c_[pooled @ root, np.ones(len(pooled))]
    y = np.where(label == 1, 1.0, -1.0)
    weight = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, c = x[inside], weight[inside]
        step = np.linalg.solve(ridge + (xs * c[:, None]).T @ xs, (xs * c[:, None]).T @ y[inside])
        if np.abs(step - w).max() < 1e-9:
            break
        w = step
    margin = x @ w
    slope, shift = 1.0, 0.0
    target = (y + 1) / 2
    design = np.c_[margin, np.ones(len(margin))]
    fitted = np.array([slope, shift])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ fitted, -30, 30)))
        h = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-2 * np.eye(2)
        fitted = fitted - np.linalg.solve(h, design.T @ (p - target) + 1e-2 * (fitted - [1.0, 0.0]))
    return Machine(landmarks, root @ w[:-1], float(w[-1]), float(max(fitted[0], 0.0)), float(fitted[1]))


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = MAX_FIT_ROWS,
) -> Machine | float:
    """A machine from labelled documents; the share of toxic ones if only one kind is there."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key).agg(F.max(label).alias("_label"))
        .orderBy(F.xxhash64(key), key).limit(max_rows)
    )
    rows = df.select(key, text).join(F.broadcast(chosen), key)
    totals = chosen.agg(F.sum("_label"), F.count("_label")).first()
    bad, total = totals[0] or 0, totals[1]
    if not 0 < bad < total:
        return bad / total if total else 0.0
    share = bad / total
    rest = F.col("n") - F.col("bad")
    gain = F.col("bad") * F.log(F.col("bad") / (F.col("n") * share)) + F.when(
        rest > 0, rest * F.log(rest / (F.col("n") * (1 - share)))
    ).otherwise(0)
    ranked = (
        word_counts(rows, text, "_label")
        .filter((F.col("bad") >= 2) & (F.col("bad") > F.col("n") * share))
        .withColumn("gain", F.round(gain, 6)).orderBy(F.desc("gain"), "word").limit(CANDIDATES).collect()
    )
    sure = [r["word"] for r in ranked if r["gain"] >= SURE]
    landmarks = choose_landmarks(sure or [r["word"] for r in ranked[:FEW]])
    if not landmarks:
        return bad / total
    found = with_pooled(rows, landmarks, text, "_pooled").select(key, "_label", "_pooled").toPandas().sort_values(key)
    return train(np.array(found["_pooled"].tolist(), np.float32), found["_label"].to_numpy(), landmarks)


def with_pooled(df: DataFrame, landmarks: list[str], text: str, out: str) -> DataFrame:
    keep = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(landmarks)
        for batch in slices(batches):
            pooled = kernel.pooled([t or "" for t in batch.column(text).to_pylist()])
            ends = pa.array(np.arange(len(pooled) + 1, dtype=np.int32) * len(landmarks))
            lists = pa.ListArray.from_arrays(ends, pa.array(pooled.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], lists], names=[*keep, out])

    return df.select(*keep, text).mapInArrow(run, schema)


def with_score(df: DataFrame, machine: Machine | float, text: str = "text", out: str = "score") -> DataFrame:
    """Replace ``text`` by its toxicity score between 0 and 1."""
    keep = [c for c in df.columns if c not in (text, out)]
    if not isinstance(machine, Machine):
        return df.select(*keep, F.lit(float(machine)).alias(out))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(machine.landmarks)
        for batch in slices(batches):
            pooled = kernel.pooled([t or "" for t in batch.column(text).to_pylist()])
            scores = pa.array(machine.score(pooled).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], scores], names=[*keep, out])

    return together(df.select(*keep, text)).mapInArrow(run, schema)
