"""Runs of periodic words, found in a Re-Pair grammar of each text.

A run is a stretch of words with smallest period q (words q apart are equal), of at
least ``LEAST`` words and ``TIMES`` periods, that no neighbouring word extends.

1. *Re-Pair.* The most frequent pair of neighbouring symbols becomes a symbol of its
   own, until no pair occurs twice. Many texts are rewritten in lockstep, and a round
   replaces every pair that no overlapping pair outranks: a new pair is never more
   frequent than the old pair it came from, so this is the order of one pair at a
   time. A pair seen once is never seen again; what lies between such pairs leaves.
2. *Boundaries.* A run crosses the inner boundary of exactly one node of the
   derivation that holds all of it. Runs across a rule's boundary are computed once,
   at its first place; the symbols left at the top are joined as a balanced tree, whose
   nodes occur once. All periods up to a third of a node are tried on both
   sides of its boundary: 8 words that are equal one period apart admit a period,
   prefix hashes give the reach to both sides, and words are compared in the end.
3. *Translation.* A rule's runs are shifted to all places of the rule. Stretches of one
   period that share a period's length are one run, of which the widest is kept.

A text costs its length times the depth of the tree, whatever it repeats. Texts are
told apart by row, so repeated and null keys do not matter. A null, empty or blank text
has no words and no runs. Words are what ASCII white space separates. Columns pass
through; those named as outputs are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import text_bytes

LEAST = 24
TIMES = 3
GRAM = 8  # a run repeats LEAST * 2 / 3 words one period apart, so 8 of them on one side of its boundary
TEXT_BYTES = 1 << 20  # texts rewritten in lockstep
STEPS = 1 << 19  # periods tried at once
RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))

_PRIME = np.int64(2**31 - 1)
_BASE = 1_000_003_579
_ODD = np.int64(0x5851F42D4D)
_LOW = np.int64((1 << 40) - 1)


def grammar(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of concatenated texts; ``words`` are ids, ``text`` the text of each place.

    Returns ``rules`` (begin, boundary, end of each rule's first place), ``places``
    (rule, begin) of all nodes of the derivations, sorted, and whether a symbol left at
    the top begins at a place.
    """
    n = len(words)
    top = np.ones(n, dtype=bool)
    _, symbol = np.unique(text * (words.max(initial=0) + 1) + words, return_inverse=True)
    begin, end = np.arange(n), np.arange(1, n + 1)
    linked = np.zeros(n, dtype=bool)  # with the symbol after it, by a pair that may occur twice
    linked[:-1] = text[1:] == text[:-1]
    known = n
    rules, places = [np.empty((0, 3), dtype=np.int64)], [np.empty((0, 2), dtype=np.int64)]
    while linked.any():
        at = np.flatnonzero(linked)
        keys, pair, total = np.unique(symbol[at] << 32 | symbol[at + 1], return_inverse=True, return_counts=True)
        # In a stretch of one symbol every second pair can be replaced.
        same = np.zeros(len(at), dtype=bool)
        same[1:] = (pair[1:] == pair[:-1]) & (at[1:] == at[:-1] + 1)
        index = np.arange(len(at))
        usable = (index - np.maximum.accumulate(np.where(same, 0, index))) % 2 == 0
        count = np.bincount(pair[usable], minlength=len(keys))
        own = (count << 40 | (np.arange(len(keys)) * _ODD & _LOW))[pair]
        rank = np.zeros(len(symbol) + 2, dtype=np.int64)  # of the pair that begins one place before
        rank[at + 1] = own
        blocked = np.zeros(len(keys), dtype=bool)
        blocked[pair[usable & ((rank[at] > own) | (rank[at + 2] > own))]] = True
        chosen = (count > 1) & ~blocked
        hit = usable & chosen[pair]
        if not hit.any():
            break
        left = at[hit]
        rule = (np.cumsum(chosen) - 1)[pair[hit]]
        _, first = np.unique(rule, return_index=True)
        rules.append(np.stack([begin[left], begin[left + 1], end[left + 1]], axis=1)[first])
        places.append(np.stack([rule + (known - n), begin[left]], axis=1))
        linked[at[total[pair] == 1]] = False
        symbol[left] = known + rule
        known += len(first)
        top[begin[left + 1]] = False
        end[left], linked[left] = end[left + 1], linked[left + 1]
        stays = np.ones(len(symbol), dtype=bool)
        stays[left + 1] = False
        symbol, begin, end, linked = symbol[stays], begin[stays], end[stays], linked[stays]
        stays = linked | np.r_[False, linked[:-1]]
        symbol, begin, end, linked = symbol[stays], begin[stays], end[stays], linked[stays]
    found = np.concatenate(places)
    return np.concatenate(rules), found[np.lexsort((found[:, 1], found[:, 0]))], top


def tree_nodes(top: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(begin, boundary, end) of the balanced trees over the symbols at the top of each text."""
    begins = np.flatnonzero(top)
    owner = text[begins]
    firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    sizes = np.diff(np.r_[firsts, len(begins)])
    number = np.arange(len(begins)) - np.repeat(firsts, sizes)
    last = np.repeat(firsts + sizes, sizes)
    text_end = np.r_[begins[firsts[1:]], len(top)]
    text_end = np.repeat(text_end, sizes)
    out, half = [np.empty((0, 3), dtype=np.int64)], 1
    while half < sizes.max(initial=0):
        mid = np.flatnonzero(number % (2 * half) == half)
        after = mid + half
        end = np.where(after < last[mid], begins[np.minimum(after, len(begins) - 1)], text_end[mid])
        out.append(np.stack([begins[mid - half], begins[mid], end], axis=1))
        half *= 2
    return np.concatenate(out)


class _Words:
    """Word ids of the texts, with hashes that compare stretches of them."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        powers = np.ones(1, dtype=np.int64)
        while len(powers) <= n:
            powers = np.r_[powers, powers * np.int64(pow(_BASE, len(powers), int(_PRIME))) % _PRIME]
        self.powers = powers
        value = (ids + 1) * np.int64(48_271) % _PRIME
        self.prefix = np.r_[0, np.cumsum(value * powers[:n] % _PRIME)] % _PRIME
        padded = np.r_[ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.zeros(GRAM, dtype=np.uint64)]
        self.gram = np.zeros(n, dtype=np.uint64)
        for k in range(GRAM):
            self.gram = self.gram * np.uint64(0xD1342543DE82EF95) + padded[k : k + n]

    def equal(self, at: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        one = (self.prefix[at + length] - self.prefix[at]) % _PRIME * self.powers[shift] % _PRIME
        other = at + shift
        return one == (self.prefix[other + length] - self.prefix[other]) % _PRIME

    def reach(self, at: np.ndarray, shift: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``at`` on, or before it, equal those ``shift`` later."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            good = self.equal(at - half if back else at, shift, half)
            low, high = np.where(good, half, low), np.where(good, high, half - 1)
        return low


def _admitted(words: _Words, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(node, period, anchor) where the words around the anchor recur one period later."""
    begin, mid, end = nodes.T
    third = (end - begin) // TIMES
    size = len(words.ids)
    for later in (True, False):
        most = np.maximum(np.minimum(third, (end - mid if later else mid - begin) - 1), 0)
        upto = np.r_[0, np.cumsum(most)]
        for low in range(0, int(upto[-1]), STEPS):
            flat = np.arange(low, min(low + STEPS, int(upto[-1])))
            node = np.searchsorted(upto, flat, side="right") - 1
            period = flat - upto[node] + 1
            anchor = mid[node] if later else mid[node] - period
            ahead = words.gram[anchor] == words.gram[anchor + period]
            behind = np.maximum(anchor - GRAM, 0)
            ahead |= words.gram[behind] == words.gram[np.minimum(behind + period, size - 1)]
            hit = np.flatnonzero(ahead)
            yield node[hit], period[hit], anchor[hit]


def _exact_reach(ids: np.ndarray, anchor: int, period: int, begin: int, end: int) -> tuple[int, int]:
    after = ids[anchor : end - period] != ids[anchor + period : end]
    before = ids[begin:anchor] != ids[begin + period : anchor + period]
    right = int(after.argmax()) if after.any() else len(after)
    left = int(before[::-1].argmax()) if before.any() else len(before)
    return anchor - left, anchor + period + right


def runs_across(words: _Words, nodes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(node, begin, end, period) of the runs, within each node, across its boundary."""
    best: dict[tuple[int, int, int], tuple[int, int]] = {}
    for node, period, anchor in _admitted(words, nodes):
        begin, _, end = nodes[node].T
        left = anchor - words.reach(anchor, period, anchor - begin, back=True)
        right = anchor + period + words.reach(anchor, period, end - anchor - period, back=False)
        good = right - left >= np.maximum(LEAST, TIMES * period)
        for row in zip(*(x[good].tolist() for x in (node, left, right, period, anchor))):
            key = row[:3]
            if key not in best or row[3] < best[key][0]:
                best[key] = row[3:]
    out = []
    ids = words.ids
    for (node, left, right), (period, anchor) in best.items():
        if not np.array_equal(ids[left : right - period], ids[left + period : right]):  # equal hashes, unequal words
            begin, _, end = nodes[node].tolist()
            left, right = _exact_reach(ids, anchor, period, begin, end)
            if right - left < max(LEAST, TIMES * period):
                continue
        out.append((node, left, right, period))
    return out


def find_runs(ids: np.ndarray, text: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (begin, end, period) of each text that has any, as places in ``ids``, in order."""
    found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    if len(ids) < LEAST:
        return {}
    rules, places, top = grammar(ids, text)
    words = _Words(ids)
    long_rules = np.flatnonzero(rules[:, 2] - rules[:, 0] >= LEAST)
    for k, left, right, period in runs_across(words, rules[long_rules]):
        rule = long_rules[k]
        low, high = np.searchsorted(places[:, 0], [rule, rule + 1])
        for shift in (places[low:high, 1] - rules[rule, 0]).tolist():
            found[int(text[left + shift]), period].append((left + shift, right + shift))
    nodes = tree_nodes(top, text)
    for _, left, right, period in runs_across(words, nodes[nodes[:, 2] - nodes[:, 0] >= LEAST]):
        found[int(text[left]), period].append((left, right))
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for (owner, period), stretches in found.items():
        stretches.sort()
        begin, end = stretches[0]
        for left, right in stretches[1:]:
            if left + period <= end:
                end = max(end, right)
            else:
                out[owner].append((begin, end, period))
                begin, end = left, right
        out[owner].append((begin, end, period))
    return {owner: sorted(rows, key=lambda r: (r[0], r[2])) for owner, rows in out.items()}


def _in_lockstep(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together stay near TEXT_BYTES."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > TEXT_BYTES:
            yield low, i
            low, size = i, 0
        size += len(t) + 64
    if low < len(texts):
        yield low, len(texts)


def runs_and_rest(texts: list[bytes]) -> tuple[list[list[dict]], list[bytes]]:
    """Of each text its runs, and its words without the repetitions within them."""
    all_runs: list[list[dict]] = []
    rest: list[bytes] = []
    for low, high in _in_lockstep(texts):
        split = [t.split() for t in texts[low:high]]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        flat = list(chain.from_iterable(split))
        known = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        ids = np.fromiter(map(known.__getitem__, flat), dtype=np.int64, count=len(flat))
        found = find_runs(ids, np.repeat(np.arange(len(split)), sizes))
        first = (np.cumsum(sizes) - sizes).tolist()
        for k, ws in enumerate(split):
            runs = found.get(k, [])
            if runs:
                kept = np.ones(len(ws), dtype=bool)
                for begin, end, period in runs:
                    kept[begin + period - first[k] : end - first[k]] = False
                ws = [ws[i] for i in np.flatnonzero(kept)]
            all_runs.append([{"start": b - first[k], "length": e - b, "period": p} for b, e, p in runs])
            rest.append(b" ".join(ws))
    return all_runs, rest


def with_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Add the runs of ``text``, by start and period, and the text without their repetitions.

    A word goes if any run contains it after that run's first period; the words that
    stay are joined by one space.
    """
    keep = [c for c in df.columns if c not in (runs, collapsed)]
    fields = [df.schema[c] for c in keep]
    at = keep.index(text)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                found, rest = runs_and_rest(text_bytes(part.column(at)))
                added = [pa.array(found, kind), pa.array(rest, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*keep, runs, collapsed])

    fields += [T.StructField(runs, RUNS), T.StructField(collapsed, T.StringType())]
    return df.select(*keep).mapInArrow(find, T.StructType(fields))


def strongest(runs: str):
    """Of a column of runs the one with the greatest exact length / period (ties: start, then period)."""
    r = F.col(runs)
    return F.aggregate(
        F.slice(r, 2, F.greatest(F.size(r), F.lit(1))),
        F.try_element_at(r, F.lit(1)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )


def stretched(key: str, text: str):
    """The derived input of the query: in a tenth of the texts, words from one place on recur.

    With h the CRC-32 of the decimal key and g its tenth, every text with h % 10 = 0 and
    n > 0 words has, from word a = g % n on, only its words a to a + p - 1, in turn, where
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts stay, and those of a null key.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.col(text), r"[ \x09-\x0D]+"), lambda w: w != "")

    def repeat(w):
        n = F.size(w).cast("long")
        a = g % n
        p = F.floor((n - a) / (F.lit(3) + g % 8)).cast("long") + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i).cast("int")))

    bound = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeat(w), " ")).otherwise(""))
    return F.when((h % 10 == 0) & F.col(text).isNotNull(), bound[0]).otherwise(F.col(text))
