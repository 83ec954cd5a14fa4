"""URL filter: allow and block rules, and a character model for the rest.

Rules decide what they fit. Two variable-order Markov models over characters,
one of URLs the rules accept and one of those they reject, judge all others by
the difference of their log-likelihoods per character. Counts are taken over
every labelled URL but a fifth (by hash), which calibrates the threshold. A
model of a longer context falls back on the next shorter one by Witten-Bell
weights, down to equal chances.

Characters fold into an alphabet of ``len(ALPHABET) + 2`` symbols, so counts of
all contexts up to ``ORDER`` are an array of fixed size: counting is a combined
aggregate, and the table of log-ratios (21 MB) is the only broadcast.

A null URL or one without ``://`` has an empty host and path. A URL without
characters has a difference of 0. Where the rules give only one verdict, the
method repeats it; where they give none, it allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm.common import text_bytes

ORDER = 3
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%#:"
SIZE = len(ALPHABET) + 2  # others, and what stands before the first character
OTHER, BEFORE = SIZE - 2, SIZE - 1
BINS, BIN_WIDTH = 4000, 0.005
HELD_OUT = 5

_CODES = np.full(256, OTHER, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODES[ord(_c)] = _CODES[ord(_c.upper())] = _i


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def ruled(df: DataFrame, rules: dict[str, str], url: str = "url") -> DataFrame:
    """Add host, path, and the longest rule that fits with its verdict."""
    host, path = host_and_path(F.col(url))
    staged = df.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, rest = pattern.partition("/")
        fits = (F.col("host") == domain) | F.col("host").endswith("." + domain)
        fits = fits & F.col("path").startswith(slash + rest)
        rule = F.when(fits, pattern).otherwise(rule)
        verdict = F.when(fits, rules[pattern]).otherwise(verdict)
    return staged.withColumns({"rule": rule, "verdict": verdict})


def grams(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every character with its context, and how many each URL has."""
    sizes = np.array([len(u) for u in urls], np.int64)
    pad = bytes(ORDER)
    flat = np.frombuffer(b"".join(pad + u for u in urls), np.uint8)
    codes = _CODES[flat]
    starts = np.cumsum(sizes + ORDER) - sizes - ORDER
    before = (starts[:, None] + np.arange(ORDER)[None, :]).ravel()
    codes[before] = BEFORE
    code = np.zeros(len(codes), np.int64)
    for back in range(ORDER, -1, -1):
        code = code * SIZE + np.concatenate([np.full(back, BEFORE), codes[: len(codes) - back]])
    keep = np.ones(len(codes), bool)
    keep[before] = False
    return code[keep], sizes


def gram_counts(df: DataFrame, url: str, label: str) -> DataFrame:
    """Rows (label, code, n) over all URLs; a batch is counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(label).to_pylist(), object)
            urls = text_bytes(batch.column(url))
            for value in set(labels):
                found, n = np.unique(grams([u for u, x in zip(urls, labels) if x == value])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value] * len(found), pa.string()), pa.array(found), pa.array(n.astype(np.int64))],
                    names=[label, "code", "n"],
                )

    counted = df.select(url, label).mapInArrow(run, f"{label} string, code long, n long")
    return counted.groupBy(label, "code").agg(F.sum("n").alias("n"))


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Probability of each symbol after each context of ``ORDER`` symbols."""
    counts = counts.reshape((SIZE,) * (ORDER + 1))
    chance = np.full(SIZE, 1 / SIZE)
    for length in range(ORDER + 1):
        n = counts.sum(axis=tuple(range(ORDER - length)))
        total = n.sum(axis=-1, keepdims=True)
        kinds = np.maximum((n > 0).sum(axis=-1, keepdims=True), 1)
        chance = (n + kinds * chance) / (total + kinds)
    return chance


def fit(df: DataFrame, url: str = "url", label: str = "verdict") -> tuple[np.ndarray | None, float, str]:
    """(log-ratio table, threshold, verdict if only one is known) of labelled URLs."""
    rows = df.filter(F.col(label).isNotNull()).select(F.coalesce(url, F.lit("")).alias(url), label)
    held = F.pmod(F.crc32(F.col(url).cast("binary")), F.lit(HELD_OUT)) == 0
    found = gram_counts(rows.filter(~held), url, label).toPandas()
    tables = {}
    for value, part in found.groupby(label):
        counts = np.zeros(SIZE ** (ORDER + 1))
        counts[part["code"].to_numpy()] = part["n"].to_numpy()
        tables[value] = smoothed(counts)
    if set(tables) != {"allow", "block"}:
        return None, 0.0, next(iter(tables), "allow")
    ratio = np.log(tables["allow"] / tables["block"]).astype(np.float32).ravel()
    scored = with_difference(rows.filter(held), ratio, url, "difference")
    slot = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(F.col("difference") / BIN_WIDTH) + BINS // 2))
    bins = scored.groupBy(label, slot.alias("slot")).count().collect()
    shape = {"allow": np.zeros(BINS), "block": np.zeros(BINS)}
    for r in bins:
        shape[r[label]][r["slot"]] += r["count"]
    if not (shape["allow"].any() and shape["block"].any()):
        return ratio, 0.0, "allow"
    lost = np.cumsum(shape["allow"]) / shape["allow"].sum() + 1 - np.cumsum(shape["block"]) / shape["block"].sum()
    best = np.flatnonzero(lost == lost.min())
    edge = best[np.abs(best + 1 - BINS // 2).argmin()] + 1
    return ratio, float((edge - BINS // 2) * BIN_WIDTH), "allow"


def with_difference(df: DataFrame, ratio: np.ndarray, url: str = "url", out: str = "difference") -> DataFrame:
    """Add the log-likelihood difference per character."""
    table = df.sparkSession.sparkContext.broadcast(ratio)
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes = grams(text_bytes(batch.column(url)))
            sums = np.concatenate([[0.0], np.cumsum(table.value[codes], dtype=np.float64)])
            ends = np.cumsum(sizes)
            value = (sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(value)], names=[*keep, out])

    return df.select(*keep).mapInArrow(run, schema)


def filtered(df: DataFrame, rules: dict[str, str], url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict and the difference behind it."""
    judged = ruled(df, rules, url)
    ratio, threshold, single = fit(judged, url)
    if ratio is None:
        return judged.withColumns(
            {"difference": F.lit(0.0), "verdict": F.coalesce("verdict", F.lit(single))}
        )
    by_model = F.when(F.col("difference") >= threshold, "allow").otherwise("block")
    return with_difference(judged, ratio, url).withColumn("verdict", F.coalesce("verdict", by_model))
