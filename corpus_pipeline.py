"""The corpus pipeline: documents through five stages, each stored and read again.

Stages keep the columns of ``documents`` (a changed text changes ``n_chars``
with it); the last returns where each token piece is packed. Every stage works
on all rows its predecessor kept, whole texts, and takes nulls, empty tables and
repeated rows as its operator says. Names that begin with an underscore are taken.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import neardup, packing, quality, repeats, secrets
from siftwork.llm.common import Scratch, read

REPEATED = 250  # bytes of a repeated string: about 50 words are 300
ORACLE_SQL = None  # trees, sketches and forests have no SQL form; see the tests


def _with_text(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text of ``found``, one row per key there."""
    changed = found.withColumn("_text", F.col(text)).withColumn("n_chars", F.length("_text").cast("long"))
    return changed.select(*[F.col("_text").alias(c) if c == "text" else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees pass."""
    trees = quality.fit(docs, read(spark, sf_dir, "labels"))
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    judged = quality.with_verdict(quality.with_statistics(whole, "_text", "_features"), trees, "_features")
    return judged.filter("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each near-duplicate group."""
    return neardup.without_near_duplicates(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of ``REPEATED`` bytes that occur anywhere else.

    A row is known by a hash of its key and text, and its length, as keys may repeat.
    """
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    left = repeats.without_repeats(rows, "_row", length=REPEATED, finish=repeats.whole_characters)
    found = left.filter("n_removed > 0").withColumn("kept", F.col("kept").cast("string"))
    changed = found.groupBy(F.col("_row").alias("_key"), "n_bytes").agg(F.min("kept").alias("_kept"))
    same = (F.col("_row") == F.col("_key")) & (F.octet_length("text") == F.col("n_bytes"))
    met = rows.join(changed, same, "left")
    return _with_text(docs, met.withColumn("_kept", F.coalesce("_kept", "text")), "_kept")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked."""
    words = secrets.dictionary(read(spark, sf_dir, "conversations").select("text"))
    return _with_text(docs, secrets.redacted(docs, secrets.scan(docs, words)), "text")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence and offset of every token piece."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = Scratch(spark).store(stage(spark, docs, sf_dir), keep=True)
    return docs
