"""Registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import (
    bpe,
    centroids,
    chats,
    neardup,
    packing,
    periods,
    quality,
    repeats,
    secrets,
    sharding,
    spots,
    toxicity,
    urls,
)
from siftwork.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(read(spark, folder, "documents"), path)


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    trees = quality.fit(documents, read(spark, folder, "labels"))
    judged = quality.with_verdict(quality.with_statistics(documents), trees)
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "score")


# Fixed values of the contract: rules over host and path.
URL_RULES = {
    "org/": "allow",
    "com/fr/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/de/": "block",
}


@query
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    return urls.filtered(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "difference")


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    documents = read(spark, folder, "documents").select("doc_id", "text")
    machine = toxicity.fit(documents, read(spark, folder, "labels").filter(~held_out))
    scored = toxicity.with_score(documents, machine)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    sharded = sharding.shard_texts(read(spark, folder, "documents"), 24)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    near = spots.edited_likeness(read(spark, folder, "documents"))
    return near.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spots.as_text(F.col("marks")).alias("fingerprint"),
        spots.as_text(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op7_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    left = repeats.without_repeats(documents)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("kept_text"))


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_components(read(spark, folder, "documents"))


@query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    words = secrets.dictionary(read(spark, folder, "conversations").select("text"))
    found = secrets.scan(read(spark, folder, "documents").select("doc_id", "text"), words)
    return found.select("doc_id", "value", "uses", *secrets.FEATURES, "score", "is_secret")


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    texts = documents.select("doc_id", periods.stretched("doc_id", "text").alias("text"))
    found = periods.with_runs(texts).withColumn("best", periods.strongest("runs"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    clustered = centroids.lloyd(read(spark, folder, "embeddings"))
    components = F.array_join("centroid", ",").cast("binary")
    return clustered.withColumn("centroid_sha256", F.sha2(components, 256)).drop("centroid")


@query
def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = chats.format_conversations(turns.unionByName(added))
    return chats.conversation_digests(chats.read_back(formatted)).withColumnRenamed("conv", "conv_id")
