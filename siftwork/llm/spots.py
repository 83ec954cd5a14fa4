"""Document fingerprints from spot signatures, in SQL functions only.

A spot is a common word (an anchor) of any of the covered languages; its
signature is the anchor with the next ``CHAIN`` content words, other common
words between them skipped. Where ``FREE`` content words follow each other
without an anchor, as in tables and names, they are a signature too, at every
word. The set of hashed signatures of a whole text is its fingerprint, so a
change touches only the signatures around it. A text without any signature takes
its whole word sequence; a text without words has an empty fingerprint.

Words are runs of letters and digits, lower-cased. Null counts as empty. Equal
texts have equal fingerprints; likeness is Jaccard's, 1 for two empty ones. Rows
that repeat a key are fingerprinted each; the document before them is compared
with the smallest of their texts.

Fingerprints fall into partitions by set length. Two whose lengths alone keep
their likeness under ``least`` lie in partitions too far apart and count as 0
without a comparison.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.llm.common import Scratch
from siftwork.operators.ordering import dense_ordinal

CHAIN, FREE = 2, 5
LEAST = 0.02
# Common words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be but by for from has have he in is it its not of on or that the this to was were which will with
als am auf aus bei das dem den der des die ein eine einer es für ich im ist mit nicht sich sie und von war wie zu zum
au aux ce dans de du elle en est et il je la le les leur mais ne nous ou par pas pour que qui sa se ses son sur un une
al como con del el ella ese esta este ha hay las lo los más mi muy no nos para pero por porque se si sin su sus una y ya
""".split()


def plain_words(text: Column) -> Column:
    """Lower-cased words with one space before and after each."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def _one_of(words: list[str]) -> str:
    """Pattern of one of the words, branching on the first letter."""
    by_letter: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        by_letter.setdefault(word[0], []).append(word[1:])
    branches = [k + "(?:" + "|".join(sorted(v, key=lambda t: (-len(t), t))) + ")" for k, v in by_letter.items()]
    return "(?:" + "|".join(branches) + ")"


def with_marks(df: DataFrame, text: str, out: str = "marks", chain: int = CHAIN) -> DataFrame:
    """Add the sorted distinct hashes of the spot signatures of ``text``."""
    anchor = _one_of(ANCHORS)
    content = f" (?:{anchor} )*+[^ ]++"
    free = f"(?!{anchor} )[^ ]++"
    spot = f"(?<= )(?=({anchor}{content * chain}|{' '.join([free] * FREE)}) )"
    staged = df.withColumn("_plain", plain_words(F.coalesce(text, F.lit(""))))
    staged = staged.withColumn("_spots", F.regexp_extract_all("_plain", F.lit(spot), F.lit(1)))
    whole = F.when(F.trim("_plain") == "", F.array().cast("array<string>")).otherwise(F.array(F.trim("_plain")))
    staged = staged.withColumn("_spots", F.when(F.size("_spots") > 0, F.col("_spots")).otherwise(whole))
    hashed = F.transform("_spots", lambda s: (F.crc32(s.cast("binary")) - F.lit(1 << 31)).cast("int"))
    return staged.withColumn(out, F.array_sort(F.array_distinct(hashed))).drop("_plain", "_spots")


def as_text(marks: Column) -> Column:
    """A fingerprint as text: its hashes in hexadecimal, in order."""
    return F.array_join(F.transform(marks, lambda m: F.lpad(F.lower(F.hex(m + F.lit(1 << 31))), 8, "0")), ",")


def length_partition(marks: Column, least: float) -> Column:
    """Partition by set length; likeness ``least`` never spans more than two next to each other."""
    return F.floor(F.log(F.greatest(F.size(marks), F.lit(1))) / F.lit(math.log(1 / least)))


def likeness(a: Column, b: Column, least: float = LEAST) -> Column:
    """Jaccard's coefficient of two sets of signatures, 0 where lengths rule ``least`` out."""
    far = F.abs(length_partition(a, least) - length_partition(b, least)) > 1
    pruned = F.least(F.size(a), F.size(b)) < least * F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(far | pruned, 0.0).when(union == 0, 1.0).otherwise(shared / union)


def edited_likeness(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The edited form has the last quarter replaced by the first as many
    characters of the next document in key order (after the last, the first).
    Null keys come first.
    """
    scratch = Scratch(df.sparkSession)
    blank = F.lit("0").cast(df.schema[key].dataType)
    texts = df.select(
        F.col(key).isNull().alias("_none"), F.coalesce(key, blank).alias("_key"), F.coalesce(text, F.lit("")).alias("_text")
    )
    own = F.when(~F.col("_none"), F.col("_key"))
    sizes = texts.groupBy(own.alias("_key")).agg(F.max(F.length("_text")).alias("_n"))
    order = scratch.store(dense_ordinal(sizes, "_key", out="_o"))
    rows = max(order.count(), 1)
    before = order.select(
        F.pmod(F.col("_o") + 1, F.lit(rows)).alias("_o"), F.col("_key").isNull().alias("_before_none"),
        F.coalesce("_key", blank).alias("_before"), "_n",
    )
    this = order.select(F.col("_key").isNull().alias("_none"), F.coalesce("_key", blank).alias("_key"), "_o")
    place = scratch.store(this.join(before, "_o").drop("_o"), keep=True)
    # One shuffle of texts by key serves both: what a document gives to the one before it, and its own row.
    base = with_marks(texts, "_text").repartition("_key", "_none")
    given = base.join(place, ["_key", "_none"]).select(
        F.col("_before").alias("_key"), F.col("_before_none").alias("_none"),
        F.struct(F.expr("left(_text, int(_n div 4))").alias("tail"), F.col("marks").alias("marks")).alias("next"),
    )
    given = given.groupBy("_key", "_none").agg(F.min("next").alias("next"))
    met = base.join(given, ["_key", "_none"])
    met = met.withColumn("n_chars", F.length("_text").cast("long")).withColumn(
        "edited", F.expr("concat(left(_text, int(n_chars - n_chars div 4)), left(next.tail, int(n_chars div 4)))")
    )
    met = with_marks(met.drop("_text"), "edited", "edited_marks")
    scratch.release()
    return met.select(
        own.alias(key),
        "n_chars",
        "edited",
        F.col("marks"),
        "edited_marks",
        likeness(F.col("marks"), F.col("edited_marks"), least).alias("near_edited"),
        likeness(F.col("marks"), F.col("next.marks"), least).alias("near_next"),
    )
