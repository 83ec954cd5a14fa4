"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key characters with a digit or a change of case,
whatever a credential word is set to, and what has a digit or a change of case
right after a credential word and white space. The forest looks at length, changes of
character class, letters covered by dictionary words, whether the value is part
of a path or link, and the words next to it. It is trained on labelled findings,
at most ``MAX_FIT_ROWS`` of them by hash (a documented bound). Without reviewed
findings, :func:`assumed_labels` takes as secrets those that stand where only
credentials do, and as ordinary those with nothing around that hints at one.

DataFrame functions and the library's own forest only. Texts are scanned where
they lie; what is shuffled are findings and dictionary words, combined first.
Null and empty texts have no findings, and an empty table none at all; where
labels are of one kind only, that kind is the verdict. Rows that repeat a key
have their findings listed once per row.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.llm.common import Scratch

MAX_FIT_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 4
BEFORE, AFTER = 48, 24  # characters of context
MARK = "<secret>"
LEAST_COUNT = 3  # uses that make a word a dictionary word

# Words that name credentials, words that name other identifiers,
# and openings of published key formats.
CREDENTIAL_WORDS = "passwords? passwd pwd secrets? tokens? api[_-]?keys? access[_-]?keys? auth credentials? bearer private[_-]?keys?".split()
OTHER_WORDS = "commit sha sha1 sha256 md5 hash uuid guid id isbn order invoice phone card version build http https www".split()
KEY_FORMATS = [r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36,}", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"sk-[A-Za-z0-9_-]{20,}", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"]

_CREDENTIAL = "(?:" + "|".join(CREDENTIAL_WORDS) + ")"
_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|[A-Za-z+/_-]*?[a-z][A-Z])[A-Za-z0-9+/_-]{12,}+={0,2}"
_SET = rf"(?i)(?<![A-Za-z]){_CREDENTIAL}[\"']?\s?[=:]\s?[\"']?([^\s\"']{{8,}})"
_OPENED = rf"(?i)(?<![A-Za-z]){_CREDENTIAL}\s+(?=[\"']?((?=\S*[0-9]|(?-i:\S*[a-z][A-Z]))[^\s\"']{{8,}}))"
_FORMAT = "(?<![A-Za-z0-9])(?:" + "|".join(KEY_FORMATS) + ")"

FEATURES = [
    "length", "classes", "changes", "distinct", "digits", "upper", "hexadecimal", "number", "covered",
    "slashes", "in_path", "credential_before", "set_before", "quoted", "other_before", "known_format",
]

EVIDENCE = ["set_before", "credential_before", "quoted"]  # of several places, the first by these


def findings(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, _row, value, uses, before, after): all places of the candidates of each
    text, those of equal context once. ``_row`` numbers the texts; store it before use."""
    texts = df.select(F.col(key), F.coalesce(text, F.lit("")).alias("_text"))
    named = F.transform(F.concat(*[F.regexp_extract_all("_text", F.lit(p), F.lit(1)) for p in (_SET, _OPENED)]), lambda v: F.regexp_replace(v, r"[.,;:)\]}#*$%&|<>!?]+$", ""))
    some = F.array_distinct(
        F.concat(F.regexp_extract_all("_text", F.lit(_RUN), F.lit(0)), named, F.regexp_extract_all("_text", F.lit(_FORMAT), F.lit(0)))
    )
    found = texts.withColumn("_values", F.filter(some, lambda v: F.length(v) >= 8)).filter(F.size("_values") > 0)
    each = found.select(key, F.monotonically_increasing_id().alias("_row"), "_text", F.explode("_values").alias("value"))
    value, whole = F.col("value"), F.col("_text")
    # Pieces begin where the value does, the first one perhaps elsewhere.
    literal = F.concat(F.lit(r"(?=\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
    sizes = F.transform(F.split(whole, literal, -1), lambda piece: F.length(piece))
    starts = F.aggregate(
        sizes, F.array(F.lit(1)).cast("array<int>"), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
    )

    def context(at: Column) -> Column:
        start = F.greatest(at - BEFORE, F.lit(1))
        before = F.substring(whole, start, at - start).alias("before")
        return F.struct(before, F.substring(whole, at + F.length(value), F.lit(AFTER)).alias("after"))

    places = F.transform(F.filter(starts, lambda at: F.substring(whole, at, F.length(value)) == value), context)
    bare = F.length(F.replace(whole, value, F.lit("")))
    uses = ((F.length(whole) - bare) / F.length(value)).cast("long").alias("uses")
    return each.select(key, "_row", "value", uses, F.explode(F.array_distinct(places)).alias("f")).select(key, "_row", "value", "uses", "f.*")


def dictionary(texts: DataFrame, text: str = "text") -> DataFrame:
    """Rows (part): lower-case words of three letters or more used often enough."""
    words = F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}{3,}"), F.lit(0)))
    counted = texts.select(words.alias("part")).groupBy("part").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT).select("part")


def with_features(found: DataFrame, words: DataFrame, scratch: Scratch) -> DataFrame:
    """Add the features of stored findings; dictionary words meet distinct values only."""
    value = F.col("value")
    parts = found.select("value").distinct().select(
        "value", F.explode(F.regexp_extract_all(F.lower(value), F.lit(r"[a-z]{3,}"), F.lit(0))).alias("part")
    )
    hits = parts.join(words, "part").groupBy("value").agg(F.sum(F.length("part")).alias("letters"))
    found = found.join(scratch.store(hits), "value", "left")
    size = F.length(value)

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    classes = sum((flag(value.rlike(p)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")), F.lit(0.0))
    near = F.regexp_extract("before", r"((?:\S+\s+){0,2}\S*)$", 1)
    columns = {
        "length": size.cast("double"),
        "classes": classes,
        "changes": F.regexp_count(value, F.lit(r"[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) / size,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "hexadecimal": flag(value.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$")),
        "number": flag(value.rlike(r"^[0-9+/_-]+$")),
        "covered": F.coalesce("letters", F.lit(0)) / size,
        "slashes": share("/"),
        "in_path": flag(F.col("before").rlike(r"(?:/|://\S*|\\)$")),
        "credential_before": flag(near.rlike(rf"(?i)(?<![A-Za-z]){_CREDENTIAL}(?![A-Za-z])")),
        "set_before": flag(F.col("before").rlike(r"[=:]\s?[\"']?$")),
        "quoted": flag(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")),
        "other_before": flag(near.rlike(r"(?i)(?<![A-Za-z])(?:" + "|".join(OTHER_WORDS) + r")(?![A-Za-z])")),
        "known_format": flag(value.rlike("^(?:" + "|".join(KEY_FORMATS) + ")$")),
    }
    return found.withColumns(columns).drop("letters")


def assumed_labels(featured: DataFrame) -> DataFrame:
    """Findings with ``label`` 1.0 or 0.0, without those that could be either.

    A value with a hint at any place of its text is ordinary at none of them, and of
    several places of a text with one label the one of most evidence stands for all.
    """
    secret = (F.col("known_format") == 1) | (
        (F.col("credential_before") == 1) & (F.col("set_before") == 1) & (F.col("covered") < 0.5) & (F.col("digits") > 0)
    )
    hint = (F.col("credential_before") == 1) | (F.col("set_before") == 1) | (F.col("quoted") == 1)
    ordinary = (F.col("number") == 1) | (F.col("in_path") == 1) | (F.col("covered") >= 0.5) | (F.col("other_before") == 1)
    hinted = F.max(hint).over(Window.partitionBy("_row", "value"))
    labelled = featured.withColumn(
        "label", F.when(secret, 1.0).when(ordinary & ~hinted, 0.0)
    ).filter(F.col("label").isNotNull())
    order = Window.partitionBy("_row", "value", "label").orderBy(*[F.desc(c) for c in EVIDENCE], "before", "after")
    return labelled.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def train(labelled: DataFrame, max_rows: int = MAX_FIT_ROWS) -> RandomForestClassificationModel | float:
    """A forest from labelled findings; the only label there is, or 0.0, if it takes two."""
    rows = labelled.select(*FEATURES, F.col("label").cast("double").alias("label"), F.xxhash64("value", "before").alias("_h"))
    rows = rows.orderBy("_h", *FEATURES).limit(max_rows)
    kinds = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    ready = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows).select("x", "label")
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(ready)


def judged(featured: DataFrame, forest: RandomForestClassificationModel | float, threshold: float = 0.5) -> DataFrame:
    """Add ``score`` and ``is_secret``."""
    if isinstance(forest, float):
        return featured.withColumn("score", F.lit(forest)).withColumn("is_secret", F.col("score") >= threshold)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(featured)
    scored = forest.transform(ready).withColumn("score", vector_to_array("probability")[1])
    columns = [c for c in featured.columns if c not in ("score", "is_secret")]
    return scored.select(*columns, "score", (F.col("score") >= threshold).alias("is_secret"))


def scan(
    df: DataFrame, words: DataFrame, key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None
) -> DataFrame:
    """One row per text and candidate: features and score of the place that looks most
    like a secret, so a value is a secret if it is one at any of its places."""
    scratch = Scratch(df.sparkSession)
    found = scratch.store(findings(df, key, text))
    featured = scratch.store(with_features(found, words, scratch), keep=True)
    forest = train(assumed_labels(featured) if labelled is None else labelled)
    scratch.release()
    places = judged(featured, forest)
    top = F.max(F.struct("score", *EVIDENCE, *[c for c in FEATURES if c not in EVIDENCE], "before", "after", "uses", "is_secret", key)).alias("f")
    best = places.groupBy("_row", "value").agg(top)
    return best.select(f"f.{key}", "value", "f.before", "f.after", "f.uses", *[f"f.{c}" for c in FEATURES], "f.score", "f.is_secret")


def redacted(df: DataFrame, verdicts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every use of a secret replaced by ``MARK``; longer values first."""
    values = verdicts.filter("is_secret").groupBy(F.col(key).alias("_key")).agg(F.collect_set("value").alias("_values"))
    longest = F.transform(
        F.sort_array(F.transform("_values", lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))), asc=False), lambda s: s["v"]
    )
    met = df.join(values, F.col(key).eqNullSafe(F.col("_key")), "left")
    clean = F.aggregate(longest, F.col(text), lambda done, v: F.replace(done, v, F.lit(MARK)))
    return met.withColumn(text, F.when(F.col("_values").isNotNull(), clean).otherwise(F.col(text))).select(*df.columns)
