"""Text expressions. Every function takes and returns a Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blank characters that the reference semantics trim and
# split on, valid both as a Java and as an RE2 character class.
BLANK = (
    r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)

# Characters that survive answer normalisation.
ANSWER_DROP = r"[^A-Za-z0-9_\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}@().:/-]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An expression used inside a lambda is otherwise re-evaluated for every
    element the lambda visits.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def trim_all(text: Column) -> Column:
    """Trim every Unicode blank, not just the space that ``F.trim`` strips."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def words(text: Column) -> Column:
    """Lower-cased words, split on blanks, empties dropped."""
    return F.filter(F.split(F.lower(text), f"{BLANK}+"), lambda w: w != "")


def shingles(text: Column, k: int = 3) -> Column:
    """Distinct k-word shingles; an empty array when there are fewer than k words."""

    def grams(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(ws) - (k - 1))
        cut = F.transform(starts, lambda i: F.array_join(F.slice(ws, i, k), " "))
        none = F.array().cast("array<string>")
        return F.when(F.size(ws) < k, none).otherwise(F.array_distinct(cut))

    return bind(words(text), grams)


def normalise_name(name: Column) -> Column:
    """Lower-case and drop ``_`` and ``-``."""
    return F.regexp_replace(F.lower(name), "[_-]", "")


def normalise_answer(text: Column) -> Column:
    """Trim, lower, collapse blanks, then drop characters outside the kept class.

    Blanks collapse before the removal, so ``a ! b`` keeps two spaces.
    """
    lowered = F.lower(trim_all(F.coalesce(text, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(lowered, f"{BLANK}+", " "), ANSWER_DROP, "")


def truncate(text: Column, limit: int = 400) -> Column:
    return F.left(text, F.lit(limit))


def token_count(text: Column) -> Column:
    """Documented fallback rule: one token per four characters, rounded up."""
    return F.ceil(F.length(text) / F.lit(4)).cast("int")


def paragraphs(text: Column, separator: str = r"\n{2,}") -> Column:
    """Trimmed, non-empty paragraphs."""
    return F.filter(F.transform(F.split(text, separator), trim_all), lambda p: p != "")
