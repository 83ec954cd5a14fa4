"""Vector expressions. Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def agreement(a: Column, b: Column) -> Column:
    """Fraction of equal positions; different lengths are an error."""
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0))
    count = F.aggregate(same, F.lit(0), lambda acc, x: acc + x)
    return F.when(F.size(a) == F.size(b), count / F.size(a)).otherwise(
        F.raise_error(F.lit("signature length mismatch"))
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 for a zero vector; different lengths are an error."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    value = F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(norms, F.lit(0.0)))
    return F.when(F.size(a) == F.size(b), value).otherwise(
        F.raise_error(F.lit("vector length mismatch"))
    )
