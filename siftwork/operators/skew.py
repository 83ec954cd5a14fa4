"""Joins whose keys may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW = 256  # rows that never make a key heavy
HEAVY_KEYS = 1024  # a key is heavy above this share of all rows, so at most so many are


def join_groups(
    members: DataFrame, groups: DataFrame, key: str, size: str = "n", how: str = "inner"
) -> DataFrame:
    """Join ``members`` with one row per key, safe for keys of any size.

    ``groups`` is unique in ``key`` and has the members of each key counted in
    ``size``. Keys above 1/1024 of all rows, at most 1024 of them, are
    broadcast, so their members are never gathered; the rest is shuffled. Where
    no key is that large, one shuffle join does. Pass ``groups`` stored: it is
    read more than once. Null keys meet nothing.
    """
    seen = groups.agg(F.sum(size), F.max(size)).first()
    bound = max(FEW, (seen[0] or 0) // HEAVY_KEYS)
    if (seen[1] or 0) <= bound:
        return members.join(groups, key, how)
    large = F.col(size) > bound
    heavy = groups.filter(large)
    apart = members.join(F.broadcast(heavy), key)
    marked = members.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return apart.unionByName(marked.join(groups.filter(~large), key, how), allowMissingColumns=True)
