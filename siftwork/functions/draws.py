"""Reproducible uniform numbers and hash scores as closed-form columns.

The n-th draw of a seeded stream depends on n alone (the generator adds a
constant to its 32-bit state per draw, then mixes it), so a plan of any size
draws in parallel, without a sequential loop.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF
TWO32 = 4294967296
# Fixed values of the 32-bit mixer: step added per draw.
STEP = 0x6D2B79F5


def seed_state(seed: str) -> int:
    return int.from_bytes(hashlib.sha256(seed.encode()).digest()[:4], "big")


def _times(a: Column, b: Column) -> Column:
    """a * b mod 2^32 for unsigned 32-bit longs; split so that BIGINT never overflows."""
    high = F.shiftleft(F.shiftright(a, 16) * b.bitwiseAND(F.lit(MASK)) % F.lit(65536), 16)
    low = a.bitwiseAND(F.lit(65535)) * b
    return (high + low).bitwiseAND(F.lit(MASK))


def _state(seed: str, n: Column) -> Column:
    turns = n.cast("bigint").bitwiseAND(F.lit(MASK))
    return (F.lit(seed_state(seed)) + _times(turns, F.lit(STEP))).bitwiseAND(F.lit(MASK))


def _mix(s: Column) -> Column:
    return _times(s.bitwiseXOR(F.shiftright(s, 15)), s.bitwiseOR(F.lit(1)))


def _stir(t: Column) -> Column:
    u = _times(t.bitwiseXOR(F.shiftright(t, 7)), t.bitwiseOR(F.lit(61)))
    return (t + u).bitwiseAND(F.lit(MASK)).bitwiseXOR(t)


def _fraction(t: Column) -> Column:
    return t.bitwiseXOR(F.shiftright(t, 14)) / F.lit(float(TWO32))


def uniform(seed: str, n: Column) -> Column:
    """Draw number ``n`` (from 1) of the stream named ``seed``, in [0, 1)."""
    return _fraction(_stir(_mix(_state(seed, n))))


def with_draws(df: DataFrame, seed: str, **numbers: Column) -> DataFrame:
    """Add several draws of one stream as columns: name = draw number.

    The steps are separate projections. They run in one generated loop like
    :func:`uniform`, but no step is written out again inside the next.
    """
    names = list(numbers)
    staged = df.withColumns({name: _state(seed, n) for name, n in numbers.items()})
    for step in (_mix, _stir, _fraction):
        staged = staged.withColumns({name: step(F.col(name)) for name in names})
    return staged


def pick(draw: Column, options: list[str]) -> Column:
    """Element of ``options`` at floor(draw * n)."""
    index = F.floor(draw * len(options)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), index)


def hash_score(salt: str, key: Column) -> Column:
    """First four bytes of sha256("salt:key") as a fraction in [0, 1)."""
    digest = F.sha2(F.concat(F.lit(salt + ":"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(TWO32))
