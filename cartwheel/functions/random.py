"""Layout-independent pseudo-random columns.

``F.rand(seed)`` depends on the partition a row lands in, so the same seed
gives different rows after a repartition or on a different cluster size, and
a recomputed partition after an executor loss may not match its first run
once upstream layout changes.  Here every draw is a function of (salt, seed,
row key): the same key always gets the same value, on any layout, on any
retry.

A draw is the first 52 bits of the MD5 of "salt:seed:key", which any SQL engine can
compute (``draw_sql``).  It names its key once: an arithmetic mix whose rounds name
their input twice doubles the expression tree with every round, and analysing such
trees took longer than drawing (see README).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^52, not 2^53: (2^53 - 0.5) / 2^53 rounds to exactly 1.0 in a double,
# (2^52 - 0.5) / 2^52 does not, so every uniform is strictly inside (0, 1).
_UNIFORM_BITS = 1 << 52


def _key(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def integer_key(key: str | Column, integral: bool) -> Column:
    """The key itself if it is integral, else a 64-bit hash of it."""
    return _key(key).cast("bigint") if integral else F.xxhash64(_key(key))


_DIGITS = 13  # hexadecimal digits of a digest that make the 52 bits


def hashed_long(key: str | Column, seed: int, salt: str) -> Column:
    """52 pseudo-random bits of an integral row key, distinct per (seed, salt)."""
    text = F.concat(F.lit(f"{salt}:{int(seed)}:"), _key(key).cast("bigint").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def draw_sql(key: str, seed: int, salt: str) -> str:
    """:func:`hashed_long` as SQL text over a bigint key."""
    return f"CAST('0x' || substr(md5('{salt}:{int(seed)}:' || CAST({key} AS VARCHAR)), 1, {_DIGITS}) AS BIGINT)"


def uniform_sql(key: str, seed: int, salt: str) -> str:
    """:func:`hashed_uniform` as SQL text."""
    return f"((CAST({draw_sql(key, seed, salt)} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({_UNIFORM_BITS} AS DOUBLE))"


def hashed_uniform(key: str | Column, seed: int, salt: str) -> Column:
    """A double uniform on the open interval (0, 1)."""
    return (hashed_long(key, seed, salt).cast("double") + F.lit(0.5)) / F.lit(float(_UNIFORM_BITS))


def hashed_int(key: str | Column, seed: int, salt: str, low: int, high: int) -> Column:
    """An integer uniform on [low, high], both ends included."""
    span = int(high) - int(low) + 1
    if span <= 0:
        raise ValueError(f"empty range [{low}, {high}]")
    return F.pmod(hashed_long(key, seed, salt), F.lit(span)) + F.lit(int(low))


def hashed_range(key: str | Column, seed: int, salt: str, low: float, high: float) -> Column:
    """A double uniform on [low, high)."""
    return F.lit(float(low)) + hashed_uniform(key, seed, salt) * F.lit(float(high) - float(low))


def hashed_normal(key: str | Column, seed: int, salt: str, mean: float = 0.0,
                  stddev: float = 1.0) -> Column:
    """A normal draw by the Box-Muller transform of two hashed uniforms."""
    u1 = hashed_uniform(key, seed, salt + ":bm1")
    u2 = hashed_uniform(key, seed, salt + ":bm2")
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(float(mean)) + F.lit(float(stddev)) * z


def hashed_pareto(key: str | Column, seed: int, salt: str, alpha: float) -> Column:
    """A classical Pareto draw with minimum 1 (inverse CDF: u ** (-1/alpha))."""
    return F.pow(hashed_uniform(key, seed, salt), F.lit(-1.0 / float(alpha)))


def hashed_choice(key: str | Column, seed: int, salt: str, values: list) -> Column:
    """A uniform pick from a small literal list."""
    if not values:
        raise ValueError("empty choice list")
    idx = hashed_int(key, seed, salt, 1, len(values))
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int"))
