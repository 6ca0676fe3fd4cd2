"""Repeatable per-row random numbers that do not depend on partitioning.

``rand(seed)`` changes with the partition layout, so a re-run on another
cluster (or after an executor loss) would draw different values.  Instead each
row's uniform is derived from a hash of ``salt:key``: 13 hex digits of md5 give
an integer in [0, 2^52), exactly representable as a double.  The same formula
is available in SQL engines with md5 (used by the oracle).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 52
HASH_RANGE = float(2 ** HASH_BITS)
TWO_PI = 2.0 * math.pi


def _key_text(*keys: Column | str) -> Column:
    parts: list[Column] = []
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit(":"))
        c = F.col(k) if isinstance(k, str) else k
        parts.append(c.cast("string"))
    return F.concat(*parts)


def hash52(salt: str, *keys: Column | str) -> Column:
    """Integer in [0, 2^52) from md5(salt ':' key1 [':' key2 ...])."""
    text = F.concat(F.lit(salt + ":"), _key_text(*keys))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def uniform(salt: str, *keys: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    return hash52(salt, *keys).cast("double") / F.lit(HASH_RANGE)


def uniform_open(salt: str, *keys: Column | str) -> Column:
    """Uniform double in (0, 1), safe for log()."""
    return (hash52(salt, *keys).cast("double") + F.lit(1.0)) / F.lit(HASH_RANGE + 1.0)


def uniform_int(salt: str, bound: Column | int, *keys: Column | str) -> Column:
    """Integer in [0, bound) drawn with the row's uniform."""
    b = F.lit(bound) if isinstance(bound, int) else bound
    return F.floor(uniform(salt, *keys) * b.cast("double")).cast("bigint")


def standard_normal(salt: str, *keys: Column | str) -> Column:
    """Box-Muller normal from two independent hash uniforms."""
    u1 = uniform_open(salt + ":u1", *keys)
    u2 = uniform(salt + ":u2", *keys)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)


def hash_bucket(bits: int, *keys: Column | str, salt: str = "bucket") -> Column:
    """Top ``bits`` bits of the 52-bit hash: a uniform bucket in [0, 2^bits)."""
    return F.shiftright(hash52(salt, *keys), HASH_BITS - bits)
