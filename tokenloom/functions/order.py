"""Repeatable randomness from hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 16 bits of the hash: at most 65,536 buckets whatever the row count, which bounds every
# table of bucket totals, and 1.5 million rows per bucket at 10^11 rows.
HASH_BUCKET_DIGITS = 4


def ordkey(seed: int | Column, *keys: str | Column) -> Column:
    """Order key of a row: md5 of the seed and the row's key."""
    seed_col = seed if isinstance(seed, Column) else F.lit(seed)
    parts = [seed_col.cast("string")]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash_bucket(key: Column) -> Column:
    """Leading digits of an order key; rises with the order key."""
    return F.substring(key, 1, HASH_BUCKET_DIGITS)


def uniform(seed: int | Column, *keys: str | Column) -> Column:
    """Number in [0, 1) with 52 random bits, exact as a double."""
    bits = F.conv(F.substring(ordkey(seed, *keys), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(2**52))
