"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(many: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: Sequence[str], salts: int = 64) -> DataFrame:
    """Inner join of a table with hot keys and a lookup table with one row (or few) per key.

    Rows of a hot key are spread over ``salts`` by their own columns; the lookup side is
    copied to every salt.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


# Most numbers (or ids) a lookup table may hold to be broadcast: about 128 MB of doubles.
MAX_BROADCAST_VALUES = 16_000_000


def lookup_join(many: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: Sequence[str], vec: str) -> DataFrame:
    """Inner join with a table of vectors: broadcast when its counted size allows, otherwise salted.

    The count reads ``lookup`` once more, so stage it first when it is costly.
    """
    held = lookup.agg(F.coalesce(F.sum(F.size(vec)), F.lit(0))).first()[0]
    if held <= MAX_BROADCAST_VALUES:
        return many.join(F.broadcast(lookup), list(on))
    return salted_join(many, lookup, on, spread_by)
