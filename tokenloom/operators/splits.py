"""Splits, shuffles and samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tokenloom.functions.order import ordkey
from tokenloom.operators.positions import key_positions, positions, shuffled_positions, with_key_bucket
from tokenloom.session import stage

# Above this many rows a sample is cut by position instead of a top-n on the driver.
TOP_N_ROWS = 1_000


def split_exact(df: DataFrame, keys: Sequence[str], valid_rows: int = 100, seed: int = 42) -> DataFrame:
    """Add ``split``: exactly ``valid_rows`` random rows are ``valid``, the rest ``train``.

    A table with no more than ``valid_rows`` rows is an error. One small top-n over the keys finds the
    border row; after that the split is a comparison, and the rows themselves are not shuffled. Where the
    border row's keys repeat, its rows are told apart by their other columns; only then is the table staged.
    """
    place = F.struct(ordkey(seed, *keys).alias("_ordkey"), *keys)
    head = df.select(place.alias("_place")).orderBy("_place").limit(valid_rows + 1)
    counted = head.groupBy("_place").agg(F.count("*").alias("_equal"))
    border = counted.agg(F.sum("_equal").alias("_n"), F.max(F.struct("_place", "_equal")).alias("_last")).select("_n", "_last._equal", "_last._place.*").first()
    if (border[0] or 0) <= valid_rows:
        raise ValueError(f"cannot take {valid_rows} validation rows from {border[0] or 0} rows")
    # The border row as a constant of the same types.
    kinds = df.select(place.alias("p")).schema["p"].dataType
    values = F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(border[2:], kinds.fields)])
    before, split_of = place < values, lambda valid: F.when(valid, F.lit("valid")).otherwise(F.lit("train"))
    # All rows of the head but the border row are valid, those with its keys too.
    repeated = border[1] - 1
    if not repeated:
        return df.withColumn("split", split_of(before))
    digest = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    numbered = stage(df.withColumn("_split_row", F.monotonically_increasing_id()), "split-rows")
    equal = place.eqNullSafe(values)
    own = F.struct(digest.alias("digest"), F.col("_split_row").alias("row"))
    last = numbered.where(equal).select(own.alias("_own")).orderBy("_own").limit(repeated).agg(F.max("_own").alias("last")).select("last.*").first()
    among = own <= F.struct(F.lit(last.digest).alias("digest"), F.lit(last.row).cast("bigint").alias("row"))
    return numbered.withColumn("split", split_of(before | (equal & among))).drop("_split_row")


def shuffle(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Add ``pos``, the row's place in a seeded random order."""
    return shuffled_positions(df, keys, seed)


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows drawn without replacement (all rows when there are fewer)."""
    if n <= TOP_N_ROWS:
        return df.orderBy(ordkey(seed, *keys), *keys).limit(n)
    # Only the rows of buckets up to the border's are shuffled.
    return shuffled_positions(df, keys, seed, "_pos", below=n).drop("_pos")


def take_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in ``order``, NULL first, whatever ``n`` and the columns are.

    A large ``n`` is cut at the position of the border: rows fall into ranges of the first column, and only those of the ranges
    up to the border's are shuffled. Rows that agree in ``order`` are told apart by a number, so exactly ``n`` come.
    """
    if n <= TOP_N_ROWS:
        return df.orderBy(*order).limit(n)
    numbered = stage(df.withColumn("_take_row", F.monotonically_increasing_id()), "take-rows")
    kind = numbered.schema[order[0]].dataType
    # A number that never falls when the column rises.
    first = F.conv(F.rpad(F.hex(F.substring(F.col(order[0]).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double") if isinstance(kind, StringType) else F.col(order[0]).cast("double")
    ranged = with_key_bucket(numbered.withColumn("_take_first", first), "_take_first")
    return positions(ranged, [*order, "_take_row"], "_range", "_take_pos", below=n).drop("_range", "_take_first", "_take_pos", "_take_row")


def percent_slice(df: DataFrame, key: str, percent: float) -> DataFrame:
    """First ``percent`` of the rows in key order, the count rounded half up."""
    cut = math.floor(df.count() * float(percent) / 100.0 + 0.5)
    return key_positions(df, key, "_pos", below=cut).drop("_pos")


def sampler(df: DataFrame, key: str, random: bool = False, seed: int = 42) -> DataFrame:
    """Index sequence over a numeric key: (pos, key), in stored or in random order."""
    narrow = df.select(key)
    placed = shuffled_positions(narrow, [key], seed) if random else key_positions(narrow, key)
    return placed.select("pos", key)


def split_report(source: DataFrame, split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows of the source, rows in both splits, rows in neither, rows not in the source."""
    origin = source.select(*keys, F.lit(1).alias("_src"), F.lit(0).alias("_train"), F.lit(0).alias("_valid"))
    made = split.select(
        *keys,
        F.lit(0).alias("_src"),
        (F.col("split") == "train").cast("int").alias("_train"),
        (F.col("split") == "valid").cast("int").alias("_valid"),
    )
    per_key = origin.unionByName(made).groupBy(*keys).agg(F.sum("_src").alias("s"), F.sum("_train").alias("t"), F.sum("_valid").alias("v"))

    def number(condition):
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return per_key.agg(
        number(F.col("s") > 0).alias("source_rows"),
        number((F.col("t") > 0) & (F.col("v") > 0)).alias("in_both"),
        number((F.col("s") > 0) & (F.col("t") + F.col("v") == 0)).alias("lost"),
        number((F.col("s") == 0) & (F.col("t") + F.col("v") > 0)).alias("added"),
    )
