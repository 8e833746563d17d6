"""Exact global positions without a window over the whole table.

Rows fall into a bounded number of ordered buckets. A narrow first pass adds up each bucket,
a running sum over the bucket totals gives every bucket its start, and a window inside the
bucket does the rest. The second pass shuffles the rows once, on the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.order import hash_bucket, ordkey

# One key bucket per so many rows, and never more buckets than this.
BUCKET_ROWS = 1_000_000
MAX_KEY_BUCKETS = 16_384
# Bucket edges come from about so many keys; edges only balance the work, never the result.
EDGE_ROWS = 10_000_000


def positions(
    df: DataFrame,
    order: Sequence[str],
    bucket: str | Column,
    out: str = "pos",
    total: str | None = None,
    weight: Column | None = None,
    group: Sequence[str] = (),
    below: int | None = None,
    since: int | None = None,
) -> DataFrame:
    """Add the 0-based position (or the sum of the weights before the row) in ``order``.

    ``bucket`` must not fall when ``order`` rises, and ``order`` must be unique within
    a group. ``total`` names a column for the row count (or whole weight) of the group.
    NULL is a group, a bucket and a key like any other and comes first. ``below`` keeps the rows
    whose position is smaller, ``since`` those whose position is not; buckets wholly beyond leave before the shuffle.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    group = list(group)
    rows = df.withColumn("_bucket", F.col(bucket) if isinstance(bucket, str) else bucket).withColumn("_weight", weight)
    totals = rows.groupBy(*group, "_bucket").agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *group,
        "_bucket",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
        *(["_sum"] if since is not None else []),
        *([F.sum("_sum").over(Window.partitionBy(*group)).alias(total)] if total else []),
    )
    # Without groups there are at most 65,536 (hash) or MAX_KEY_BUCKETS (key) starts, so the
    # broadcast is bounded. Group counts have no bound: Spark chooses the join.
    starts = starts.toDF(*[f"_at_{name}" if name in (*group, "_bucket") else name for name in starts.columns])
    starts = starts if group else F.broadcast(starts)
    if below is not None:
        starts = starts.where(F.col("_start") < below)
    if since is not None:
        starts = starts.where(F.col("_start") + F.col("_sum") > since).drop("_sum")
    same = F.lit(True)
    for name in [*group, "_bucket"]:
        same = same & F.col(name).eqNullSafe(F.col(f"_at_{name}"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(starts, same).withColumn(
        out, F.col("_start") + F.sum("_weight").over(inside) - F.col("_weight")
    )
    if below is not None:
        placed = placed.where(F.col(out) < below)
    if since is not None:
        placed = placed.where(F.col(out) >= since)
    return placed.drop("_bucket", "_start", "_weight", *[f"_at_{name}" for name in [*group, "_bucket"]])


def shuffled_positions(
    df: DataFrame,
    keys: Sequence[str],
    seed: int | Column = 42,
    out: str = "pos",
    total: str | None = None,
    group: Sequence[str] = (),
    ties: Sequence[str] = (),
    below: int | None = None,
    since: int | None = None,
) -> DataFrame:
    """Position in the seeded random order of the rows; ``keys``, with ``ties`` where they repeat, identify a row."""
    keyed = df.withColumn("_ordkey", ordkey(seed, *keys))
    placed = positions(keyed, ["_ordkey", *keys, *ties], hash_bucket(F.col("_ordkey")), out, total, group=group, below=below, since=since)
    return placed.drop("_ordkey")


def with_key_bucket(df: DataFrame, key: str, out: str = "_range") -> DataFrame:
    """Bucket a numeric key by its approximate quantiles, whatever its distribution.

    The edges only have to rise with the key, so approximate ones still give exact positions.
    """
    keys = df.select(F.col(key).cast("double").alias("_number")).where("_number IS NOT NULL AND NOT isnan(_number)")
    cores = df.sparkSession.sparkContext.defaultParallelism
    count = keys.count()
    buckets = min(MAX_KEY_BUCKETS, max(cores, count // BUCKET_ROWS))
    steps = [i / buckets for i in range(1, buckets)]
    if count > EDGE_ROWS:
        keys = keys.sample(EDGE_ROWS / count, seed=1)
    edges = sorted(set(keys.approxQuantile("_number", steps, 1.0 / (4 * buckets)))) if steps else []
    if not edges:
        return df.withColumn(out, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)))
    number = df.withColumn("_number", F.col(key).cast("double"))
    splits = [float("-inf"), *edges, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_number", outputCol="_bucket_number", handleInvalid="keep").transform(number)
    # Nothing is before NULL and nothing after NaN, as in Spark's own order.
    place = F.when(F.col("_number").isNull(), F.lit(-1)).otherwise(F.col("_bucket_number").cast("int"))
    return bucketed.withColumn(out, place).drop("_number", "_bucket_number")


def key_positions(
    df: DataFrame,
    key: str,
    out: str = "pos",
    total: str | None = None,
    weight: Column | None = None,
    group: Sequence[str] = (),
    below: int | None = None,
) -> DataFrame:
    """Position in the order of a unique numeric key (the stored order)."""
    placed = positions(with_key_bucket(df, key), [key], "_range", out, total, weight, group, below)
    return placed.drop("_range")
