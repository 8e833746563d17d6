"""Operator 2, sharding: a uniform shuffle with exact shard sizes by a communication matrix.

The law is ``rows``: shard sizes are at most one row apart. Each partition of the input learns from
a matrix of hypergeometric draws how many of its rows go to each shard, which is what a uniform
permutation of all rows would have sent there. Rows are permuted inside their partition and dealt
out by those counts, exchanged, and permuted again inside their shard, which gives their slot.

A narrow table with the numbers of the rows (partition and place) is written once, so a lost
executor finds the same rows under the same numbers. The matrix has one row per partition, at most
MAX_PARTITIONS; the shards' slots are numbered through buckets of a bounded number of rows, so
neither a shard nor a hot source is ever one task.

Defined results: rows, not keys, are dealt out, so repeated rows and equal or NULL ids each get a
shard and slot of their own; NULL texts have size 1; an empty table gives an empty table; only
``key`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import documents, query
from tokenloom.session import stage

SHARDS = 8
SEED = 42
#: Most partitions of the numbered table, and so rows of the matrix.
MAX_PARTITIONS = 65_536
#: About so many rows of a shard are put in order by one task.
BUCKET_ROWS = 500_000
HASH_RANGE = 1 << 31


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement from ``good`` + ``bad`` are good, for any size.

    The weights follow from their ratios, outwards from the mode, over twelve standard deviations.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1)))
    low, high = max(low, mode - int(12 * spread) - 12), min(high, mode + int(12 * spread) + 12)
    k = np.arange(low, high, dtype=np.float64)
    ratios = (np.log(good - k) + np.log(n - k)) - (np.log(k + 1) + np.log(bad - n + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(ratios)))
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right").clip(0, high - low))


def communication_matrix(counts: list[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """Rows that each partition sends to each shard: row sums are ``counts``, column sums at most one apart."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    left = [total // shards + (shard < total % shards) for shard in range(shards)]
    matrix = []
    for count in counts:
        row, need = [], count
        rest = sum(left)
        for shard in range(shards):
            rest -= left[shard]
            sent = draw_hypergeometric(rng, left[shard], rest, need) if need else 0
            row.append(sent)
            need -= sent
        left = [have - sent for have, sent in zip(left, row)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Rows (key, size, text_crc32, shard, slot)."""
    spark = df.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("key"), (F.octet_length(value) + F.lit(1)).cast("bigint").alias("size"), F.crc32(value).alias("text_crc32"),
        F.monotonically_increasing_id().alias("number"),
    )
    if df.rdd.getNumPartitions() > MAX_PARTITIONS:
        rows = rows.coalesce(MAX_PARTITIONS)
    rows = stage(rows, "shard-rows").withColumn("part", F.shiftrightunsigned("number", 33).cast("int"))
    # One number per partition, so at most MAX_PARTITIONS rows come to the driver and go out again.
    counts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())
    matrix = communication_matrix([count for _, count in counts], shards, seed)
    bounds = [(part, np.cumsum(row).tolist()) for (part, _), row in zip(counts, matrix)]
    table = spark.createDataFrame(bounds, "part int, bounds array<bigint>")
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "number"), "number")
    placed = rows.withColumn("place", F.row_number().over(local) - 1).join(F.broadcast(table), "part")
    dealt = placed.withColumn("shard", F.size(F.filter("bounds", lambda bound: bound <= F.col("place"))))
    total = sum(count for _, count in counts)
    buckets = max(1, min(MAX_PARTITIONS, -(-total // (shards * BUCKET_ROWS))))
    dealt = dealt.withColumn("draw", F.pmod(F.xxhash64(F.lit(seed + 1), "number"), F.lit(HASH_RANGE)))
    dealt = stage(dealt.select("key", "size", "text_crc32", "number", "shard", "draw", F.expr(f"int(draw * {buckets} div {HASH_RANGE})").alias("bucket")), "shard-dealt")
    sums = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("draw", "number")
    slots = dealt.withColumn("_place", F.row_number().over(within)).join(F.broadcast(starts), ["shard", "bucket"])
    return slots.select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("start") + F.col("_place") - 1).alias("slot"))


@query("op2_sharding")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7."""
    return shuffle_into_shards(documents(spark, folder)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
