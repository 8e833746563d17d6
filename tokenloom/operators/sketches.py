"""Quantile sketches as tables of counts by logarithmic bucket: they merge by addition, over batches, days or clusters.

A value of bucket b lies in (g^(b-1), g^b], g = (1 + accuracy) / (1 - accuracy); the bucket's answer 2 g^b / (g + 1) is
off by at most ``accuracy`` times the value. A group has as many rows as the logarithm of its range, however many values it has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 0.01


def _base(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def sketch(df: DataFrame, by: str, value: str, accuracy: float = ACCURACY) -> DataFrame:
    """Rows (by, sign, bucket, n). NULL and NaN values are left out; zero has sign 0 and bucket 0."""
    x = F.col(value).cast("double")
    kept = df.where(x.isNotNull() & ~F.isnan(x))
    # Rounded first, so that a power of the base falls to the same bucket wherever it is computed.
    bucket = F.ceil(F.round(F.log(F.abs(x)) / F.lit(math.log(_base(accuracy))), 9))
    rows = kept.select(by, F.signum(x).cast("int").alias("sign"), F.when(x == 0, F.lit(0)).otherwise(bucket).cast("bigint").alias("bucket"))
    return rows.groupBy(by, "sign", "bucket").agg(F.count("*").alias("n"))


def merge(parts: DataFrame, by: str) -> DataFrame:
    """One sketch from the rows of many."""
    return parts.groupBy(by, "sign", "bucket").agg(F.sum("n").alias("n"))


def quantiles(table: DataFrame, by: str, shares: Sequence[float], accuracy: float = ACCURACY) -> DataFrame:
    """Rows (by, share, n, value): the value of rank floor(share * (n - 1)), from 0, of every group."""
    base = _base(accuracy)
    size = F.lit(2.0) * F.pow(F.lit(base), F.col("bucket").cast("double")) / F.lit(base + 1)
    own = table.withColumn("value", F.when(F.col("sign") == 0, 0.0).otherwise(F.col("sign") * size)).withColumn("_order", F.col("sign") * F.col("bucket"))
    # A group's window holds its buckets, a few thousand at most.
    ordered = Window.partitionBy(by).orderBy("sign", "_order")
    upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = own.withColumn("_upto", upto).withColumn("_whole", F.sum("n").over(Window.partitionBy(by)))
    asked = placed.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    rank = F.floor(F.col("share") * (F.col("_whole") - 1))
    return asked.where((F.col("_upto") > rank) & (F.col("_upto") - F.col("n") <= rank)).select(by, "share", F.col("_whole").alias("n"), "value")
