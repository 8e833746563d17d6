"""Block quantisation with quantised scales: 4-bit codes, an 8-bit code for the scale of a block, two numbers for a group of scales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.vectors import dequantize_nf4, quantize_nf4
from tokenloom.operators.positions import key_positions
from tokenloom.session import stage

#: Values of a block, blocks whose scales are quantised together, and most groups that are broadcast.
BLOCK = 64
GROUP = 256
BROADCAST_GROUPS = 1_000_000


def quantize_double(df: DataFrame, key: str, vec: str, block: int = BLOCK, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(blocks, groups) of a vector table with a unique numeric key.

    Blocks are rows (key, part, codes, scale_code, group), groups are rows (group, middle, reach): a scale is
    about middle + scale_code * reach / 127, at most reach / 254 away. Groups take rows in key order, as many whole vectors as
    have ``group`` blocks (one at least), so a vector's scales are in one group.
    """
    parts = F.sequence(F.lit(0), F.floor((F.size(vec) - 1) / block).cast("int"))
    cut = F.when(F.size(vec) > 0, F.transform(parts, lambda p: F.slice(vec, p * block + 1, block)))
    per_vector = df.agg(F.max(F.ceil(F.size(vec) / block))).first()[0] or 1
    rows = key_positions(df.select(key, vec), key, "_pos").withColumn("group", F.floor(F.col("_pos") / max(1, group // int(per_vector))).cast("bigint"))
    blocks = rows.select(key, "group", F.posexplode(cut).alias("part", "_x")).withColumn("_q", quantize_nf4(F.col("_x")))
    blocks = stage(blocks.select(key, "group", "part", "_q.codes", "_q.scale"), "quantized")
    middles = blocks.groupBy("group").agg(F.avg("scale").alias("middle"), F.min("scale").alias("_low"), F.max("scale").alias("_high"))
    groups = stage(middles.select("group", "middle", F.greatest(F.col("_high") - F.col("middle"), F.col("middle") - F.col("_low")).alias("reach")), "scale-groups")
    share = F.when(F.col("reach") > 0, (F.col("scale") - F.col("middle")) / F.col("reach")).otherwise(0.0)
    coded = _with_groups(blocks, groups).withColumn("scale_code", F.round(share * 127.0).cast("tinyint"))
    return coded.select(key, "part", "codes", "scale_code", "group"), groups


def _with_groups(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    return blocks.join(F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups, "group")


def dequantize_double(blocks: DataFrame, groups: DataFrame, key: str, out: str = "vec") -> DataFrame:
    """Rows (key, ``out``): the vectors that the codes stand for."""
    scale = F.col("middle") + F.col("scale_code") * F.col("reach") / 127.0
    values = _with_groups(blocks, groups).select(key, "part", dequantize_nf4(scale, F.col("codes")).alias("_x"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("part", "_x"))), lambda p: p["_x"])
    return values.groupBy(key).agg(F.flatten(listed).alias(out))
