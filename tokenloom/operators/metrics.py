"""Counts, losses, accuracy, latency and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.prompts import strip
from tokenloom.operators.positions import positions, with_key_bucket
from tokenloom.session import stage


def row_counts(df: DataFrame, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("row_count"))


def eval_loss_accuracy(scored: DataFrame) -> DataFrame:
    """One row from (batch_id, label, pred, loss): accuracy in percent over rows, the mean of the
    batch mean losses, and the mean over rows (where a short last batch weighs less)."""
    per_batch = scored.groupBy("batch_id").agg(
        F.count("*").alias("_n"), F.sum("loss").alias("_loss"),
        F.sum(F.when(F.col("label") == F.col("pred"), 1).otherwise(0)).alias("_right"),
    )
    return per_batch.agg(
        F.sum("_n").alias("row_count"),
        F.count("*").alias("batches"),
        (100.0 * F.sum("_right") / F.sum("_n")).alias("accuracy"),
        F.avg(F.col("_loss") / F.col("_n")).alias("avg_loss_batches"),
        (F.sum("_loss") / F.sum("_n")).alias("avg_loss_rows"),
    )


def running_loss(batched: DataFrame, loss: str, every: int, batch_size: int) -> DataFrame:
    """Mean loss of every ``every``-th batch and the rows seen up to it (batches count from 1)."""
    number = F.col("batch_id") + 1
    per_batch = batched.where(number % every == 0).groupBy("batch_id").agg(F.avg(loss).alias("loss"), F.count("*").alias("_n"))
    return per_batch.select(number.alias("batch"), "loss", (F.col("batch_id") * batch_size + F.col("_n")).alias("rows_seen"))


def every_nth(df: DataFrame, step: str, n: int) -> DataFrame:
    return df.where(F.col(step) % n == 0)


def exact_percentiles(df: DataFrame, by: str, value: str, shares: Sequence[float]) -> DataFrame:
    """Exact interpolated percentiles per group: rows (by, share, percentile).

    Equal values are counted first; ranks then come from bucketed running sums, so neither a
    hot group nor a hot value ends up in one task or in one aggregation buffer.
    """
    counts = stage(df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_count")), "counts")
    ranked = positions(with_key_bucket(counts, value), [value], "_range", "_from", "_n", F.col("_count"), [by])
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    asked = ranked.withColumn("share", F.explode(wanted)).withColumn("_rank", F.col("share") * (F.col("_n") - 1))
    low, high = F.floor("_rank"), F.ceil("_rank")
    last = F.col("_from") + F.col("_count") - 1
    near = asked.where((F.col("_from") <= high) & (last >= low))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (last >= rank), F.col(value)))

    ends = near.groupBy(by, "share").agg(at(low).alias("_low"), at(high).alias("_high"), F.first(F.col("_rank") - low).alias("_part"))
    return ends.select(by, "share", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("percentile"))


def latency_stats(df: DataFrame, by: str, ms: str, shares: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Calls, mean and percentiles of a recorded duration per group."""
    basic = df.groupBy(by).agg(F.count("*").alias("calls"), F.avg(ms).alias("mean_ms"))
    names = {s: f"p{round(s * 100)}" for s in shares}
    spread = exact_percentiles(df, by, ms, shares).groupBy(by).agg(
        *[F.max(F.when(F.col("share") == s, F.col("percentile"))).alias(n) for s, n in names.items()]
    )
    spread = spread.withColumnRenamed(by, "_group")
    return basic.join(spread, F.col(by).eqNullSafe(F.col("_group")), "left").drop("_group")


def normalized(text: Column) -> Column:
    return F.lower(strip(text))


def compare_models(base: DataFrame, tuned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gold, base and tuned answers side by side, with exact-match flags.

    ``base`` is (keys..., gold, output), ``tuned`` is (keys..., output); rows meet on the key.
    """
    both = base.withColumnRenamed("output", "base").join(tuned.withColumnRenamed("output", "tuned"), list(keys))
    gold = normalized(F.col("gold"))
    return both.withColumns(
        {
            "base_match": (normalized(F.col("base")) == gold).cast("int"),
            "tuned_match": (normalized(F.col("tuned")) == gold).cast("int"),
        }
    )


def match_rates(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count("*").alias("row_count"), F.avg("base_match").alias("base_rate"), F.avg("tuned_match").alias("tuned_rate")
    )
