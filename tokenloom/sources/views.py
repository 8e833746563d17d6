"""Derived views of the chat table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Turn numbers of a bucket: a conversation is spread over buckets, however long it is.
BUCKET_TURNS = 1024


def with_next_turn(conversations: DataFrame, bucket_turns: int = BUCKET_TURNS) -> DataFrame:
    """Rows (conv_id, turn, role, text, next_role, next_text): each turn with the one that follows, also over gaps.

    Turns are followed inside buckets of turn numbers; the last of a bucket gets the first turn of the
    next bucket that has any. So the texts are shuffled once and no conversation is one task.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("_b", F.floor(F.col("turn") / bucket_turns))
    heads = rows.groupBy("conv_id", "_b").agg(F.min(F.struct("turn", "role", "text")).alias("_head"))
    # One row per bucket: the window over a conversation is shorter than the conversation by that factor.
    nexts = heads.select(F.col("conv_id").alias("_c"), F.col("_b").alias("_d"), F.lead("_head").over(Window.partitionBy("conv_id").orderBy("_b")).alias("_next"))
    inside = Window.partitionBy("conv_id", "_b").orderBy("turn")
    followed = rows.withColumn("_own", F.lead(F.struct("turn", "role", "text")).over(inside))
    last = followed.where("_own IS NULL").join(nexts, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("_b").eqNullSafe(F.col("_d")))
    kept = ["conv_id", "turn", "role", "text"]
    rest = followed.where("_own IS NOT NULL").select(*kept, F.col("_own.role").alias("next_role"), F.col("_own.text").alias("next_text"))
    return rest.unionByName(last.select(*kept, F.col("_next.role").alias("next_role"), F.col("_next.text").alias("next_text")))


def question_answer_pairs(conversations: DataFrame, bucket_turns: int = BUCKET_TURNS) -> DataFrame:
    """Each user turn directly followed by an assistant turn, with the system text as context."""
    followed = with_next_turn(conversations, bucket_turns).where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    asked = followed.select("conv_id", "turn", F.col("text").alias("question"), F.col("next_text").alias("answer"))
    system = conversations.where((F.col("role") == "system") & (F.col("turn") == 0)).select(
        "conv_id", F.col("text").alias("context")
    )
    return asked.join(system, "conv_id", "left").select("conv_id", "turn", "question", "context", "answer")


def opening_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the first two items of every conversation that has two.

    Only those two rows per conversation are read on, so no conversation is collected whole.
    """
    first_two = conversations.where(F.col("turn").isin(0, 1))
    per = first_two.groupBy("conv_id").agg(
        F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("_a"),
        F.max(F.when(F.col("turn") == 1, F.col("text"))).alias("_b"),
    )
    both = per.where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return both.select("conv_id", F.array("_a", "_b").alias("turns"))
