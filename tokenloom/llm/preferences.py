"""Operator 1, chat formatting: preference pairs with one prompt and two masked completions.

The chosen and the rejected conversation of a pair share a prompt: their longest common prefix of
turns. It is found on digests, by aggregates that combine before the shuffle; the prompt is
rendered once, from the chosen side, and only the turns after it are rendered for both sides.
A completion comes with the character spans that count for the loss (what an assistant says and
its end mark); everything else in it, and the whole prompt, is masked.

A pair is rendered in blocks of ``block_turns`` turn numbers, so that a conversation of any length
is never one row; the texts of a pair's blocks, in order, are the texts of the pair. Ordinary
conversations have one block.

Defined results: two turns are equal if role and text are (NULL equals NULL); a side that has no
turn where the other has one ends the prefix; repeated turns of one number must be equal as a
multiset and are rendered in the order of role and text; a NULL turn number comes before all
others; a NULL id is a pair of its own; NULL roles and texts are rendered as empty; a pair of which
one side is missing has no common turn; equal conversations have empty completions; empty tables
give an empty table. Only the four named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import query
from tokenloom.sources.readers import read_table

#: Turn numbers of a block.
BLOCK_TURNS = 64
ASSISTANT = "assistant"
FIRST_TURN = -(2**63)


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def body(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def _turns(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    number = F.coalesce(F.col(turn).cast("bigint"), F.lit(FIRST_TURN).cast("bigint"))
    return df.select(F.col(key).alias("id"), number.alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))


def common_prefix(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows (id, stop): the first turn number at which the sides differ, NULL if they never do."""
    code = F.xxhash64(F.col("role").isNull(), "role", F.col("text").isNull(), "text").cast("decimal(20,0)")
    coded = chosen.select("id", "turn", F.lit(1).alias("n"), code.alias("code")).unionByName(
        rejected.select("id", "turn", F.lit(-1).alias("n"), (-code).alias("code"))
    )
    # Equal multisets cancel out, in their number and in the sum of their digests.
    turns = coded.groupBy("id", "turn").agg(((F.sum("n") != 0) | (F.sum("code") != 0)).alias("differs"))
    return turns.groupBy("id").agg(F.min(F.when(F.col("differs"), F.col("turn"))).alias("stop"))


def _of_part(part: str) -> Column:
    return F.filter("turns", lambda x: x["part"] == part)


def _rendered(turns: Column, head: Callable[[Column], Column], tail: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(head(x["role"]), tail(x["text"]))), "")


def _loss_spans(turns: Column, head: Callable[[Column], Column], tail: Callable[[Column], Column]) -> Column:
    """(begin, end) of what the assistant says, in characters of the completion."""
    spans = "array<struct<begin:int,end:int>>"

    def add(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(head(x["role"]))
        end = begin + F.length(tail(x["text"]))
        own = F.array(F.struct(begin.alias("begin"), end.alias("end"))).cast(spans)
        kept = F.when(x["role"] == ASSISTANT, F.concat(state["spans"], own)).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))
    return F.aggregate(turns, start, add, lambda state: state["spans"])


def preference_pairs(
    chosen: DataFrame, rejected: DataFrame, key: str = "id", turn: str = "turn", role: str = "role", text: str = "text",
    block_turns: int = BLOCK_TURNS, head: Callable[[Column], Column] = header, tail: Callable[[Column], Column] = body,
) -> DataFrame:
    """Rows (key, block, prompt_turns, prompt, chosen, rejected, chosen_loss, rejected_loss)."""
    left, right = _turns(chosen, key, turn, role, text), _turns(rejected, key, turn, role, text)
    stops = common_prefix(left, right).select(F.col("id").alias("_id"), "stop")
    sides = left.select("*", F.lit("chosen").alias("side")).unionByName(right.select("*", F.lit("rejected").alias("side")))
    placed = sides.join(stops, F.col("id").eqNullSafe(F.col("_id"))).drop("_id")
    shared = F.col("stop").isNull() | (F.col("turn") < F.col("stop"))
    placed = placed.withColumn("part", F.when(shared, F.lit("prompt")).otherwise(F.col("side"))).where(~(shared & (F.col("side") == "rejected")))
    placed = placed.withColumn("block", F.floor(F.col("turn") / F.lit(block_turns)).cast("bigint"))
    grouped = placed.groupBy("id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "part"))).alias("turns"))
    parts = grouped.select("id", "block", *(_of_part(part).alias(f"_{part}") for part in ("prompt", "chosen", "rejected")))
    return parts.select(
        F.col("id").alias(key), "block", F.size("_prompt").alias("prompt_turns"),
        *(_rendered(F.col(f"_{part}"), head, tail).alias(part) for part in ("prompt", "chosen", "rejected")),
        *(_loss_spans(F.col(f"_{part}"), head, tail).alias(f"{part}_loss") for part in ("chosen", "rejected")),
    )


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Rejected conversations: each ends in the last answer of its neighbour (ids 2k and 2k + 1) instead of its own.

    A conversation without an answer of its own stays as it is; without a neighbour's answer it just loses its own.
    """
    said = F.when(F.col("role") == ASSISTANT, F.struct("turn", "text"))
    last = conversations.groupBy("conv_id").agg(F.max(said).alias("answer")).select("conv_id", F.col("answer.turn").alias("at"), F.col("answer.text").alias("answer"))
    before = conversations.join(last.select("conv_id", "at"), "conv_id").where(F.col("at").isNull() | (F.col("turn") < F.col("at"))).select("conv_id", "turn", "role", "text")
    neighbour = last.where(F.col("at").isNotNull()).select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("answer").alias("text"))
    swapped = last.where(F.col("at").isNotNull()).join(neighbour, "conv_id").select("conv_id", F.col("at").alias("turn"), F.lit(ASSISTANT).alias("role"), "text")
    return before.unionByName(swapped)


OP1_SQL = """WITH last AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS at FROM conversations GROUP BY conv_id),
answers AS (SELECT c.conv_id, c.turn, c.text FROM conversations c JOIN last l ON l.conv_id = c.conv_id AND c.turn = l.at),
rejected AS (
  SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c JOIN last l ON l.conv_id = c.conv_id WHERE l.at IS NULL OR c.turn < l.at
  UNION ALL SELECT a.conv_id, a.turn, 'assistant', b.text FROM answers a JOIN answers b ON b.conv_id = xor(a.conv_id, 1)),
stops AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id,
    min(CASE WHEN c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text THEN coalesce(c.turn, r.turn) END) AS stop
  FROM conversations c FULL JOIN rejected r ON r.conv_id = c.conv_id AND r.turn = c.turn GROUP BY 1),
sides AS (SELECT conv_id, turn, role, text, 'chosen' AS side FROM conversations UNION ALL SELECT conv_id, turn, role, text, 'rejected' FROM rejected),
placed AS (
  SELECT s.conv_id, turn // 64 AS block, turn, role, text,
    CASE WHEN stop IS NULL OR turn < stop THEN 'prompt' ELSE side END AS part,
    '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS tail
  FROM sides s JOIN stops t ON t.conv_id = s.conv_id WHERE NOT (side = 'rejected' AND (stop IS NULL OR turn < stop))),
spanned AS (
  SELECT *, sum(length(head) + length(tail)) OVER (PARTITION BY conv_id, block, part ORDER BY turn) AS stop_at FROM placed),
texts AS (
  SELECT conv_id, block, part, count(*) AS n, string_agg(head || tail, '' ORDER BY turn) AS text,
    coalesce(string_agg((stop_at - length(tail)) || '-' || stop_at, ',' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM spanned GROUP BY conv_id, block, part),
keys AS (SELECT DISTINCT conv_id, block FROM placed)
SELECT k.conv_id, k.block::BIGINT AS block, coalesce(p.n, 0)::INTEGER AS prompt_turns, md5(coalesce(p.text, '')) AS prompt_md5,
  md5(coalesce(c.text, '')) AS chosen_md5, md5(coalesce(r.text, '')) AS rejected_md5, coalesce(c.loss, '') AS chosen_loss, coalesce(r.loss, '') AS rejected_loss
FROM keys k LEFT JOIN texts p ON p.conv_id = k.conv_id AND p.block = k.block AND p.part = 'prompt'
LEFT JOIN texts c ON c.conv_id = k.conv_id AND c.block = k.block AND c.part = 'chosen'
LEFT JOIN texts r ON r.conv_id = k.conv_id AND r.block = k.block AND r.part = 'rejected'"""


@query("op1_preference_pairs", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last answer, as digests."""
    conversations = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    pairs = preference_pairs(conversations, swapped_answers(conversations), key="conv_id")
    spans = lambda name: F.array_join(F.transform(name, lambda x: F.concat_ws("-", x["begin"].cast("string"), x["end"].cast("string"))), ",").alias(name)
    return pairs.select(
        "conv_id", "block", "prompt_turns", *(F.md5(part).alias(f"{part}_md5") for part in ("prompt", "chosen", "rejected")), spans("chosen_loss"), spans("rejected_loss")
    )
