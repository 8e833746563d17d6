"""Mini-batches, padding, packing and sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators import batching as B
from tokenloom.operators.tokens import attention_mask, pretokenize, tokenize_pairs, truncate
from tokenloom.plans.prompting import BY_CONTEXT_SQL, answered_prompt, open_prompt
from tokenloom.plans.registry import (
    PAIR_KEY, PAIRS_SQL, pieces_sql, SEED, VOCAB_SQL, documents, ids_sql, joined, pairs, query, shuffled_sql, vocabulary,
)
from tokenloom.functions.prompts import prompt_by_context
from tokenloom.operators.splits import split_exact
from tokenloom.session import stage
from tokenloom.plans.tokenizing import CUT_IDS, CUTOFF, DOC_IDS, _labels_sql
from tokenloom.sources.readers import read_table

BATCH = 64
SMALL = 8
DOC_KEY = ["doc_id"]
DOCS = f"{shuffled_sql('o', 'documents', 'doc_id', columns='doc_id')}"


def doc_keys(spark, folder) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id")


@query("minibatch", f"WITH {DOCS} SELECT doc_id, pos, pos // {BATCH} AS batch_id FROM o")
def minibatch(spark, folder):
    return B.minibatch(doc_keys(spark, folder), DOC_KEY, BATCH, SEED)


@query("drop_last", f"WITH {DOCS} SELECT doc_id, pos, pos // {BATCH} AS batch_id FROM o WHERE pos < n // {BATCH} * {BATCH}")
def drop_last(spark, folder):
    return B.minibatch(doc_keys(spark, folder), DOC_KEY, BATCH, SEED, drop_last=True)


PADDED_SQL = f"""WITH {CUT_IDS}, {shuffled_sql('o', 'ended', 'conv_id, turn')},
labelled AS (SELECT conv_id, turn, pos // {SMALL} AS batch_id, ids, len(ids) AS n, string_split({_labels_sql('prompt_len')}, ' ') AS lab FROM o),
wide AS (SELECT *, (ceil(max(n) OVER (PARTITION BY batch_id) / 8.0) * 8)::BIGINT AS width FROM labelled)
SELECT conv_id, turn, batch_id, width,
       array_to_string(list_concat(list_transform(range(width - n), lambda x: 0::BIGINT), ids), ' ') AS ids,
       array_to_string(list_concat(list_transform(range(width - n), lambda x: 0), list_transform(ids, lambda x: 1)), ' ') AS mask,
       array_to_string(list_concat(list_transform(range(width - n), lambda x: '-100'), lab), ' ') AS labels FROM wide"""


def tokenized(spark, folder, **options):
    vocab = vocabulary(spark, folder)
    return tokenize_pairs(pairs(spark, folder), vocab, open_prompt(), answered_prompt(), PAIR_KEY, CUTOFF, **options)


def batched(rows):
    """Rows with their ``batch_id``: the ids are staged with a row number, so rows without a key and rows that share one keep
    their own batch, and the position passes read the narrow columns only."""
    numbered = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "tokenized")
    batches = B.minibatch(numbered.select(*PAIR_KEY, "_row"), PAIR_KEY, SMALL, SEED, ties=["_row"])
    return numbered.join(batches.select("_row", "batch_id"), "_row").drop("_row")


@query("pad_batch", PADDED_SQL)
def pad_batch(spark, folder):
    rows = batched(tokenized(spark, folder, mask_prompt=True).select(*PAIR_KEY, "input_ids", "attention_mask", "labels"))
    padded = B.pad_batch(rows, pad_id=0, multiple=8, side="left")
    return padded.select(
        *PAIR_KEY, "batch_id", F.size("input_ids").cast("bigint").alias("width"), joined("input_ids").alias("ids"),
        joined("attention_mask").alias("mask"), joined("labels").alias("labels"),
    )


PROMPT_IDS = f"""{PAIRS_SQL}, {VOCAB_SQL},
asked AS MATERIALIZED (SELECT conv_id, turn, {BY_CONTEXT_SQL} AS prompt FROM pairs), {ids_sql('ids', 'asked', 'conv_id, turn', 'prompt')}"""


def prompt_ids(spark, folder, cutoff: int | None = None):
    """Ids of the prompts, whole unless a cutoff is given."""
    vocab = vocabulary(spark, folder)
    rows = pairs(spark, folder).withColumn("prompt", prompt_by_context(F.col("question"), F.col("context")))
    rows = vocab.with_ids(rows, PAIR_KEY, "prompt")
    if cutoff is not None:
        rows = rows.withColumn("input_ids", truncate(F.col("input_ids"), cutoff))
    return vocab, rows.select(*PAIR_KEY, "input_ids", attention_mask(F.col("input_ids")).alias("attention_mask"))


@query(
    "pad_longest",
    f"""WITH {PROMPT_IDS}, {shuffled_sql('o', 'ids', 'conv_id, turn')},
    cut AS (SELECT conv_id, turn, pos // {SMALL} AS batch_id, ids FROM o),
    wide AS (SELECT *, len(ids) AS n, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM cut)
    SELECT conv_id, turn, batch_id, array_to_string(list_concat(ids, list_transform(range(width - n), lambda x: r + 1)), ' ') AS ids,
           n AS mask_sum FROM wide CROSS JOIN base""",
)
def pad_longest(spark, folder):
    vocab, rows = prompt_ids(spark, folder)
    padded = B.pad_batch(batched(rows), vocab.eos_id, multiple=1, side="right")
    ones = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return padded.select(*PAIR_KEY, "batch_id", joined("input_ids").alias("ids"), ones.alias("mask_sum"))


@query(
    "pad_max_length",
    f"""WITH {PROMPT_IDS}, cut AS (SELECT conv_id, turn, ids, max(len(ids)) OVER () AS width FROM ids)
    SELECT conv_id, turn, array_to_string(list_concat(list_transform(range(width - len(ids)), lambda x: r + 1), ids), ' ') AS ids,
           len(ids) AS mask_sum FROM cut CROSS JOIN base""",
)
def pad_max_length(spark, folder):
    vocab, rows = prompt_ids(spark, folder)
    rows = stage(rows, "prompt-ids")
    padded = B.pad_max_length(rows, vocab.eos_id)
    ones = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return padded.select(*PAIR_KEY, joined("input_ids").alias("ids"), ones.alias("mask_sum"))


LENGTHS_SQL = f"lens AS MATERIALIZED (SELECT doc_id, len({pieces_sql('text')}) AS len FROM documents)"


def lengths(spark, folder):
    return documents(spark, folder).select("doc_id", F.size(pretokenize("text")).alias("len"))


GROUPED_SQL = f"""{LENGTHS_SQL}, {shuffled_sql('o', 'lens', 'doc_id')},
runs AS (SELECT *, greatest(1, least(n // (4 * {SMALL}), 50)) * {SMALL} AS run_rows FROM o),
placed AS (SELECT doc_id, len, (pos // run_rows) * run_rows + row_number() OVER (PARTITION BY pos // run_rows ORDER BY len DESC, pos) - 1 AS pos FROM runs)"""


@query("group_by_length", f"WITH {GROUPED_SQL} SELECT doc_id, len, pos, pos // {SMALL} AS batch_id FROM placed")
def group_by_length(spark, folder):
    rows = B.group_by_length(lengths(spark, folder), DOC_KEY, "len", SMALL, SEED)
    return rows.withColumn("len", F.col("len").cast("bigint"))


CHUNK = 2048


@query(
    "pack_sequences",
    f"""WITH {DOC_IDS}, ended AS (SELECT doc_id, list_append(ids, (SELECT r + 1 FROM base)) AS ids FROM ids),
    t AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM ended),
    g AS (SELECT id, row_number() OVER (ORDER BY doc_id, p) - 1 AS place FROM t)
    SELECT place // {CHUNK} AS chunk, count(*) AS n, md5(string_agg(id::VARCHAR, ' ' ORDER BY place)) AS hash
    FROM g GROUP BY place // {CHUNK} HAVING count(*) = {CHUNK}""",
)
def pack_sequences(spark, folder):
    vocab = vocabulary(spark, folder)
    rows = vocab.with_ids(documents(spark, folder), DOC_KEY)
    chunks = B.pack_sequences(rows, "doc_id", "input_ids", CHUNK, vocab.eos_id)
    return chunks.select("chunk", F.size("input_ids").cast("bigint").alias("n"), F.md5(joined("input_ids")).alias("hash"))


def epochs_sql(count: int, columns: str = "doc_id, epoch") -> str:
    return f"""repeated AS (SELECT doc_id, unnest(range({count})) AS epoch FROM documents),
    {shuffled_sql('o', 'repeated', 'doc_id', seed='42 + epoch', columns=columns, partition='epoch')}"""


WORLD, EPOCHS = 3, 2
SHARDS_SQL = f"""{epochs_sql(EPOCHS)},
padded AS (SELECT doc_id, epoch, unnest(range(pos, ((n + {WORLD} - 1) // {WORLD}) * {WORLD}, n)) AS pos FROM o)"""


def shards(spark, folder):
    return B.rank_shards(doc_keys(spark, folder), DOC_KEY, WORLD, EPOCHS, SEED).withColumn("epoch", F.col("epoch").cast("bigint"))


@query("rank_shards", f"WITH {SHARDS_SQL} SELECT doc_id, epoch, pos, pos % {WORLD} AS rank, pos // {WORLD} AS step_pos FROM padded")
def rank_shards(spark, folder):
    return shards(spark, folder).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "range_shards",
    f"""WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)
        SELECT doc_id, pos, pos // ((n + {WORLD} - 1) // {WORLD}) AS shard FROM o""",
)
def range_shards(spark, folder):
    return B.range_shards(doc_keys(spark, folder), "doc_id", WORLD).withColumn("shard", F.col("shard").cast("bigint"))


@query(
    "collate",
    f"""WITH {PAIRS_SQL}, {shuffled_sql('o', 'pairs', 'conv_id, turn')}
        SELECT pos // {SMALL} AS batch_id, count(*) AS batch_rows, string_agg(conv_id::VARCHAR, ' ' ORDER BY pos) AS conv_ids,
               md5(string_agg(question, '|' ORDER BY pos)) AS questions, md5(string_agg(answer, '|' ORDER BY pos)) AS answers
        FROM o GROUP BY pos // {SMALL}""",
)
def collate(spark, folder):
    batched = B.minibatch(pairs(spark, folder), PAIR_KEY, SMALL, SEED)
    lists = B.collate(batched, ["conv_id", "question", "answer"])
    return lists.select(
        "batch_id", F.col("batch_rows").cast("bigint"), joined("conv_id").alias("conv_ids"),
        F.md5(joined("question", "|")).alias("questions"), F.md5(joined("answer", "|")).alias("answers"),
    )


@query("epochs", f"WITH {epochs_sql(3)} SELECT doc_id, epoch, pos, n AS n_rows FROM o")
def epochs(spark, folder):
    rows = B.epochs(doc_keys(spark, folder), 3, DOC_KEY, SEED)
    return rows.withColumn("epoch", F.col("epoch").cast("bigint"))


ACCUMULATION, MAX_STEPS = 8, 200


@query(
    "step_plan",
    f"""WITH {LENGTHS_SQL}, {shuffled_sql('o', 'lens', 'doc_id')}, b AS (SELECT *, pos // 2 AS batch_id FROM o)
        SELECT batch_id // {ACCUMULATION} AS step, count(DISTINCT batch_id) AS batches, count(*) AS row_count, sum(len)::BIGINT AS tokens
        FROM b WHERE batch_id // {ACCUMULATION} < {MAX_STEPS} GROUP BY batch_id // {ACCUMULATION}""",
)
def step_plan(spark, folder):
    return B.step_plan(B.minibatch(lengths(spark, folder), DOC_KEY, 2, SEED), "len", ACCUMULATION, MAX_STEPS)


@query(
    "rank_summary",
    f"""WITH {SHARDS_SQL}, b AS (SELECT epoch, pos % {WORLD} AS rank, pos // {WORLD} // 32 AS batch, count(*) AS c FROM padded GROUP BY 1, 2, 3)
        SELECT epoch, rank, max(c) AS batch_size, count(*) AS steps FROM b GROUP BY epoch, rank""",
)
def rank_summary(spark, folder):
    return B.rank_summary(shards(spark, folder), 32).withColumn("rank", F.col("rank").cast("bigint"))


def training_steps(spark, folder, valid_rows: int = 10, max_steps: int | None = None) -> DataFrame:
    """The whole preparation of a training set: split, render, encode, mask, group by length, pad,
    and one row per optimizer step with its rows, tokens and share of padding. ``max_steps`` ends it early."""
    train = split_exact(pairs(spark, folder), PAIR_KEY, valid_rows, SEED).where(F.col("split") == "train").drop("split")
    vocab = vocabulary(spark, folder)
    prompt = prompt_by_context(F.col("question"), F.col("context"))
    rows = tokenize_pairs(train, vocab, prompt, F.concat(prompt, F.lit(" "), "answer"), PAIR_KEY, CUTOFF, mask_prompt=True)
    # The prepared set is written once; the batch passes then read only the columns they need.
    rows = stage(rows.select(*PAIR_KEY, "input_ids", "attention_mask", "labels", F.size("input_ids").alias("len")), "prepared")
    padded = B.pad_batch(B.group_by_length(rows, PAIR_KEY, "len", 2, SEED)).withColumn("width", F.size("input_ids"))
    steps = padded.withColumn("step", F.floor(F.col("batch_id") / ACCUMULATION))
    if max_steps is not None:
        steps = steps.where(F.col("step") < max_steps)
    return steps.groupBy("step").agg(
        F.count("*").alias("row_count"),
        F.sum("len").alias("tokens"),
        F.sum("width").alias("padded_tokens"),
        F.round(1.0 - F.sum("len") / F.sum("width"), 6).alias("padding_share"),
    )


TRAINING_SQL = f"""WITH {PAIRS_SQL}, {VOCAB_SQL}, {shuffled_sql('sp', 'pairs', 'conv_id, turn')},
lens AS (SELECT conv_id, turn, least(len({pieces_sql(BY_CONTEXT_SQL + " || ' ' || answer")}), {CUTOFF}) AS raw FROM sp WHERE pos >= 10),
ended AS (SELECT conv_id, turn, CASE WHEN raw < {CUTOFF} THEN raw + 1 ELSE raw END AS len FROM lens),
{shuffled_sql('o', 'ended', 'conv_id, turn')},
runs AS (SELECT *, greatest(1, least(n // 8, 50)) * 2 AS run_rows FROM o),
placed AS (SELECT len, (pos // run_rows) * run_rows + row_number() OVER (PARTITION BY pos // run_rows ORDER BY len DESC, pos) - 1 AS pos FROM runs),
wide AS (SELECT pos, len, (ceil(max(len) OVER (PARTITION BY pos // 2) / 8.0) * 8)::BIGINT AS width FROM placed)
SELECT pos // 2 // {ACCUMULATION} AS step, count(*) AS row_count, sum(len)::BIGINT AS tokens, sum(width)::BIGINT AS padded_tokens,
       round(1.0 - sum(len)::DOUBLE / sum(width), 6) + 0.0 AS padding_share
FROM wide GROUP BY 1"""

query("training_steps", TRAINING_SQL)(training_steps)
