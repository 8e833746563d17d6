"""Streaming queries; each gives the rows of its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators.candidates import generate, prepare_options
from tokenloom.plans.decoding import END, GREEDY_PICK, PENALTY, STEPS, generate_sql, scores
from tokenloom.plans.prompting import SUPPORT_SQL
from tokenloom.operators import sketches
from tokenloom.plans.registry import PAIR_KEY, joined, query, r6, sql_r6, vocabulary
from tokenloom.plans.tokenizing import DOC_IDS
from tokenloom.session import new_path, spread, stage
from tokenloom.sources.datasets import read_range
from tokenloom.sources.readers import read_table
from tokenloom.streaming import streams


OPTIONS = 512


def stream_of(spark, folder, name):
    return streams.stream_table(spark, folder, name, read_table(spark, folder, name).schema)


@query("stream_samples", "SELECT conv_id, turn, role, text FROM conversations")
def stream_samples(spark, folder):
    return streams.run_to_table(stream_of(spark, folder, "conversations"), new_path(spark, "stream-samples"))


@query("stream_prompts", f"SELECT conv_id, turn, {SUPPORT_SQL} AS prompt FROM conversations WHERE role = 'user'")
def stream_prompts(spark, folder):
    prompts = streams.stream_prompts(stream_of(spark, folder, "conversations"))
    return streams.run_to_table(prompts, new_path(spark, "stream-prompts"))


@query("stream_answers", generate_sql(GREEDY_PICK, "(SELECT conv_id, turn, text FROM conversations WHERE role = 'user')", "text"))
def stream_answers(spark, folder):
    """Question in, answer out: scores and options are built once, each arriving batch is continued.

    A batch with a longer history than the options allow builds its own, so the answers are exact.
    """
    asked = stream_of(spark, folder, "conversations").where("role = 'user'").select(*PAIR_KEY, "text")
    table = stage(scores(spark, folder, end_token=END), "scores")
    options = prepare_options(table, OPTIONS)

    def answer(batch):
        done = generate(spread(batch, *PAIR_KEY), table, PAIR_KEY, "text", END, STEPS, penalty=PENALTY, k=40, prepared=options)
        return done.select(*PAIR_KEY, joined("tokens").alias("completion"))

    return streams.run_with(asked, new_path(spark, "stream-answers"), answer, "conv_id bigint, turn bigint, completion string")


@query("stream_tokenize", f"WITH {DOC_IDS} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM ids")
def stream_tokenize(spark, folder):
    rows = streams.stream_tokenize(stream_of(spark, folder, "documents"), vocabulary(spark, folder), new_path(spark, "stream-ids"))
    return rows.select("doc_id", joined("input_ids").alias("ids"))


SHARES = (0.5, 0.95, 0.99)
_BASE = (1 + sketches.ACCURACY) / (1 - sketches.ACCURACY)


@query(
    "latency_sketch",
    f"""WITH s AS (
      SELECT event_type, sign(value)::INT AS sgn, count(*) AS n,
             CASE WHEN value = 0 THEN 0 ELSE ceil(round(ln(CASE WHEN value = 0 THEN 1 ELSE abs(value) END) / ln({_BASE!r}), 9)) END::BIGINT AS bucket
      FROM events WHERE value IS NOT NULL GROUP BY ALL),
    run AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY sgn, sgn * bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY event_type) AS whole FROM s),
    asked AS (SELECT *, floor(share * (whole - 1)) AS place FROM run, (SELECT unnest({list(SHARES)}::DOUBLE[]) AS share))
    SELECT event_type, share, whole::BIGINT AS n, {sql_r6(f'sgn * 2.0 * pow({_BASE!r}, bucket) / {_BASE + 1!r}')} AS value
    FROM asked WHERE upto > place AND upto - n <= place""",
)
def latency_sketch(spark, folder):
    """Quantiles of a stream's values from sketches, one of every batch, added up."""
    events = stream_of(spark, folder, "events").select("event_type", "value")
    parts = streams.run_with(
        events, new_path(spark, "stream-sketch"), lambda batch: sketches.sketch(batch, "event_type", "value"),
        "event_type string, sign int, bucket bigint, n bigint",
    )
    found = sketches.quantiles(sketches.merge(parts, "event_type"), "event_type", SHARES)
    return found.select("event_type", "share", "n", r6("value").alias("value"))


def document_range(spark, folder):
    """First id and the one after the last."""
    low, high = read_table(spark, folder, "documents").agg(F.min("doc_id"), F.max("doc_id")).first()
    return low, high + 1


@query("dataset_scan", "SELECT doc_id, n_chars, lang FROM documents")
def dataset_scan(spark, folder):
    """Samples of a custom dataset: the ids come lazily from the source's ranges, each finds its document."""
    low, end = document_range(spark, folder)
    ids = read_range(spark, low, end, max(1, (end - low) // 16)).withColumnRenamed("id", "doc_id")
    return ids.join(read_table(spark, folder, "documents"), "doc_id").select("doc_id", "n_chars", "lang")


@query("dataset_stream", "SELECT doc_id, n_chars FROM documents")
def dataset_stream(spark, folder):
    """The dataset as a stream that is stopped half way and goes on after it has grown; every item comes once."""
    low, end = document_range(spark, folder)
    path = new_path(spark, "stream-dataset")
    for stop in ((low + end + 1) // 2, end):
        ids = read_range(spark, low, stop, max(1, (end - low) // 16), stream=True).withColumnRenamed("id", "doc_id")
        samples = streams.run_to_table(ids.join(read_table(spark, folder, "documents"), "doc_id").select("doc_id", "n_chars"), path)
    return samples
