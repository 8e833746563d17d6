"""Counts, losses, accuracy, latency and model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions import vectors as V
from tokenloom.operators import matrices as MX
from tokenloom.operators import metrics as M
from tokenloom.operators.batching import sequential_batches
from tokenloom.operators.splits import split_exact
from tokenloom.plans.ingest import SPLIT_SQL, VALID_ROWS
from tokenloom.plans.registry import CELLS_SQL, PAIR_KEY, PAIRS_SQL, SEED, embeddings, pairs, query, r6, sql_r6
from tokenloom.sources.readers import read_table

BATCH = 64
#: Values of an embedding.
SIZE = 64


def scored_embeddings(spark, folder):
    """Rows with logits: the vector times the mean vector of every label."""
    rows = embeddings(spark, folder)
    labels, weights = MX.labelled_matrix(MX.mean_vectors(rows, "vec", "label"), "label", "vec")
    rows = rows.withColumn("logits", MX.matmul(F.col("vec"), weights.T))
    # A class is the place of its label in the matrix; the two differ as soon as a number is missing.
    return rows.withColumns({"class": MX.class_of(F.col("label"), labels), "pred": MX.label_of(V.argmax(F.col("logits")), labels)})


SCORED_SQL = f"""{CELLS_SQL},
lse AS (SELECT vec_id, ln(sum(exp(s))) AS lse FROM logits GROUP BY vec_id),
best AS (SELECT vec_id, j AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, j) AS rn FROM logits) WHERE rn = 1),
scored AS MATERIALIZED (
  SELECT l.vec_id, l.label, b.pred, e.lse - l.s AS loss FROM logits l JOIN lse e USING (vec_id) JOIN best b USING (vec_id) WHERE l.j = l.label)"""


@query("row_counts", f"WITH {SPLIT_SQL} SELECT split, count(*) AS row_count FROM split GROUP BY split")
def row_counts(spark, folder):
    return M.row_counts(split_exact(pairs(spark, folder).select(*PAIR_KEY), PAIR_KEY, VALID_ROWS, SEED))


@query(
    "eval_loss_accuracy",
    f"""WITH {SCORED_SQL}, b AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // {BATCH} AS batch FROM scored),
    per AS (SELECT batch, count(*) AS n, sum(loss) AS loss, count(*) FILTER (WHERE label = pred) AS good FROM b GROUP BY batch)
    SELECT sum(n)::BIGINT AS row_count, count(*) AS batches, {sql_r6('100.0 * sum(good) / sum(n)')} AS accuracy,
           {sql_r6('avg(loss / n)')} AS avg_loss_batches, {sql_r6('sum(loss) / sum(n)')} AS avg_loss_rows FROM per""",
)
def eval_loss_accuracy(spark, folder):
    scored = scored_embeddings(spark, folder).select(
        "vec_id", "label", "pred", V.cross_entropy(F.col("logits"), F.col("class")).alias("loss")
    )
    result = M.eval_loss_accuracy(sequential_batches(scored, "vec_id", BATCH))
    return result.select("row_count", "batches", *[r6(c).alias(c) for c in ("accuracy", "avg_loss_batches", "avg_loss_rows")])


@query(
    "running_loss",
    f"""WITH b AS (SELECT value, (row_number() OVER (ORDER BY event_id) - 1) // {BATCH} AS batch_id FROM events)
    SELECT batch_id + 1 AS batch, {sql_r6('avg(value)')} AS loss, batch_id * {BATCH} + count(*) AS rows_seen
    FROM b WHERE (batch_id + 1) % 10 = 0 GROUP BY batch_id""",
)
def running_loss(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "value")
    return M.running_loss(sequential_batches(events, "event_id", BATCH), "value", 10, BATCH).withColumn("loss", r6("loss"))


REDUCE_SQL = """SELECT {how} AS how, 'all' AS axis, -1 AS at, {all} AS value FROM cells
UNION ALL SELECT {how}, 'columns', k, {all} FROM cells GROUP BY k
UNION ALL SELECT {how}, 'rows', vec_id, {all} FROM cells GROUP BY vec_id"""


def reduced(spark, folder, hows):
    rows = MX.reduce_all(embeddings(spark, folder), "vec_id", "vec", hows, SIZE)
    return rows.select("how", "axis", "at", r6("value").alias("value"))


@query("tensor_mean", f"WITH {CELLS_SQL} " + REDUCE_SQL.format(how="'mean'", all=sql_r6("avg(x)")))
def tensor_mean(spark, folder):
    return reduced(spark, folder, ["mean"])


@query("tensor_reduce", f"WITH {CELLS_SQL} " + " UNION ALL ".join(REDUCE_SQL.format(how=f"'{h}'", all=sql_r6(f"{h}(x)")) for h in ("sum", "min", "max")))
def tensor_reduce(spark, folder):
    return reduced(spark, folder, ["sum", "min", "max"])


@query(
    "latency_stats",
    f"""SELECT event_type, count(*) AS calls, {sql_r6('avg(value)')} AS mean_ms, {sql_r6('quantile_cont(value, 0.5)')} AS p50,
        {sql_r6('quantile_cont(value, 0.95)')} AS p95 FROM events GROUP BY event_type""",
)
def latency_stats(spark, folder):
    stats = M.latency_stats(read_table(spark, folder, "events"), "event_type", "value")
    return stats.select("event_type", "calls", *[r6(c).alias(c) for c in ("mean_ms", "p50", "p95")])


@query(
    "compare_models",
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn, answer AS gold, CASE WHEN conv_id % 2 = 0 THEN lower(answer) ELSE question END AS base,
        concat('  ', answer, chr(10)) AS tuned, CASE WHEN conv_id % 2 = 0 OR lower(question) = lower(answer) THEN 1 ELSE 0 END AS base_match,
        1 AS tuned_match FROM pairs""",
)
def compare_models(spark, folder):
    rows = pairs(spark, folder)
    base = rows.select(*PAIR_KEY, F.col("answer").alias("gold"), F.when(F.col("conv_id") % 2 == 0, F.lower("answer")).otherwise(F.col("question")).alias("output"))
    tuned = rows.select(*PAIR_KEY, F.concat(F.lit("  "), "answer", F.lit("\n")).alias("output"))
    return M.compare_models(base, tuned, PAIR_KEY)


@query(
    "loss_columns",
    f"""WITH {SCORED_SQL}, sq AS (SELECT e.vec_id, avg((e.x - c.c) * (e.x - c.c)) AS mse FROM cells e JOIN centers c ON c.k = e.k AND c.label = e.label GROUP BY e.vec_id)
    SELECT s.vec_id, s.label, {sql_r6('s.loss')} AS cross_entropy, {sql_r6('s.loss')} AS nll, {sql_r6('sq.mse')} AS squared_error
    FROM scored s JOIN sq USING (vec_id)""",
)
def loss_columns(spark, folder):
    rows = MX.with_mean_vector(scored_embeddings(spark, folder), "vec_id", "vec", "label", "center")
    both = rows.withColumn("prob", V.softmax(F.col("logits")))
    return both.select(
        "vec_id", "label",
        r6(V.cross_entropy(F.col("logits"), F.col("class"))).alias("cross_entropy"),
        r6(V.negative_log_likelihood(F.col("prob"), F.col("class"))).alias("nll"),
        r6(V.squared_error(F.col("vec"), F.col("center"))).alias("squared_error"),
    )
