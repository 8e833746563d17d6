"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators.splits import percent_slice, split_exact
from tokenloom.operators.training import sgd_linear
from tokenloom.plans.fitting import FEATURES, RATE, TARGET, fit_rows, fit_sql
from tokenloom.plans.registry import PAIR_KEY, PAIRS_SQL, SEED, embeddings, pairs, query, r6, shuffled_sql, sql_r6
from tokenloom.session import new_path
from tokenloom.sources import readers, writers
from tokenloom.functions.vectors import total

VALID_ROWS = 20
PAIR_SCHEMA = "conv_id bigint, turn bigint, question string, context string, answer string"


@query("scan_json", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def scan_json(spark, folder):
    path = new_path(spark, "pairs-json")
    pairs(spark, folder).write.json(path)
    return readers.read_json(spark, path, PAIR_SCHEMA)


SPLIT_SQL = f"""{PAIRS_SQL}, {shuffled_sql('ordered', 'pairs', 'conv_id, turn')},
split AS (SELECT * EXCLUDE (pos, n), CASE WHEN pos < {VALID_ROWS} THEN 'valid' ELSE 'train' END AS split FROM ordered)"""


@query("load_split", f"WITH {SPLIT_SQL} SELECT conv_id, turn, question, answer FROM split WHERE split = 'train'")
def load_split(spark, folder):
    path = new_path(spark, "pairs-split")
    split_exact(pairs(spark, folder), PAIR_KEY, VALID_ROWS, SEED).write.partitionBy("split").parquet(path)
    return readers.load_split(spark, path, "train").select("conv_id", "turn", "question", "answer")


@query(
    "percent_slice",
    """SELECT doc_id, source, n_chars FROM (
         SELECT *, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents)
       WHERE i <= floor(n * 5 / 100.0 + 0.5)""",
)
def slice_documents(spark, folder):
    narrow = readers.read_table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return percent_slice(narrow, "doc_id", 5)


@query("scan_csv_manifest", "SELECT concat('doc_', doc_id, '.txt') AS name, quality AS label FROM labels")
def scan_csv_manifest(spark, folder):
    path = new_path(spark, "labels-csv")
    labels = readers.read_table(spark, folder, "labels")
    stored = labels.select(F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("file"), F.col("quality").alias("class"))
    stored.write.option("header", True).csv(path)
    return readers.read_csv_manifest(spark, path, "name string, label int")


@query(
    "join_blobs",
    "SELECT d.doc_id, md5(d.text) AS sample, l.quality * 10 AS label FROM documents d JOIN labels l ON l.doc_id = d.doc_id",
)
def join_blobs(spark, folder):
    return readers.join_blobs(
        readers.read_table(spark, folder, "documents"), readers.read_table(spark, folder, "labels"), "doc_id", "text", "quality",
        transform=F.md5, target_transform=lambda label: label * 10,
    )


@query(
    "range_source",
    """SELECT r.id, count(l.l_orderkey) AS items
       FROM (SELECT unnest(range(lo, hi + 1)) AS id FROM (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)) r
       LEFT JOIN lineitem l ON l.l_orderkey = r.id GROUP BY r.id""",
)
def range_source(spark, folder):
    orders = readers.read_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    low, high = orders.agg(F.min("id"), F.max("id")).first()
    items = orders.groupBy("id").agg(F.count("*").alias("items"))
    ids = readers.range_source(spark, low, high + 1).join(items, "id", "left")
    return ids.select("id", F.coalesce("items", F.lit(0)).cast("bigint").alias("items"))


@query("materialize_once", f"WITH {SPLIT_SQL} SELECT conv_id, turn, length(question) AS question_chars, split FROM split")
def materialize_once(spark, folder):
    base, params = new_path(spark, "prepared"), {"valid_rows": VALID_ROWS, "seed": SEED}
    source = pairs(spark, folder)

    def build(df):
        return split_exact(df, PAIR_KEY, VALID_ROWS, SEED)

    writers.materialize_once(spark, source, build, base, params)
    again = writers.materialize_once(spark, source, build, base, params)
    return again.select("conv_id", "turn", F.char_length("question").cast("bigint").alias("question_chars"), F.col("split").cast("string"))


KEEP, EPOCHS = 3, 6


@query(
    "snapshot_sink",
    f"WITH {fit_sql(EPOCHS, 1)} "
    + " UNION ALL ".join(
        f"SELECT {s} AS step, {s + 1} AS epochs_run, "
        + ", ".join(f"{sql_r6(f'w{i}')} AS w{i}" for i in range(len(FEATURES) + 1))
        + f" FROM s{s + 1}"
        for s in range(EPOCHS - KEEP, EPOCHS)
    ),
)
def snapshot_sink(spark, folder):
    store = writers.SnapshotStore(spark, new_path(spark, "snapshots"), KEEP)
    rows, keys = fit_rows(spark, folder)
    sgd_linear(rows, FEATURES, TARGET, keys, RATE, EPOCHS, 1, SEED, store)
    weights = [r6(F.get("weights", F.lit(i))).alias(f"w{i}") for i in range(len(FEATURES) + 1)]
    return store.table().select("step", "epochs_run", *weights)


@query(
    "prediction_sink",
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn, question AS prompt, answer AS gold,
        lower(answer) AS base, concat(' ', answer, ' ') AS tuned FROM pairs""",
)
def prediction_sink(spark, folder):
    predictions = pairs(spark, folder).select(
        *PAIR_KEY, F.col("question").alias("prompt"), F.col("answer").alias("gold"),
        F.lower("answer").alias("base"), F.concat(F.lit(" "), "answer", F.lit(" ")).alias("tuned"),
    )
    return writers.write_predictions(predictions, new_path(spark, "predictions"))


@query(
    "tensor_scan",
    f"""WITH t AS (SELECT concat('layers.', label, '.weight') AS name, vec_id AS i, list_sum(embedding::DOUBLE[]) AS s FROM embeddings)
        SELECT name, i, {sql_r6('s')} AS total FROM t""",
)
def tensor_scan(spark, folder):
    stored = embeddings(spark, folder).select(
        F.concat(F.lit("layers."), "label", F.lit(".weight")).alias("name"), F.col("vec_id").alias("i"), "vec"
    )
    path = writers.write_tensors(stored, new_path(spark, "tensors"))
    return readers.tensor_scan(spark, path).select(F.col("name").cast("string"), "i", r6(total(F.col("vec"))).alias("total"))
