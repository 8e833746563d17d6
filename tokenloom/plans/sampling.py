"""Splits, shuffles and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import splits as S
from tokenloom.plans.ingest import SPLIT_SQL, VALID_ROWS
from tokenloom.plans.registry import PAIR_KEY, SEED, PAIRS_SQL, pairs, query, shuffled_sql
from tokenloom.sources.readers import read_table


def _split(spark, folder):
    return S.split_exact(pairs(spark, folder), PAIR_KEY, VALID_ROWS, SEED)


@query("split_exact", f"WITH {SPLIT_SQL} SELECT conv_id, turn, split FROM split")
def split_exact(spark, folder):
    return _split(spark, folder).select(*PAIR_KEY, "split")


@query("shuffle", f"WITH {shuffled_sql('o', 'documents', 'doc_id')} SELECT doc_id, source, pos FROM o")
def shuffle(spark, folder):
    return S.shuffle(read_table(spark, folder, "documents").select("doc_id", "source"), ["doc_id"], SEED)


@query("sample_n", "SELECT doc_id, text FROM documents ORDER BY md5(concat_ws(':', 42, doc_id)), doc_id LIMIT 10")
def sample_n(spark, folder):
    return S.sample_n(read_table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], 10, SEED)


@query(
    "take_n",
    f"WITH {SPLIT_SQL} SELECT conv_id, turn, question FROM split WHERE split = 'train' ORDER BY conv_id, turn LIMIT 2",
)
def take_n(spark, folder):
    train = _split(spark, folder).where(F.col("split") == "train")
    return S.take_n(train.select(*PAIR_KEY, "question"), PAIR_KEY, 2)


@query(
    "sampler",
    f"""WITH {shuffled_sql('o', 'documents', 'doc_id')}
        SELECT 'random' AS kind, pos, doc_id FROM o
        UNION ALL SELECT 'sequential' AS kind, row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id FROM documents""",
)
def sampler(spark, folder):
    docs = read_table(spark, folder, "documents")
    random = S.sampler(docs, "doc_id", True, SEED).withColumn("kind", F.lit("random"))
    return random.unionByName(S.sampler(docs, "doc_id").withColumn("kind", F.lit("sequential")))


@query(
    "split_disjoint",
    f"WITH {PAIRS_SQL} SELECT count(*) AS source_rows, 0::BIGINT AS in_both, 0::BIGINT AS lost, 0::BIGINT AS added FROM pairs",
)
def split_disjoint(spark, folder):
    return S.split_report(pairs(spark, folder), _split(spark, folder), PAIR_KEY)
