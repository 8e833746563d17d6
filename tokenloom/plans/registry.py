"""Registry of queries and shared SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.constants import SIMPLE_PATTERN
from tokenloom.operators.tokens import Vocabulary
from tokenloom.session import spread
from tokenloom.sources.readers import read_table
from tokenloom.sources.views import question_answer_pairs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCAB_SIZE = 8000
SEED = 42
PAIR_KEY = ["conv_id", "turn"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the equivalent SQL where SQL can say it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# --- inputs -------------------------------------------------------------------------------
def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"), "doc_id")


def pairs(spark: SparkSession, folder: str, spread_out: bool = False) -> DataFrame:
    turns = read_table(spark, folder, "conversations")
    return question_answer_pairs(spread(turns, "conv_id", "turn") if spread_out else turns)


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "embeddings")
    return table.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")


def vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    return Vocabulary.build(documents(spark, folder), "text", VOCAB_SIZE)


def r6(column) -> F.Column:
    """Rounded to 6 places."""
    return F.round(column, 6)


def joined(column, separator: str = " ") -> F.Column:
    return F.array_join(column, separator)


# --- shared SQL ---------------------------------------------------------------------------
def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


def pieces_sql(text: str) -> str:
    return f"regexp_extract_all({text}, {sql_text(SIMPLE_PATTERN)})"


PAIRS_SQL = """turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer
  FROM conversations),
pairs AS (
  SELECT t.conv_id, t.turn, t.text AS question, s.text AS context, t.answer
  FROM turns t LEFT JOIN (SELECT conv_id, text FROM conversations WHERE role = 'system' AND turn = 0) s
    ON s.conv_id = t.conv_id
  WHERE t.role = 'user' AND t.next_role = 'assistant')"""

VOCAB_SQL = f"""vocab AS MATERIALIZED (
  SELECT piece, row_number() OVER (ORDER BY n DESC, piece) - 1 AS id
  FROM (SELECT piece, count(*) AS n FROM (SELECT unnest({pieces_sql('text')}) AS piece FROM documents)
        GROUP BY piece ORDER BY n DESC, piece LIMIT {VOCAB_SIZE})),
base AS MATERIALIZED (SELECT count(*) AS r FROM vocab)"""


def ids_sql(name: str, source: str, keys: str, text: str) -> str:
    """CTE ``name`` (keys, ids): ids of ``text`` for every row of ``source``."""
    key_list = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"s.{k} = i.{k}" for k in key_list)
    return f"""{name}_tok AS (
  SELECT {keys}, unnest({pieces_sql(text)}) AS piece, generate_subscripts({pieces_sql(text)}, 1) AS pos FROM {source}),
{name}_lists AS (
  SELECT {keys}, list(coalesce(v.id, (SELECT r + 2 FROM base)) ORDER BY pos) AS ids
  FROM {name}_tok t LEFT JOIN vocab v ON v.piece = t.piece GROUP BY {keys}),
{name} AS MATERIALIZED (
  SELECT {', '.join('s.' + k for k in key_list)}, coalesce(i.ids, []::BIGINT[]) AS ids
  FROM {source} s LEFT JOIN {name}_lists i ON {on})"""


def shuffled_sql(name: str, source: str, key: str, seed: str = str(SEED), columns: str = "*", partition: str = "") -> str:
    """CTE ``name``: rows of ``source`` with ``pos`` in the seeded order and the row count ``n``."""
    first = key.split(",")[0].strip()
    text = f"concat_ws(':', {seed}, {key})"
    part = f"PARTITION BY {partition} " if partition else ""
    count = f"count({first}) OVER ({part.strip()})"
    return f"""{name} AS MATERIALIZED (
  SELECT {columns}, row_number() OVER ({part}ORDER BY md5({text}), {key}) - 1 AS pos, {count} AS n FROM {source})"""


CELLS_SQL = """cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings),
centers AS MATERIALIZED (SELECT label, k, avg(x) AS c FROM cells GROUP BY label, k),
logits AS MATERIALIZED (
  SELECT e.vec_id, e.label, c.label AS j, sum(e.x * c.c) AS s
  FROM cells e JOIN centers c ON c.k = e.k GROUP BY e.vec_id, e.label, c.label)"""
