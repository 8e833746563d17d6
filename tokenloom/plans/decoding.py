"""Next-token candidates and generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import candidates as N
from tokenloom.plans.registry import PAIR_KEY, PAIRS_SQL, pieces_sql, SEED, documents, joined, pairs, query, r6, sql_r6
from tokenloom.functions.constants import NAMED_SPECIALS
from tokenloom.sources.readers import read_table

END = NAMED_SPECIALS[1]
K, P = 50, 0.85


def pairs_of_pieces(source: str, end: bool = False) -> str:
    pieces = pieces_sql("text")
    listed = f"CASE WHEN len({pieces}) > 0 THEN list_append({pieces}, '{END}') ELSE {pieces} END" if end else pieces
    return f"""(SELECT l[i] AS ctx, l[i + 1] AS token FROM (
      SELECT l, unnest(range(1, len(l))) AS i FROM (SELECT {listed} AS l FROM {source})))"""


CAND_SQL = f"""cand AS MATERIALIZED (
  SELECT ctx, token, count(*) AS weight, ln(count(*)) AS score FROM {pairs_of_pieces('documents')} GROUP BY ctx, token)"""
TOP_SQL = f"""{CAND_SQL}, top AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ctx ORDER BY score DESC, token) AS place FROM cand) WHERE place <= {K})"""


def scores(spark, folder, **options):
    return N.next_token_scores(documents(spark, folder), "text", **options)


@query("next_token_scores", f"WITH {CAND_SQL} SELECT ctx, token, weight, {sql_r6('score')} AS score FROM cand")
def next_token_scores(spark, folder):
    return scores(spark, folder).withColumn("score", r6("score"))


@query(
    "temperature",
    f"""WITH {CAND_SQL} SELECT ctx, token, {sql_r6('exp(score / 0.4) / sum(exp(score / 0.4)) OVER (PARTITION BY ctx)')} AS prob FROM cand""",
)
def temperature(spark, folder):
    return N.temperature(scores(spark, folder), 0.4).select("ctx", "token", r6("prob").alias("prob"))


@query("top_k", f"WITH {TOP_SQL} SELECT ctx, token, weight, place FROM top")
def top_k(spark, folder):
    kept = N.top_k(scores(spark, folder), K)
    return kept.select("ctx", "token", "weight", F.col("place").cast("bigint").alias("place"))


@query(
    "top_p",
    f"""WITH {TOP_SQL}, run AS (SELECT *, coalesce(sum(weight) OVER (PARTITION BY ctx ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(weight) OVER (PARTITION BY ctx) AS whole FROM top)
        SELECT ctx, token, weight FROM run WHERE before::DOUBLE < {P}::DOUBLE * whole::DOUBLE""",
)
def top_p(spark, folder):
    return N.top_p(N.top_k(scores(spark, folder), K), P).select("ctx", "token", "weight")


@query(
    "repetition_penalty",
    f"""WITH {CAND_SQL}, hist AS (SELECT DISTINCT ctx, token FROM {pairs_of_pieces('conversations')})
        SELECT c.ctx, c.token, {sql_r6('CASE WHEN h.ctx IS NULL THEN score WHEN score > 0 THEN score / 1.2 ELSE score * 1.2 END')} AS score
        FROM cand c LEFT JOIN hist h ON h.ctx = c.ctx AND h.token = c.token""",
)
def repetition_penalty(spark, folder):
    history = N.next_token_scores(read_table(spark, folder, "conversations"))
    return N.repetition_penalty(scores(spark, folder), history, 1.2).select("ctx", "token", r6("score").alias("score"))


@query("greedy", f"WITH {TOP_SQL} SELECT ctx, token, {sql_r6('score')} AS score FROM top WHERE place = 1")
def greedy(spark, folder):
    return N.greedy(scores(spark, folder)).withColumn("score", r6("score"))


DRAWS = 3


@query(
    "sample_candidates",
    f"""WITH {TOP_SQL}, run AS (SELECT *, sum(weight) OVER (PARTITION BY ctx ORDER BY place) AS upto, sum(weight) OVER (PARTITION BY ctx) AS whole FROM top),
    d AS (SELECT *, unnest(range({DRAWS})) AS draw FROM run),
    u AS (SELECT *, ('0x' || substr(md5(concat_ws(':', {SEED}, ctx, draw)), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 * whole::DOUBLE AS target FROM d)
    SELECT ctx, draw, token FROM u WHERE upto::DOUBLE > target AND (upto - weight)::DOUBLE <= target""",
)
def sample_candidates(spark, folder):
    kept = N.top_k(scores(spark, folder), K)
    return N.sample_candidates(kept, DRAWS, SEED).withColumn("draw", F.col("draw").cast("bigint"))


STEPS, PENALTY = 6, 1.3


def generate_sql(pick: str, source: str = "pairs", text: str = "question") -> str:
    """Unrolled steps; ``pick`` gives (conv_id, turn, token) from the options of a step."""
    parts = [
        PAIRS_SQL,
        f"""cand AS MATERIALIZED (SELECT ctx, token, ln(count(*)) AS score FROM {pairs_of_pieces('documents', True)} GROUP BY ctx, token)""",
        f"""s0 AS MATERIALIZED (SELECT conv_id, turn, {pieces_sql(text)} AS seen, {pieces_sql(text)}[-1] AS ctx,
            []::VARCHAR[] AS tokens FROM {source})""",
    ]
    for step in range(STEPS):
        parts.append(
            f"""o{step} AS MATERIALIZED (
            SELECT g.conv_id, g.turn, c.token, CASE WHEN NOT (list_contains(g.seen, c.token) OR list_contains(g.tokens, c.token)) THEN c.score
                   WHEN c.score > 0 THEN c.score / {PENALTY} ELSE c.score * {PENALTY} END AS score
            FROM s{step} g JOIN cand c ON c.ctx = g.ctx),
            b{step} AS MATERIALIZED ({pick.format(step=step)}),
            s{step + 1} AS MATERIALIZED (
            SELECT g.conv_id, g.turn, g.seen, CASE WHEN b.token <> '{END}' THEN b.token END AS ctx,
                   CASE WHEN b.token <> '{END}' THEN list_append(g.tokens, b.token) ELSE g.tokens END AS tokens
            FROM s{step} g LEFT JOIN b{step} b ON b.conv_id = g.conv_id AND b.turn = g.turn)"""
        )
    return "WITH " + ",\n".join(parts) + f" SELECT conv_id, turn, array_to_string(tokens, ' ') AS completion FROM s{STEPS}"


GREEDY_PICK = """SELECT conv_id, turn, token FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, token) AS rn FROM o{step}) WHERE rn = 1"""


def generated(spark, folder, **options):
    prompts = pairs(spark, folder, spread_out=True).select(*PAIR_KEY, "question")
    table = scores(spark, folder, end_token=END)
    done = N.generate(prompts, table, PAIR_KEY, "question", END, STEPS, penalty=PENALTY, k=40, **options)
    return done.select(*PAIR_KEY, joined("tokens").alias("completion"))


@query("generate", generate_sql(GREEDY_PICK))
def generate(spark, folder):
    return generated(spark, folder)


HEAT, NUCLEUS = 0.3, 0.85
SAMPLE_PICK = f"""SELECT conv_id, turn, token FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, token) AS pick FROM (
    SELECT *, max(upto) OVER (PARTITION BY conv_id, turn) AS kept FROM (
      SELECT *, sum(w) OVER (PARTITION BY conv_id, turn ORDER BY rn) AS upto, sum(w) OVER (PARTITION BY conv_id, turn) AS whole FROM (
        SELECT *, exp((score - max(score) OVER (PARTITION BY conv_id, turn)) / {HEAT}) AS w FROM (
          SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, token) AS rn FROM o{{step}}) WHERE rn <= 40))
    WHERE upto - w < {NUCLEUS} * whole)
  WHERE upto > ('0x' || substr(md5(concat_ws(':', {SEED}, conv_id, turn, {{step}})), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 * kept) WHERE pick = 1"""


@query("generate_sampled", generate_sql(SAMPLE_PICK))
def generate_sampled(spark, folder):
    return generated(spark, folder, do_sample=True, heat=HEAT, p=NUCLEUS, seed=SEED)
