"""Vector and matrix operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tokenloom.functions import vectors as V
from tokenloom.functions.constants import NF4_CODES, NORM_EPS, ROPE_THETA
from tokenloom.operators import attention as A
from tokenloom.operators import blocks as BL
from tokenloom.operators import matrices as MX
from tokenloom.operators import quantization as Q
from tokenloom.operators.positions import key_positions
from tokenloom.plans.evaluation import scored_embeddings
from tokenloom.plans.registry import CELLS_SQL, embeddings, query, r6, sql_r6
from tokenloom.session import stage

SIZE = 64
CONTEXT = A.CONTEXT


def long_rows(df, keys, **columns):
    """One row per vector position with every named vector's value, rounded (no vector is empty)."""
    packed = F.arrays_zip(*[c.alias(n) for n, c in columns.items()])
    spread = df.select(*keys, F.posexplode_outer(packed).alias("k", "_v"))
    return spread.select(*keys, F.col("k").cast("bigint").alias("k"), *[r6(F.col("_v")[n]).alias(n) for n in columns])


def with_center(spark, folder):
    return MX.with_mean_vector(embeddings(spark, folder), "vec_id", "vec", "label", "center")


@query(
    "vec_arith",
    f"""WITH {CELLS_SQL} SELECT e.vec_id, e.k, {sql_r6('x + c')} AS added, {sql_r6('x - c')} AS taken, {sql_r6('x * c')} AS times,
        {sql_r6('x / c')} AS over, {sql_r6('(x + c) * (c - 2)')} AS mixed FROM cells e JOIN centers c ON c.label = e.label AND c.k = e.k""",
)
def vec_arith(spark, folder):
    x, y = F.col("vec"), F.col("center")
    return long_rows(
        with_center(spark, folder), ["vec_id"], added=V.add(x, y), taken=V.subtract(x, y), times=V.multiply(x, y), over=V.divide(x, y),
        mixed=V.elementwise(x, y, lambda a, b: (a + b) * (b - 2)),
    )


@query(
    "vec_math",
    f"""WITH {CELLS_SQL} SELECT vec_id, k, {sql_r6('sin(x)')} AS sine, {sql_r6('exp(x)')} AS power_e, {sql_r6('x * x')} AS squared,
        {sql_r6('1 / sqrt(x * x + 1)')} AS inv_root FROM cells""",
)
def vec_math(spark, folder):
    x = F.col("vec")
    return long_rows(
        embeddings(spark, folder), ["vec_id"], sine=F.transform(x, F.sin), power_e=F.transform(x, F.exp),
        squared=F.transform(x, lambda v: F.pow(v, F.lit(2.0))), inv_root=F.transform(x, lambda v: V.rsqrt(v * v + 1)),
    )


@query("dot", f"WITH {CELLS_SQL} SELECT e.vec_id, {sql_r6('sum(x * c)')} AS dot FROM cells e JOIN centers c ON c.label = e.label AND c.k = e.k GROUP BY e.vec_id")
def dot(spark, folder):
    return with_center(spark, folder).select("vec_id", r6(V.dot(F.col("vec"), F.col("center"))).alias("dot"))


@query(
    "matmul",
    f"""WITH {CELLS_SQL}, places AS (SELECT label AS j, row_number() OVER (ORDER BY label) - 1 AS k FROM (SELECT DISTINCT label FROM centers))
    SELECT vec_id, k, {sql_r6('s')} AS value FROM logits JOIN places USING (j)""",
)
def matmul(spark, folder):
    return long_rows(scored_embeddings(spark, folder), ["vec_id"], value=F.col("logits"))


@query(
    "broadcast_op",
    f"""WITH {CELLS_SQL}, a AS (SELECT vec_id, avg(x) AS m FROM cells GROUP BY vec_id), b AS (SELECT k, avg(x) AS c FROM cells GROUP BY k)
        SELECT vec_id, k, {sql_r6('m + c')} AS added, {sql_r6('m * c')} AS outer_product FROM a CROSS JOIN b""",
)
def broadcast_op(spark, folder):
    rows = embeddings(spark, folder)
    # One number per vector position, as many as the vectors are wide.
    means = sorted(MX.column_means(rows, "vec").collect(), key=lambda r: r.k)
    row = V.literal_vector([m.value for m in means])
    column = rows.select("vec_id", V.mean(F.col("vec")).alias("m"))
    return long_rows(
        column, ["vec_id"], added=V.broadcast_row(F.col("m"), row, lambda a, b: a + b),
        outer_product=V.broadcast_row(F.col("m"), row, lambda a, b: a * b),
    )


GRID_SQL = f"""{CELLS_SQL}, grid AS (SELECT dense_rank() OVER (ORDER BY vec_id) - 1 AS i, k AS j, x AS v FROM cells)"""


def numbered_rows(spark, folder):
    """The vectors with a dense row number, written once."""
    return stage(key_positions(embeddings(spark, folder), "vec_id", "row").select("row", "vec"), "numbered")


def cells_of_rows(rows):
    return MX.cells(rows, "row", "vec").withColumn("j", F.col("j").cast("bigint"))


def grid(spark, folder):
    """Cells (i, j, v) with a dense row number."""
    return cells_of_rows(numbered_rows(spark, folder))


def rounded(df):
    return df.withColumns({"v": r6("v"), "j": F.col("j").cast("bigint")})


@query("reshape", f"WITH {GRID_SQL} SELECT (i * 64 + j) // 16 AS i, (i * 64 + j) % 16 AS j, {sql_r6('v')} AS v FROM grid")
def reshape(spark, folder):
    rows = numbered_rows(spark, folder)
    count = rows.agg(F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()[0]
    return rounded(MX.reshape(cells_of_rows(rows), SIZE, -1, 16, count))


@query(
    "transpose",
    f"WITH {GRID_SQL} SELECT 'transpose' AS kind, 0 AS b, j AS i, i AS j, {sql_r6('v')} AS v FROM grid "
    f"UNION ALL SELECT 'permute', j, 0, i, {sql_r6('v')} FROM grid",
)
def transpose(spark, folder):
    cells = grid(spark, folder)
    flat = rounded(MX.transpose(cells)).select(F.lit("transpose").alias("kind"), F.lit(0).cast("bigint").alias("b"), "i", "j", "v")
    cube = MX.permute(MX.add_axis(cells, "b"), ["b", "i", "j"], [2, 0, 1])
    moved = rounded(cube).select(F.lit("permute").alias("kind"), F.col("b").cast("bigint"), F.col("i").cast("bigint"), "j", "v")
    return flat.unionByName(moved)


@query(
    "index_slice",
    f"""WITH {GRID_SQL} SELECT 'set' AS kind, i, j, CASE WHEN j >= 2 AND j < 4 THEN 100.0 ELSE {sql_r6('v')} END AS v FROM grid
        UNION ALL SELECT 'part', i, j - 2, {sql_r6('v')} FROM grid WHERE j >= 2 AND j < 4
        UNION ALL SELECT 'column', i, 0, {sql_r6('v')} FROM grid WHERE j = 2""",
)
def index_slice(spark, folder):
    cells = grid(spark, folder)
    assigned = MX.assign_slice(cells, 100.0, columns=slice(2, 4))
    part = MX.index_slice(cells, columns=slice(2, 4))
    column = MX.index_slice(cells, columns=2).withColumn("j", F.lit(0))

    def tagged(df, kind):
        return rounded(df).select(F.lit(kind).alias("kind"), "i", "j", "v")

    return tagged(assigned, "set").unionByName(tagged(part, "part")).unionByName(tagged(column, "column"))


SEQ_SQL = f"""{CELLS_SQL},
placed AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings),
seqs AS MATERIALIZED (SELECT c.label, p.pos // {CONTEXT} AS seq, p.pos % {CONTEXT} AS p, c.k, c.x FROM cells c JOIN placed p USING (vec_id))"""
SEQ_KEY = ["label", "seq"]


def sequences(spark, folder):
    rows = A.sequences(embeddings(spark, folder), "label", "vec_id", CONTEXT)
    return rows.select("label", "seq", "p", "vec")


ROPE_SQL = f"""rot AS MATERIALIZED (
  SELECT a.label, a.seq, a.p, a.k, CASE WHEN a.k % 2 = 0 THEN a.x * cos(t) - b.x * sin(t) ELSE b.x * sin(t) + a.x * cos(t) END AS x
  FROM (SELECT *, p * pow({ROPE_THETA}, -((k // 2) / 32.0)) AS t FROM seqs) a
  JOIN seqs b ON b.label = a.label AND b.seq = a.seq AND b.p = a.p AND b.k = CASE WHEN a.k % 2 = 0 THEN a.k + 1 ELSE a.k - 1 END)"""


def rotated(spark, folder):
    rows = sequences(spark, folder)
    return rows.withColumn("q", V.rope(F.col("vec"), F.col("p"), SIZE))


@query("rope", f"WITH {SEQ_SQL}, {ROPE_SQL} SELECT label, seq, p, k, {sql_r6('x')} AS value FROM rot")
def rope(spark, folder):
    return long_rows(rotated(spark, folder), [*SEQ_KEY, "p"], value=F.col("q")).withColumn("p", F.col("p").cast("bigint"))


@query(
    "rms_norm",
    f"""WITH {CELLS_SQL}, ms AS (SELECT vec_id, avg(x * x) AS m FROM cells GROUP BY vec_id)
        SELECT c.vec_id, c.k, {sql_r6(f'x / sqrt(m + {NORM_EPS}) * (1 + k / 100.0)')} AS value FROM cells c JOIN ms USING (vec_id)""",
)
def rms_norm(spark, folder):
    weights = V.literal_vector([1 + k / 100.0 for k in range(SIZE)])
    return long_rows(embeddings(spark, folder), ["vec_id"], value=V.rms_norm(F.col("vec"), weights))


SCORES_SQL = f"""{SEQ_SQL}, {ROPE_SQL},
scores AS MATERIALIZED (
  SELECT q.label, q.seq, q.p AS i, r.p AS j, sum(q.x * r.x) / sqrt({SIZE}) AS s
  FROM rot q JOIN rot r ON r.label = q.label AND r.seq = q.seq AND r.k = q.k AND r.p <= q.p GROUP BY q.label, q.seq, q.p, r.p),
weights AS MATERIALIZED (
  SELECT label, seq, i, j, exp(s) / sum(exp(s)) OVER (PARTITION BY label, seq, i) AS w FROM scores)"""


def attention_rows(spark, folder):
    """Rotated queries and keys, plain values, of whole sequences."""
    rows = A.sequences(embeddings(spark, folder), "label", "vec_id", CONTEXT)
    rotated = V.rope(F.col("vec"), F.col("p"), SIZE)
    return rows.select(*SEQ_KEY, "p", "seq_rows", rotated.alias("q"), rotated.alias("k"), F.col("vec").alias("v"))


def cells_of(df, column):
    """One row per query and key."""
    values = df.select(*SEQ_KEY, F.col("p").cast("bigint").alias("i"), "first", F.posexplode_outer(column).alias("at", "_x"))
    return values.select(*SEQ_KEY, "i", (F.col("first") + F.col("at")).cast("bigint").alias("j"), r6("_x").alias("value"))


@query("attention_scores", f"WITH {SCORES_SQL} SELECT label, seq, i, j, {sql_r6('s')} AS value FROM scores")
def attention_scores(spark, folder):
    return cells_of(A.score_rows(attention_rows(spark, folder), SEQ_KEY), "scores")


@query("softmax", f"WITH {SCORES_SQL} SELECT label, seq, i, j, {sql_r6('w')} AS value FROM weights")
def softmax(spark, folder):
    return cells_of(A.weight_rows(attention_rows(spark, folder), SEQ_KEY), "weights")


@query(
    "attention_pool",
    f"""WITH {SCORES_SQL} SELECT w.label, w.seq, w.i, v.k AS j, {sql_r6('sum(w.w * v.x)')} AS value
        FROM weights w JOIN seqs v ON v.label = w.label AND v.seq = w.seq AND v.p = w.j GROUP BY w.label, w.seq, w.i, v.k""",
)
def attention_pool(spark, folder):
    rows = A.attend(attention_rows(spark, folder), SEQ_KEY)
    values = rows.select(*SEQ_KEY, F.col("p").cast("bigint").alias("i"), F.posexplode_outer("out").alias("j", "_x"))
    return values.select(*SEQ_KEY, "i", F.col("j").cast("bigint"), r6("_x").alias("value"))


HEADS, KV_HEADS, HEAD = 8, 2, 8


def _rotated_sql(source: str, name: str) -> str:
    """CTE: rows (label, seq, p, head, d, x) of ``source`` with every head rotated by its position."""
    return f"""{name} AS MATERIALIZED (
  SELECT a.label, a.seq, a.p, a.head, a.d, CASE WHEN a.d % 2 = 0 THEN a.x * cos(t) - b.x * sin(t) ELSE b.x * sin(t) + a.x * cos(t) END AS x
  FROM (SELECT *, p * pow({ROPE_THETA}, -((d // 2) / {HEAD / 2})) AS t FROM {source}) a
  JOIN {source} b ON b.label = a.label AND b.seq = a.seq AND b.p = a.p AND b.head = a.head AND b.d = CASE WHEN a.d % 2 = 0 THEN a.d + 1 ELSE a.d - 1 END)"""


HEADS_SQL = f"""{SEQ_SQL},
q0 AS MATERIALIZED (SELECT label, seq, p, k // {HEAD} AS head, k % {HEAD} AS d, x FROM seqs),
k0 AS MATERIALIZED (SELECT label, seq, p, k // {HEAD} AS head, k % {HEAD} AS d, x FROM seqs WHERE k < {KV_HEADS * HEAD}),
{_rotated_sql("q0", "qh")},
{_rotated_sql("k0", "kv")},
vv AS (SELECT label, seq, p, (k - {SIZE - KV_HEADS * HEAD}) // {HEAD} AS g, k % {HEAD} AS d, x FROM seqs WHERE k >= {SIZE - KV_HEADS * HEAD}),
hs AS (SELECT q.label, q.seq, q.head, q.p AS i, c.p AS j, sum(q.x * c.x) / sqrt({HEAD}) AS s
  FROM qh q JOIN kv c ON c.label = q.label AND c.seq = q.seq AND c.d = q.d AND c.head = q.head // {HEADS // KV_HEADS} AND c.p <= q.p
  GROUP BY q.label, q.seq, q.head, q.p, c.p),
hw AS MATERIALIZED (SELECT *, exp(s) / sum(exp(s)) OVER (PARTITION BY label, seq, head, i) AS w FROM hs),
heads AS MATERIALIZED (SELECT h.label, h.seq, h.head, h.i AS p, v.d, sum(h.w * v.x) AS o
  FROM hw h JOIN vv v ON v.label = h.label AND v.seq = h.seq AND v.p = h.j AND v.g = h.head // {HEADS // KV_HEADS}
  GROUP BY h.label, h.seq, h.head, h.i, v.d)"""


def attended(spark, folder):
    """Outputs of all heads, side by side: queries and keys are rotated head by head."""
    width, place = KV_HEADS * HEAD, F.col("p")
    rows = A.sequences(embeddings(spark, folder), "label", "vec_id", CONTEXT)
    rows = rows.select(
        *SEQ_KEY, "p", "seq_rows", V.rope_heads(F.col("vec"), place, HEADS, HEAD).alias("q"),
        V.rope_heads(F.slice("vec", 1, width), place, KV_HEADS, HEAD).alias("k"), F.slice("vec", SIZE - width + 1, width).alias("v"),
    )
    return A.attend(rows, SEQ_KEY, HEADS, KV_HEADS)


@query("multi_head", f"WITH {HEADS_SQL} SELECT label, seq, head, p, d AS k, {sql_r6('o')} AS value FROM heads")
def multi_head(spark, folder):
    rows = long_rows(A.head_outputs(attended(spark, folder), SEQ_KEY, HEADS), [*SEQ_KEY, "head", "p"], value=F.col("out"))
    return rows.withColumns({"p": F.col("p").cast("bigint"), "head": F.col("head").cast("bigint")})


@query("concat_heads", f"WITH {HEADS_SQL} SELECT label, seq, p, head * {HEAD} + d AS k, {sql_r6('o')} AS value FROM heads")
def concat_heads(spark, folder):
    rows = long_rows(attended(spark, folder), [*SEQ_KEY, "p"], value=F.col("out"))
    return rows.withColumn("p", F.col("p").cast("bigint"))


HIDDEN = 16


def fixed_weights(rows: int, columns: int, shift: int) -> np.ndarray:
    """Repeatable stand-in weights in [-0.5, 0.5)."""
    i, j = np.arange(rows)[:, None], np.arange(columns)[None, :]
    return ((i * 131 + j * 17 + shift) % 101) / 101.0 - 0.5


def _weight_sql(i: str, j: str, shift: int) -> str:
    return f"((({i}) * 131 + ({j}) * 17 + {shift}) % 101) / 101.0 - 0.5"


@query(
    "batch_score",
    f"""WITH {CELLS_SQL}, h AS (SELECT unnest(range({HIDDEN})) AS h),
    mid AS MATERIALIZED (SELECT vec_id, h, sum(x * ({_weight_sql('k', 'h', 1)})) AS a, sum(x * ({_weight_sql('k', 'h', 3)})) AS b FROM cells CROSS JOIN h GROUP BY vec_id, h),
    o AS (SELECT unnest(range({SIZE})) AS k)
    SELECT vec_id, k, {sql_r6(f"sum(a / (1 + exp(-a)) * b * ({_weight_sql('h', 'k', 2)}))")} AS value FROM mid CROSS JOIN o GROUP BY vec_id, k""",
)
def batch_score(spark, folder):
    w1, w3, w2 = fixed_weights(SIZE, HIDDEN, 1), fixed_weights(SIZE, HIDDEN, 3), fixed_weights(HIDDEN, SIZE, 2)
    scored = embeddings(spark, folder).select("vec_id", MX.batch_score(F.col("vec"), w1, w3, w2).alias("out"))
    return long_rows(scored, ["vec_id"], value=F.col("out"))


@query(
    "argmax",
    f"""WITH {CELLS_SQL} SELECT vec_id, label, j AS pred FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, j) AS rn FROM logits) WHERE rn = 1""",
)
def argmax(spark, folder):
    return scored_embeddings(spark, folder).select("vec_id", "label", "pred")


@query(
    "score_matrix",
    f"""WITH {CELLS_SQL}, m AS (SELECT a.label, b.label AS o, sum(a.c * b.c) AS s FROM centers a JOIN centers b ON b.k = a.k GROUP BY a.label, b.label)
        SELECT label, o AS other, {sql_r6('s')} AS score FROM m""",
)
def score_matrix(spark, folder):
    return MX.score_matrix(embeddings(spark, folder), "vec", "label").withColumn("score", r6("score"))


@query(
    "quantize_vectors",
    f"""WITH {CELLS_SQL}, s AS (SELECT vec_id, max(abs(x)) AS scale FROM cells GROUP BY vec_id),
    q AS (SELECT vec_id, k, x, scale, round(x / scale * 127.0)::INT AS code FROM cells JOIN s USING (vec_id))
    SELECT vec_id, {sql_r6('any_value(q.scale)')} AS scale, string_agg(code::VARCHAR, ' ' ORDER BY k) AS codes,
           {sql_r6('max(abs(q.x - q.code * q.scale / 127.0))')} AS worst FROM q GROUP BY vec_id""",
)
def quantize_vectors(spark, folder):
    rows = embeddings(spark, folder).withColumn("q", V.quantize_int8(F.col("vec"))).select("vec_id", "vec", "q.scale", "q.codes")
    rows = rows.withColumn("back", V.subtract(F.col("vec"), V.dequantize_int8(F.col("scale"), F.col("codes"))))
    return rows.select("vec_id", r6("scale").alias("scale"), F.array_join("codes", " ").alias("codes"), r6(V.block_scale(F.col("back"))).alias("worst"))


@query(
    "quantize_vectors_4bit",
    f"""WITH {CELLS_SQL}, s AS (SELECT vec_id, max(abs(x)) AS scale FROM cells GROUP BY vec_id),
    book AS (SELECT unnest([{', '.join(map(repr, NF4_CODES))}]::DOUBLE[]) AS value, unnest(range(16)) AS code),
    q AS (SELECT vec_id, k, x, scale, code, value, row_number() OVER (PARTITION BY vec_id, k ORDER BY abs(x / scale - value), code) AS rn
          FROM cells JOIN s USING (vec_id) CROSS JOIN book)
    SELECT vec_id, string_agg(code::VARCHAR, ' ' ORDER BY k) AS codes, {sql_r6('max(abs(q.x - q.value * q.scale))')} AS worst FROM q WHERE rn = 1 GROUP BY vec_id""",
)
def quantize_vectors_4bit(spark, folder):
    rows = embeddings(spark, folder).withColumn("q", V.quantize_nf4(F.col("vec"))).select("vec_id", "vec", "q.scale", "q.codes")
    back = V.subtract(F.col("vec"), V.dequantize_nf4(F.col("scale"), F.col("codes")))
    return rows.select("vec_id", F.array_join("codes", " ").alias("codes"), r6(V.block_scale(back)).alias("worst"))


@query(
    "quantize_double",
    f"""WITH {CELLS_SQL}, s AS (SELECT vec_id, max(abs(x)) AS scale FROM cells GROUP BY vec_id),
    placed AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // {Q.GROUP} AS grp FROM s),
    groups AS (SELECT grp, avg(scale) AS middle, max(scale) AS high, min(scale) AS low FROM placed GROUP BY grp),
    coded AS (SELECT vec_id, grp, scale, middle, greatest(high - middle, middle - low) AS reach FROM placed JOIN groups USING (grp)),
    scales AS (SELECT *, CASE WHEN reach > 0 THEN round((scale - middle) / reach * 127.0)::INT ELSE 0 END AS scale_code FROM coded),
    book AS (SELECT unnest([{', '.join(map(repr, NF4_CODES))}]::DOUBLE[]) AS value, unnest(range(16)) AS code),
    q AS (SELECT vec_id, k, x, value, scale_code, middle + scale_code * reach / 127.0 AS about,
                 row_number() OVER (PARTITION BY vec_id, k ORDER BY abs(x / scale - value), code) AS rn FROM cells JOIN scales USING (vec_id) CROSS JOIN book)
    SELECT vec_id, any_value(scale_code) AS scale_code, {sql_r6('any_value(about)')} AS scale, {sql_r6('max(abs(x - value * about))')} AS worst
    FROM q WHERE rn = 1 GROUP BY vec_id""",
)
def quantize_double(spark, folder):
    """4-bit codes whose scales are 8-bit codes themselves, read back."""
    rows = embeddings(spark, folder).select("vec_id", "vec")
    blocks, groups = Q.quantize_double(rows, "vec_id", "vec")
    back = Q.dequantize_double(blocks, groups, "vec_id", "back")
    about = blocks.where("part = 0").join(groups, "group").select("vec_id", F.col("scale_code").cast("int"), (F.col("middle") + F.col("scale_code") * F.col("reach") / 127.0).alias("scale"))
    met = rows.join(back, "vec_id").join(about, "vec_id")
    return met.select("vec_id", "scale_code", r6("scale").alias("scale"), r6(V.block_scale(V.subtract(F.col("vec"), F.col("back")))).alias("worst"))


GRAM_BLOCK = 16


@query(
    "block_matmul",
    f"WITH {CELLS_SQL} SELECT a.k AS i, b.k AS j, {sql_r6('sum(a.x * b.x)')} AS value FROM cells a JOIN cells b ON a.vec_id = b.vec_id GROUP BY a.k, b.k",
)
def block_matmul(spark, folder):
    """The transposed vector table times itself, in blocks: the inner side is the table's rows."""
    blocks = stage(BL.from_rows(embeddings(spark, folder), "vec_id", "vec", GRAM_BLOCK), "blocks")
    cells = BL.to_cells(BL.multiply(BL.transpose(blocks, GRAM_BLOCK), blocks), GRAM_BLOCK)
    return cells.select("i", "j", r6("v").alias("value"))
