import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import vectors as V
from tokenloom.functions.constants import NF4_CODES
from tokenloom.operators import attention as A
from tokenloom.operators import matrices as MX


def lit(values):
    return V.literal_vector(values)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def matrix(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)], "i bigint, vec array<double>")


def dense(grid, shape):
    out = np.full(shape, np.nan)
    for r in grid.collect():
        out[r.i, r.j] = r.v
    return out


def test_arithmetic(spark):
    x, y = lit([1, 2, 3]), lit([4, 5, 6])
    assert one(spark, V.dot(x, y)) == 32
    assert one(spark, V.add(x, y)) == [5, 7, 9]
    assert one(spark, V.divide(x, lit([2, 0, 3]))) == [0.5, None, 1.0]
    assert one(spark, V.elementwise(lit([2]), lit([3]), lambda a, b: (a + b) * (b - 2))) == [5]


def test_reductions(spark):
    df = matrix(spark, [[1, 2, 3], [4, 5, 6]])
    assert MX.tensor_reduce(df, "i", "vec", "mean", None).first().value == 3.5
    assert [r.value for r in MX.tensor_reduce(df, "i", "vec", "mean", 0).orderBy("k").collect()] == [2.5, 3.5, 4.5]
    assert [r.value for r in MX.tensor_reduce(df, "i", "vec", "mean", 1).orderBy("i").collect()] == [2, 5]
    assert [r.value for r in MX.tensor_reduce(df, "i", "vec", "mean", 1, True).orderBy("i").collect()] == [[2], [5]]
    assert MX.tensor_reduce(df, "i", "vec", "max", None).first().value == 6
    assert [r.value for r in MX.tensor_reduce(df, "i", "vec", "min", 0).orderBy("k").collect()] == [1, 2, 3]


def test_broadcasting(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    got = rows.select(V.broadcast_row(F.col("x"), lit([4, 5]), lambda a, b: a + b).alias("r")).collect()
    assert [r.r for r in got] == [[5, 6], [6, 7], [7, 8]]


def test_slicing_of_twelve_values(spark):
    grid = MX.cells(matrix(spark, np.arange(12).reshape(3, 4)), "i", "vec")
    assert MX.index_slice(grid, 1, 3).first().v == 7
    assert sorted(r.v for r in MX.index_slice(grid, 1).collect()) == [4, 5, 6, 7]
    assert sorted((r.i, r.v) for r in MX.index_slice(grid, columns=2).collect()) == [(0, 2), (1, 6), (2, 10)]
    assert dense(MX.index_slice(grid, slice(1, 3), slice(2, 4)), (2, 2)).tolist() == [[6, 7], [10, 11]]
    assert dense(MX.assign_slice(grid, 100, columns=slice(2, 4)), (3, 4)).tolist() == [[0, 1, 100, 100], [4, 5, 100, 100], [8, 9, 100, 100]]


def test_reshape_transpose_permute(spark):
    grid = MX.cells(matrix(spark, np.arange(1, 7).reshape(2, 3)), "i", "vec")
    assert dense(MX.reshape(grid, 3, 3, 2), (3, 2)).tolist() == [[1, 2], [3, 4], [5, 6]]
    assert dense(MX.reshape(grid, 3, -1, 6), (1, 6)).tolist() == [[1, 2, 3, 4, 5, 6]]
    with pytest.raises(ValueError):
        MX.reshape(grid, 3, 4, 2)
    assert dense(MX.transpose(grid), (3, 2)).tolist() == [[1, 4], [2, 5], [3, 6]]
    cube = MX.permute(MX.add_axis(grid, "b"), ["b", "i", "j"], [2, 0, 1])
    assert sorted((r.b, r.i, r.j, r.v) for r in cube.collect()) == sorted((j, 0, i, 1.0 + 3 * i + j) for i in range(2) for j in range(3))
    assert sorted(MX.drop_axis(MX.add_axis(grid, "b"), "b").columns) == ["i", "j", "v"]
    with pytest.raises(Exception, match="longer than one"):
        MX.drop_axis(grid, "i").collect()


def test_products_agree(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(40, 6)), rng.normal(size=(6, 5))
    df = matrix(spark, a)
    shipped = np.array([r.y for r in df.select("i", MX.matmul(F.col("vec"), b).alias("y")).orderBy("i").collect()])
    joined = dense(MX.matmul_cells(MX.cells(df, "i", "vec"), MX.cells(matrix(spark, b), "i", "vec")), (40, 5))
    assert np.allclose(shipped, a @ b) and np.allclose(joined, a @ b)
    with pytest.raises(Exception, match="must have 7 values"):
        df.select(MX.matmul(F.col("vec"), rng.normal(size=(7, 2)))).collect()


def test_norm_softmax_losses(spark):
    v = np.array([0.5, -2.0, 3.0])
    assert np.allclose(one(spark, V.rms_norm(lit(v), lit([1, 2, 3]))), v / math.sqrt((v**2).mean() + 1e-5) * [1, 2, 3])
    e = np.exp(v - v.max())
    assert np.allclose(one(spark, V.softmax(lit(v))), e / e.sum())
    assert np.allclose(one(spark, V.softmax(lit([1000.0, 999.0]))), [1 / (1 + math.exp(-1)), 1 / (1 + math.e)])
    loss = one(spark, V.cross_entropy(lit(v), F.lit(1)))
    assert math.isclose(loss, one(spark, V.negative_log_likelihood(V.softmax(lit(v)), F.lit(1))))
    assert one(spark, V.argmax(lit([1, 5, 5]))) == 1
    assert one(spark, V.squared_error(lit([1, 2]), lit([3, 2]))) == 2


def test_rotation(spark):
    freqs = V.rotation_frequencies(128)
    assert len(freqs) == 64 and freqs[0] == 1.0
    assert np.allclose(freqs[1:3], [0.81462, 0.66360], atol=1e-5) and math.isclose(freqs[-1], 2.4551e-06, rel_tol=1e-4)
    v = np.arange(1, 9) / 10
    got = np.array(one(spark, V.rope(lit(v), F.lit(3), 8)))
    z = (v[0::2] + 1j * v[1::2]) * np.exp(3j * np.array(V.rotation_frequencies(8)))
    assert np.allclose(got[0::2] + 1j * got[1::2], z)
    assert np.allclose(one(spark, V.rope(lit(v), F.lit(0), 8)), v)


def test_quantization(spark):
    rng = random.Random(3)
    v = [rng.uniform(-1, 1) for _ in range(64)]
    q = one(spark, V.quantize_int8(lit(v)))
    assert np.allclose([c * q.scale / 127 for c in q.codes], v, atol=q.scale / 254 + 1e-12)
    q = one(spark, V.quantize_nf4(lit(v)))
    nearest = [int(np.argmin([abs(x / q.scale - c) for c in NF4_CODES])) for x in v]
    assert list(q.codes) == nearest
    assert one(spark, V.quantize_int8(lit([0, 0]))).codes == [0, 0]


def attention(q, k, v):
    s = q @ k.T / math.sqrt(q.shape[1])
    s[np.triu_indices(len(q), 1)] = -np.inf
    w = np.exp(s - s.max(axis=1, keepdims=True))
    return (w / w.sum(axis=1, keepdims=True)) @ v


def attention_frame(spark, sequences):
    """Rows of (seq, q, k, v) matrices, with the length of each sequence."""
    rows = [(seq, i, len(q), q[i].tolist(), k[i].tolist(), v[i].tolist()) for seq, q, k, v in sequences for i in range(len(q))]
    return spark.createDataFrame(rows, "seq bigint, p int, seq_rows int, q array<double>, k array<double>, v array<double>").repartition(4)


def test_causal_attention_of_seventeen_positions(spark):
    rng = np.random.default_rng(2)
    q, k, v = (rng.normal(size=(17, 8)) for _ in range(3))
    df = attention_frame(spark, [(0, q, k, v), (1, q[:3], k[:3], v[:3])])
    pieces = A.weight_rows(df, ["seq"], block=5).collect()
    assert sum(len(r.weights) for r in pieces if r.seq == 0) == 153
    for seq, n in ((0, 17), (1, 3)):
        weights = np.zeros((n, n))
        for r in pieces:
            if r.seq == seq:
                weights[r.p, r["first"] : r["first"] + len(r.weights)] = r.weights
        assert np.allclose(weights.sum(axis=1), 1.0) and not np.triu(weights, 1).any()
        assert np.allclose(weights @ v[:n], attention(q[:n], k[:n], v[:n]))


@pytest.mark.parametrize("rows, block", [(300, A.BLOCK), (300, 16), (33, 1)])
def test_attention_over_a_whole_sequence(spark, rows, block):
    """Every position sees all before it, in whatever blocks; large scores do not overflow; NULL is a sequence."""
    rng = np.random.default_rng(6)
    q, k, v = 20 * rng.normal(size=(rows, 8)), 20 * rng.normal(size=(rows, 8)), rng.normal(size=(rows, 6))
    df = attention_frame(spark, [(None, q, k, v), (4, q[:2], k[:2], v[:2])])
    found = A.attend(df, ["seq"], block=block).orderBy("p").collect()
    assert np.allclose([r.out for r in found if r.seq is None], attention(q, k, v))
    assert np.allclose([r.out for r in found if r.seq == 4], attention(q[:2], k[:2], v[:2]))
    # Blocks merge: each row appears once, whatever number of blocks it saw.
    assert [r.p for r in found if r.seq is None] == list(range(rows))


def test_shared_key_heads(spark):
    rng = np.random.default_rng(4)
    q, k, v = rng.normal(size=(5, 16)), rng.normal(size=(5, 8)), rng.normal(size=(5, 8))
    rows = A.attend(attention_frame(spark, [(0, q, k, v)]), ["seq"], heads=4, kv_heads=2, block=2)
    want = np.concatenate([attention(q[:, h * 4 : h * 4 + 4], k[:, h // 2 * 4 : h // 2 * 4 + 4], v[:, h // 2 * 4 : h // 2 * 4 + 4]) for h in range(4)], axis=1)
    assert np.allclose([r.out for r in rows.orderBy("p").collect()], want)
    heads = {(r.p, r.head): r.out for r in A.head_outputs(rows, ["seq"], 4).collect()}
    assert len(heads) == 20 and all(np.allclose(heads[p, h], want[p, 4 * h : 4 * h + 4]) for p, h in heads)


def test_heads_are_rotated_one_by_one(spark):
    rng = np.random.default_rng(8)
    vec = rng.normal(size=12)
    got = one(spark, V.rope_heads(lit(vec.tolist()), F.lit(5), 3, 4))
    for h in range(3):
        assert np.allclose(got[4 * h : 4 * h + 4], one(spark, V.rope(lit(vec[4 * h : 4 * h + 4].tolist()), F.lit(5), 4)))


def test_sequences_of_a_hot_group_stay_short(spark):
    df = spark.range(300).select("id", F.lit(1).alias("g"))
    rows = A.sequences(df, "g", "id", 32).collect()
    assert max(r.p for r in rows) == 31 and max(r.seq for r in rows) == 299 // 32
    assert all(r.seq * 32 + r.p == r.id for r in rows)


def test_score_matrix_is_the_mean_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    x, g = rng.normal(size=(30, 4)), np.arange(30) % 3
    df = spark.createDataFrame([(int(g[i]), x[i].tolist()) for i in range(30)], "g int, vec array<double>")
    df = df.unionByName(spark.createDataFrame([(12, [1.0, 0.0, 0.0, 0.0])], df.schema))
    table = {(r.g, r.other): r.score for r in MX.score_matrix(df, "vec", "g").collect()}
    assert len(table) == 16 and math.isclose(table[12, 12], 1.0)
    for a in range(3):
        for b in range(3):
            assert math.isclose(table[a, b], (x[g == a] @ x[g == b].T).mean(), abs_tol=1e-12)


def test_ignored_and_impossible_labels(spark):
    logits = F.array(*[F.lit(float(i)) for i in range(120)])
    assert one(spark, V.cross_entropy(logits, F.lit(-100))) is None
    assert one(spark, V.negative_log_likelihood(V.softmax(logits), F.lit(-100))) is None
    for label in (-1, 120):
        with pytest.raises(Exception, match="no such class"):
            one(spark, V.cross_entropy(logits, F.lit(label)))


def test_rotation_refuses_another_size(spark):
    with pytest.raises(Exception, match="expected a vector of 8 values"):
        one(spark, V.rope(F.array(*[F.lit(1.0)] * 10), F.lit(1), 8))


def test_gated_score(spark):
    rng = np.random.default_rng(6)
    x, w1, w3, w2 = rng.normal(size=(9, 4)), rng.normal(size=(4, 6)), rng.normal(size=(4, 6)), rng.normal(size=(6, 3))
    got = np.array([r.y for r in matrix(spark, x).select("i", MX.batch_score(F.col("vec"), w1, w3, w2).alias("y")).orderBy("i").collect()])
    gate = x @ w1
    assert np.allclose(got, (gate / (1 + np.exp(-gate)) * (x @ w3)) @ w2)


def test_labels_that_are_no_places(spark):
    """Labels 0, 5 and 70: the class is the place in the matrix, the answer the label."""
    df = spark.createDataFrame([(5, [0.0, 2.0]), (0, [3.0, 0.0]), (70, [-1.0, -1.0]), (None, [9.0, 9.0])], "label int, vec array<double>")
    labels, weights = MX.labelled_matrix(df, "label", "vec")
    assert labels == [0, 5, 70] and weights.tolist() == [[3, 0], [0, 2], [-1, -1]]
    rows = df.withColumn("logits", MX.matmul(F.col("vec"), weights.T))
    rows = rows.select("label", MX.label_of(V.argmax(F.col("logits")), labels).alias("pred"), V.cross_entropy(F.col("logits"), MX.class_of(F.col("label"), labels)).alias("loss"), "logits")
    for r in rows.collect():
        if r.label is None:
            assert r.loss is None
        else:
            assert r.pred == r.label
            assert math.isclose(r.loss, math.log(sum(map(math.exp, r.logits))) - r.logits[labels.index(r.label)])


def test_reductions_in_one_pass(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 5))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(40)], "id int, vec array<double>").repartition(3)
    got = {(r.how, r.axis, r["at"]): r.value for r in MX.reduce_all(df, "id", "vec", ["mean", "sum", "min", "max"], 5).collect()}
    for how in ("mean", "sum", "min", "max"):
        assert math.isclose(got[how, "all", -1], getattr(x, how)())
        assert np.allclose([got[how, "columns", i] for i in range(5)], getattr(x, how)(axis=0))
        assert np.allclose([got[how, "rows", i] for i in range(40)], getattr(x, how)(axis=1))
    assert len(got) == 4 * 46 and MX.reduce_all(df.limit(0), "id", "vec", ["mean", "max"], 5).collect() == []
    with pytest.raises(Exception, match="expected a vector"):
        MX.reduce_all(df, "id", "vec", ["sum"], 4).collect()
