"""Block matrices, double quantisation, quantile sketches and custom datasets against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.constants import NF4_CODES
from tokenloom.operators import blocks as BL
from tokenloom.operators import quantization as Q
from tokenloom.operators import sketches as S
from tokenloom.sources import datasets as D
from tokenloom.streaming import streams


def rows_of(spark, matrix, numbers=None):
    numbers = range(len(matrix)) if numbers is None else numbers
    return spark.createDataFrame([(int(i), list(map(float, row))) for i, row in zip(numbers, matrix)], "i bigint, vec array<double>").repartition(3)


def dense(cells, shape):
    out = np.zeros(shape)
    for r in cells.collect():
        if r.i < shape[0] and r.j < shape[1]:
            out[r.i, r.j] = r.v
        else:
            assert r.v == 0
    return out


@pytest.mark.parametrize("broadcast", [BL.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("n, k, m", [(13, 7, 9), (4, 4, 4), (1, 10, 1), (30, 3, 11)])
def test_product_of_block_tables(spark, monkeypatch, broadcast, n, k, m):
    monkeypatch.setattr(BL, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(BL, "HELD", 2)
    rng = np.random.default_rng(n)
    a, b = rng.normal(size=(n, k)), rng.normal(size=(k, m))
    left, right = BL.from_rows(rows_of(spark, a), "i", "vec", 4), BL.from_rows(rows_of(spark, b), "i", "vec", 4)
    assert np.allclose(dense(BL.to_cells(BL.multiply(left, right), 4), (n, m)), a @ b)
    assert np.allclose(dense(BL.to_cells(BL.transpose(left, 4), 4), (k, n)), a.T)
    gram = BL.multiply(BL.transpose(left, 4), left)
    assert np.allclose(dense(BL.to_cells(gram, 4), (k, k)), a.T @ a)


def test_missing_rows_are_zero(spark):
    a, b = np.eye(9), np.arange(18.0).reshape(9, 2)
    kept = [0, 2, 8]
    left, right = BL.from_rows(rows_of(spark, a), "i", "vec", 4), BL.from_rows(rows_of(spark, b[kept], kept), "i", "vec", 4)
    want = np.zeros((9, 2))
    want[kept] = b[kept]
    assert np.allclose(dense(BL.to_cells(BL.multiply(left, right), 4), (9, 2)), want)
    empty = BL.from_rows(rows_of(spark, a).limit(0), "i", "vec", 4)
    assert BL.multiply(left, empty).collect() == []


def test_large_weights_are_multiplied_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(20, 10)), rng.normal(size=(10, 6))
    df, weights = rows_of(spark, x), rows_of(spark, w)
    small = {r.i: r.vec for r in BL.matmul(df, "i", "vec", weights, "i", "vec", 4).collect()}
    monkeypatch.setattr(BL, "MAX_LOCAL_WEIGHTS", 5)
    large = {r.i: r.vec for r in BL.matmul(df, "i", "vec", weights, "i", "vec", 4).collect()}
    assert small.keys() == large.keys() == set(range(20))
    assert all(np.allclose(small[i], x[i] @ w) and np.allclose(large[i], x[i] @ w) for i in range(20))


@pytest.mark.parametrize("width, group", [(64, 256), (150, 8), (64, 3)])
def test_double_quantisation_within_its_bounds(spark, width, group):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(40, width)) * rng.uniform(0.1, 4, size=(40, 1))
    x[7] = 0.0
    df = spark.createDataFrame([(i * 3, x[i].tolist()) for i in range(40)], "id bigint, vec array<double>").repartition(4)
    blocks, groups = Q.quantize_double(df, "id", "vec", group=group)
    back = {r.id: r.vec for r in Q.dequantize_double(blocks, groups, "id").collect()}
    reach = {r.group: (r.middle, r.reach) for r in groups.collect()}
    rows = blocks.collect()
    assert len(rows) == 40 * -(-width // 64)
    for r in rows:
        part = x[r.id // 3][64 * r.part : 64 * r.part + 64]
        scale, (middle, far) = np.abs(part).max(), reach[r.group]
        about = middle + r.scale_code * far / 127
        assert abs(about - scale) <= far / 254 + 1e-12
        # The code is the nearest of the book for the exact scale.
        if scale:
            assert list(r.codes) == [int(np.argmin([abs(v / scale - c) for c in NF4_CODES])) for v in part]
        assert np.allclose(back[r.id][64 * r.part : 64 * r.part + 64], [NF4_CODES[c] * about for c in r.codes])
    sizes = {}
    for r in rows:
        sizes[r.group] = sizes.get(r.group, 0) + 1
    assert max(sizes.values()) <= max(group, -(-width // 64))


def exact(values, share):
    return sorted(values)[math.floor(share * (len(values) - 1))]


def test_sketch_answers_within_its_accuracy(spark):
    draw = random.Random(3)
    values = {"a": [draw.lognormvariate(3, 2) for _ in range(4000)], "b": [draw.uniform(-50, 50) for _ in range(1500)] + [0.0] * 40, "c": [7.0] * 2500, None: [1.0, 2.0]}
    rows = [(g, v) for g, own in values.items() for v in own] + [("a", None), ("a", float("nan"))]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.95, 0.999, 1.0]
    whole = S.sketch(df, "g", "v")
    parts = [S.sketch(part, "g", "v") for part in df.randomSplit([1.0, 2.0, 3.0], seed=1)]
    merged = S.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), "g")
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    for r in S.quantiles(merged, "g", shares).collect():
        want = exact(values[r.g], r.share)
        assert abs(r.value - want) <= S.ACCURACY * abs(want) + 1e-12 and r.n == len(values[r.g])
    assert S.quantiles(merged, "g", shares).count() == 4 * len(shares)
    assert whole.where("g = 'c'").count() == 1 and whole.where("g = 'a'").count() < 1500
    loose = S.quantiles(S.sketch(df, "g", "v", 0.2), "g", [0.5], 0.2).where("g = 'a'").first()
    assert abs(loose.value - exact(values["a"], 0.5)) <= 0.2 * exact(values["a"], 0.5)


def test_sketches_of_a_stream_add_up(spark, tmp_path):
    folder = str(tmp_path)
    table = spark.range(900).select(F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("g"), (F.col("id") * 1.5 + 1).alias("v"))
    table.repartition(6).write.parquet(f"{folder}/t.parquet")

    def parts():
        stream = streams.stream_table(spark, folder, "t", table.schema, max_files=2)
        return streams.run_with(stream, f"{folder}/out", lambda batch: S.sketch(batch, "g", "v"), "g string, sign int, bucket bigint, n bigint")

    want = sorted(map(str, S.sketch(table, "g", "v").collect()))
    for _ in range(2):  # a second run finds nothing new
        found = parts()
        assert sorted(map(str, S.merge(found, "g").collect())) == want
    assert found.count() > len(want)


def squares():
    """A dataset class that travels by value, as the workers cannot import the tests."""

    class Squares:
        schema = "i bigint, name string, square double"

        def __init__(self, size):
            self.size = size

        def __len__(self):
            return self.size

        def __getitem__(self, i):
            return (i, None if i % 4 == 0 else f"item {i}", float(i * i))

    return Squares


def test_a_dataset_is_read_in_ranges(spark):
    kind = squares()
    D.register_dataset(spark, "squares", lambda options: kind(int(options["size"])))
    table = spark.read.format("squares").option("size", 103).option("partition_items", 10).load()
    assert table.rdd.getNumPartitions() == 11
    assert sorted(tuple(r) for r in table.collect()) == [kind(103)[i] for i in range(103)]
    assert table.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] == 10
    assert spark.read.format("squares").option("size", 0).load().collect() == []


def test_a_dataset_streams_exactly_once_after_a_restart(spark, tmp_path):
    kind = squares()
    D.register_dataset(spark, "squares", lambda options: kind(int(options["size"])))
    for size in (25, 25, 60, 61):
        stream = spark.readStream.format("squares").option("size", size).option("partition_items", 7).load()
        found = streams.run_to_table(stream, str(tmp_path / "out"))
        assert sorted(r.i for r in found.collect()) == list(range(size))


def test_index_ranges(spark):
    assert [r.id for r in D.read_range(spark, 3, 7, 2).orderBy("id").collect()] == [3, 4, 5, 6]
    with pytest.raises(ValueError, match="greater"):
        D.read_range(spark, 3, 3)
    with pytest.raises(IndexError):
        D.IndexRange(0, 2)[2]
