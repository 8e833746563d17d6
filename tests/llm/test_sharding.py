"""Exact sizes, gapless slots, and draws that follow the law of a uniform shuffle."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tokenloom.llm import sharding as s


def check(rows, total, shards):
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == len(rows) == total
    assert max(sizes.get(i, 0) for i in range(shards)) - min(sizes.get(i, 0) for i in range(shards)) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))


@pytest.mark.parametrize("good,bad,n", [(5, 7, 4), (1, 1, 1), (300, 100, 50), (3, 0, 2), (0, 4, 3)])
def test_hypergeometric_frequencies(good, bad, n):
    rng = np.random.default_rng(1)
    draws = Counter(s.draw_hypergeometric(rng, good, bad, n) for _ in range(20_000))
    for k in range(max(0, n - bad), min(n, good) + 1):
        p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
        assert abs(draws[k] / 20_000 - p) < 0.02


def test_hypergeometric_of_huge_tables():
    rng = np.random.default_rng(2)
    draws = [s.draw_hypergeometric(rng, 10**12, 7 * 10**12, 800_000) for _ in range(200)]
    assert abs(np.mean(draws) - 100_000) < 100 and 200 < np.std(draws) < 400


def test_matrix_margins():
    counts = [0, 5, 1000, 17, 3]
    matrix = np.array(s.communication_matrix(counts, 8))
    assert matrix.sum(1).tolist() == counts and matrix.min() >= 0
    assert matrix.sum(0).max() - matrix.sum(0).min() <= 1


def test_every_row_gets_a_slot(spark):
    rows = [(i % 50 if i % 7 else None, "same" if i % 3 else None, "x", i) for i in range(1003)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, part int").repartition(5)
    check(s.shuffle_into_shards(frame).collect(), 1003, 8)
    check(s.shuffle_into_shards(frame, shards=3).collect(), 1003, 3)
    assert s.shuffle_into_shards(frame.limit(0)).collect() == []
    check(s.shuffle_into_shards(frame.limit(3)).collect(), 3, 8)


def test_buckets_give_the_same_law(spark, monkeypatch):
    monkeypatch.setattr(s, "BUCKET_ROWS", 10)
    frame = spark.range(2000).selectExpr("id AS doc_id", "string(id) AS text")
    rows = s.shuffle_into_shards(frame).collect()
    check(rows, 2000, 8)
    # Neighbours of the input do not stay neighbours.
    near = sum(abs(a.doc_id - b.doc_id) == 1 for a, b in zip(*(lambda o: (o, o[1:]))(sorted(rows, key=lambda r: (r.shard, r.slot)))))
    assert near < 20


def test_query_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = s.op2(spark, folder).collect()
    check(rows, len(texts), 8)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
