import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import batching as B


@pytest.fixture(scope="module")
def ragged(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(100) for _ in range(rng.choice([0, 1, 3, 7, 20]))]) for i in range(120)]
    rows.append((120, list(range(300))))
    return spark.createDataFrame(rows, "id bigint, ids array<int>"), rows


def test_minibatches(spark):
    rows = B.minibatch(spark.range(200), ["id"], 64).collect()
    sizes = {b: sum(r.batch_id == b for r in rows) for b in range(4)}
    assert sizes == {0: 64, 1: 64, 2: 64, 3: 8}
    assert {r.batch_id for r in B.minibatch(spark.range(200), ["id"], 64, drop_last=True).collect()} == {0, 1, 2}


def test_packing_matches_a_plain_loop(spark, ragged):
    df, rows = ragged
    stream = [i for _, ids in sorted(rows) for i in [*ids, -1]]
    want = [stream[at : at + 16] for at in range(0, len(stream) - 15, 16)]
    got = sorted(B.pack_sequences(df, "id", "ids", 16, -1).collect(), key=lambda r: r.chunk)
    assert [r.input_ids for r in got] == want


def test_padding(spark, ragged):
    df, _ = ragged
    rows = B.minibatch(df.withColumns({"input_ids": F.col("ids"), "attention_mask": F.array_repeat(F.lit(1), F.size("ids")), "labels": F.col("ids")}), ["id"], 8)
    for side in ("left", "right"):
        for r in B.pad_batch(rows, 0, 8, side).collect():
            assert len(r.input_ids) == len(r.attention_mask) == len(r.labels)
            assert len(r.input_ids) % 8 == 0 and sum(r.attention_mask) == len(r.ids)
            pad = len(r.input_ids) - len(r.ids)
            real = r.input_ids[pad:] if side == "left" else r.input_ids[: len(r.ids)]
            assert real == r.ids and r.labels.count(-100) == pad


def test_length_groups(spark, ragged):
    df, rows = ragged
    got = B.group_by_length(df.withColumn("len", F.size("ids")), ["id"], "len", 4, mega_batches=5).collect()
    assert sorted(r.pos for r in got) == list(range(len(rows)))
    factor = max(1, min(len(rows) // 16, 5))
    for run in range(-(-len(rows) // (factor * 4))):
        part = [r.len for r in sorted(got, key=lambda r: r.pos) if r.pos // (factor * 4) == run]
        assert part == sorted(part, reverse=True)


def test_range_shards_of_three_to_seven(spark):
    rows = B.range_shards(spark.range(3, 7), "id", 2).collect()
    assert sorted(r.id for r in rows if r["shard"] == 0) == [3, 4]
    assert sorted(r.id for r in rows if r["shard"] == 1) == [5, 6]
    many = B.range_shards(spark.range(3, 7), "id", 20).collect()
    assert sorted(r.id for r in many) == [3, 4, 5, 6] and len({r["shard"] for r in many}) == 4


@pytest.mark.parametrize("n, world", [(10, 3), (9, 3), (2, 7)])
def test_rank_shards_cover_and_balance(spark, n, world):
    rows = B.rank_shards(spark.range(n), ["id"], world, 2).collect()
    for epoch in (0, 1):
        part = [r for r in rows if r.epoch == epoch]
        sizes = {r: sum(x["rank"] == r for x in part) for r in range(world)}
        assert set(sizes.values()) == {-(-n // world)}
        assert {r.id for r in part} == set(range(n))
        by_pos = {r.pos: r.id for r in part}
        assert all(by_pos[p] == by_pos[p % n] for p in by_pos)


def test_epochs_differ_in_order(spark):
    rows = B.epochs(spark.range(50), 2, ["id"]).collect()
    orders = [[r.id for r in sorted(rows, key=lambda r: r.pos) if r.epoch == e] for e in (0, 1)]
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])


def test_collate(spark):
    batched = B.minibatch(spark.range(10).withColumn("x", F.col("id") * 2), ["id"], 4)
    rows = B.collate(batched, ["id", "x"]).collect()
    assert sorted(r.batch_rows for r in rows) == [2, 4, 4]
    assert all(r.x == [2 * i for i in r.id] for r in rows)

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch_id": [frame.batch_id.iloc[0]], "s": [int(frame.x.sum())]})

    assert sum(r.s for r in B.collate_with(batched, total, "batch_id bigint, s bigint").collect()) == 90


def test_step_plan_and_rank_summary(spark):
    batched = B.minibatch(spark.range(100).withColumn("len", F.lit(3)), ["id"], 4)
    rows = {r.step: r for r in B.step_plan(batched, "len", 8, 3).collect()}
    assert set(rows) == {0, 1, 2} and rows[0].tokens == 96 and rows[0].batches == 8
    summary = B.rank_summary(B.rank_shards(spark.range(100), ["id"], 3), 32).collect()
    assert {(r["rank"], r.batch_size, r.steps) for r in summary} == {(0, 32, 2), (1, 32, 2), (2, 32, 2)}


def test_batches_of_rows_without_or_with_equal_keys(spark):
    from tokenloom.plans.batches import batched

    rows = [(None, None, [i]) for i in range(7)] + [(1, 2, [50 + i]) for i in range(9)] + [(1, None, [90]), (5, 5, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, input_ids array<int>").repartition(3)
    got = batched(df).collect()
    assert sorted(str(r.input_ids) for r in got) == sorted(str(ids) for *_, ids in rows)
    sizes = [sum(r.batch_id == b for r in got) for b in {r.batch_id for r in got}]
    assert sum(sizes) == len(rows) and len({r.batch_id for r in got}) == -(-len(rows) // max(sizes))


def test_packing_a_row_without_ids(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, None), (3, []), (4, [7])], "id bigint, ids array<int>")
    got = {r.chunk: r.input_ids for r in B.pack_sequences(df, "id", "ids", 3, 0).collect()}
    assert got == {0: [5, 6, 0], 1: [0, 0, 7]}


def test_padding_to_a_maximum_length(spark, monkeypatch):
    df = spark.createDataFrame([(1, [5, 6, 7], [1, 1, 1]), (2, [8], [1]), (3, [], [])], "id bigint, input_ids array<int>, attention_mask array<int>")
    whole = {r.id: (r.input_ids, r.attention_mask) for r in B.pad_max_length(df, 9).collect()}
    assert whole == {1: ([5, 6, 7], [1, 1, 1]), 2: ([9, 9, 8], [0, 0, 1]), 3: ([9, 9, 9], [0, 0, 0])}
    assert {r.id: r.input_ids for r in B.pad_max_length(df, 9, 2, side="right").collect()} == {1: [5, 6], 2: [8, 9], 3: [9, 9]}
    monkeypatch.setattr(B, "MAX_PADDED", 2)
    with pytest.raises(ValueError, match="maximum length"):
        B.pad_max_length(df, 9)
    assert B.pad_max_length(df.limit(0), 9).collect() == []
