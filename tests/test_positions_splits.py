import pytest
from pyspark.sql import functions as F

from tokenloom.functions.order import ordkey
from tokenloom.operators import positions as P
from tokenloom.operators import splits as S


def test_shuffled_positions_are_the_global_order(spark):
    rows = P.shuffled_positions(spark.range(1000).repartition(7), ["id"], 7, total="n").withColumn("o", ordkey(7, "id")).collect()
    ordered = sorted(rows, key=lambda r: (r.o, r.id))
    assert [r.pos for r in ordered] == list(range(1000))
    assert {r.n for r in rows} == {1000}


def test_shuffled_positions_between_two_borders(spark):
    ordered = [r.id for r in spark.range(5000).orderBy(ordkey(7, "id"), "id").collect()]
    df = spark.range(5000).repartition(7)
    for since, below in ((0, 5), (1200, 1300), (4990, 9000), (5000, 6000)):
        placed = P.shuffled_positions(df, ["id"], 7, below=below, since=since)
        assert [(r.pos, r.id) for r in placed.orderBy("pos").collect()] == list(enumerate(ordered))[since:below]
        assert placed.columns == ["id", "pos"]
    grouped = spark.range(600).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    whole = P.shuffled_positions(grouped, ["id"], 7, group=["g"]).where("pos >= 50 and pos < 60")
    some = P.shuffled_positions(grouped, ["id"], 7, group=["g"], below=60, since=50)
    assert some.count() == 30 and sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


def test_key_positions_with_clustered_keys(spark):
    ids = [*range(500), *[10**15 + 3 * i for i in range(300)], -(10**12)]
    df = spark.createDataFrame([(i,) for i in ids], "k bigint").repartition(5)
    rows = sorted(P.key_positions(df, "k").collect(), key=lambda r: r.k)
    assert [r.pos for r in rows] == list(range(len(ids)))


def test_sampled_edges_do_not_change_positions(spark, monkeypatch):
    monkeypatch.setattr(P, "EDGE_ROWS", 50)
    rows = sorted(P.key_positions(spark.range(2000).repartition(6), "id").collect(), key=lambda r: r.id)
    assert [r.pos for r in rows] == list(range(2000))


def test_positions_in_a_hot_group(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"))
    rows = P.key_positions(df, "id", group=["g"], total="n").collect()
    for group in {r.g for r in rows}:
        part = sorted((r for r in rows if r.g == group), key=lambda r: r.id)
        assert [r.pos for r in part] == list(range(len(part)))
        assert {r.n for r in part} == {len(part)}


def test_weighted_positions_sum_the_weights_before(spark):
    df = spark.range(200).withColumn("w", F.col("id") % 5)
    rows = sorted(P.key_positions(df, "id", weight=F.col("w")).collect(), key=lambda r: r.id)
    at = 0
    for r in rows:
        assert r.pos == at
        at += r.w


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(500)
    first = S.split_exact(df, ["id"], 100).collect()
    again = S.split_exact(df.repartition(3), ["id"], 100).collect()
    assert sum(r.split == "valid" for r in first) == 100
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    report = S.split_report(df, S.split_exact(df, ["id"], 100), ["id"]).first()
    assert tuple(report) == (500, 0, 0, 0)


def test_split_needs_more_rows_than_the_validation_set(spark):
    with pytest.raises(Exception, match="cannot take 100 validation rows"):
        S.split_exact(spark.range(34), ["id"], 100).collect()


def test_large_samples_match_small_ones(spark, monkeypatch):
    df = spark.range(300)
    small = {r.id for r in S.sample_n(df, ["id"], 40).collect()}
    head = [r.id for r in S.take_n(df, ["id"], 25).collect()]
    monkeypatch.setattr(S, "TOP_N_ROWS", 5)
    assert {r.id for r in S.sample_n(df, ["id"], 40).collect()} == small
    assert sorted(r.id for r in S.take_n(df, ["id"], 25).collect()) == head == list(range(25))


def test_large_heads_take_any_order(spark):
    df = spark.range(2500).selectExpr("id % 7 AS a", "string(id) AS b")
    got = [tuple(r) for r in S.take_n(df, ["a", "b"], 1001).collect()]
    assert got == sorted(map(tuple, df.collect()))[:1001]
    assert len(S.take_n(df, ["b"], 1001).collect()) == 1001


def test_null_keys_and_groups_are_placed(spark):
    df = spark.createDataFrame([(None, "x")] + [(i, None if i % 2 else "x") for i in range(50)], "id bigint, g string")
    rows = sorted(P.key_positions(df, "id", total="n").collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(51)) and rows[0].id is None and rows[0].n == 51
    grouped = P.key_positions(df, "id", group=["g"]).collect()
    assert sorted(r.pos for r in grouped if r.g is None) == list(range(25)) and len(grouped) == 51
    assert len(P.key_positions(df.where("id IS NULL"), "id").collect()) == 1


def test_split_moves_no_rows(spark):
    plan = S.split_exact(spark.range(500), ["id"], 100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_percent_slice_rounds_the_count(spark):
    assert sorted(r.id for r in S.percent_slice(spark.range(130), "id", 5).collect()) == list(range(7))


def test_sampler_orders(spark):
    assert sorted(map(tuple, S.sampler(spark.range(10), "id").collect())) == [(i, i) for i in range(10)]
    random = S.sampler(spark.range(50), "id", True).collect()
    assert sorted(r.id for r in random) == sorted(r.pos for r in random) == list(range(50))
    assert any(r.id != r.pos for r in random)


def test_split_is_exact_where_keys_repeat(spark):
    # A hot key on a third of the rows, at the head of the hash order; NULL keys; rows that are equal as a whole.
    first = spark.range(20).orderBy(ordkey(42, "id"), "id").first().id
    for hot in (first, None):
        rows = [(hot if i % 3 == 0 else i % 20, i // 4, {"a": i // 4}) for i in range(300)]
        df = spark.createDataFrame(rows, "k bigint, v int, m map<string,int>")
        for n in (1, 30, 120, 299):
            got = S.split_exact(df, ["k"], n).collect()
            assert len(got) == 300 and sum(r.split == "valid" for r in got) == n
            assert sorted(str((r.k, r.v, r.m)) for r in got) == sorted(map(str, rows))
            again = S.split_exact(df.repartition(5), ["k"], n).collect()
            assert sorted(map(str, again)) == sorted(map(str, got))


def test_large_takes_are_cut_at_the_border(spark, monkeypatch):
    monkeypatch.setattr(S, "TOP_N_ROWS", 5)
    rows = [(i % 7 if i % 5 else None, f"k{i % 40:02d}" if i % 11 else None, i) for i in range(300)] + [(3, "k01", 500)] * 30
    df = spark.createDataFrame(rows, "a int, b string, id int").repartition(6)
    for order in (["a", "b"], ["b", "a"], ["b"], ["id"]):
        places = [df.columns.index(name) for name in order]
        want = sorted(([row[i] for i in places] for row in rows), key=lambda v: [(x is not None, x if x is not None else "") for x in v])
        for n in (6, 90, 329, 400):
            got = S.take_n(df, order, n)
            assert got.columns == df.columns
            found = sorted(([r[name] for name in order] for r in got.collect()), key=lambda v: [(x is not None, x if x is not None else "") for x in v])
            assert found == want[:n]


def test_large_samples_shuffle_the_head_only(spark, monkeypatch):
    df = spark.range(5000)
    want = [r.id for r in df.withColumn("o", ordkey(42, "id")).orderBy("o", "id").limit(700).collect()]
    monkeypatch.setattr(S, "TOP_N_ROWS", 5)
    assert sorted(r.id for r in S.sample_n(df, ["id"], 700).collect()) == sorted(want)
    assert S.sample_n(df, ["id"], 6000).count() == 5000
    assert sorted(r.id for r in S.percent_slice(df, "id", 2.5).collect()) == list(range(125))


def test_positions_of_rows_that_share_keys(spark):
    df = spark.createDataFrame([(1, i) for i in range(20)] + [(None, i) for i in range(20)], "k int, row int")
    placed = P.shuffled_positions(df, ["k"], ties=["row"]).collect()
    assert sorted(r.pos for r in placed) == list(range(40))
