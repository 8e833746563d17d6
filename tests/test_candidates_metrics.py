import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import candidates as N
from tokenloom.operators import metrics as M

END = "<|end_of_text|>"


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(11)
    rows = [("hot", f"t{i}", rng.randrange(1, 50)) for i in range(300)]
    rows += [(f"c{i}", f"t{rng.randrange(40)}", rng.randrange(1, 9)) for i in range(60) for _ in range(4)]
    rows = [(c, t, w) for (c, t), w in {(c, t): w for c, t, w in rows}.items()]
    df = spark.createDataFrame(rows, "ctx string, token string, weight bigint").withColumn("score", F.log("weight"))
    return df.cache(), rows


def by_context(rows):
    groups = {}
    for ctx, token, weight in rows:
        groups.setdefault(ctx, []).append((-weight, token))
    return {c: [(t, -w) for w, t in sorted(v)] for c, v in groups.items()}


def test_followers(spark):
    df = spark.createDataFrame([("a b a b c",), ("a",), ("",)], "text string")
    got = {(r.ctx, r.token): r.weight for r in N.next_token_scores(df, end_token=END).collect()}
    assert got == {("a", "b"): 2, ("b", "a"): 1, ("b", "c"): 1, ("c", END): 1, ("a", END): 1}


def test_softmax_over_far_apart_scores(spark):
    values = {"x": [1000.0, 999.0, -1000.0], "y": [-2000.0, -2001.0], "z": [3.0]}
    df = spark.createDataFrame([(c, f"t{i}", v) for c, vs in values.items() for i, v in enumerate(vs)], "ctx string, token string, score double")
    got = {(r.ctx, r.token): r.prob for r in N.temperature(df, 0.5).collect()}
    for c, vs in values.items():
        e = np.exp((np.array(vs) - max(vs)) / 0.5)
        for i, p in enumerate(e / e.sum()):
            assert math.isclose(got[(c, f"t{i}")], p, rel_tol=1e-9, abs_tol=1e-300)


def test_top_k_and_top_p(scores):
    df, rows = scores
    kept = N.top_k(df, 10)
    groups = by_context(rows)
    assert {(r.ctx, r.token) for r in kept.collect()} == {(c, t) for c, v in groups.items() for t, _ in v[:10]}
    want = set()
    for c, v in groups.items():
        whole, run = sum(w for _, w in v[:10]), 0
        for t, w in v[:10]:
            if run < 0.6 * whole:
                want.add((c, t))
            run += w
    assert {(r.ctx, r.token) for r in N.top_p(kept, 0.6).collect()} == want


def test_greedy_takes_the_first_of_equals(scores):
    df, rows = scores
    assert {r.ctx: r.token for r in N.greedy(df).collect()} == {c: v[0][0] for c, v in by_context(rows).items()}


def test_penalty_divides_and_multiplies(spark):
    df = spark.createDataFrame([("c", "a", 2.0), ("c", "b", -2.0), ("c", "d", 1.0)], "ctx string, token string, score double")
    history = spark.createDataFrame([("c", "a"), ("c", "b"), ("c", "a")], "ctx string, token string")
    assert {r.token: r.score for r in N.repetition_penalty(df, history, 1.25).collect()} == {"a": 1.6, "b": -2.5, "d": 1.0}


def test_draws_follow_the_weights(scores):
    df, rows = scores
    kept = N.top_k(df.where("ctx = 'hot'"), 4)
    drawn = Counter(r.token for r in N.sample_candidates(kept, 4000, 1).collect())
    top = by_context(rows)["hot"][:4]
    assert sum(drawn.values()) == 4000
    for token, weight in top:
        assert abs(drawn[token] / 4000 - weight / sum(w for _, w in top)) < 0.04


def plain_greedy(groups, pieces, steps, penalty, min_length):
    seen, ctx, out = set(pieces), pieces[-1], []
    for step in range(steps):
        options = [(t, s) for t, s in groups.get(ctx, []) if t != END or len(pieces) + step >= min_length]
        adjusted = sorted((-(s / penalty if s > 0 else s * penalty) if t in seen or t in out else -s, t) for t, s in options)
        if not adjusted or adjusted[0][1] == END:
            break
        ctx = adjusted[0][1]
        out.append(ctx)
    return out


@pytest.mark.parametrize("penalty, min_length", [(1.0, 0), (3.0, 0), (3.0, 9)])
def test_generation_matches_a_plain_loop(spark, penalty, min_length):
    rng = random.Random(4)
    words = ["a", "b", "c", "d", "e"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 9))) for _ in range(40)]
    table = N.next_token_scores(spark.createDataFrame([(t,) for t in texts], "text string"), end_token=END)
    groups = {}
    for r in table.collect():
        groups.setdefault(r.ctx, []).append((r.token, r.score))
    prompts = [(i, " ".join(rng.choice([*words, "zz"]) for _ in range(rng.randrange(1, 7)))) for i in range(30)]
    df = spark.createDataFrame(prompts, "id bigint, text string")
    for prepared in (None, N.prepare_options(table, 2), N.prepare_options(table, 50)):
        got = N.generate(df, table, ["id"], "text", END, 6, min_length, k=1, penalty=penalty, stage_every=2, prepared=prepared).collect()
        for r in got:
            assert r.tokens == plain_greedy(groups, dict(prompts)[r.id].split(), 6, penalty, min_length)


def test_a_long_prompt_lengthens_only_its_own_lists(spark, monkeypatch):
    rng = random.Random(6)
    words = [a + b for a in "abcde" for b in "uvwxyz"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 12))) for _ in range(150)]
    table = N.next_token_scores(spark.createDataFrame([(t,) for t in texts], "text string"), end_token=END)
    groups = {}
    for r in table.collect():
        groups.setdefault(r.ctx, []).append((r.token, r.score))
    prompts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))) for i in range(20)] + [(20, " ".join(words * 2)), (21, "")]
    df = spark.createDataFrame(prompts, "id bigint, text string")
    lengths, plain = [], N.prepare_options

    def watched(scores, size):
        lengths.append(size)
        return plain(scores, size)

    monkeypatch.setattr(N, "prepare_options", watched)
    monkeypatch.setattr(N, "HISTORIES", (4, 16))
    for broadcast in (N.BROADCAST_OPTIONS, 0):
        monkeypatch.setattr(N, "BROADCAST_OPTIONS", broadcast)
        monkeypatch.setattr(N, "SALT_ROWS", 5)
        lengths.clear()
        got = N.generate(df, table, ["id"], "text", END, 4, k=1, penalty=3.0, stage_every=2).collect()
        assert sorted(lengths) == [1 + 3 + 4 + 1, 1 + 30 + 4 + 1]
        assert sorted(r.id for r in got) == list(range(22))
        for r in got:
            want = plain_greedy(groups, dict(prompts)[r.id].split(), 4, 3.0, 0) if r.id != 21 else []
            assert r.tokens == want


def test_pairs_are_counted_without_a_lambda(spark):
    rows = [("a b a b",), ("a",), ("",), (None,), ("b a b",)]
    table = N.next_token_scores(spark.createDataFrame(rows, "text string"), end_token=END)
    assert {(r.ctx, r.token): r.weight for r in table.collect()} == {("a", "b"): 3, ("b", "a"): 2, ("b", END): 2, ("a", END): 1}
    assert "lambda" not in table._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("lead", [0, 1, 15])
def test_a_pick_from_the_head_of_a_list_is_that_of_the_whole(spark, monkeypatch, lead):
    rng = random.Random(8)
    words = [a + b for a in "abcde" for b in "uvwxyz"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 30))) for _ in range(200)]
    table = N.next_token_scores(spark.createDataFrame([(t,) for t in texts], "text string"), end_token=END)
    groups = {}
    for r in table.collect():
        groups.setdefault(r.ctx, []).append((r.token, r.score))
    prompts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    df = spark.createDataFrame(prompts, "id bigint, text string")
    sampled = {}
    for head in (10**6, lead):
        monkeypatch.setattr(N, "LEAD", head)
        run = N.generate(df, table, ["id"], "text", END, 3, do_sample=True, heat=0.5, p=0.9, k=5, penalty=1.5)
        sampled[head] = {r.id: r.tokens for r in run.collect()}
    assert sampled[lead] == sampled[10**6]
    for r in N.generate(df, table, ["id"], "text", END, 4, k=1, penalty=1.5).collect():
        assert r.tokens == plain_greedy(groups, dict(prompts)[r.id].split(), 4, 1.5, 0)


def test_sampled_generation_is_repeatable_and_stays_in_the_nucleus(spark):
    df = spark.createDataFrame([("a b",)] * 6 + [("a c",)] * 3 + [("a d",)], "text string")
    table = N.next_token_scores(df, end_token=END)
    prompts = spark.range(400).withColumn("text", F.lit("a"))
    run = lambda: sorted((r.id, tuple(r.tokens)) for r in N.generate(prompts, table, ["id"], "text", END, 1, do_sample=True, p=0.85).collect())
    first = run()
    assert first == run()
    share = Counter(t for _, tokens in first for t in tokens)
    assert set(share) == {"b", "c"} and abs(share["b"] / 400 - 2 / 3) < 0.08


def test_percentiles_with_a_hot_value(spark):
    rng = random.Random(9)
    rows = [("g", 5.0)] * 500 + [("g", round(rng.uniform(0, 10), 2)) for _ in range(701)] + [("h", 1.0), ("h", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {(r.g, r.share): r.percentile for r in M.exact_percentiles(df, "g", "v", [0.0, 0.1, 0.5, 0.95, 1.0]).collect()}
    for group in ("g", "h"):
        values = [v for g, v in rows if g == group]
        for share in (0.0, 0.1, 0.5, 0.95, 1.0):
            assert math.isclose(got[(group, share)], np.quantile(values, share), abs_tol=1e-9)


def test_loss_weighs_batches_and_rows(spark):
    rows = [(0, 1, 1, 1.0), (0, 1, 0, 3.0), (1, 0, 0, 8.0)]
    r = M.eval_loss_accuracy(spark.createDataFrame(rows, "batch_id bigint, label int, pred int, loss double")).first()
    assert (r.row_count, r.batches, r.avg_loss_batches, r.avg_loss_rows) == (3, 2, 5.0, 4.0)
    assert math.isclose(r.accuracy, 200 / 3)


def test_model_comparison_ignores_case_and_blanks(spark):
    base = spark.createDataFrame([(1, "Yes", "no"), (2, "A", " a\n")], "id int, gold string, output string")
    tuned = spark.createDataFrame([(2, "A"), (1, "YES ")], "id int, output string")
    rates = M.match_rates(M.compare_models(base, tuned, ["id"])).first()
    assert (rates.row_count, rates.base_rate, rates.tuned_rate) == (2, 0.5, 1.0)
