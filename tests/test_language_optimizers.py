"""Follower model, optimiser and network against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tokenloom.functions.order import ordkey
from tokenloom.operators import language as L
from tokenloom.operators import network as N
from tokenloom.operators import optimizers as O
from tokenloom.sources.writers import SnapshotStore


def plain_probability(sequences, order, kinds, mass, context, token):
    """Probability of ``token`` after ``context`` (the ids before it, nearest last) by the definition."""
    counts = [Counter() for _ in range(order)]
    for ids in sequences:
        padded = [-1] * (order - 1) + ids
        for i in range(order - 1, len(padded)):
            for k in range(order):
                counts[k][tuple(padded[i - k : i + 1])] += 1
    p = (counts[0][(token,)] + 1) / (sum(counts[0].values()) + kinds)
    for k in range(1, order):
        before = tuple(context[len(context) - k :])
        whole = sum(n for gram, n in counts[k].items() if gram[:-1] == before)
        p = (counts[k][(*before, token)] + mass * p) / (whole + mass)
    return p


@pytest.mark.parametrize("order", [1, 2, 3])
def test_losses_against_the_definition(spark, order):
    draw = random.Random(order)
    seen = [[draw.randrange(6) for _ in range(draw.randrange(0, 9))] for _ in range(20)]
    asked = [[draw.randrange(8) for _ in range(draw.randrange(0, 7))] for _ in range(12)]
    labels = [[i if draw.random() < 0.6 else -100 for i in ids] for ids in asked]
    docs = spark.createDataFrame([(ids,) for ids in seen] + [(None,)], "ids array<int>").repartition(3)
    rows = spark.createDataFrame([(i if i else None, ids, lab) for i, (ids, lab) in enumerate(zip(asked, labels))] + [(99, None, None)], "key int, ids array<int>, labels array<int>")
    model = L.FollowerModel.fit(docs, "ids", kinds=9, order=order, mass=2.5)
    got = {(r.key or 0, r.pos): (r.id, r.loss) for r in model.token_losses(rows, ["key"], "ids", "labels").collect()}
    want = {}
    for i, (ids, lab) in enumerate(zip(asked, labels)):
        padded = [-1] * (order - 1) + ids
        for pos, label in enumerate(lab):
            if label != -100:
                p = plain_probability(seen, order, 9, 2.5, padded[pos : pos + order - 1], ids[pos])
                want[i, pos] = (ids[pos], -math.log(p))
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1]) for k in want)
    mean = {r.key or 0: r for r in L.masked_loss(model.token_losses(rows, ["key"], "ids", "labels"), ["key"]).collect()}
    for key in mean:
        losses = [loss for (k, _), (_, loss) in want.items() if k == key]
        assert mean[key].n_tokens == len(losses) and math.isclose(mean[key].perplexity, math.exp(sum(losses) / len(losses)))


def test_probabilities_of_all_ids_add_up(spark):
    docs = spark.createDataFrame([([1, 2, 3, 1, 2],), ([2, 2],)], "ids array<int>")
    model = L.FollowerModel.fit(docs, "ids", kinds=5, order=3)
    for context in ((1, 2), (4, 4), (-1, 1)):
        wanted = spark.createDataFrame([(*context, i) for i in range(5)], "c2 int, c1 int, id int")
        assert math.isclose(sum(math.exp(r.log_prob) for r in model.log_probabilities(wanted).collect()), 1.0)


def test_rates():
    how = O.AdamW(rate=2.0, warmup=4, total=12)
    assert [how.rate_at(s) for s in (1, 2, 4)] == [0.5, 1.0, 2.0]
    assert math.isclose(how.rate_at(8), 1.0) and math.isclose(how.rate_at(12), 0.0, abs_tol=1e-12) and how.rate_at(20) == how.rate_at(12)
    assert O.AdamW(rate=2.0).rate_at(500) == 2.0
    assert np.allclose(O.AdamW(1.0, clip=1.0).clipped(np.array([3.0, 4.0])), [0.6, 0.8])


def plain_linear(x, y, keys, how, batch, accumulate, steps, order_of):
    """The same training row by row: weights, moments and losses after every step."""
    w, m, v, out = np.zeros(x.shape[1] + 1), 0.0, 0.0, []
    per_step = batch * accumulate
    spe = -(-len(x) // per_step)
    for done in range(steps):
        epoch, at = divmod(done, spe)
        rows = order_of(epoch)[at * per_step : (at + 1) * per_step]
        gradients, losses = [], []
        for start in range(0, len(rows), batch):
            part = rows[start : start + batch]
            error = x[part] @ w[:-1] + w[-1] - y[part]
            gradients.append([*(2 * error[:, None] * x[part]).mean(axis=0), 2 * error.mean()])
            losses.append((error**2).mean())
        g = np.mean(gradients, axis=0)
        norm = np.sqrt((g**2).sum())
        g = g if norm <= how.clip else g * how.clip / norm
        m, v = how.beta1 * m + (1 - how.beta1) * g, how.beta2 * v + (1 - how.beta2) * g * g
        rate = how.rate_at(done + 1)
        w = w - rate * how.decay * w - rate * (m / (1 - how.beta1 ** (done + 1))) / (np.sqrt(v / (1 - how.beta2 ** (done + 1))) + how.eps)
        out.append((w, m, v, np.mean(losses), norm))
    return out


def test_training_follows_a_plain_loop_and_resumes(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(53, 2)), rng.normal(size=53)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(53)], "id int, a double, b double, y double").repartition(5)
    how = O.AdamW(rate=0.3, decay=0.2, warmup=2, total=9, clip=0.7)

    def order_of(epoch):
        return [r.id for r in df.select("id", ordkey(7 + epoch, "id").alias("o")).orderBy("o", "id").collect()]

    want = plain_linear(x, y, None, how, 10, 2, 7, order_of)
    monkeypatch.setattr(O, "DEALT_STEPS", 2)
    seen = []
    gradients = O.linear_gradients(["a", "b"], "y")
    store = SnapshotStore(spark, str(tmp_path / "snap"), 2)

    def run(steps, store=None):
        return O.train(df, ["a", "b", "y"], ["id"], gradients, [0.0] * 3, how, 10, 2, steps, seed=7, snapshots=store, on_step=lambda *s: seen.append(s))

    run(4, store)
    state = run(7, store)
    assert [s[0].step for s in seen] == [1, 2, 3, 4, 5, 6, 7]
    for (got, loss, norm), (w, m, v, want_loss, want_norm) in zip(seen, want):
        assert np.allclose(got.weights, w) and np.allclose(got.mean, m) and np.allclose(got.square, v)
        assert math.isclose(loss, want_loss) and math.isclose(norm, want_norm)
    whole = run(7)
    assert np.allclose(whole.packed(), state.packed(), rtol=0, atol=1e-12)
    # Micro-batches hold exactly their size; an epoch's last one what is left.
    sizes = []

    def watched(rows, weights):
        sizes.append([r["count"] for r in rows.groupBy("micro").count().orderBy("micro").collect()])
        return gradients(rows, weights)

    O.train(df, ["a", "b", "y"], ["id"], watched, [0.0] * 3, how, 10, 2, 4, seed=7)
    assert sizes == [[10, 10], [10, 10], [10, 3], [10, 10]]
    assert run(0).step == 0 and O.train(df.limit(0), ["a", "b", "y"], ["id"], gradients, [0.0] * 3, how, 10, 2, 4).step == 0


LAYERS = [6, 5, 4, 3]


def test_training_deals_only_the_rows_of_its_steps(spark, monkeypatch):
    """Of an epoch's rows only the range of the steps that run is asked for, so the rest is not shuffled."""
    asked, whole = [], O.shuffled_positions
    monkeypatch.setattr(O, "shuffled_positions", lambda *a, since=0, below=None, **b: asked.append((since, below)) or whole(*a, since=since, below=below, **b))
    monkeypatch.setattr(O, "DEALT_STEPS", 2)
    df = spark.range(100).selectExpr("id", "id / 100.0D AS a", "id / 50.0D AS y")
    O.train(df, ["a", "y"], ["id"], O.linear_gradients(["a"], "y"), [0.0] * 2, O.AdamW(rate=0.1), 10, 2, 8, seed=7)
    assert asked == [(0, 40), (40, 80), (80, 100), (0, 40), (40, 60)]


def test_gradient_of_the_network_by_differences():
    rng = np.random.default_rng(1)
    x, classes, w = rng.normal(size=(8, 6)), rng.integers(0, 3, 8), rng.normal(size=N.weight_count(LAYERS)) * 0.5
    gradient, loss = N.backward(x, classes, w, LAYERS)
    shares = N.forward(x, w, LAYERS)[-1]
    assert math.isclose(loss, -np.log(shares[np.arange(8), classes]).sum())
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-6
        slope = (N.backward(x, classes, w + step, LAYERS)[1] - N.backward(x, classes, w - step, LAYERS)[1]) / 2e-6
        assert math.isclose(slope, gradient[i], rel_tol=1e-4, abs_tol=1e-6)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_tree_of_partial_gradients(spark, parts):
    rng = np.random.default_rng(2)
    x, classes, micro = rng.normal(size=(90, 6)), rng.integers(0, 3, 90), np.arange(90) // 40
    w = N.start_weights(LAYERS)
    rows = spark.createDataFrame([(x[i].tolist(), int(classes[i]), int(micro[i])) for i in range(90)], "vec array<double>, y int, micro bigint").repartition(parts)
    gradients, losses = N.network_gradients(LAYERS, "vec", "y")(rows, w)
    for number in range(3):
        own = micro == number
        gradient, loss = N.backward(x[own], classes[own], w, LAYERS)
        assert np.allclose(gradients[number], gradient / own.sum()) and math.isclose(losses[number], loss / own.sum())


def test_network_learns_classes_apart(spark):
    """Three noisy classes with labels that are no places: over 95 percent of held-out rows come out right."""
    rng = np.random.default_rng(4)
    centres, names = rng.normal(size=(3, 6)) * 3, [5, 0, 70]
    classes = rng.integers(0, 3, 400)
    x = centres[classes] + rng.normal(size=(400, 6)) * 0.5
    df = spark.createDataFrame([(i, x[i].tolist(), int(classes[i])) for i in range(400)], "id int, vec array<double>, class int").repartition(4)
    how = O.AdamW(rate=0.05, warmup=3)
    state = O.train(df.where("id < 300"), ["vec", "class"], ["id"], N.network_gradients(LAYERS, "vec", "class"), N.start_weights(LAYERS), how, 50, 2, 15)
    scored = N.classify(df.where("id >= 300"), "vec", state.weights, LAYERS, names).collect()
    assert np.mean([r.pred == names[r["class"]] for r in scored]) > 0.95
    assert all(1 / 3 <= r.confidence <= 1 for r in scored)
    shares = N.forward(x[300:], state.weights, LAYERS)[-1]
    assert np.allclose(sorted(r.confidence for r in scored), np.sort(shares.max(axis=1)))
    assert N.classify(df.limit(0), "vec", state.weights, LAYERS, names).collect() == []
    assert scored[0].asDict().keys() == {"id", "vec", "class", "pred", "confidence"}
