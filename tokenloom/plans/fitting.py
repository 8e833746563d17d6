"""Training queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions.order import ordkey
from tokenloom.operators import optimizers as O
from tokenloom.operators import training as T
from tokenloom.operators.network import classify, network_gradients, start_weights
from tokenloom.plans.registry import CELLS_SQL, SEED, embeddings, query, r6, sql_r6
from tokenloom.session import new_path, spread
from tokenloom.sources.readers import read_table
from tokenloom.sources.writers import SnapshotStore

FEATURES, TARGET, RATE = ["x1", "x2", "x3"], "y", 0.2
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
STEPS = 4
VALID_TENTHS = 1
WEIGHTS = [f"w{i}" for i in range(len(FEATURES) + 1)]


def fit_rows(spark, folder):
    """Scaled regression rows of the line items and the columns that identify a row."""
    items = spread(read_table(spark, folder, "lineitem"), *ROW_KEY)
    rows = items.select(
        *ROW_KEY,
        (F.col("l_quantity") / 50.0).alias("x1"),
        (F.col("l_discount") * 10.0).alias("x2"),
        (F.col("l_tax") * 10.0).alias("x3"),
        (F.col("l_extendedprice") / 100000.0).alias("y"),
    )
    return rows, ROW_KEY


def held_out():
    """About a tenth of the rows, by hash."""
    return F.conv(F.substring(ordkey("valid", *ROW_KEY), 1, 8), 16, 10).cast("bigint") % 10 < VALID_TENTHS


_HASH = "('0x' || substr(md5(concat_ws(':', {seed}, l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8))::BIGINT"
_ERROR = "(s.w3 + f.x1 * s.w0 + f.x2 * s.w1 + f.x3 * s.w2 - f.y)"


def fit_sql(epochs: int, steps: int, where: str = "true") -> str:
    """CTEs ``s0`` ... with the weights after every step of gradient descent."""
    source = f"""fit_all AS MATERIALIZED (
      SELECT *, l_quantity / 50.0 AS x1, l_discount * 10.0 AS x2, l_tax * 10.0 AS x3, l_extendedprice / 100000.0 AS y,
             {_HASH.format(seed="'valid'")} % 10 < {VALID_TENTHS} AS held_out FROM lineitem),
    fit AS MATERIALIZED (SELECT * FROM fit_all WHERE {where})"""
    parts = [source, "s0 AS MATERIALIZED (SELECT " + ", ".join(f"0.0::DOUBLE AS {w}" for w in WEIGHTS) + ")"]
    for done in range(epochs * steps):
        epoch, step = divmod(done, steps)
        inputs = ["f.x1", "f.x2", "f.x3", "1.0"]
        new = ", ".join(
            f"any_value(s.{w}) - {RATE} * 2.0 * sum({_ERROR} * {x}) / count(*) AS {w}" for w, x in zip(WEIGHTS, inputs)
        )
        deal = f"{_HASH.format(seed=SEED + epoch)} % {steps} = {step}"
        parts.append(f"s{done + 1} AS MATERIALIZED (SELECT {new} FROM fit f, s{done} s WHERE {deal})")
    return ",\n".join(parts)


def weights_sql(step: int, extra: str = "") -> str:
    return "SELECT " + ", ".join(f"{sql_r6(w)} AS {w}" for w in WEIGHTS) + f"{extra} FROM s{step}"


def weights_row(spark, weights, **extra):
    values = {**{n: round(float(w), 6) for n, w in zip(WEIGHTS, weights)}, **extra}
    return spark.createDataFrame([values]).select(*[F.col(c) for c in values])


@query("sgd_linear", f"WITH {fit_sql(2, STEPS)} " + weights_sql(2 * STEPS))
def sgd_linear(spark, folder):
    rows, keys = fit_rows(spark, folder)
    return weights_row(spark, T.sgd_linear(rows, FEATURES, TARGET, keys, RATE, 2, STEPS, SEED))


@query("resume_training", f"WITH {fit_sql(3, STEPS)} " + weights_sql(3 * STEPS, ", true AS same_as_unbroken"))
def resume_training(spark, folder):
    rows, keys = fit_rows(spark, folder)
    store = SnapshotStore(spark, new_path(spark, "resume"), 2)
    T.sgd_linear(rows, FEATURES, TARGET, keys, RATE, 1, STEPS, SEED, store)
    resumed = T.sgd_linear(rows, FEATURES, TARGET, keys, RATE, 3, STEPS, SEED, store)
    unbroken = T.sgd_linear(rows, FEATURES, TARGET, keys, RATE, 3, STEPS, SEED)
    same = all(abs(a - b) < 1e-9 for a, b in zip(resumed, unbroken))
    return weights_row(spark, resumed, same_as_unbroken=same)


MAX_STEPS, EVAL_EVERY = 7, 2


@query(
    "eval_schedule",
    f"WITH {fit_sql(2, STEPS, 'NOT held_out')} "
    + " UNION ALL ".join(
        f"SELECT {k} AS step, {sql_r6(f'avg({_ERROR} * {_ERROR})')} AS valid_loss FROM fit_all f, s{k} s WHERE held_out"
        for k in range(EVAL_EVERY, MAX_STEPS + 1, EVAL_EVERY)
    ),
)
def eval_schedule(spark, folder):
    rows, keys = fit_rows(spark, folder)
    metrics = T.train_with_eval(
        rows.where(~held_out()), rows.where(held_out()), FEATURES, TARGET, keys, RATE, MAX_STEPS, EVAL_EVERY, STEPS, SEED
    )
    return metrics.select("step", r6("valid_loss").alias("valid_loss"))


BATCH, ACCUMULATE, ADAM_STEPS, BROKEN_AT = 2048, 2, 6, 3
ADAM = O.AdamW(rate=0.1, decay=0.1, warmup=2, total=ADAM_STEPS + 2, clip=0.5)


def moved_sql(step: int, how: O.AdamW) -> tuple[str, str, str]:
    """Expressions of the new mean, square and weight from columns w, m, v and the clipped gradient g."""
    mean = f"({how.beta1} * m + {1 - how.beta1!r} * g)"
    square = f"({how.beta2} * v + {1 - how.beta2!r} * g * g)"
    rate = repr(how.rate_at(step))
    move = f"({mean} / {1 - how.beta1**step!r}) / (sqrt({square} / {1 - how.beta2**step!r}) + {how.eps!r})"
    return mean, square, f"(w - {rate} * {how.decay} * w - {rate} * {move})"


def dealt_sql(step: int, source: str, key: str, order: str, per_step: int, batch: int) -> str:
    """Rows of ``source`` that step ``step`` (from 0) uses, with ``micro``; each epoch has its own order."""
    epochs = f"(SELECT {step} // ceil(count(*) / {per_step}.0)::BIGINT FROM {source})"
    place = f"(SELECT {step} % ceil(count(*) / {per_step}.0)::BIGINT FROM {source})"
    return f"""(SELECT *, pos // {batch} AS micro FROM (
      SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', {SEED} + {epochs}, {key})), {order}) - 1 AS pos FROM {source}) WHERE pos // {per_step} = {place})"""


def adam_sql(steps: int) -> str:
    """CTEs ``a1`` ...: rows (i, w, m, v, g, loss, norm) after every step, a row a weight."""
    keys = ", ".join(ROW_KEY)
    parts = [
        "adam_rows AS MATERIALIZED (SELECT *, l_quantity / 50.0 AS x1, l_discount * 10.0 AS x2, l_tax * 10.0 AS x3, l_extendedprice / 100000.0 AS y FROM lineitem)",
        f"a0 AS MATERIALIZED (SELECT unnest(range({len(WEIGHTS)})) AS i, 0.0::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v)",
    ]
    for step in range(1, steps + 1):
        weight = [f"(SELECT w FROM a{step - 1} WHERE i = {i})" for i in range(len(WEIGHTS))]
        error = f"({weight[3]} + x1 * {weight[0]} + x2 * {weight[1]} + x3 * {weight[2]} - y)"
        mean, square, moved = moved_sql(step, ADAM)
        per_micro = ", ".join(f"avg(2.0 * e * {x}) AS g{i}" for i, x in enumerate(["x1", "x2", "x3", "1.0"]))
        norm = "sqrt(" + " + ".join(f"avg(g{i}) * avg(g{i})" for i in range(len(WEIGHTS))) + ")"
        parts += [
            f"""e{step} AS MATERIALIZED (SELECT micro, {per_micro}, avg(e * e) AS loss FROM (
              SELECT *, {error} AS e FROM {dealt_sql(step - 1, 'adam_rows', keys, keys, BATCH * ACCUMULATE, BATCH)}) GROUP BY micro)""",
            f"""n{step} AS MATERIALIZED (SELECT unnest([{', '.join(f'avg(g{i})' for i in range(len(WEIGHTS)))}]) AS raw,
              unnest(range({len(WEIGHTS)})) AS i, {norm} AS norm, avg(loss) AS loss FROM e{step})""",
            f"""a{step} AS MATERIALIZED (SELECT i, {moved} AS w, {mean} AS m, {square} AS v, loss, norm FROM (
              SELECT a.*, n.loss, n.norm, n.raw * CASE WHEN n.norm > {ADAM.clip} THEN {ADAM.clip} / n.norm ELSE 1.0 END AS g
              FROM (SELECT i, w, m, v FROM a{step - 1}) a JOIN n{step} n ON n.i = a.i))""",
        ]
    return ",\n".join(parts)


def adam_fit(spark, folder, steps, store=None, on_step=None):
    rows, keys = fit_rows(spark, folder)
    gradients = O.linear_gradients(FEATURES, TARGET)
    return O.train(rows, [*FEATURES, TARGET], keys, gradients, [0.0] * len(WEIGHTS), ADAM, BATCH, ACCUMULATE, steps, SEED, store, on_step=on_step)


@query(
    "adamw_linear",
    f"WITH {adam_sql(ADAM_STEPS)} " + " UNION ALL ".join(
        f"SELECT {k} AS step, {sql_r6(repr(ADAM.rate_at(k)))} AS rate, {sql_r6('any_value(loss)')} AS loss, {sql_r6('any_value(norm)')} AS norm, "
        + ", ".join(f"{sql_r6(f'sum(w) FILTER (WHERE i = {i})')} AS {name}" for i, name in enumerate(WEIGHTS)) + f" FROM a{k}"
        for k in range(1, ADAM_STEPS + 1)
    ),
)
def adamw_linear(spark, folder):
    """Every step of a fit by mini-batches with accumulation, warm-up, decay and clipping."""
    steps = []
    adam_fit(spark, folder, ADAM_STEPS, on_step=lambda state, loss, norm: steps.append((state.step, ADAM.rate_at(state.step), loss, norm, *map(float, state.weights))))
    names = ["rate", "loss", "norm", *WEIGHTS]
    table = spark.createDataFrame(steps, "step int, " + ", ".join(f"{name} double" for name in names))
    return table.select("step", *[r6(name).alias(name) for name in names])


@query(
    "resume_adamw",
    f"WITH {adam_sql(ADAM_STEPS)} SELECT i, {sql_r6('w')} AS weight, {sql_r6('m')} AS mean, round(v, 9) + 0.0 AS square, true AS same_as_unbroken FROM a{ADAM_STEPS}",
)
def resume_adamw(spark, folder):
    """Weights and moments of a fit that was broken off and went on from its snapshot."""
    store = SnapshotStore(spark, new_path(spark, "resume-adamw"), 2)
    adam_fit(spark, folder, BROKEN_AT, store)
    resumed, unbroken = adam_fit(spark, folder, ADAM_STEPS, store), adam_fit(spark, folder, ADAM_STEPS)
    same = all(abs(a - b) < 1e-12 for a, b in zip(resumed.packed(), unbroken.packed()))
    rows = [(i, *map(float, values), same) for i, values in enumerate(zip(resumed.weights, resumed.mean, resumed.square))]
    table = spark.createDataFrame(rows, "i int, weight double, mean double, square double, same_as_unbroken boolean")
    return table.select("i", r6("weight").alias("weight"), r6("mean").alias("mean"), F.round("square", 9).alias("square"), "same_as_unbroken")


LAYERS, MLP_BATCH, MLP_ACCUMULATE, MLP_STEPS = [64, 12, 8, 10], 64, 2, 3
MLP_ADAM = O.AdamW(rate=0.05, decay=0.01, warmup=1, total=8, clip=1.0)


def forward_sql(name: str, source: str, state: str) -> str:
    """CTEs ``{name}0`` ...: (vec_id, i, x) entering every layer, -1 being the bias, and ``{name}p`` with the class shares."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT vec_id, k AS i, x FROM {source} UNION ALL SELECT DISTINCT vec_id, -1, 1.0 FROM {source})"]
    for layer in range(len(LAYERS) - 1):
        summed = f"SELECT a.vec_id, s.j AS i, sum(a.x * s.w) AS x FROM {name}{layer} a JOIN {state} s ON s.layer = {layer} AND s.i = a.i GROUP BY a.vec_id, s.j"
        if layer < len(LAYERS) - 2:
            parts.append(f"{name}{layer + 1} AS MATERIALIZED (SELECT vec_id, i, greatest(x, 0.0) AS x FROM ({summed}) UNION ALL SELECT DISTINCT vec_id, -1, 1.0 FROM {source})")
        else:
            parts.append(f"{name}p AS MATERIALIZED (SELECT vec_id, i AS j, exp(x) / sum(exp(x)) OVER (PARTITION BY vec_id) AS p FROM ({summed}))")
    return ",\n".join(parts)


def mlp_sql(steps: int) -> str:
    """CTEs of a network trained for ``steps`` steps; ``m{k}`` holds (layer, i, j, w, m, v), bias rows have i = -1."""
    first = " UNION ALL ".join(
        f"SELECT {layer} AS layer, i, j, CASE WHEN i < 0 THEN 0.0 ELSE (((i * 131 + j * 17 + 7) % 101) / 101.0 - 0.5) * 2.0 / sqrt({a}) END::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v "
        f"FROM (SELECT unnest(range(-1, {a})) AS i), (SELECT unnest(range({b})) AS j)"
        for layer, (a, b) in enumerate(zip(LAYERS, LAYERS[1:]))
    )
    parts = [
        CELLS_SQL, "classes AS MATERIALIZED (SELECT label, row_number() OVER (ORDER BY label) - 1 AS class FROM (SELECT DISTINCT label FROM embeddings))",
        "train AS MATERIALIZED (SELECT e.vec_id, c.class FROM embeddings e JOIN classes c USING (label))", f"m0 AS MATERIALIZED ({first})",
    ]
    last = len(LAYERS) - 2
    for step in range(1, steps + 1):
        deal = dealt_sql(step - 1, "train", "vec_id", "vec_id", MLP_BATCH * MLP_ACCUMULATE, MLP_BATCH)
        parts += [
            f"b{step} AS MATERIALIZED (SELECT *, 1.0 / count(*) OVER (PARTITION BY micro) / (SELECT count(DISTINCT micro) FROM {deal}) AS share FROM {deal})",
            f"c{step} AS MATERIALIZED (SELECT c.vec_id, c.k, c.x FROM cells c JOIN b{step} USING (vec_id))",
            forward_sql(f"f{step}_", f"c{step}", f"m{step - 1}"),
            f"d{step}_{last} AS MATERIALIZED (SELECT p.vec_id, p.j, (p.p - CASE WHEN p.j = b.class THEN 1.0 ELSE 0.0 END) AS x FROM f{step}_p p JOIN b{step} b USING (vec_id))",
        ]
        for layer in range(last, 0, -1):
            parts.append(
                f"""d{step}_{layer - 1} AS MATERIALIZED (SELECT d.vec_id, s.i AS j, sum(d.x * s.w) AS x FROM d{step}_{layer} d
                  JOIN m{step - 1} s ON s.layer = {layer} AND s.j = d.j AND s.i >= 0
                  JOIN f{step}_{layer} a ON a.vec_id = d.vec_id AND a.i = s.i AND a.x > 0 GROUP BY d.vec_id, s.i)"""
            )
        gradients = " UNION ALL ".join(
            f"SELECT {layer} AS layer, a.i, d.j, sum(d.x * a.x * b.share) AS raw FROM d{step}_{layer} d JOIN f{step}_{layer} a ON a.vec_id = d.vec_id JOIN b{step} b ON b.vec_id = d.vec_id GROUP BY a.i, d.j"
            for layer in range(last + 1)
        )
        mean, square, moved = moved_sql(step, MLP_ADAM)
        parts += [
            f"g{step} AS MATERIALIZED ({gradients})",
            f"""m{step} AS MATERIALIZED (SELECT layer, i, j, {moved} AS w, {mean} AS m, {square} AS v FROM (
              SELECT s.layer, s.i, s.j, s.w, s.m, s.v, coalesce(raw, 0.0) * (SELECT least(1.0, {MLP_ADAM.clip} / sqrt(sum(raw * raw))) FROM g{step}) AS g
              FROM m{step - 1} s LEFT JOIN g{step} g ON g.layer = s.layer AND g.i = s.i AND g.j = s.j))""",
        ]
    parts.append(forward_sql("out_", "cells", f"m{steps}"))
    return ",\n".join(parts)


def labelled_classes(rows):
    """The label values in order, and the rows with the place of theirs; labels are few."""
    labels = [row.label for row in rows.select("label").where("label IS NOT NULL").distinct().orderBy("label").collect()]
    return labels, rows.where("label IS NOT NULL").withColumn("class", F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1)


@query(
    "mlp_classifier",
    f"""WITH {mlp_sql(MLP_STEPS)} SELECT e.vec_id, e.label, c.label AS pred, {sql_r6('b.p')} AS confidence
        FROM (SELECT vec_id, j, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, j) AS place FROM out_p) b
        JOIN classes c ON c.class = b.j JOIN embeddings e USING (vec_id) WHERE b.place = 1""",
)
def mlp_classifier(spark, folder):
    """Class and its share by a network with two ReLU layers after the first steps of its training, which SQL follows."""
    labels, rows = labelled_classes(embeddings(spark, folder))
    gradients = network_gradients(LAYERS, "vec", "class")
    state = O.train(rows, ["vec", "class"], ["vec_id"], gradients, start_weights(LAYERS), MLP_ADAM, MLP_BATCH, MLP_ACCUMULATE, MLP_STEPS, SEED)
    scored = classify(embeddings(spark, folder), "vec", state.weights, LAYERS, labels)
    return scored.select("vec_id", "label", F.col("pred").cast("int").alias("pred"), r6("confidence").alias("confidence"))
