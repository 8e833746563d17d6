"""Training as Spark jobs: classifier, gradient descent, resume and evaluation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.order import ordkey
from tokenloom.session import new_path, stage
from tokenloom.sources.writers import SnapshotStore

# Up to this many steps every task may write a file of each step.
FEW_STEPS = 32


def mlp_classifier(train: DataFrame, vec: str, label: str, layers: Sequence[int], max_iter: int = 60, seed: int = 42):
    """Fit a network with two hidden layers and return the fitted pipeline."""
    network = MultilayerPerceptronClassifier(
        layers=list(layers), featuresCol="features", labelCol="target", maxIter=max_iter, seed=seed, solver="l-bfgs"
    )
    return Pipeline(stages=[network]).fit(as_features(train, vec, label))


def as_features(df: DataFrame, vec: str, label: str) -> DataFrame:
    return df.withColumns({"features": array_to_vector(F.col(vec).cast("array<double>")), "target": F.col(label).cast("double")})


def batch_of(seed: int, epoch: int, steps: int, keys: Sequence[str]) -> Column:
    """Step of the epoch that uses a row; a new deal every epoch."""
    return (F.conv(F.substring(ordkey(seed + epoch, *keys), 1, 8), 16, 10).cast("bigint") % steps).cast("int")


def predict(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Linear model; the last weight is the intercept."""
    result = F.lit(float(weights[-1]))
    for name, weight in zip(features, weights):
        result = result + F.col(name) * F.lit(float(weight))
    return result


def mean_squared_error(df: DataFrame, features: Sequence[str], target: str, weights: Sequence[float]) -> float:
    error = predict(features, weights) - F.col(target)
    return df.agg(F.avg(error * error)).first()[0]


def gradient_step(df: DataFrame, features: Sequence[str], target: str, weights: Sequence[float], rate: float) -> list[float]:
    """One step on the mean squared error: the tasks add up partial gradients, one row returns."""
    error = predict(features, weights) - F.col(target)
    sums = df.agg(F.count("*"), *[F.sum(error * F.col(f)) for f in features], F.sum(error)).first()
    if not sums[0]:
        return list(weights)
    return [w - rate * 2.0 * g / sums[0] for w, g in zip(weights, sums[1:])]


def sgd_linear(
    df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], rate: float, max_epochs: int,
    steps_per_epoch: int = 1, seed: int = 42, snapshots: SnapshotStore | None = None, save_every: int = 1,
    on_step: Callable[[int, list[float]], None] | None = None, max_steps: int | None = None,
) -> list[float]:
    """Data-parallel gradient descent. Continues after the newest snapshot when there is one.

    The needed columns are written once. Every epoch then deals its rows to the steps by a
    hash, a folder per step, so an epoch reads them once whatever its number of steps.
    """
    weights, first = [0.0] * (len(features) + 1), 0
    if snapshots and (found := snapshots.latest()):
        _, first, weights = found
    if first >= max_epochs:
        return weights
    rows = stage(df.select(*dict.fromkeys([*features, target, *keys])), "fit")
    for epoch in range(first, max_epochs):
        dealt = rows
        if steps_per_epoch > 1:
            dealt = rows.select(*features, target, batch_of(seed, epoch, steps_per_epoch, keys).alias("step"))
            path = new_path(df.sparkSession, "epoch")
            if steps_per_epoch > FEW_STEPS:
                # Keeps the number of files near the number of steps, and splits large ones.
                dealt = dealt.hint("rebalance", "step")
            dealt.write.partitionBy("step").parquet(path)
            dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
        for step in range(steps_per_epoch):
            done = epoch * steps_per_epoch + step
            if max_steps is not None and done >= max_steps:
                return weights
            batch = dealt.where(F.col("step") == step) if steps_per_epoch > 1 else dealt
            weights = gradient_step(batch, features, target, weights, rate)
            if on_step:
                on_step(done + 1, weights)
        if snapshots and epoch % save_every == 0:
            snapshots.save(epoch, epoch + 1, weights)
    return weights


def train_with_eval(
    train: DataFrame, valid: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], rate: float,
    max_steps: int, eval_every: int, steps_per_epoch: int, seed: int = 42,
) -> DataFrame:
    """Metrics table (step, valid_loss): evaluated every ``eval_every`` steps up to ``max_steps``."""
    rows: list[tuple[int, float]] = []
    valid = stage(valid.select(*features, target), "valid")

    def evaluate(step: int, weights: list[float]) -> None:
        if step % eval_every == 0:
            rows.append((step, mean_squared_error(valid, features, target, weights)))

    epochs = -(-max_steps // steps_per_epoch)
    sgd_linear(train, features, target, keys, rate, epochs, steps_per_epoch, seed, on_step=evaluate, max_steps=max_steps)
    return train.sparkSession.createDataFrame(rows, "step int, valid_loss double")
