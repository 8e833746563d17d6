"""Training by mini-batches: fixed batch size, accumulation, AdamW, warm-up and decay, clipping, snapshots with moments."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.positions import shuffled_positions
from tokenloom.operators.training import predict
from tokenloom.session import new_path, stage
from tokenloom.sources.writers import SnapshotStore

#: Steps whose rows are dealt and written together.
DEALT_STEPS = 64


@dataclass(frozen=True)
class AdamW:
    """Adam with decoupled weight decay; the rate rises over ``warmup`` steps and falls along a cosine to 0 at ``total``."""

    rate: float
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    decay: float = 0.01
    warmup: int = 0
    total: int | None = None
    clip: float | None = 1.0

    def rate_at(self, step: int) -> float:
        """Rate of a step; steps count from 1."""
        if step <= self.warmup:
            return self.rate * step / self.warmup
        if self.total is None:
            return self.rate
        done = (step - self.warmup) / max(1, self.total - self.warmup)
        return self.rate * 0.5 * (1.0 + math.cos(math.pi * min(1.0, done)))

    def clipped(self, gradient: np.ndarray) -> np.ndarray:
        norm = float(np.sqrt((gradient * gradient).sum()))
        return gradient if self.clip is None or norm <= self.clip else gradient * (self.clip / norm)


@dataclass
class State:
    """Weights and moments after ``step`` steps."""

    weights: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    step: int = 0

    @classmethod
    def start(cls, weights: np.ndarray) -> State:
        return cls(np.array(weights, float), np.zeros(len(weights)), np.zeros(len(weights)))

    def update(self, gradient: np.ndarray, how: AdamW) -> State:
        step, gradient = self.step + 1, how.clipped(gradient)
        mean = how.beta1 * self.mean + (1 - how.beta1) * gradient
        square = how.beta2 * self.square + (1 - how.beta2) * gradient * gradient
        rate = how.rate_at(step)
        move = (mean / (1 - how.beta1**step)) / (np.sqrt(square / (1 - how.beta2**step)) + how.eps)
        return State(self.weights - rate * how.decay * self.weights - rate * move, mean, square, step)

    def packed(self) -> list[float]:
        return np.concatenate([self.weights, self.mean, self.square]).tolist()

    @classmethod
    def unpacked(cls, values: Sequence[float], step: int) -> State:
        return cls(*np.split(np.array(values, float), 3), step)


#: Means of the gradient and the loss of every micro-batch of a step: (rows of the step with ``micro``, weights) to (gradients, losses).
Gradients = Callable[[DataFrame, np.ndarray], tuple[np.ndarray, np.ndarray]]


def linear_gradients(features: Sequence[str], target: str) -> Gradients:
    """Mean squared error of a linear model; the last weight is the intercept. Tasks add up, a row a micro-batch returns."""

    def of(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        error = predict(features, weights.tolist()) - F.col(target)
        means = [F.avg(error * F.col(name) * 2.0) for name in features] + [F.avg(error * 2.0), F.avg(error * error)]
        found = rows.groupBy("micro").agg(*[mean.alias(f"m{i}") for i, mean in enumerate(means)]).orderBy("micro").collect()
        table = np.array([list(row)[1:] for row in found])
        return table[:, :-1], table[:, -1]

    return of


def train(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], gradients: Gradients, start: Sequence[float], how: AdamW, batch_size: int,
    accumulate: int, max_steps: int, seed: int = 42, snapshots: SnapshotStore | None = None, save_every: int = 1,
    on_step: Callable[[State, float, float], None] | None = None,
) -> State:
    """Train on micro-batches of exactly ``batch_size`` rows (an epoch's last one may be shorter), ``accumulate`` of them a step.

    A step's gradient is the mean over its micro-batches. Each epoch has a seeded order of its own. Its rows get their
    exact positions ``DEALT_STEPS`` steps at a time: only the hash buckets that these steps touch are shuffled, and their needed
    columns are written in a folder per step, so only steps that run are written and a step reads its own rows. Continues after the newest snapshot, moments and all.
    ``keys`` identify a row. ``on_step`` gets the new state, the step's loss and the gradient's norm before clipping.
    """
    state = State.start(np.array(start, float))
    if snapshots and (found := snapshots.latest()):
        state = State.unpacked(found[2], found[0])
    if state.step >= max_steps:
        return state
    rows = stage(df.select(*dict.fromkeys([*columns, *keys])), "fit")
    count = rows.count()
    if not count:
        return state
    per_step = batch_size * accumulate
    steps_per_epoch = -(-count // per_step)
    dealt, held = None, range(0)
    while state.step < max_steps:
        epoch, at = divmod(state.step, steps_per_epoch)
        if state.step not in held:
            last = min(at + DEALT_STEPS, steps_per_epoch, at + max_steps - state.step)
            held = range(state.step, state.step + last - at)
            placed = shuffled_positions(rows, keys, seed + epoch, "_pos", below=last * per_step, since=at * per_step)
            placed = placed.select(*dict.fromkeys(columns), F.floor(F.col("_pos") / batch_size).alias("micro"), F.floor(F.col("_pos") / per_step).cast("int").alias("step"))
            path = new_path(df.sparkSession, "steps")
            placed.hint("rebalance", "step").write.partitionBy("step").parquet(path)
            dealt = df.sparkSession.read.schema(placed.schema).parquet(path)
        found, losses = gradients(dealt.where(F.col("step") == at).drop("step"), state.weights)
        gradient = found.mean(axis=0)
        state = state.update(gradient, how)
        if on_step:
            on_step(state, float(losses.mean()), float(np.sqrt((gradient * gradient).sum())))
        if snapshots and (state.step % save_every == 0 or state.step == max_steps):
            snapshots.save(state.step, epoch, state.packed())
    return state
