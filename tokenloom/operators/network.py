"""A ReLU network trained data-parallel: tasks turn Arrow blocks into partial gradients, which a tree of tasks adds up."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.optimizers import Gradients

#: Partial sums that one task of the tree adds.
FAN = 16


def weight_count(layers: Sequence[int]) -> int:
    return sum((a + 1) * b for a, b in zip(layers, layers[1:]))


def start_weights(layers: Sequence[int]) -> np.ndarray:
    """Repeatable small weights, zero biases."""
    parts = []
    for a, b in zip(layers, layers[1:]):
        i, j = np.arange(a)[:, None], np.arange(b)[None, :]
        parts += [((((i * 131 + j * 17 + 7) % 101) / 101.0 - 0.5) * 2.0 / np.sqrt(a)).reshape(-1), np.zeros(b)]
    return np.concatenate(parts)


def unpack(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, bias) of every layer from the flat weights."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += (a + 1) * b
    return out


def forward(x: np.ndarray, weights: np.ndarray, layers: Sequence[int]) -> list[np.ndarray]:
    """Inputs of every layer and the class shares at the end."""
    held = [x]
    parts = unpack(weights, layers)
    for i, (matrix, bias) in enumerate(parts):
        x = x @ matrix + bias
        if i < len(parts) - 1:
            x = np.maximum(x, 0.0)
        held.append(x)
    powers = np.exp(held[-1] - held[-1].max(axis=1, keepdims=True))
    held[-1] = powers / powers.sum(axis=1, keepdims=True)
    return held


def backward(x: np.ndarray, classes: np.ndarray, weights: np.ndarray, layers: Sequence[int]) -> tuple[np.ndarray, float]:
    """Sums over rows of the gradient of the cross entropy, and of the cross entropy."""
    held = forward(x, weights, layers)
    rows, parts = np.arange(len(x)), unpack(weights, layers)
    loss = float(-np.log(held[-1][rows, classes]).sum())
    slope = held[-1].copy()
    slope[rows, classes] -= 1.0
    out = []
    for (matrix, _), entering in zip(reversed(parts), reversed(held[:-1])):
        out = [(entering.T @ slope).reshape(-1), slope.sum(axis=0), *out]
        slope = (slope @ matrix.T) * (entering > 0)
    return np.concatenate(out), loss


def vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def _sums(micro: list[int], sums: list[np.ndarray]) -> pa.RecordBatch:
    arrays = [pa.array(micro, pa.int64()), pa.array([value.tobytes() for value in sums], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["micro", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for micro, packed in zip(batch.column("micro").to_pylist(), batch.column("sums").to_pylist()):
            values = np.frombuffer(packed)
            total[micro] = total[micro] + values if micro in total else values
    if total:
        yield _sums(list(total), list(total.values()))


def network_gradients(layers: Sequence[int], vec: str, target: str) -> Gradients:
    """Gradients of a classifier with ReLU layers; ``target`` numbers the classes from 0.

    A task gives one partial sum a micro-batch; each round of the tree adds up to FAN of them, so no task and not the
    driver gets more than that many. What is held is a vector as long as the weights a micro-batch of the step.
    """
    def of(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                x = vectors(batch.column(vec), layers[0])
                classes, micro = batch.column(target).to_numpy(), batch.column("micro").to_numpy()
                for number in np.unique(micro).tolist():
                    own = micro == number
                    gradient, loss = backward(x[own], classes[own], weights, layers)
                    values = np.concatenate([gradient, [loss, float(own.sum())]])
                    total[number] = total[number] + values if number in total else values
            if total:
                yield _sums(list(total), list(total.values()))

        parts = rows.select(vec, F.col(target).cast("int").alias(target), "micro").mapInArrow(partial, "micro bigint, sums binary")
        count = rows.rdd.getNumPartitions()
        while count > 1:
            count = -(-count // FAN)
            numbered = parts.withColumn("_to", F.spark_partition_id() % count)
            parts = numbered.repartition(count, "_to").mapInArrow(_added, "micro bigint, sums binary")
        found = sorted((row.micro, np.frombuffer(row.sums)) for row in parts.collect())
        table = np.array([values[:-1] / values[-1] for _, values in found])
        return table[:, :-1], table[:, -1]

    return of


def classify(df: DataFrame, vec: str, weights: np.ndarray, layers: Sequence[int], classes: Sequence[int]) -> DataFrame:
    """Add ``pred`` (the value of the most likely class, the first of equals) and ``confidence`` (its share)."""
    names = np.array(list(classes), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = forward(vectors(batch.column(vec), layers[0]), weights, layers)[-1]
            best = shares.argmax(axis=1)
            arrays = [pa.array(names[best]), pa.array(shares[np.arange(len(best)), best])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "pred", "confidence"])

    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema.fields)
    return df.mapInArrow(run, f"{schema}, pred bigint, confidence double")
