"""Matrix tables: rows (i, vec) or cells (i, j, v)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.vectors import mean, total
from tokenloom.operators.joins import lookup_join, salted_join
from tokenloom.session import stage

# Largest weight matrix (number of values) that travels to the executors.
MAX_LOCAL_WEIGHTS = 16_000_000


def cells(df: DataFrame, i: str, vec: str) -> DataFrame:
    """Cells (i, j, v) of a table of row vectors."""
    return df.select(F.col(i).alias("i"), F.posexplode(vec).alias("j", "v"))


def row_map(function: Callable[[np.ndarray], np.ndarray], size: int) -> Callable[[Column], Column]:
    """Column function that applies ``function`` to (rows, size) blocks of a vector column."""

    @F.arrow_udf("array<double>")
    def apply(column: pa.Array) -> pa.Array:
        block = column.flatten().to_numpy(zero_copy_only=False)
        if block.size != len(column) * size:
            raise ValueError(f"every vector must have {size} values")
        result = np.ascontiguousarray(function(block.reshape(len(column), size)), dtype=np.float64)
        offsets = np.arange(len(column) + 1, dtype=np.int32) * result.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(result.reshape(-1)))

    return apply


def matmul(vec: Column, weights: np.ndarray) -> Column:
    """Row vectors times a (size, m) weight matrix that is small enough to ship."""
    if weights.size > MAX_LOCAL_WEIGHTS:
        raise ValueError("weights too large to ship, use matmul_cells")
    return row_map(lambda block: block @ weights, weights.shape[0])(vec)


def matmul_cells(a: DataFrame, b: DataFrame, salts: int = 16) -> DataFrame:
    """Product of two cell tables, for a right side too large to ship.

    All of a column of ``a`` meets one row of ``b``; salting on the row spreads it.
    """
    left = a.select("i", F.col("j").alias("k"), F.col("v").alias("x"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("y"))
    met = salted_join(left, right, ["k"], ["i"], salts)
    return met.groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("v"))


def labelled_matrix(df: DataFrame, row: str, vec: str) -> tuple[list, np.ndarray]:
    """The values of ``row`` in order and the matrix of their vectors: class ``i`` of the matrix is the i-th value."""
    held = df.agg(F.sum(F.size(vec))).first()[0] or 0
    if held > MAX_LOCAL_WEIGHTS:
        raise ValueError(f"{held} weights are too many to ship")
    rows = sorted(df.select(row, vec).where(F.col(row).isNotNull()).collect(), key=lambda r: r[0])
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)


def class_of(label: Column, labels: Sequence) -> Column:
    """Place of a label among ``labels``; NULL for one that is not there."""
    return F.nullif(F.array_position(F.lit(list(labels)), label), F.lit(0)) - 1


def label_of(place: Column, labels: Sequence) -> Column:
    return F.get(F.lit(list(labels)), place)


def weights_matrix(df: DataFrame, row: str, vec: str) -> np.ndarray:
    """A small weight table as a matrix, rows in the order of ``row``; its size is checked first."""
    held = df.agg(F.sum(F.size(vec))).first()[0] or 0
    if held > MAX_LOCAL_WEIGHTS:
        raise ValueError(f"{held} weights are too many to ship")
    return np.array([r[1] for r in sorted(df.select(row, vec).collect(), key=lambda r: r[0])], dtype=np.float64)


def column_means(df: DataFrame, vec: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean per vector position: rows (by..., k, value)."""
    return df.select(*by, F.posexplode(vec).alias("k", "_x")).groupBy(*by, "k").agg(F.avg("_x").alias("value"))


def mean_vectors(df: DataFrame, vec: str, by: str) -> DataFrame:
    """Mean vector per group: rows (by, ``vec``). Only one number per group and position is collected."""
    per = column_means(df, vec, [by])
    ordered = F.sort_array(F.collect_list(F.struct("k", "value")))
    return per.groupBy(by).agg(ordered.alias("_cells")).select(by, F.col("_cells.value").alias(vec))


def with_mean_vector(df: DataFrame, key: str, vec: str, by: str, out: str) -> DataFrame:
    """Add the mean vector of the row's group. The group means are staged, so they are computed once."""
    means = stage(mean_vectors(df, vec, by).withColumnRenamed(vec, out), "means")
    return lookup_join(df, means, [by], [key], out)


def tensor_reduce(df: DataFrame, key: str, vec: str, how: str, dim: int | None, keepdim: bool = False) -> DataFrame:
    """Reduce a matrix table by ``mean``, ``sum``, ``min`` or ``max``.

    dim None gives one value, dim 0 one per column (k, value), dim 1 one per row
    (key, value); ``keepdim`` wraps each value in an array of one.
    """
    per_row = {"mean": mean, "sum": total, "min": F.array_min, "max": F.array_max}[how]
    over = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[how]
    if dim == 1:
        result = df.select(key, per_row(F.col(vec)).alias("value"))
    elif dim == 0:
        result = df.select(F.posexplode(vec).alias("k", "_x")).groupBy("k").agg(over("_x").alias("value"))
    elif how == "mean":
        sums = df.select(total(F.col(vec)).alias("_s"), F.size(vec).alias("_n"))
        result = sums.agg((F.sum("_s") / F.sum("_n")).alias("value"))
    else:
        result = df.select(per_row(F.col(vec)).alias("_x")).agg(over("_x").alias("value"))
    return result.withColumn("value", F.array("value")) if keepdim else result


def reduce_all(df: DataFrame, key: str, vec: str, hows: Sequence[str], width: int) -> DataFrame:
    """Rows (how, axis, at, value) of several reductions: over all cells, per column and per row.

    One pass aggregates all columns side by side, without a row per cell; the whole follows from the columns. Rows are a
    projection. Vectors must have ``width`` values.
    """
    over = {"mean": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    wrong = F.raise_error(F.concat(F.lit(f"expected a vector of {width} values, got "), F.size(vec).cast("string")))
    checked = df.withColumn(vec, F.when(F.size(vec) != width, wrong).otherwise(F.col(vec)))
    sums = checked.agg(F.count(vec).alias("_n"), *[F.array(*[over[how](F.get(vec, F.lit(i))) for i in range(width)]).alias(f"_{how}") for how in hows])

    def columns(how: str) -> Column:
        return F.transform(f"_{how}", lambda x: x / F.col("_n")) if how == "mean" else F.col(f"_{how}")

    def whole(how: str) -> Column:
        return {"mean": mean, "sum": total, "min": F.array_min, "max": F.array_max}[how](columns(how))

    listed = F.array(*[
        F.struct(F.lit(how).alias("how"), F.lit(axis).alias("axis"), (F.array(whole(how)) if axis == "all" else columns(how)).alias("values"))
        for how in hows for axis in ("all", "columns")
    ])
    flat = sums.where("_n > 0").select(F.explode(listed).alias("_r")).select("_r.how", "_r.axis", F.posexplode("_r.values").alias("_k", "value"))
    flat = flat.select("how", "axis", F.when(F.col("axis") == "all", -1).otherwise(F.col("_k")).cast("bigint").alias("at"), "value")
    per_row = {"mean": mean, "sum": total, "min": F.array_min, "max": F.array_max}
    own = F.array(*[F.struct(F.lit(how).alias("how"), per_row[how](F.col(vec)).alias("value")) for how in hows])
    rows = df.select(F.col(key).cast("bigint").alias("at"), F.explode_outer(own).alias("_r"))
    return flat.unionByName(rows.select("_r.how", F.lit("rows").alias("axis"), "at", "_r.value"))


def reshape(grid: DataFrame, columns: int, new_rows: int, new_columns: int, count: int | None = None) -> DataFrame:
    """View a cell table with ``columns`` columns as (new_rows, new_columns); -1 is inferred.

    The number of cells must match; it is counted unless ``count`` gives it.
    """
    if new_rows != -1 and new_columns == -1:
        raise ValueError("give the number of columns")
    place = F.col("i") * columns + F.col("j")
    moved = grid.select(
        F.floor(place / new_columns).cast("bigint").alias("i"), (place % new_columns).cast("int").alias("j"), "v"
    )
    count = grid.count() if count is None else count
    if count % new_columns or (new_rows != -1 and count != new_rows * new_columns):
        raise ValueError(f"{count} cells do not fit ({new_rows}, {new_columns})")
    return moved


def transpose(grid: DataFrame) -> DataFrame:
    """Swap the axes of a cell table; stays a projection because a new row may be unbounded."""
    return grid.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def permute(grid: DataFrame, axes: Sequence[str], order: Sequence[int]) -> DataFrame:
    """Reorder the axis columns of a cell table."""
    others = [c for c in grid.columns if c not in axes]
    return grid.select(*[F.col(axes[o]).alias(axes[n]) for n, o in enumerate(order)], *others)


def _inside(name: str, part: int | slice) -> Column:
    col = F.col(name)
    if isinstance(part, int):
        return col == part
    condition = F.lit(True)
    if part.start is not None:
        condition = condition & (col >= part.start)
    if part.stop is not None:
        condition = condition & (col < part.stop)
    return condition


def index_slice(grid: DataFrame, rows: int | slice = slice(None), columns: int | slice = slice(None)) -> DataFrame:
    """Cells in the slice, renumbered from 0; a single index drops its axis."""
    kept = grid.where(_inside("i", rows) & _inside("j", columns))
    for name, part in (("i", rows), ("j", columns)):
        if isinstance(part, int):
            kept = kept.drop(name)
        elif part.start:
            kept = kept.withColumn(name, F.col(name) - part.start)
    return kept


def assign_slice(grid: DataFrame, value: float, rows: int | slice = slice(None), columns: int | slice = slice(None)) -> DataFrame:
    """Cells with the slice set to ``value``."""
    return grid.withColumn("v", F.when(_inside("i", rows) & _inside("j", columns), F.lit(float(value))).otherwise(F.col("v")))


def add_axis(grid: DataFrame, name: str) -> DataFrame:
    return grid.select(F.lit(0).alias(name), *grid.columns)


def drop_axis(grid: DataFrame, name: str) -> DataFrame:
    """Remove an axis of length one; running it fails when the axis is longer."""
    long = F.raise_error(F.lit(f"axis {name} is longer than one"))
    first = grid.columns[0] if grid.columns[0] != name else grid.columns[1]
    kept = grid.withColumn(first, F.when(F.col(name) != 0, long).otherwise(F.col(first)))
    return kept.drop(name)


def score_matrix(df: DataFrame, vec: str, by: str) -> DataFrame:
    """Mean dot products between groups as cells (``by``, other, score), every pair of groups that there is.

    The mean over all pairs of rows equals the dot product of the group means, so no pair
    of rows is formed.
    """
    spread = mean_vectors(df, vec, by).select(by, F.posexplode(vec).alias("k", "x"))
    other = spread.select(F.col(by).alias("other"), "k", F.col("x").alias("y"))
    return spread.join(other, "k").groupBy(by, "other").agg(F.sum(F.col("x") * F.col("y")).alias("score"))


def batch_score(vec: Column, w1: np.ndarray, w3: np.ndarray, w2: np.ndarray) -> Column:
    """Gated feed-forward score of every row: (silu(x W1) * (x W3)) W2."""

    def forward(block: np.ndarray) -> np.ndarray:
        gate = block @ w1
        return ((gate / (1.0 + np.exp(-gate))) * (block @ w3)) @ w2

    return row_map(forward, w1.shape[0])(vec)


