"""Causal attention over whole sequences, block against block.

A group of rows is cut into sequences of the model's context length, and a sequence into blocks of
``BLOCK`` rows. Each block of queries meets the blocks of keys and values up to its own, one after the
other, and keeps per query and head the largest score, the sum of the powers and the weighted vector;
these three merge over any blocks, so neither a row of scores nor a sequence has to fit a task. All heads
of a block are one matrix product. The rows are shuffled twice: into blocks, and to the query blocks that need them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.positions import key_positions

#: Rows of a sequence, unless a caller says otherwise, and of a block.
CONTEXT = 2_048
BLOCK = 128


def sequences(df: DataFrame, group: str, key: str, context: int = CONTEXT) -> DataFrame:
    """Add ``seq`` (number of the sequence in the group), ``p`` (position in it) and ``seq_rows`` (its length)."""
    placed = key_positions(df, key, "_pos", "_size", group=[group])
    return (
        placed.withColumn("seq", F.floor(F.col("_pos") / context).cast("bigint"))
        .withColumn("p", (F.col("_pos") % context).cast("int"))
        .withColumn("seq_rows", F.least(F.lit(context), F.col("_size") - F.col("seq") * context).cast("int"))
        .drop("_pos", "_size")
    )


def _dealt(df: DataFrame, keys: Sequence[str], block: int) -> DataFrame:
    """Rows (keys..., target, block, q, k, v): every block of queries with the blocks it sees, its own first."""
    held = F.sort_array(F.collect_list(F.struct("p", "q", "k", "v")))
    rows = df.withColumn("block", F.floor(F.col("p") / block).cast("int"))
    packed = rows.groupBy(*keys, "block").agg(held.alias("_rows"), F.max("seq_rows").alias("_size"))
    last = F.floor((F.col("_size") - 1) / block).cast("int")
    blocks = packed.withColumn("target", F.explode(F.sequence(F.col("block"), last)))
    # Only a block's own queries are needed; keys and values travel to every later block.
    q = F.when(F.col("target") == F.col("block"), F.col("_rows.q"))
    dealt = blocks.select(*keys, "target", "block", q.alias("q"), F.col("_rows.k").alias("k"), F.col("_rows.v").alias("v"))
    order = [*keys, "target"]
    return dealt.repartition(*order).sortWithinPartitions(*order, F.col("block").desc())


def matrices(column: pa.Array) -> list[np.ndarray | None]:
    """The (n, d) matrix of every row of a nested list column."""
    inner = column.flatten()
    flat = inner.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    table = flat.reshape(len(inner), flat.size // len(inner) if len(inner) else 0)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    parts = np.split(table, np.cumsum(lengths)[:-1])
    return [part if there else None for part, there in zip(parts, column.is_valid().to_pylist())]


class QueryBlock:
    """Queries of a block, all heads, with what they have gathered so far."""

    def __init__(self, q: np.ndarray, heads: int, kv_heads: int):
        self.rows, self.heads, self.share = len(q), heads, heads // kv_heads
        self.kv_heads = kv_heads
        size = q.shape[1] // heads
        # (kv head, query head of it, row, value): every key head meets its queries in one product.
        self.q = q.reshape(self.rows, kv_heads, self.share, size).transpose(1, 2, 0, 3) / np.sqrt(size)
        self.peak = np.full((kv_heads, self.share, self.rows), -np.inf)
        self.whole = np.zeros((kv_heads, self.share, self.rows))
        self.out: np.ndarray | None = None

    def scores(self, k: np.ndarray, own: bool) -> np.ndarray:
        """(kv head, query head, row, key); a later key of the own block has no score."""
        keys = k.reshape(len(k), self.kv_heads, -1).transpose(1, 2, 0)
        found = self.q @ keys[:, None]
        if own:
            found[..., np.triu(np.ones((self.rows, len(k)), bool), 1)] = -np.inf
        return found

    def merge(self, scores: np.ndarray, v: np.ndarray) -> None:
        """Add a block's scores and values to what is gathered."""
        peak = np.maximum(self.peak, scores.max(axis=-1))
        keep, powers = np.exp(self.peak - peak), np.exp(scores - peak[..., None])
        part = powers @ v.reshape(len(v), self.kv_heads, -1).transpose(1, 0, 2)[:, None]
        self.out = part if self.out is None else self.out * keep[..., None] + part
        self.whole = self.whole * keep + powers.sum(axis=-1)
        self.peak = peak

    def flat(self, values: np.ndarray) -> np.ndarray:
        """(row, head...) of values that have the heads first."""
        return np.moveaxis(values.reshape(self.heads, *values.shape[2:]), 0, 1)

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the heads' outputs side by side, their largest scores and their sums of powers."""
        out = self.out / self.whole[..., None]
        return self.flat(out).reshape(self.rows, -1), self.flat(self.peak), self.flat(self.whole)


def _lists(table: np.ndarray) -> pa.Array:
    """A list column from the rows of a matrix."""
    offsets = np.arange(0, table.size + 1, table.shape[1] or 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(table).reshape(-1)))


def _walk(batches: Iterator[pa.RecordBatch], heads: int, kv_heads: int):
    """(key values, target, block, queries, scores, values, whether the block is the queries' own), in order."""
    queries = None
    for batch in batches:
        names = [name for name in batch.schema.names if name not in ("target", "block", "q", "k", "v")]
        columns = zip(*(matrices(batch.column(name)) for name in ("q", "k", "v")))
        places = zip(batch.column("target").to_pylist(), batch.column("block").to_pylist())
        for i, ((q, k, v), (target, block)) in enumerate(zip(columns, places)):
            own = target == block
            if own:
                queries = QueryBlock(q, heads, kv_heads)
            yield [batch.column(name).slice(i, 1) for name in names], names, target, block, queries, queries.scores(k, own), v, own


def _repeat(values: list[pa.Array], count: int) -> list[pa.Array]:
    return [value.take(pa.array(np.zeros(count, np.int64))) for value in values]


def attend(df: DataFrame, keys: Sequence[str], heads: int = 1, kv_heads: int = 1, block: int = BLOCK) -> DataFrame:
    """Rows (keys..., p, out, peak, whole) from (keys..., p, seq_rows, q, k, v).

    ``out`` holds the heads' outputs side by side, ``peak`` and ``whole`` the largest score and the sum of the powers of each.
    """
    dealt = _dealt(df, keys, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None

        def rows() -> pa.RecordBatch:
            values, names, target, queries = done
            out, peak, whole = queries.results()
            place = pa.array(np.arange(queries.rows, dtype=np.int32) + np.int32(target * block))
            arrays = [*_repeat(values, queries.rows), place, _lists(out), _lists(peak), _lists(whole)]
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "p", "out", "peak", "whole"])

        for values, names, target, _, queries, scores, v, own in _walk(batches, heads, kv_heads):
            if own and done:
                yield rows()
            queries.merge(scores, v)
            done = (values, names, target, queries)
        if done:
            yield rows()

    columns = [f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keys]
    return dealt.mapInArrow(run, ", ".join([*columns, "p int, out array<double>, peak array<double>, whole array<double>"]))


def score_rows(df: DataFrame, keys: Sequence[str], heads: int = 1, kv_heads: int = 1, block: int = BLOCK) -> DataFrame:
    """Rows (keys..., p, head, first, scores): a query's scores with the rows ``first``, ``first`` + 1 and so on of one block."""
    dealt = _dealt(df, keys, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, names, target, at, queries, scores, _, own in _walk(batches, heads, kv_heads):
            table = queries.flat(scores)  # (row, head, key)
            rows, _, width = table.shape
            lengths = np.repeat(np.arange(1, rows + 1), heads) if own else np.full(rows * heads, width)
            ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            held = pa.ListArray.from_arrays(ends, pa.array(table.reshape(-1, width)[np.arange(width) < lengths[:, None]]))
            place = np.repeat(np.arange(rows, dtype=np.int32) + np.int32(target * block), heads)
            head = np.tile(np.arange(heads, dtype=np.int32), rows)
            first = np.full(rows * heads, at * block, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*_repeat(values, rows * heads), pa.array(place), pa.array(head), pa.array(first), held], names=[*names, "p", "head", "first", "scores"]
            )

    columns = [f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keys]
    return dealt.mapInArrow(run, ", ".join([*columns, "p int, head int, first int, scores array<double>"]))


def weight_rows(df: DataFrame, keys: Sequence[str], heads: int = 1, kv_heads: int = 1, block: int = BLOCK) -> DataFrame:
    """``score_rows`` with ``weights``, the softmax over all scores of a query, in place of the scores."""
    totals = attend(df, keys, heads, kv_heads, block).select(*keys, "p", "peak", "whole")
    totals = totals.toDF(*[f"_at_{name}" if name in (*keys, "p") else name for name in totals.columns])
    same = F.lit(True)
    for name in (*keys, "p"):
        same = same & F.col(name).eqNullSafe(F.col(f"_at_{name}"))
    pieces = score_rows(df, keys, heads, kv_heads, block).join(totals, same)
    peak, whole = F.get("peak", F.col("head")), F.get("whole", F.col("head"))
    return pieces.select(*keys, "p", "head", "first", F.transform("scores", lambda s: F.exp(s - peak) / whole).alias("weights"))


def head_outputs(df: DataFrame, keys: Sequence[str], heads: int) -> DataFrame:
    """Rows (keys..., p, head, out) from the side-by-side outputs of ``attend``."""
    size = F.floor(F.size("out") / heads).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(heads - 1)), lambda h: F.slice("out", h * size + 1, size))
    # Outer, because a plain explode adds a filter that would run the Python step twice.
    return df.select(*keys, "p", F.posexplode_outer(parts).alias("head", "out"))
