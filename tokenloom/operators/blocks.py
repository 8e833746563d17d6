"""Matrices in dense blocks: rows (bi, bj, cols, block), the block's values packed row by row.

A product joins on the inner block number, multiplies block by block in Arrow batches and adds up, first what a task
has, then by target block. Blocks of rows that do not exist are zero and take no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.joins import salted_join
from tokenloom.operators.matrices import MAX_LOCAL_WEIGHTS, row_map
from tokenloom.session import stage

#: Rows and columns of a block.
SIZE = 256
#: Bytes of blocks that one side may have to be broadcast, and products a task adds up before it passes them on.
BROADCAST_BYTES = 128 << 20
HELD = 64

SCHEMA = "bi bigint, bj bigint, cols int, block binary"


def _batch(keys: list[tuple[int, int]], blocks: list[np.ndarray]) -> pa.RecordBatch:
    arrays = [
        pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([b.shape[1] for b in blocks], pa.int32()),
        pa.array([np.ascontiguousarray(b).tobytes() for b in blocks], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["bi", "bj", "cols", "block"])


def _dense(packed: bytes, cols: int) -> np.ndarray:
    return np.frombuffer(packed).reshape(-1, cols)


def from_rows(df: DataFrame, row: str, vec: str, size: int = SIZE) -> DataFrame:
    """Blocks of a table of row vectors; ``row`` numbers them from 0, numbers may be missing."""
    starts = F.sequence(F.lit(0), F.floor((F.size(vec) - 1) / size).cast("int"))
    parts = F.when(F.size(vec) > 0, F.transform(starts, lambda c: F.slice(vec, c * size + 1, size)))
    cut = df.select(F.floor(F.col(row) / size).alias("bi"), (F.col(row) % size).cast("int").alias("r"), F.posexplode(parts).alias("bj", "part"))
    # A block has at most ``size`` rows.
    held = cut.groupBy("bi", F.col("bj").cast("bigint").alias("bj")).agg(F.collect_list(F.struct("r", "part")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, blocks = [], []
            for bi, bj, rows in zip(*(batch.column(name).to_pylist() for name in ("bi", "bj", "rows"))):
                block = np.zeros((size, len(rows[0]["part"])))
                for item in rows:
                    block[item["r"]] = item["part"]
                keys.append((bi, bj))
                blocks.append(block)
            yield _batch(keys, blocks)

    return held.mapInArrow(run, SCHEMA)


def transpose(blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """The other way round; the last columns become rows, zero beyond their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, turned = [], []
            for bi, bj, cols, packed in zip(*(batch.column(name).to_pylist() for name in ("bi", "bj", "cols", "block"))):
                block = np.zeros((size, size))
                block[:cols] = _dense(packed, cols).T
                keys.append((bj, bi))
                turned.append(block)
            yield _batch(keys, turned)

    return blocks.select("bi", "bj", "cols", "block").mapInArrow(run, SCHEMA)


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("bi", "bj", "cols", "block", "other_cols", "other"))
        for bi, bj, cols, packed, other_cols, other in zip(*columns):
            product = _dense(packed, cols) @ _dense(other, other_cols)[:cols]
            total[bi, bj] = total[bi, bj] + product if (bi, bj) in total else product
            if len(total) >= HELD:
                yield _batch(list(total), list(total.values()))
                total = {}
    if total:
        yield _batch(list(total), list(total.values()))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks of a place; they come sorted by it."""
    current, total = None, None
    for batch in batches:
        for bi, bj, cols, packed in zip(*(batch.column(name).to_pylist() for name in ("bi", "bj", "cols", "block"))):
            block = _dense(packed, cols)
            if (bi, bj) != current:
                if current:
                    yield _batch([current], [total])
                current, total = (bi, bj), block
            else:
                total = total + block
    if current:
        yield _batch([current], [total])


def multiply(a: DataFrame, b: DataFrame, salts: int = 16) -> DataFrame:
    """Product of two block tables of the same block size.

    The smaller side is broadcast while its counted bytes allow. Otherwise the blocks of ``a`` that share an inner
    number, all of them for a tall matrix, are spread over salts.
    """
    left = stage(a.select("bi", F.col("bj").alias("k"), "cols", "block"), "left-blocks")
    right = stage(b.select(F.col("bi").alias("k"), "bj", F.col("cols").alias("other_cols"), F.col("block").alias("other")), "right-blocks")
    bytes_of = {name: df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0] for name, df, column in (("left", left, "block"), ("right", right, "other"))}
    if min(bytes_of.values()) <= BROADCAST_BYTES:
        met = left.join(F.broadcast(right), "k") if bytes_of["right"] <= bytes_of["left"] else F.broadcast(left).join(right, "k")
    else:
        met = salted_join(left, right, ["k"], ["bi"], salts)
    products = met.select("bi", "bj", "cols", "block", "other_cols", "other").mapInArrow(_multiplied, SCHEMA)
    return products.repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInArrow(_summed, SCHEMA)


def to_rows(blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (i, bj, part): the part of a row that lies in one column of blocks; rows past the matrix's end are zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bi, bj, cols, packed in zip(*(batch.column(name).to_pylist() for name in ("bi", "bj", "cols", "block"))):
                block = _dense(packed, cols)
                ends = pa.array(np.arange(0, block.size + 1, cols, dtype=np.int32))
                parts = pa.ListArray.from_arrays(ends, pa.array(block.reshape(-1)))
                number = pa.array(bi * size + np.arange(len(block), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([number, pa.array(np.full(len(block), bj, np.int64)), parts], names=["i", "bj", "part"])

    return blocks.select("bi", "bj", "cols", "block").mapInArrow(run, "i bigint, bj bigint, part array<double>")


def to_cells(blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """Cells (i, j, v)."""
    cells = to_rows(blocks, size).select("i", "bj", F.posexplode("part").alias("c", "v"))
    return cells.select("i", (F.col("bj") * size + F.col("c")).alias("j"), "v")


def matmul(df: DataFrame, row: str, vec: str, weights: DataFrame, weights_row: str, weights_vec: str, size: int = SIZE) -> DataFrame:
    """Rows (``row``, ``vec``): row vectors times a weight table (number, vector), whose size is counted first.

    Weights up to ``MAX_LOCAL_WEIGHTS`` values travel to the rows; more are multiplied in blocks, for which ``row`` must number the rows.
    """
    held = weights.agg(F.coalesce(F.sum(F.size(weights_vec)), F.lit(0))).first()[0]
    if 0 < held <= MAX_LOCAL_WEIGHTS:
        matrix = np.array([r[1] for r in sorted(weights.select(weights_row, weights_vec).collect(), key=lambda r: r[0])], dtype=np.float64)
        return df.select(row, row_map(lambda block: block @ matrix, matrix.shape[0])(F.col(vec)).alias(vec))
    product = to_rows(multiply(from_rows(df, row, vec, size), from_rows(weights, weights_row, weights_vec, size)), size)
    joined = product.groupBy("i").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("bj", "part"))), lambda p: p["part"])).alias(vec))
    return df.select(row).join(joined.withColumnRenamed("i", row), row)
