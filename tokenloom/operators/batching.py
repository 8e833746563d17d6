"""Mini-batches, padding, packing and sharding."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.constants import IGNORE_LABEL
from tokenloom.operators.positions import key_positions, shuffled_positions
from tokenloom.session import stage


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b).cast("bigint")


def minibatch(df: DataFrame, keys: Sequence[str], batch_size: int = 64, seed: int = 42, drop_last: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """Add ``pos`` and ``batch_id`` over a seeded shuffle; ``drop_last`` leaves out the short batch, ``ties`` tell rows of equal keys apart."""
    placed = shuffled_positions(df, keys, seed, "pos", "_n", ties=ties)
    if drop_last:
        placed = placed.where(F.col("pos") < F.floor(F.col("_n") / batch_size) * batch_size)
    return placed.withColumn("batch_id", _div(F.col("pos"), batch_size)).drop("_n")


def sequential_batches(df: DataFrame, key: str, batch_size: int = 64) -> DataFrame:
    """Add ``pos`` and ``batch_id`` in the order of a numeric key."""
    placed = key_positions(df, key)
    return placed.withColumn("batch_id", _div(F.col("pos"), batch_size))


def group_by_length(
    df: DataFrame, keys: Sequence[str], length: str, batch_size: int = 8, seed: int = 42, mega_batches: int = 50
) -> DataFrame:
    """Batches of similar length: a random order cut into runs of several batches, each run
    sorted by falling length. Adds ``pos`` and ``batch_id``."""
    placed = shuffled_positions(df, keys, seed, "_pos", "_n")
    factor = F.greatest(F.lit(1), F.least(F.floor(F.col("_n") / (4 * batch_size)), F.lit(mega_batches)))
    run_rows = factor * batch_size
    placed = placed.withColumn("_run", _div(F.col("_pos"), run_rows)).withColumn("_run_rows", run_rows)
    # A run holds at most mega_batches * batch_size rows.
    inside = Window.partitionBy("_run").orderBy(F.col(length).desc(), F.col("_pos"))
    placed = placed.withColumn("pos", F.col("_run") * F.col("_run_rows") + F.row_number().over(inside) - 1)
    return placed.withColumn("batch_id", _div(F.col("pos"), batch_size)).drop("_pos", "_n", "_run", "_run_rows")


def _pad(arr: Column, value: int | Column, width: Column, side: str) -> Column:
    fill = value if isinstance(value, Column) else F.lit(value)
    filler = F.array_repeat(fill, (width - F.size(arr)).cast("int"))
    return F.concat(filler, arr) if side == "left" else F.concat(arr, filler)


def pad_to(
    df: DataFrame, width: Column, pad_id: int, side: str = "left", ids: str = "input_ids",
    mask: str = "attention_mask", labels: str | None = "labels",
) -> DataFrame:
    """Pad ids, mask and labels to ``width``. Readers must use the mask, not the padding id."""
    df = df.withColumn("_width", width)
    df = df.withColumn(ids, _pad(F.col(ids), pad_id, F.col("_width"), side))
    df = df.withColumn(mask, _pad(F.col(mask), 0, F.col("_width"), side))
    if labels and labels in df.columns:
        df = df.withColumn(labels, _pad(F.col(labels), IGNORE_LABEL, F.col("_width"), side))
    return df.drop("_width")


def pad_batch(
    df: DataFrame, pad_id: int = 0, multiple: int = 8, side: str = "left", ids: str = "input_ids",
    mask: str = "attention_mask", labels: str | None = "labels",
) -> DataFrame:
    """Pad every row to the longest of its ``batch_id``, rounded up to ``multiple``."""
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch_id"))
    return pad_to(df, (F.ceil(longest / multiple) * multiple).cast("int"), pad_id, side, ids, mask, labels)


#: Longest row that ``pad_max_length`` pads a table to when no length is given.
MAX_PADDED = 16_384


def pad_max_length(df: DataFrame, pad_id: int, max_length: int | None = None, side: str = "left", ids: str = "input_ids",
                   mask: str = "attention_mask", labels: str | None = "labels") -> DataFrame:
    """Pad every row to ``max_length``, cutting longer ones, or to the longest row of the table.

    Without a length one long row multiplies the bytes of all others, so a table whose longest row has more than
    MAX_PADDED ids is refused. ``df`` is read twice then; stage it first when it is costly.
    """
    if max_length is None:
        max_length = df.agg(F.max(F.size(ids))).first()[0] or 0
        if max_length > MAX_PADDED:
            raise ValueError(f"the longest row has {max_length} ids: give a maximum length")
    lists = [ids, mask, *([labels] if labels and labels in df.columns else [])]
    cut = df.withColumns({name: F.slice(name, 1, max_length) for name in lists}) if max_length else df
    return pad_to(cut, F.lit(max_length), pad_id, side, ids, mask, labels)


def pack_sequences(df: DataFrame, key: str, ids: str, chunk_size: int, eos_id: int) -> DataFrame:
    """Join all rows in key order, an end marker after each, and cut into whole chunks.

    Returns (chunk, input_ids) with exactly ``chunk_size`` ids; the tail is dropped. A row
    is cut where it crosses a chunk border, so no task holds more than its chunks. A row with NULL
    ids is an empty one: its end marker only.
    """
    known = F.coalesce(F.col(ids), F.array().cast(df.schema[ids].dataType))
    ended = df.select(key, F.concat(known, F.array(F.lit(eos_id))).alias("_ids")).withColumn("_len", F.size("_ids"))
    # The ids are computed once; the totals then read only the key and length columns.
    placed = key_positions(stage(ended, "pack"), key, "_from", weight=F.col("_len"))
    first = _div(F.col("_from"), chunk_size)
    last = _div(F.col("_from") + F.col("_len") - 1, chunk_size)

    def piece(chunk: Column) -> Column:
        start = F.greatest(chunk * chunk_size - F.col("_from"), F.lit(0))
        stop = F.least((chunk + 1) * chunk_size - F.col("_from"), F.col("_len").cast("bigint"))
        part = F.slice("_ids", (start + 1).cast("int"), (stop - start).cast("int"))
        return F.struct(chunk.alias("chunk"), F.struct(F.col("_from"), part.alias("part")).alias("_piece"))

    # The row is cut before it is exploded, so a long row is not copied for each of its chunks.
    pieces = placed.select(F.inline(F.transform(F.sequence(first, last), piece)))
    chunks = pieces.groupBy("chunk").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
    joined = chunks.select("chunk", F.flatten(F.col("_pieces.part")).alias("input_ids"))
    return joined.where(F.size("input_ids") == chunk_size)


def epochs(df: DataFrame, count: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Repeat the table per epoch, each in an order of its own: adds ``epoch``, ``pos``, ``n_rows``."""
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return shuffled_positions(repeated, keys, F.lit(seed) + F.col("epoch"), "pos", "n_rows", group=["epoch"])


def rank_shards(df: DataFrame, keys: Sequence[str], world: int, epoch_count: int = 1, seed: int = 42) -> DataFrame:
    """Deal every epoch's order to ``world`` ranks in turn.

    The order is padded to a multiple of ``world`` by wrapping to its start, so all ranks get
    equally many rows. Adds ``epoch``, ``rank``, ``pos`` and ``step_pos`` (place in the rank).
    """
    placed = epochs(df, epoch_count, keys, seed)
    padded = F.ceil(F.col("n_rows") / world) * world
    wrapped = placed.withColumn("pos", F.explode(F.sequence(F.col("pos"), padded - 1, F.col("n_rows"))))
    wrapped = wrapped.withColumn("rank", (F.col("pos") % world).cast("int"))
    return wrapped.withColumn("step_pos", _div(F.col("pos"), world)).drop("n_rows")


def range_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Contiguous shards in key order; each row is in exactly one. Adds ``pos`` and ``shard``."""
    placed = key_positions(df, key, "pos", "_n")
    per_shard = F.ceil(F.col("_n") / shards)
    return placed.withColumn("shard", _div(F.col("pos"), per_shard).cast("int")).drop("_n")


def collate(df: DataFrame, columns: Sequence[str], order: str = "pos") -> DataFrame:
    """One row per batch: parallel lists of ``columns`` in batch order."""
    rows = F.sort_array(F.collect_list(F.struct(order, *columns)))
    batches = df.groupBy("batch_id").agg(rows.alias("_rows"))
    return batches.select("batch_id", F.size("_rows").alias("batch_rows"), *[F.col(f"_rows.{c}").alias(c) for c in columns])


def collate_with(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """Hand every batch as a pandas frame to ``function`` (a custom collate function)."""
    return df.groupBy("batch_id").applyInPandas(function, schema)


def step_plan(df: DataFrame, tokens: str, accumulation: int, max_steps: int) -> DataFrame:
    """Rows, batches and tokens per optimizer step of a batched table, up to ``max_steps``."""
    stepped = df.withColumn("step", _div(F.col("batch_id"), accumulation)).where(F.col("step") < max_steps)
    per_batch = stepped.groupBy("step", "batch_id").agg(F.count("*").alias("_rows"), F.sum(tokens).alias("_tokens"))
    return per_batch.groupBy("step").agg(
        F.count("*").alias("batches"), F.sum("_rows").alias("row_count"), F.sum("_tokens").alias("tokens")
    )


def rank_summary(shards: DataFrame, batch_size: int) -> DataFrame:
    """Largest batch and number of steps per epoch and rank."""
    batches = shards.groupBy("epoch", "rank", _div(F.col("step_pos"), batch_size).alias("_batch")).agg(F.count("*").alias("_rows"))
    return batches.groupBy("epoch", "rank").agg(F.max("_rows").alias("batch_size"), F.count("*").alias("steps"))
