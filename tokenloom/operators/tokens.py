"""Vocabulary, encoding, masks and labels."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.constants import FULL_PATTERN, IGNORE_LABEL, SIMPLE_PATTERN, special_names
from tokenloom.operators.joins import lookup_join, salted_join
from tokenloom.operators.merges import Merger
from tokenloom.session import stage

# Largest vocabulary that travels to the executors as a value; a larger one is joined.
MAX_LOCAL_PIECES = 1_000_000
# Pieces or ids that a worker merges or decodes together: a batch holds thousands of texts of any length, their work tables many bytes a piece.
PART_PIECES = 131_072


def pretokenize(text: str | Column, pattern: str = SIMPLE_PATTERN) -> Column:
    """Pieces of a text, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def pretokenize_full(text: str | Column) -> Column:
    """Pieces that join back to the text; white space is what Unicode calls so."""
    return pretokenize(text, "(?U)" + FULL_PATTERN)


def build_vocab(df: DataFrame, text: str = "text", size: int = 8000) -> DataFrame:
    """Rank table (piece, id, is_special): the most frequent pieces, then the special names."""
    counts = df.select(F.explode(pretokenize(text)).alias("piece")).groupBy("piece").agg(F.count("*").alias("_count"))
    # Bands of counts (by binary digits) that can hold the top ``size``: rare pieces, nearly
    # all of them, are left out before the sort. At most 64 bands exist.
    banded = counts.withColumn("_band", F.length(F.bin("_count")))
    bands = banded.groupBy("_band").agg(F.count("*").alias("_pieces"))
    above = F.sum("_pieces").over(Window.orderBy(F.col("_band").desc()).rowsBetween(Window.unboundedPreceding, -1))
    needed = bands.withColumn("_above", F.coalesce(above, F.lit(0))).where(F.col("_above") < size).select("_band")
    frequent = banded.join(F.broadcast(needed), "_band")
    top = frequent.orderBy(F.col("_count").desc(), "piece").limit(size)
    # One list of at most ``size`` pieces: the special names follow whatever its length is.
    best = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("_count")).alias("_neg"), "piece"))).alias("_best"))
    names = F.split(F.lit(" ".join(special_names())), " ")
    listed = best.select(F.size("_best").alias("_n"), F.posexplode(F.concat(F.col("_best.piece"), names)).alias("id", "piece"))
    return listed.select("piece", "id", (F.col("id") >= F.col("_n")).alias("is_special"))


class Vocabulary:
    """A rank table together with the column functions that use it."""

    def __init__(self, table: DataFrame):
        self.table = table

    @classmethod
    def build(cls, df: DataFrame, text: str = "text", size: int = 8000) -> Vocabulary:
        return cls(stage(build_vocab(df, text, size), "vocabulary"))

    @cached_property
    def _rows(self) -> tuple[list[str], list[str]] | None:
        """(pieces, specials) in id order, or None when the table is too large to ship."""
        if self.table.count() > MAX_LOCAL_PIECES:
            return None
        rows = sorted(self.table.collect(), key=lambda r: r.id)
        return [r.piece for r in rows if not r.is_special], [r.piece for r in rows if r.is_special]

    @cached_property
    def size(self) -> int:
        """Number of plain pieces, which is also the id of the first special name."""
        if self._rows is not None:
            return len(self._rows[0])
        return self.table.where(~F.col("is_special")).count()

    @property
    def is_local(self) -> bool:
        return self._rows is not None

    @property
    def bos_id(self) -> int:
        return self.size

    @property
    def eos_id(self) -> int:
        return self.size + 1

    @property
    def unk_id(self) -> int:
        return self.size + 2

    @property
    def pieces(self) -> list[str]:
        if self._rows is None:
            raise ValueError("the vocabulary is too large for the driver")
        return self._rows[0]

    def ids(self, pieces: Column) -> Column:
        """Ids of a piece list, unknown pieces mapped to the unknown id; needs a local vocabulary."""
        known = pa.array(self.pieces, pa.string())
        unk = self.unk_id

        @F.arrow_udf("array<int>")
        def lookup(column: pa.Array) -> pa.Array:
            found = pc.fill_null(pc.index_in(column.flatten().cast(pa.string()), value_set=known), unk)
            return _relist(column, found.cast(pa.int32()))

        return lookup(pieces)

    def texts(self, ids: Column, skip_special: bool = False) -> Column:
        """Pieces of an id list; needs a local vocabulary."""
        plain, special = self._rows or ([], [])
        if not plain:
            raise ValueError("the vocabulary is too large for the driver")
        names = pa.array(plain + special, pa.string())

        @F.arrow_udf("array<string>")
        def lookup(column: pa.Array) -> pa.Array:
            return _relist(column, names.take(column.flatten()))

        shown = F.filter(ids, lambda i: i < len(plain)) if skip_special else ids
        return lookup(shown)

    def with_ids(self, df: DataFrame, key: Sequence[str], text: str | Column = "text", out: str = "input_ids") -> DataFrame:
        """Add the ids of ``text``. A local vocabulary needs no shuffle; a larger one is joined."""
        pieces = pretokenize(text)
        if self.is_local:
            return df.withColumn(out, self.ids(pieces))
        return self.join_ids(df, key, pieces, out)

    def join_ids(self, df: DataFrame, key: Sequence[str], pieces: Column, out: str = "input_ids") -> DataFrame:
        """Ids by a join on the piece. Each distinct piece of a row is looked up once, and the
        result travels back to the row as a map, so the shuffled rows stay narrow."""
        plain = self.table.where(~F.col("is_special")).select("piece", "id")
        distinct = df.select(*key, F.explode(F.array_distinct(pieces)).alias("piece"))
        found = salted_join(distinct, plain, ["piece"], key)
        pairs = found.groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct("piece", "id"))).alias("_map"))
        unk = F.lit(self.unk_id)
        ids = F.transform(pieces, lambda p: F.coalesce(F.try_element_at(F.col("_map"), p), unk).cast("int"))
        return _join_maps(df, pairs, key).withColumn(out, ids).drop("_map")

    def with_texts(self, df: DataFrame, key: Sequence[str], ids: str = "input_ids", out: str = "pieces", skip_special: bool = False) -> DataFrame:
        """Add the pieces of an id list, by value or, for a larger vocabulary, by a join."""
        if self.is_local:
            return df.withColumn(out, self.texts(F.col(ids), skip_special))
        return self.join_texts(df, key, ids, out, skip_special)

    def join_texts(self, df: DataFrame, key: Sequence[str], ids: str = "input_ids", out: str = "pieces", skip_special: bool = False) -> DataFrame:
        """Pieces by a join on the id, the counterpart of ``join_ids``."""
        distinct = df.select(*key, F.explode(F.array_distinct(ids)).alias("id"))
        found = salted_join(distinct, self.table.select("id", "piece"), ["id"], key)
        names = found.groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct("id", "piece"))).alias("_map"))
        shown = F.filter(ids, lambda i: i < F.lit(self.size)) if skip_special else F.col(ids)
        texts = F.transform(shown, lambda i: F.try_element_at(F.col("_map"), i))
        return _join_maps(df, names, key).withColumn(out, texts).drop("_map")


def _join_maps(df: DataFrame, maps: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with the map of their key; rows that share a key share its map, and NULL is a key."""
    maps = maps.toDF(*[f"_of_{name}" if name in key else name for name in maps.columns])
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    return df.join(maps, same, "left").drop(*[f"_of_{name}" for name in key])


def _relist(shape: pa.Array, values: pa.Array) -> pa.Array:
    """Lists of the same lengths as ``shape`` around ``values``; NULL lists stay NULL."""
    lengths = pc.fill_null(pc.list_value_length(shape), 0).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths)])
    return pa.ListArray.from_arrays(offsets, values, mask=shape.is_null() if shape.null_count else None)


def add_bos(ids: Column, bos_id: int) -> Column:
    return F.concat(F.array(F.lit(bos_id)), ids)


def add_eos(ids: Column, eos_id: int, cutoff: int = 512) -> Column:
    """Append the end marker when there is room and the row does not already end with it."""
    ended = F.coalesce(F.try_element_at(ids, F.lit(-1)) == eos_id, F.lit(False))
    return F.when(~ended & (F.size(ids) < cutoff), F.concat(ids, F.array(F.lit(eos_id)))).otherwise(ids)


def truncate(ids: Column, cutoff: int = 512) -> Column:
    return F.slice(ids, 1, cutoff)


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def make_labels(ids: Column, prompt_length: Column | None = None, prompt_has_eos: bool = False) -> Column:
    """Copy of the ids; with ``prompt_length`` the prompt's part is replaced by the ignored label."""
    if prompt_length is None:
        return ids
    hidden = F.greatest(prompt_length - 1, F.lit(0)) if prompt_has_eos else prompt_length
    return F.concat(F.array_repeat(F.lit(IGNORE_LABEL), hidden.cast("int")), F.slice(ids, hidden.cast("int") + 1, F.size(ids)))


def strip_prompt_ids(ids: Column, prompt_ids: Column) -> Column:
    """Ids after the prompt's ids."""
    return F.slice(ids, F.size(prompt_ids) + 1, F.size(ids))


def tokenize_pairs(
    df: DataFrame, vocab: Vocabulary, prompt: Column, answered: Column, key: Sequence[str], cutoff: int = 512,
    append_eos: bool = True, mask_prompt: bool = False, prompt_has_eos: bool = False,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and ``labels`` for rendered prompts."""
    rows = vocab.with_ids(df.withColumn("_answered", answered), key, "_answered")
    prompt_length = None
    if mask_prompt:
        # The prompt's length needs no vocabulary: one id per piece.
        rows = rows.withColumn("_prompt_len", F.least(F.size(pretokenize(prompt)), F.lit(cutoff)))
        prompt_length = F.col("_prompt_len")
    ids = truncate(F.col("input_ids"), cutoff)
    rows = rows.withColumn("input_ids", add_eos(ids, vocab.eos_id, cutoff) if append_eos else ids)
    rows = rows.withColumn("attention_mask", attention_mask(F.col("input_ids")))
    rows = rows.withColumn("labels", make_labels(F.col("input_ids"), prompt_length, prompt_has_eos))
    return rows.drop("_answered", "_prompt_len")


def _row_parts(lists: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows with ``PART_PIECES`` values together at most, or one row."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(lists):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + PART_PIECES, "right")))
        yield lists.slice(first, last - first)
        first = last


def _by_parts(work: Callable[[pa.Array | np.ndarray], tuple[np.ndarray, np.ndarray]], values: pa.Array | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both results of ``work``, which treats each value by itself, from parts of ``PART_PIECES`` values of a long row."""
    found = [work(values[start : start + PART_PIECES]) for start in range(0, max(1, len(values)), PART_PIECES)]
    return np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found])


def bpe_ranks(vocab: Vocabulary) -> dict[bytes, int]:
    """Ranks of a byte-pair encoding: 256 bytes, then the vocabulary's pieces."""
    ranks = {bytes([b]): b for b in range(256)}
    for piece in vocab.pieces:
        ranks.setdefault(piece.encode("utf-8"), len(ranks))
    return ranks


def encode_bpe(df: DataFrame, key: Sequence[str], vocab: Vocabulary, text: str = "text", out: str = "input_ids", pieces: str | None = None) -> DataFrame:
    """Add byte-pair ids, without a shuffle: each batch merges its distinct pieces that the worker has not lately seen.

    A text that holds a special name is an error. The ids depend on the row alone, so ``key`` may repeat or be NULL.
    ``pieces`` names a column for the number of pieces.
    """
    ranks = bpe_ranks(vocab)

    @F.arrow_udf("struct<ids: array<int>, pieces: int>")
    def merge(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = Merger(ranks)
        for pieces in chain.from_iterable(map(_row_parts, column)):
            ids, counts = _by_parts(merger.encode, pieces.flatten().cast(pa.string()))
            lengths = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(lengths)))]
            mask = pieces.is_null() if pieces.null_count else None
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)), mask=mask)
            yield pa.StructArray.from_arrays([lists, pa.array(lengths, pa.int32())], names=["ids", "pieces"])

    refused = F.lit(False)
    for name in special_names():
        refused = refused | F.contains(F.col(text), F.lit(name))
    # All names begin alike, so few texts are searched for each of them.
    refused = F.contains(F.col(text), F.lit(os.path.commonprefix(special_names()))) & refused
    checked = F.when(refused, F.raise_error(F.lit("a special name stands in the text"))).otherwise(F.col(text))
    merged = df.withColumn("_merged", merge(pretokenize_full(checked)))
    counted = {} if pieces is None else {pieces: F.col("_merged.pieces").cast("bigint")}
    return merged.withColumns({out: F.col("_merged.ids"), **counted}).drop("_merged")


def decode_bpe(ids: Column, vocab: Vocabulary) -> Column:
    """Text of byte-pair ids: the bytes of all ids, joined."""
    ranks = bpe_ranks(vocab)

    @F.arrow_udf("string")
    def decode(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = Merger(ranks)
        for lists in chain.from_iterable(map(_row_parts, column)):
            raw, counts = _by_parts(merger.decode, lists.flatten().to_numpy())
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(lengths)))].tolist()
            whole, there = raw.tobytes(), lists.is_valid().to_pylist()
            yield pa.array([whole[a:b].decode("utf-8", "replace") if known else None for a, b, known in zip(ends, ends[1:], there)], pa.string())

    return decode(ids)


def embed_tokens(df: DataFrame, table: DataFrame, key: Sequence[str], ids: str = "input_ids") -> DataFrame:
    """Vector of every id: rows (key, pos, id, vec). ``table`` is (id, vec).

    A frequent id is hot on the token side, so the table is broadcast while it is small (by a
    count of its values) and otherwise joined with each id spread over salts.
    """
    # Outer, because a plain explode adds a filter that would compute the ids twice.
    tokens = df.select(*key, F.posexplode_outer(ids).alias("pos", "id")).where(F.col("pos").isNotNull())
    return lookup_join(tokens, table, ["id"], [*key, "pos"], "vec")


def length_stats(df: DataFrame, length: Column, cutoff: int, by: str) -> DataFrame:
    """Rows, tokens, longest and mean length and number of truncated rows per group."""
    return (
        df.withColumn("_len", length)
        .groupBy(by)
        .agg(
            F.count("*").alias("row_count"),
            F.sum("_len").cast("bigint").alias("tokens"),
            F.max("_len").cast("bigint").alias("longest"),
            F.round(F.sum("_len") / F.count("*"), 6).alias("mean_len"),
            F.sum(F.when(F.col("_len") > cutoff, 1).otherwise(0)).cast("bigint").alias("truncated"),
        )
    )
