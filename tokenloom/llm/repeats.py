"""Operator 8, suffix-array dedup: a depth-limited radix sort of suffixes, to the depth of a window.

Bytes covered by a window of DEPTH bytes that starts anywhere else too are removed. Two equal windows
have the same lowest-hashed gram in the same place, so suffixes are first dealt out by that gram,
their anchor: one row stands for the run of windows that share it. Then most significant digits:

1. the anchor's gram: a gram that occurs once leaves all its windows unique, and most go here;
2. the whole extent of the run: where it occurs twice or more, all its windows are repeated; one
   copy of it goes on as a partner for others;
3. the rest: the extents that share an anchor. A small group is compared byte by byte, a large one
   is sorted by whole windows. Equal groups are exactly the repeated windows.

Digits are counted with partial aggregation, so a passage in a third of all documents is no hot task.
Extents and windows are told apart by 96 bits of two hashes (one wrong pair expected among 10^14),
texts by 64 bits, which are checked against a second digest.

Defined results: NULL and empty texts have no bytes and no spans; a text that occurs twice loses
all its bytes if it has DEPTH of them; overlapping windows count; rows are judged by their text, so
equal or NULL ids do no harm; an empty table gives an empty table; only ``key`` and ``text`` are
read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches, text_column
from tokenloom.llm.near_duplicates import mix
from tokenloom.session import stage

DEPTH = 200
GRAM = 32
#: Windows of a text that are handled at once.
SEGMENT = 1 << 19
#: Extents of a group that are compared byte by byte; larger groups are sorted by windows.
SMALL_GROUP = 64
#: Most rows, and numbers in rows, of a table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_NUMBERS = 1_000_000, 4_000_000

_PLACE = np.uint64((1 << 20) - 1)


class Powers:
    """One rolling hash modulo 2^64: random values of bytes, powers of a base and of its inverse."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(0, 2**61)) * 8 + 3
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, size: int) -> None:
        if len(self.power) < size:
            size = max(size, 2 * len(self.power))
            for name, base in (("power", self.base), ("inverse", pow(self.base, -1, 2**64))):
                factors = np.full(size, base & (2**64 - 1), np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def sums(self, raw: np.ndarray) -> np.ndarray:
        self.grow(len(raw) + 1)
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.power[: len(raw)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of raw[begin:end]."""
        return mix((sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


FIRST, SECOND = Powers(11), Powers(12)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by minima from both ends of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, 2**64 - 1, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


class Runs:
    """The runs of windows of a text that share an anchor: anchor, first and last start, digits."""

    def __init__(self, raw: np.ndarray, depth: int, gram: int):
        found = [self._segment(raw[start : start + SEGMENT + depth - 1], start, depth, gram) for start in range(0, max(0, len(raw) - depth + 1), SEGMENT)]
        self.anchor, self.low, self.high, self.gram, self.extent, self.tail = (
            np.concatenate(parts) if parts else np.empty(0, np.int64) for parts in ([x[i] for x in found] for i in range(6))
        )

    @staticmethod
    def _segment(raw: np.ndarray, start: int, depth: int, gram: int) -> tuple[np.ndarray, ...]:
        sums = FIRST.sums(raw)
        at = np.arange(len(raw) - gram + 1)
        grams = FIRST.of(sums, at, at + gram)
        # Of equal grams the last one: the place, counted from the end, fills the low bits.
        ranked = (grams & ~_PLACE) | (_PLACE - at.astype(np.uint64))
        anchors = (_PLACE - (lowest(ranked, depth - gram + 1) & _PLACE)).astype(np.int64)
        change = np.flatnonzero(np.diff(anchors))
        low, high = np.append(0, change + 1), np.append(change, len(anchors) - 1)
        anchor = anchors[low]
        tail = SECOND.of(SECOND.sums(raw), low, high + depth) >> np.uint64(32)
        return (
            anchor + start, low + start, high + start, grams[anchor].view(np.int64), FIRST.of(sums, low, high + depth).view(np.int64),
            tail.astype(np.uint32).view(np.int32).astype(np.int64),
        )


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8"), np.uint8)


def _runs_of(depth: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            parts: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for text, code in zip(text_column(batch), batch.column("code").to_pylist()):
                runs = Runs(_raw(text), depth, gram)
                for part, values in zip(parts, (runs.gram, runs.extent, runs.tail, np.full(len(runs.low), code), runs.low, runs.high)):
                    part.append(values)
            columns = [np.concatenate(part) for part in parts]
            kinds = [np.int64, np.int64, np.int32, np.int64, np.int32, np.int32]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(k)) for c, k in zip(columns, kinds)], names=["gram", "extent", "tail", "code", "low", "high"]
            )

    return run


def _contexts(depth: int, gram: int):
    """The bytes of the runs of a text that are looked for, cut at their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for text, code, targets in zip(text_column(batch), batch.column("code").to_pylist(), batch.column("targets").to_pylist()):
                raw = _raw(text)
                runs = Runs(raw, depth, gram)
                unique = {t["low"]: t["once"] for t in targets}
                for i in np.flatnonzero(np.isin(runs.low, list(unique))).tolist():
                    low, high, anchor = int(runs.low[i]), int(runs.high[i]), int(runs.anchor[i])
                    rows.append((int(runs.gram[i]), int(runs.extent[i]), int(runs.tail[i]), code, low, anchor - low, unique[low], raw[low : high + depth].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()))],
                names=["gram", "extent", "tail", "code", "low", "ahead", "once", "bytes"],
            )

    return run


def _ranges(marked: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the windows that start where marked."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0]))))
    return [(int(b), int(e) - 1 + depth) for b, e in zip(edges[::2], edges[1::2])]


def compare_group(rows: list[tuple[bool, int, int, int, np.ndarray]], depth: int) -> list[tuple[int, int, int]]:
    """Ranges (code, begin, end) of a group's unique extents that are repeated in another extent of the group.

    A row is (unique, code, low, bytes ahead of the anchor, bytes). Two extents are aligned at their anchor; how far
    they agree to either side gives the windows that they share.
    """
    found = []
    for x, (once, code, low, ahead, text) in enumerate(rows):
        if not once:
            continue
        marked = np.zeros(len(text) - depth + 2, np.int32)
        for y, (_, _, _, other_ahead, other) in enumerate(rows):
            if x == y:
                continue
            left, right = min(ahead, other_ahead), min(len(text) - ahead, len(other) - other_ahead)
            same = text[ahead - left : ahead + right] == other[other_ahead - left : other_ahead + right]
            apart = np.flatnonzero(~same)
            cut = int(np.searchsorted(apart, left))
            begin = ahead - left + (int(apart[cut - 1]) + 1 if cut else 0)
            stop = ahead - left + (int(apart[cut]) if cut < len(apart) else left + right)
            if stop - begin >= depth:
                marked[begin] += 1
                marked[stop - depth + 1] -= 1
        if marked.any():
            found += [(code, low + b, low + e) for b, e in _ranges(np.cumsum(marked)[:-1] > 0, depth)]
    return found


def _compare(depth: int):
    """Groups of equal grams, which lie next to each other in a partition, compared one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[tuple[int, int], tuple] = {}
        last, found = None, []
        for batch in small_batches(batches, "bytes"):
            columns = (batch.column(c).to_pylist() for c in ("gram", "extent", "tail", "once", "code", "low", "ahead", "bytes"))
            for gram, extent, tail, once, code, low, ahead, raw in zip(*columns):
                if gram != last:
                    if len(group) > 1:
                        found += compare_group(list(group.values()), depth)
                    group, last = {}, gram
                group.setdefault((extent, tail), (once, code, low, ahead, np.frombuffer(raw, np.uint8)))
            yield _range_batch(found)
            found = []
        if len(group) > 1:
            yield _range_batch(compare_group(list(group.values()), depth))

    return run


def _range_batch(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names=["code", "begin", "end"])


def _windows(depth: int):
    """Every window of an extent by its hashes, with its place in the text where the extent is unique."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", 1 << 18):
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            for raw, code, low, once in zip(*(batch.column(c).to_pylist() for c in ("bytes", "code", "low", "once"))):
                raw = np.frombuffer(raw, np.uint8)
                at = np.arange(len(raw) - depth + 1)
                tail = (SECOND.of(SECOND.sums(raw), at, at + depth) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                for part, values in zip(parts, (FIRST.of(FIRST.sums(raw), at, at + depth).view(np.int64), tail, np.full(len(at), code), at + low, np.full(len(at), once))):
                    part.append(values)
            kinds = (np.int64, np.int32, np.int64, np.int32, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p).astype(k)) for p, k in zip(parts, kinds)], names=["window", "tail", "code", "begin", "once"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Touching ranges of a text in one, as begin and end numbers in turn."""
    for batch in batches:
        merged = []
        for ranges in batch.column("ranges").to_pylist():
            flat: list[int] = []
            for r in sorted(ranges, key=lambda r: r["begin"]):
                if flat and r["begin"] <= flat[-1]:
                    flat[-1] = max(flat[-1], r["end"])
                else:
                    flat += [r["begin"], r["end"]]
            merged.append(flat)
        yield pa.RecordBatch.from_arrays([batch.column("code"), pa.array(merged, pa.list_(pa.int32()))], names=["code", "spans"])


def _held(table: DataFrame, rows: int, numbers: int = 0) -> DataFrame:
    """The table, to be broadcast if its counted size is within the bounds."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS and numbers <= BROADCAST_NUMBERS else table


def repeated_spans(docs: DataFrame, text: str = "text", depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """Rows (code, spans): per text that has any, the merged byte ranges covered by repeated windows. ``code`` is its xxhash64."""
    value = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.xxhash64(value).alias("code"), value.alias("text"))
    texts = texts.where(F.octet_length("text") >= depth)
    runs = stage(texts.mapInArrow(_runs_of(depth, gram), "gram bigint, extent bigint, tail int, code bigint, low int, high int"), "repeat-runs")
    # First digit: anchors that occur twice or more.
    shared = stage(runs.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeat-grams")
    left = stage(runs.join(_held(shared, shared.count()), "gram"), "repeat-left")
    # Second digit: whole extents.
    first = F.min(F.struct("code", "low")).alias("first")
    extents = stage(left.groupBy("gram", "extent", "tail").agg(F.count("*").alias("n"), first, F.min("high").alias("high")), "repeat-extents")
    open_grams = extents.groupBy("gram").agg(F.count("*").alias("members"), F.max(F.col("n") == 1).alias("open")).where("open AND members > 1").select("gram", "members")
    targets = extents.join(open_grams, "gram").select("gram", "extent", "tail", "members", F.col("first.code").alias("code"), F.col("first.low").alias("low"), (F.col("n") == 1).alias("once"))
    targets = stage(targets, "repeat-targets")
    by_text = stage(targets.groupBy("code").agg(F.collect_list(F.struct("low", "once")).alias("targets")), "repeat-wanted")
    rows, numbers = by_text.agg(F.count("*"), F.coalesce(F.sum(F.size("targets")), F.lit(0))).first()
    # The same text may stand in several rows; comparison and windows take an extent once.
    cut = texts.join(_held(by_text, rows, numbers), "code").select("code", "text", "targets").mapInArrow(
        _contexts(depth, gram), "gram bigint, extent bigint, tail int, code bigint, low int, ahead int, once boolean, bytes binary"
    )
    cut = stage(cut.dropDuplicates(["code", "low"]), "repeat-cut").join(targets.select("code", "low", "members"), ["code", "low"])
    # At most SMALL_GROUP extents have a gram here, so no gram is hot; sorted, a group is read in one go.
    small = cut.where(F.col("members") <= SMALL_GROUP).drop("members").repartition("gram").sortWithinPartitions("gram", "extent", "tail")
    small = small.mapInArrow(_compare(depth), "code bigint, begin int, end int")
    windows = cut.where(F.col("members") > SMALL_GROUP).select("bytes", "code", "low", "once").mapInArrow(_windows(depth), "window bigint, tail int, code bigint, begin int, once boolean")
    windows = stage(windows, "repeat-windows")
    twice = windows.groupBy("window", "tail").agg(F.count("*").alias("n")).where("n > 1").select("window", "tail")
    large = windows.where("once").join(twice, ["window", "tail"], "left_semi").select("code", "begin", (F.col("begin") + depth).alias("end"))
    # An extent that many texts share is one hot key, so not it is joined: the places of the others, each once, are taken out.
    alone = extents.where("n = 1").select("first.code", "first.low")
    places = left.groupBy("code", "low").agg(F.max("high").alias("high"))
    certain = places.join(alone, ["code", "low"], "left_anti").select("code", F.col("low").alias("begin"), (F.col("high") + depth).alias("end"))
    ranges = certain.unionByName(small).unionByName(large)
    return stage(ranges.groupBy("code").agg(F.collect_set(F.struct("begin", "end")).alias("ranges")).mapInArrow(_merge, "code bigint, spans array<int>"), "repeat-spans")


def check_codes(docs: DataFrame, text: str = "text") -> None:
    """Raise if two different texts have one code; one narrow row per document is shuffled."""
    value = F.coalesce(F.col(text), F.lit(""))
    codes = docs.select(F.xxhash64(value).alias("code"), F.crc32(value).alias("check"), F.octet_length(value).alias("size"))
    twice = codes.groupBy("code").agg(F.min("check").alias("a"), F.max("check").alias("b"), F.min("size").alias("c"), F.max("size").alias("d")).where("a <> b OR c <> d")
    if not twice.isEmpty():
        raise ValueError("two texts have one code; give the texts another seed")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        kept, sizes, removed = [], [], []
        for text, spans in zip(text_column(batch), batch.column("spans").to_pylist()):
            raw = text.encode("utf-8")
            spans = spans or []
            parts, last = [], 0
            for begin, end in zip(spans[::2], spans[1::2]):
                parts.append(raw[last:begin])
                last = end
            kept.append(b"".join([*parts, raw[last:]]))
            sizes.append(len(raw))
            removed.append(len(raw) - len(kept[-1]))
        digests = [hashlib.sha256(x).hexdigest() for x in kept]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), batch.column("spans"), pa.array(digests)],
            names=["key", "n_bytes", "n_removed", "spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """Rows (key, n_bytes, n_removed, spans, kept_sha256); spans are begin and end bytes in turn, NULL for none."""
    check_codes(docs, text)
    spans = repeated_spans(docs, text, depth, gram)
    rows, numbers = spans.agg(F.count("*"), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    base = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("code"), F.col(text).alias("text"))
    kind = base.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes bigint, n_removed bigint, spans array<int>, kept_sha256 string"
    joined = base.join(_held(spans, rows, numbers), "code", "left").select("key", "text", "spans")
    return joined.mapInArrow(_cut, schema).withColumnRenamed("key", key)


@query("op8_suffix_repeats")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that repeated 200-byte strings cover."""
    return remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_bytes", "n_removed", F.expr("cast(if(spans IS NULL, 0, size(spans)) div 2 AS bigint)").alias("n_spans"), "kept_sha256"
    )
