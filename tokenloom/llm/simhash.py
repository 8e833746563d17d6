"""Operator 11, SimHash near-dedup: a hierarchical index of fingerprints in Gray order.

A text's fingerprint has a bit set if over half of the hashes of its word shingles have it. Distinct
fingerprints are sorted by their rank in the reflected Gray code, where neighbours share most bits,
and cut into regions. A region's index is a tree: a node holds the bits that all fingerprints below
it have in common, less those its parent already holds, so a shared pattern is compared once for the
whole group. A search adds up the differences on the way down and leaves a group as soon as they
exceed the limit; what reaches a leaf is compared in full. The regions' own shared bits are the upper
part of the tree: they are a short table that every task gets, and say which regions a fingerprint
has to be sent to. Between two regions the search goes one way only.

A search does not put out its pairs. The region keeps the components of what it has met, and only
what joins two of them goes out, so a large group of near copies costs a link a member and region.

Defined results: NULL, empty and blank texts have the fingerprint zero, which links like any other;
a text of fewer words than a shingle is one shingle; equal texts, repeated rows and equal ids share a
component, whose id is the smallest that is not NULL (NULL if all its ids are); an empty table gives an
empty table. Only ``key`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches, text_column
from tokenloom.llm.components import components
from tokenloom.session import stage

SHINGLE = 3
SEED = 42
LIMIT = 3
#: Least and most fingerprints of a region; between them there are about REGIONS regions.
REGION_LEAST, REGION_MOST, REGIONS = 4_096, 1 << 20, 1_024
#: Fingerprints of a leaf, children of a node, fingerprints searched at once and cells of one comparison.
LEAF, FAN, SEARCHED, CELLS = 32, 8, 512, 1 << 22
#: Fingerprints that are sent to other regions at once.
SENT = 16_384

LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of a text, repeats included."""
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts, (ends[size - 1 :] - 1).tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        part = np.ascontiguousarray(hashes[start : start + 4096]).astype("<u8").view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = np.array([fingerprint(shingle_hashes(text, size)) for text in text_column(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], names=["key", "fp"])

    return run


def gray_rank(code: Column) -> Column:
    """Place of a code in the reflected Gray order, as a number that sorts like it."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(2**63)))


def shared_bits(codes: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray]:
    """For every ``group`` codes in a row: the bits they have in common, and their values."""
    starts = np.arange(0, len(codes), group)
    ones, zeros = np.bitwise_and.reduceat(codes, starts), np.bitwise_and.reduceat(~codes, starts)
    return ones | zeros, ones


class GrayTree:
    """Index over groups of codes in Gray order; each level holds the shared bits that its parent lacks."""

    def __init__(self, masks: np.ndarray, values: np.ndarray):
        """``masks``, ``values``: the shared bits of the leaves, in order."""
        levels = [(masks, values)]
        while len(levels[-1][0]) > FAN:
            low_masks, low_values = levels[-1]
            starts = np.arange(0, len(low_masks), FAN)
            ones = np.bitwise_and.reduceat(low_masks & low_values, starts)
            zeros = np.bitwise_and.reduceat(low_masks & ~low_values, starts)
            levels.append((ones | zeros, ones))
        levels.reverse()
        self.levels = []
        for i, (mask, value) in enumerate(levels):
            own = mask if i == 0 else mask & ~np.repeat(levels[i - 1][0], FAN)[: len(mask)]
            self.levels.append((own, value & own))

    def search(self, codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (code, leaf) whose shared bits differ in at most ``limit`` places."""
        who = np.zeros(0, np.int64)
        for i, (own, value) in enumerate(self.levels):
            if i == 0:
                who, node = np.repeat(np.arange(len(codes)), len(own)), np.tile(np.arange(len(own)), len(codes))
                apart = np.zeros(len(who), np.uint8)
            else:
                node = (node[:, None] * FAN + np.arange(FAN)).reshape(-1)
                there = node < len(own)
                who, apart, node = np.repeat(who, FAN)[there], np.repeat(apart, FAN)[there], node[there]
            apart = apart + np.bitwise_count((codes[who] ^ value[node]) & own[node])
            near = apart <= limit
            who, node, apart = who[near], node[near], apart[near]
        return who, node


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the parts of a[i] and b[i]; ``parent`` gives every place its part's least place, before and after."""
    while len(a):
        root_a, root_b = parent[a], parent[b]
        apart = root_a != root_b
        a, b, root_a, root_b = a[apart], b[apart], root_a[apart], root_b[apart]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(root_a, root_b), np.minimum(root_a, root_b))
        while True:
            upper = parent[parent]
            if np.array_equal(upper, parent):
                break
            parent[:] = upper


class Region:
    """Codes of one region in Gray order with their tree and the components known so far."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parent = np.arange(len(codes))
        self.tree = GrayTree(*shared_bits(codes, LEAF))
        self.padded = np.concatenate([codes, np.repeat(codes[-1:], -len(codes) % LEAF)]).reshape(-1, LEAF)

    def pairs(self, codes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of pairs (place in ``codes``, place in the region) within the limit."""
        for start in range(0, len(codes), SEARCHED):
            part = codes[start : start + SEARCHED]
            who, leaf = self.tree.search(part, limit)
            for at in range(0, len(who), CELLS // LEAF):
                block = slice(at, at + CELLS // LEAF)
                near = np.bitwise_count(part[who[block], None] ^ self.padded[leaf[block]]) <= limit
                row, place = np.nonzero(near)
                found = leaf[block][row] * LEAF + place
                inside = found < len(self.codes)
                yield who[block][row[inside]] + start, found[inside]

    def link(self, codes: np.ndarray | None, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that join components when ``codes`` are searched (None: the region itself)."""
        size = len(self.codes)
        every = self.codes if codes is None else np.concatenate([self.codes, codes])
        before = np.concatenate([self.parent, np.arange(size, len(every))])
        parent = before.copy()
        for who, found in self.pairs(self.codes if codes is None else codes, limit):
            unite(parent, who if codes is None else who + size, found)
        moved = np.flatnonzero((parent != before) & (before == np.arange(len(every))))
        # The parts keep the least place, so a place of the region never points out of it.
        self.parent = parent[:size]
        return every[moved], every[parent[moved]]


def _pack(limit_rows: int):
    """Regions of the sorted codes of a partition."""

    def region(number: int, codes: np.ndarray) -> pa.RecordBatch:
        mask, value = shared_bits(codes, len(codes))
        arrays = [pa.array([number]), pa.array(mask.view(np.int64)), pa.array(value.view(np.int64)), pa.array([codes.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["region", "mask", "value", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            codes = batch.column("fp").to_numpy().view(np.uint64)
            while len(codes):
                part, codes = codes[: limit_rows - size], codes[limit_rows - size :]
                held.append(part)
                size += len(part)
                if size == limit_rows:
                    yield region(number, np.concatenate(held))
                    number, held, size = number + 1, [], 0
        if size:
            yield region(number, np.concatenate(held))

    return run


def _send(regions: list[tuple[int, int, int]], limit: int):
    """Each region's codes to itself (whole) and to the later regions whose shared bits allow a link."""

    def row(target: int, own: bool, codes: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([target], pa.int64()), pa.array([not own]), pa.array([codes.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["target", "guest", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.array([r[0] for r in regions], np.int64)
        masks, values = (np.array([r[i] for r in regions], np.int64).view(np.uint64) for i in (1, 2))
        tree = GrayTree(masks, values)
        for batch in batches:
            for number, packed in zip(batch.column("region").to_pylist(), batch.column("codes").to_pylist()):
                codes = np.frombuffer(packed, np.uint64)
                yield row(number, True, codes)
                for start in range(0, len(codes), SENT):
                    part = codes[start : start + SENT]
                    found = [tree.search(part[i : i + SEARCHED], limit) for i in range(0, len(part), SEARCHED)]
                    who = np.concatenate([w + i * SEARCHED for i, (w, _) in enumerate(found)])
                    target = np.concatenate([t for _, t in found])
                    later = numbers[target] > number
                    who, target = who[later], target[later]
                    order = np.argsort(target, kind="stable")
                    who, target = who[order], target[order]
                    for each in np.split(np.arange(len(who)), np.flatnonzero(np.diff(target)) + 1):
                        if len(each):
                            yield row(int(numbers[target[each[0]]]), False, part[who[each]])

    return run


def _search(limit: int):
    """Links of every region: its own codes come first, then those sent to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = None
        for batch in batches:
            for guest, packed in zip(batch.column("guest").to_pylist(), batch.column("codes").to_pylist()):
                codes = np.frombuffer(packed, np.uint64)
                if not guest:
                    region = Region(codes)
                a, b = region.link(codes if guest else None, limit)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def region_rows(count: int) -> int:
    """Fingerprints of a region: few regions, as every one sees a share of all others, but none too large for a task."""
    return max(REGION_LEAST, min(REGION_MOST, count // REGIONS))


def hamming_links(nodes: DataFrame, code: str = "fp", limit: int = LIMIT, rows: int | None = None) -> DataFrame:
    """Links (a, b) between distinct codes that differ in at most ``limit`` bits, enough to connect what such pairs connect."""
    spark = nodes.sparkSession
    count = nodes.count()
    rows = rows or region_rows(count)
    parts = max(1, -(-count // rows))
    ordered = nodes.select(F.col(code).alias("fp"), gray_rank(F.col(code)).alias("rank"))
    ordered = ordered.repartitionByRange(parts, "rank").sortWithinPartitions("rank").select("fp")
    regions = stage(ordered.mapInArrow(_pack(2 * rows), "region bigint, mask bigint, value bigint, codes binary"), "gray-regions")
    # One line a region: at most REGIONS and one for REGION_MOST fingerprints, twice that where the ranges are uneven.
    upper = sorted(tuple(row) for row in regions.select("region", "mask", "value").collect())
    if not upper:
        return spark.createDataFrame([], "a bigint, b bigint")
    sent = regions.select("region", "codes").mapInArrow(_send(upper, limit), "target bigint, guest boolean, codes binary")
    dealt = sent.repartition(max(len(upper), spark.sparkContext.defaultParallelism), "target").sortWithinPartitions("target", "guest")
    return dealt.mapInArrow(_search(limit), "a bigint, b bigint")


def simhash_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, limit: int = LIMIT, rows: int | None = None) -> DataFrame:
    """Rows (key, fp, component_id): the fingerprint as a signed number, and the smallest id that links reach."""
    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_fingerprints(size), f"key {kind}, fp bigint")
    found = stage(found, "gray-fingerprints")
    nodes = stage(found.groupBy("fp").agg(F.min("key").alias("low")), "gray-nodes")
    roots = stage(components(hamming_links(nodes, "fp", limit, rows)), "gray-roots")
    # Only fingerprints with a link have a root.
    lowest = roots.join(nodes, roots["node"] == nodes["fp"]).groupBy("root").agg(F.min("low").alias("least"))
    joined = roots.join(lowest, "root").select(F.col("node").alias("fp"), F.col("least"), F.lit(True).alias("linked"))
    placed = nodes.join(joined, "fp", "left").select("fp", F.when(F.col("linked"), F.col("least")).otherwise(F.col("low")).alias("component_id"))
    return found.join(placed, "fp").select(F.col("key").alias(key), "fp", "component_id")


@query("op11_simhash_near_dedup")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
