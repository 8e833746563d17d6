"""Operator 5, benchmark decontamination: a broadcast set of the test's n-grams.

Spark turns the benchmark into a table of its distinct normalised windows. Up to BLOCK_WINDOWS of them,
counted, become a set of hashes that every task holds. Tasks scan the training texts word by word:
words outside the benchmark's vocabulary cannot be part of a hit, the others form windows whose hashes are
looked up, and every hit is verified word by word. A larger benchmark stays a table: tasks hold only a
bitmap of its hashes, of a bounded size whatever the benchmark, built slice by slice by Spark; the windows of a
text that the bitmap lets pass are joined with the table by a shuffle, which verifies them. Either way the
texts are read once, and the result does not depend on the bound.

Defined results: NULL texts and texts without words have no windows and no hits; an item without
words marks nothing; items with equal windows are all reported; NULL item ids are reported as
nothing but still mark words; an empty benchmark leaves every document clean; repeated rows are
judged row by row. Only ``key``, ``text`` and the two benchmark columns are read, so other columns
cannot clash; the functions that return documents keep all their columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches, text_column
from tokenloom.session import stage
from tokenloom.sources.readers import read_table

#: Words of a window.
WINDOW = 10
#: Most windows of the broadcast set: about 8 bytes of hash and WINDOW ids of 4 bytes each.
BLOCK_WINDOWS = 1_000_000
#: Bits a window of the bitmap for larger benchmarks, its largest size as a power of two (128 MB) and the slices it is built in.
BITS_A_WINDOW = 16
MOST_BITS = 30
SLICES = 256
#: Codes of words that a worker keeps.
CACHED_WORDS = 200_000

#: A-Z lower-cased, every other ASCII character but a-z and 0-9 a blank; bytes over 127 belong to words.
NORMALISE = bytes(
    i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256)
)
WORD = re.compile(rb"[^ ]+")
MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(NORMALISE).split()


class WindowSet:
    """Windows with their owners: word ids, sorted hashes, ids for verification."""

    def __init__(self, items: list[tuple[list[int], list[bytes]]], window: int = WINDOW):
        """``items``: owners and words; more words than a window are all their windows."""
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        for own, words in items:
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1) if size else ():
                windows.setdefault(tuple(ids[start : start + size]), set()).update(own)
        self.by_size: dict[int, tuple[np.ndarray, list[tuple[int, ...]], list[tuple[int, ...]]]] = {}
        for size in {len(w) for w in windows}:
            own = [w for w in windows if len(w) == size]
            hashes = self.hashes(np.array(own, dtype=np.int64).reshape(-1), size)[::size]
            order = np.argsort(hashes, kind="stable")
            self.by_size[size] = (hashes[order], [own[i] for i in order], [tuple(sorted(windows[own[i]])) for i in order])

    @staticmethod
    def hashes(ids: np.ndarray, size: int) -> np.ndarray:
        """Hash of the window that starts at each place but the last ``size`` - 1."""
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIER)
        mixed ^= mixed >> np.uint64(29)
        total = np.zeros(max(0, len(ids) - size + 1), dtype=np.uint64)
        for i in range(size):
            total = total * np.uint64(0xD6E8FEB86659FD93 | 1) + mixed[i : i + len(total)]
        return total

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items whose windows occur."""
        hit = np.zeros(len(words), dtype=bool)
        found: set[int] = set()
        get = self.vocabulary.get
        ids = np.array([get(word, -1) for word in words], dtype=np.int64)
        known = ids >= 0
        for size, (hashes, windows, owners) in self.by_size.items():
            if len(ids) < size:
                continue
            # Only windows all of whose words are in the vocabulary.
            sums = np.concatenate(([0], np.cumsum(known)))
            starts = np.flatnonzero(sums[size:] - sums[:-size] == size)
            if not len(starts):
                continue
            asked = self.hashes(ids, size)[starts]
            places = np.searchsorted(hashes, asked)
            places[places == len(hashes)] = 0
            for start, place in zip(starts[hashes[places] == asked].tolist(), places[hashes[places] == asked].tolist()):
                asked_ids = tuple(ids[start : start + size].tolist())
                # Equal hashes stand next to each other; the words decide.
                while place < len(hashes) and windows[place] != asked_ids and place + 1 < len(hashes) and hashes[place + 1] == hashes[place]:
                    place += 1
                if windows[place] == asked_ids:
                    hit[start : start + size] = True
                    found.update(owners[place])
        return hit, found


class WordCodes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def window_hashes(words: list[bytes], size: int, codes: WordCodes) -> np.ndarray:
    """Hash of every window of ``size`` words."""
    return WindowSet.hashes(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)), size)


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int = WINDOW) -> DataFrame:
    """Rows (size, hash, gram, owners): the distinct windows of the items, words joined by blanks, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in small_batches(batches, "text", 1 << 20):
            for owner, text in zip(batch.column("item").to_pylist(), text_column(batch)):
                words = words_of(text)
                size = min(window, len(words))
                hashes = window_hashes(words, size, codes) if size else np.empty(0, np.uint64)
                for start in range(0, len(hashes), 10_000):
                    own = hashes[start : start + 10_000]
                    grams = [b" ".join(words[i : i + size]) for i in range(start, start + len(own))]
                    arrays = [pa.array([size] * len(own), pa.int32()), pa.array(own.view(np.int64)), pa.array(grams, pa.binary()), pa.array([owner] * len(own), pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["size", "hash", "gram", "owner"])

    rows = benchmark.select(F.col(item).cast("bigint").alias("item"), F.col(text).alias("text"))
    every = rows.mapInArrow(run, "size int, hash bigint, gram binary, owner bigint")
    return stage(every.groupBy("size", "hash", "gram").agg(F.collect_set("owner").alias("owners")), "benchmark-windows")


def small_set(windows: DataFrame, window: int, most: int) -> WindowSet | None:
    """The windows as a set if there are at most ``most``."""
    if windows.count() > most:
        return None
    return WindowSet([(list(row.owners), bytes(row.gram).split(b" ")) for row in windows.select("gram", "owners").toLocalIterator()], window)


def hash_bitmap(windows: DataFrame) -> tuple[int, np.ndarray]:
    """(power, bits packed): bit ``hash >> (64 - power)`` is set for every window; at most 2^MOST_BITS bits, whatever the table."""
    count = windows.count()
    power = max(16, min(MOST_BITS, (BITS_A_WINDOW * count).bit_length()))
    size = (1 << power) // SLICES
    placed = windows.select(F.shiftrightunsigned("hash", 64 - power).alias("bit")).select((F.floor(F.col("bit") / size)).cast("int").alias("slice"), (F.col("bit") % size).cast("int").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers, at = batch.column("slice").to_numpy(), batch.column("at").to_numpy()
            for number in np.unique(numbers).tolist():
                slices.setdefault(number, np.zeros(size, bool))[at[numbers == number]] = True
        if slices:
            packed = [np.packbits(bits, bitorder="little").tobytes() for bits in slices.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array(packed, pa.binary())], names=["slice", "bits"])

    # A slice is whole in one task, so the driver gets each slice once.
    held = np.zeros((1 << power) // 8, np.uint8)
    for row in placed.distinct().repartition(SLICES, "slice").mapInArrow(run, "slice int, bits binary").toLocalIterator():
        held[row.slice * size // 8 : (row.slice + 1) * size // 8] = np.frombuffer(row.bits, np.uint8)
    return power, held


def _passing(held: Broadcast, sizes: list[int]):
    """Windows of the texts that the bitmap lets pass: (digest, size, hash, gram, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power, bits = held.value
        codes = WordCodes()
        for batch in small_batches(batches, "text"):
            found: list[tuple] = []
            for digest, text in zip(batch.column("digest").to_pylist(), text_column(batch)):
                words = words_of(text)
                for size in sizes:
                    if len(words) < size:
                        continue
                    hashes = window_hashes(words, size, codes)
                    place = hashes >> np.uint64(64 - power)
                    for start in np.flatnonzero(bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).tolist():
                        found.append((digest, size, int(hashes[start : start + 1].view(np.int64)[0]), b" ".join(words[start : start + size]), start))
            if found:
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*found), kinds)], names=["digest", "size", "hash", "gram", "start"])

    return run


def _spans(hit: np.ndarray) -> list[int]:
    """Begin and end of every run of hit words, one after the other."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edges.tolist()


HITS = "n_words bigint, spans array<int>, items array<bigint>"


def _scan(held: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: WindowSet = held.value
        for batch in small_batches(batches, "text"):
            counts, spans, items = [], [], []
            for text in text_column(batch):
                words = words_of(text)
                hit, found = sets.scan(words)
                counts.append(len(words))
                spans.append(_spans(hit))
                items.append(sorted(found))
            arrays = [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], "n_words", "spans", "items"])

    return run


def _digest(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _united(docs: DataFrame, text: str, windows: DataFrame) -> DataFrame:
    """Rows (digest, spans, items) of the texts with hits, by a join of the windows that the bitmap lets pass."""
    sizes = [row["size"] for row in windows.select("size").distinct().orderBy("size").collect()]
    held = docs.sparkSession.sparkContext.broadcast(hash_bitmap(windows))
    # Hits depend on the text alone, so its digest names it; equal texts give equal rows.
    rows = docs.select(_digest(text).alias("digest"), F.col(text).alias("text"))
    passing = rows.mapInArrow(_passing(held, sizes), "digest string, size int, hash bigint, gram binary, start int").distinct()
    met = passing.join(windows, ["size", "hash", "gram"])
    span = F.array(F.col("start"), F.col("start") + F.col("size"))
    united = met.select("digest", span.alias("span"), "owners").groupBy("digest").agg(
        F.flatten(F.collect_list("span")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("owners")))).alias("items")
    )
    return united.mapInArrow(_merge_spans, "digest string, spans array<int>, items array<bigint>")


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Rows (key, n_words, spans, items): runs of hit words as (begin, end) pairs, items with occurring windows.

    One row per document.
    """
    spark, windows = docs.sparkSession, benchmark_windows(benchmark, item, item_text, window)
    held = small_set(windows, window, block)
    if held is not None:
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        kind = rows.schema["key"].dataType.simpleString()
        found = rows.mapInArrow(_scan(spark.sparkContext.broadcast(held)), f"key {kind}, {HITS}")
        return found.withColumnRenamed("key", key)
    hits = _united(docs, text, windows)
    base = docs.select(F.col(key).alias("key"), _digest(text).alias("digest"), word_count(F.col(text)).alias("n_words"))
    empty_spans, empty_items = F.array().cast("array<int>"), F.array().cast("array<bigint>")
    joined = base.join(hits, "digest", "left").select(
        "key", "n_words", F.coalesce("spans", empty_spans).alias("spans"), F.coalesce("items", empty_items).alias("items")
    )
    return joined.withColumnRenamed("key", key)


def word_count(text):
    """Words of a text as a column, by the same rule as ``words_of``."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint")


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        merged = []
        for flat in batch.column("spans").to_pylist():
            hit = np.zeros(max(flat), dtype=bool)
            for begin, end in zip(flat[::2], flat[1::2]):
                hit[begin:end] = True
            merged.append(_spans(hit))
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(merged, pa.list_(pa.int32())), batch.column("items")], names=batch.schema.names)


def _cut(value: str, spans: list[int]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = value.encode("utf-8")
    places = [m.span() for m in WORD.finditer(raw.translate(NORMALISE))]
    parts, last = [], 0
    for begin, end in zip(spans[::2], spans[1::2]):
        parts.append(raw[last : places[begin][0]])
        last = places[end - 1][1]
    return b"".join([*parts, raw[last:]]).decode("utf-8")


def _without_spans(held: Broadcast, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: WindowSet = held.value
        for batch in small_batches(batches, text):
            at = batch.schema.get_field_index(text)
            cleaned = []
            for value in batch.column(text).to_pylist():
                spans = _spans(sets.scan(words_of(value))[0]) if value is not None else []
                cleaned.append(_cut(value, spans) if spans else value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(cleaned, batch.schema.field(at).type))

    return run


def _without_joined(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            at = batch.schema.get_field_index(text)
            spans = batch.column("_hit_spans").to_pylist()
            cleaned = [_cut(value, own) if own else value for value, own in zip(batch.column(text).to_pylist(), spans)]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(cleaned, batch.schema.field(at).type))
            yield batch.select([name for name in batch.schema.names if name != "_hit_spans"])

    return run


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents, all their columns, without the hit words and what stands between them.

    The text is judged as it is and the united spans are cut once, so the result does not depend on the size of the benchmark.
    """
    windows = benchmark_windows(benchmark, item, item_text, window)
    held = small_set(windows, window, block)
    if held is not None:
        return docs.mapInArrow(_without_spans(docs.sparkSession.sparkContext.broadcast(held), text), docs.schema)
    hits = _united(docs, text, windows).select(F.col("digest").alias("_hit_digest"), F.col("spans").alias("_hit_spans"))
    joined = docs.withColumn("_hit_digest", _digest(text)).join(hits, "_hit_digest", "left").select(*(f"`{c}`" for c in docs.columns), "_hit_spans")
    return joined.mapInArrow(_without_joined(text), docs.schema)


def _clean_only(held: Broadcast, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: WindowSet = held.value
        for batch in small_batches(batches, text):
            clean = [not sets.scan(words_of(value))[0].any() for value in text_column(batch, text)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents, all their columns, that hold no window of the benchmark."""
    windows = benchmark_windows(benchmark, item, item_text, window)
    held = small_set(windows, window, block)
    if held is not None:
        return docs.mapInArrow(_clean_only(docs.sparkSession.sparkContext.broadcast(held), text), docs.schema)
    hits = _united(docs, text, windows).select(F.col("digest").alias("_hit_digest"))
    return docs.withColumn("_hit_digest", _digest(text)).join(hits, "_hit_digest", "left_anti").select(*(f"`{c}`" for c in docs.columns))


OP5_SQL = r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower_text, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents)),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower_text, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM benchmark)),
bw AS (SELECT item_id, w, least(10, len(w)) AS s, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
g AS MATERIALIZED (SELECT DISTINCT item_id, s, array_to_string(w[i:i + s - 1], ' ') AS gram FROM bw),
sizes AS (SELECT DISTINCT s FROM g),
dw AS (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d, sizes WHERE len(w) >= s),
dg AS (SELECT doc_id, s, i, array_to_string(w[i:i + s - 1], ' ') AS gram FROM dw),
h AS MATERIALIZED (SELECT doc_id, dg.s, i, item_id FROM dg JOIN g ON g.s = dg.s AND g.gram = dg.gram),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + s)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.names, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id"""


@query("op5_decontamination", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Hit words and items of every document."""
    found = contamination(documents(spark, folder), read_table(spark, folder, "benchmark"))
    widths = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(widths, F.lit(0).cast("bigint"), lambda total, x: total + x)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def digest(items: list[int]) -> str:
    """The digest of a list of items, as the query gives it."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
