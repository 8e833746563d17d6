"""Operator 12, filter interaction audit: what every order of five filters keeps, and which filter does the work.

Four filters judge a text alone: A few words, B few distinct words, C many capitals, D a sign of
``SIGNS``. The fifth, E, asks whether a smaller id has the same text anywhere in the table. It is
answered by radix tries: texts are dealt to ranges by prefixes as long as it takes to tell the texts
of a sample apart; in each range the full texts go into a compressed trie whose terminals hold the
least id, and walking the trie gives the rows that hold it. Tasks build tries of bounded size of the
rows they read first, so of a text that a third of all rows have, few rows travel: a row with more than
the least id of its task is a duplicate already. A range that is still heavy after ``PREFIX`` bytes is
dealt on by a digest of the whole text, so equal texts always meet. What remains of a document is a
mask of five bits; masks are counted per part and label, and all 120 orders are read off those counts.

Defined results: a NULL text is empty, a NULL ``lang`` the part of the empty name; equal texts of one
id (repeated rows) are no duplicates of each other; a row with a NULL id is no duplicate and makes
none, as NULL is not smaller than anything, and has no labels; of repeated labels one that says 1
counts; an empty table gives no rows. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches
from tokenloom.sources.readers import read_table

FILTERS = "ABCDE"
#: Fewest words, least percent of distinct words, most percent of capitals, signs that no text may hold.
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
SIGNS = "#$%&*|"
#: Bit of each filter in a mask.
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}

#: Distinct texts whose prefixes set the borders of the ranges, and the longest prefix. They balance the work only.
SAMPLE = 40_000
PREFIX = 256
MAX_RANGES = 8_192
#: Bytes of text in one trie, of a range and of the rows a task reads.
TRIE_BYTES = 16 << 20

_CAPITALS = bytes(range(65, 91))
_SIGN = re.compile(f"[{re.escape(SIGNS)}]")


def own_mask(text: str, raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()
    mask = BIT["A"] if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < MIN_DISTINCT * len(words):
        mask |= BIT["B"]
    if 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MAX_CAPITALS * len(text):
        mask |= BIT["C"]
    return mask | BIT["D"] if _SIGN.search(text) else mask


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:  # a[:low] == b[:low], a[:high + 1] differ
        middle = (low + high) // 2
        if a[low : middle + 1] == b[low : middle + 1]:
            low = middle + 1
        else:
            high = middle
    return low


class Node:
    """A node of a trie: the bytes on the edge to it, children by first byte, and what a text that ends here holds."""

    __slots__ = ("edge", "children", "least", "rows", "mask", "repeated")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.children: dict[int, Node] = {}
        self.rows: dict[str, int] | None = None  # rows with the least id, counted by part
        self.least = None
        self.mask = 0
        self.repeated = False


class Trie:
    """Compressed trie of byte strings with the least id of each at its terminal."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def terminal(self, text: bytes) -> Node:
        """The node where a text ends, made if need be."""
        node, at, size = self.root, 0, len(text)
        while at < size:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += size - at + 200
                return child
            edge = child.edge
            if text.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            same = common_prefix(edge, text[at : at + len(edge)])
            upper = node.children[text[at]] = Node(edge[:same])
            child.edge = edge[same:]
            upper.children[child.edge[0]] = child
            self.bytes += 200
            node, at = upper, at + same
        return node

    def insert(self, text: bytes, key, part: str, mask: int, count: int, out: list) -> None:
        """Add rows of a text; rows with more than its least id go out as duplicates."""
        node = self.terminal(text)
        if node.rows is None:
            node.least, node.rows, node.mask = key, {part: count}, mask
            return
        node.repeated = True
        if key < node.least:
            out.extend((node.least, p, mask | BIT["E"], n) for p, n in node.rows.items())
            node.least, node.rows = key, {part: count}
        elif key == node.least:
            node.rows[part] = node.rows.get(part, 0) + count
        else:
            out.append((key, part, mask | BIT["E"], count))

    def walk(self) -> Iterator[tuple[bytes, Node]]:
        """All texts with their terminals."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node.edge
            if node.rows is not None:
                yield text, node
            stack.extend((text, child) for child in node.children.values())


class Ranges:
    """Borders of the ranges and, for those that prefixes cannot cut finely enough, their number of digest parts."""

    def __init__(self, sample: list[tuple[bytes, int]], wanted: int, most: float):
        """``sample``: prefixes with weights; ``wanted`` ranges of about equal weight; ``most``: weight beyond which a range is cut by digest."""
        sample = sorted(sample)
        share = sum(weight for _, weight in sample) / max(1, wanted)
        self.borders: list[bytes] = []
        weights, gathered = [0], 0
        for i, (prefix, weight) in enumerate(sample):
            if gathered >= share and prefix != sample[i - 1][0]:
                self.borders.append(prefix[: common_prefix(sample[i - 1][0], prefix) + 1])
                weights.append(0)
                gathered = 0
            gathered += weight
            weights[-1] += weight
        self.parts = [max(1, round(weight / most + 0.5)) if weight > most else 1 for weight in weights]
        self.starts = list(itertools.accumulate([0, *self.parts]))
        self.total = self.starts[-1]

    def bucket(self, text: bytes) -> int:
        at = bisect_right(self.borders, text)
        parts = self.parts[at]
        return self.starts[at] + (xxhash.xxh64_intdigest(text) % parts if parts > 1 else 0)


def plan_ranges(docs: DataFrame, text: str) -> Ranges:
    """Ranges from an even sample of the distinct texts: those whose digest falls to the sample."""
    rows = docs.count()
    nth = max(1, rows // SAMPLE)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    digested = docs.select(F.xxhash64(raw).alias("digest"), F.substring(raw, 1, PREFIX).alias("prefix"), F.octet_length(raw).alias("size"))
    taken = digested.where(F.pmod("digest", F.lit(nth)) == 0).groupBy("digest").agg(F.min("prefix").alias("prefix"), F.min("size").alias("size"))
    sample = [(bytes(row.prefix), row.size + 1) for row in taken.select("prefix", "size").collect()]
    weight = sum(size for _, size in sample) * nth
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MAX_RANGES, max(4 * tasks, weight // TRIE_BYTES))
    return Ranges(sample, wanted, max(weight / wanted, TRIE_BYTES) / nth)


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    keys, parts, masks, counts = zip(*rows) if rows else ((), (), (), ())
    arrays = [pa.array(keys, kind), pa.array(parts, pa.string()), pa.array(masks, pa.int32()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "part", "mask", "n"])


def _to_ranges(ranges: Ranges, trie_bytes: int):
    """Judge texts and combine equal ones in tries; rows without text are decided already."""

    def emit(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        """``rows``: (bucket, text or None, key, part, mask, n)."""
        inner = _rows([row[2:] for row in rows], kind)
        head = [pa.array([row[0] for row in rows], pa.int32()), pa.array([row[1] for row in rows], pa.binary())]
        return pa.RecordBatch.from_arrays([*head, *inner.columns], names=["bucket", "text", *inner.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, kind = Trie(), None

        def leave(node_rows: Iterator[tuple[bytes, Node]]) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for text, node in node_rows:
                bucket = ranges.bucket(text)
                rows.extend((bucket, text, node.least, part, node.mask, n) for part, n in node.rows.items())
                size += len(text) * len(node.rows)
                if size > 4 << 20:
                    yield emit(rows, kind)
                    rows, size = [], 0
            if rows:
                yield emit(rows, kind)

        for batch in small_batches(batches, "text"):
            kind, decided = batch.column("key").type, []
            columns = (batch.column(name).to_pylist() for name in ("key", "text", "part"))
            for key, text, part in zip(*columns):
                text = text or ""
                raw = text.encode("utf-8")
                mask = own_mask(text, raw)
                if key is None:
                    decided.append((key, part, mask, 1))
                else:
                    trie.insert(raw, key, part, mask, 1, decided)
            if decided:
                yield emit([(-1 - i % ranges.total, None, *row) for i, row in enumerate(decided)], kind)
            if trie.bytes > trie_bytes:
                # Texts met twice stay, so a frequent one leaves a task once; the rest makes room.
                full, trie = trie, Trie()
                stay, kept = [], 0
                for text, node in full.walk():
                    if node.repeated and kept + len(text) <= trie_bytes // 4:
                        kept += len(text)
                        stay.append((text, node))
                staying = {id(node) for _, node in stay}
                yield from leave((text, node) for text, node in full.walk() if id(node) not in staying)
                for text, node in stay:
                    again = trie.terminal(text)
                    again.least, again.rows, again.mask, again.repeated = node.least, node.rows, node.mask, True
        yield from leave(trie.walk())

    return run


def _from_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One trie after the other: the rows come sorted by bucket."""
    trie, current, kind = Trie(), None, None

    def least() -> list[tuple]:
        return [(node.least, part, node.mask, n) for _, node in trie.walk() for part, n in node.rows.items()]

    for batch in small_batches(batches, "text", 16 << 20):
        kind, out = batch.column("key").type, []
        columns = (batch.column(name).to_pylist() for name in ("bucket", "text", "key", "part", "mask", "n"))
        for bucket, text, key, part, mask, n in zip(*columns):
            if text is None:
                out.append((key, part, mask, n))
                continue
            if bucket != current:
                out.extend(least())
                trie, current = Trie(), bucket
            trie.insert(text, key, part, mask, n, out)
        if out:
            yield _rows(out, kind)
    if kind is not None:
        yield _rows(least(), kind)


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Rows (key, part, mask, n): the filters that documents fail, as bits of ``BIT``; ``n`` rows are alike."""
    ranges = plan_ranges(docs, text)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    kind = rows.schema["key"].dataType.simpleString()
    dealt = rows.mapInArrow(_to_ranges(ranges, trie_bytes), f"bucket int, text binary, key {kind}, part string, mask int, n bigint")
    found = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_from_ranges, f"key {kind}, part string, mask int, n bigint")
    return found.groupBy("key", "part", "mask").agg(F.sum("n").alias("n"))


def mask_counts(failed: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (part, mask, good, toxic, n): documents by the filters they fail and their labels."""
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # Rows without an id have no labels; they stay out of the join, where they would be one key.
    named = failed.where("key IS NOT NULL").join(known, "key", "left")
    every = named.unionByName(failed.where("key IS NULL"), allowMissingColumns=True)
    good, toxic = (F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic"))
    return every.select("part", "mask", good, toxic, "n").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def all_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    orders = ["".join(order) for order in itertools.permutations(FILTERS)]
    rows = counts.withColumn("filter_order", F.explode(F.lit(orders)))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.expr("substring(filter_order, step, 1)")
    bit = sum((F.when(letter == name, value).otherwise(0) for name, value in BIT.items()), F.lit(0))
    before = sum((F.when(F.locate(name, F.col("filter_order")) < F.col("step"), value).otherwise(0) for name, value in BIT.items()), F.lit(0))
    rows = rows.withColumn("bit", bit).withColumn("before", before)
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    removed = fails & ~earlier

    def total(condition, value=None):
        return F.sum(F.when(condition, F.col("n") if value is None else value).otherwise(F.lit(0).cast("bigint")))

    # Of the filters that a document fails each is the first in an equal share of all orders.
    share = F.expr(f"n * ({len(orders)} div greatest(bit_count(mask), 1))")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The whole audit of ``docs`` with ``labels`` (key, quality, toxic)."""
    return all_orders(mask_counts(failures(docs, key, text, part), labels, key))


_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), known AS (
  SELECT doc_id, coalesce(max(quality), 0) = 1 AS good, coalesce(max(toxic), 0) = 1 AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < {MIN_WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[{SIGNS}]') THEN 'D' ELSE '' END
         || CASE WHEN first_id < texts.doc_id THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN known ON texts.doc_id = known.doc_id
), counts AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), met AS (
  SELECT part, filter_order, step, good, toxic, fails, n, letter,
         contains(fails, letter) AS now, translate(fails, before, '') <> fails AS earlier
  FROM steps, counts
)
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (now AND NOT earlier), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (now AND earlier), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
       coalesce(sum(n) FILTER (now AND NOT earlier AND good), 0)::BIGINT AS good_lost,
       coalesce(sum(n) FILTER (now AND NOT earlier AND toxic), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(length(fails), 1)) FILTER (now), 0)::BIGINT AS shapley
FROM met GROUP BY part, filter_order, step
"""


@query("op12_filter_audit", _SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """All 120 orders of the five filters over all documents, by language."""
    return audit(documents(spark, folder), read_table(spark, folder, "labels"))
