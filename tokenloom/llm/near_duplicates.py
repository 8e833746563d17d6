"""Operator 3, MinHash near-dedup: a multi-index Hamming join of b-bit signatures.

A text's set of word shingles gets a signature of CHUNKS x SYMBOLS min-hashes of 16 bits each. Two
signatures that differ in at most CHUNKS * (ERRORS + 1) - 1 symbols have, by the pigeonhole
principle, a chunk that differs in at most ERRORS symbols; so every signature is indexed, chunk by
chunk, under all ways to leave out ERRORS symbols, and every pair under that distance shares a key.
At a similarity of 0.8 a pair shares no key with probability 1e-7. What shares a key is compared by
size, by the whole signature and by the least shingles of BINS ranges, and what remains is confirmed
on the full sets.

Equal sets are one node. A bucket's centre is the node that shares the most keys with others. Every
node is compared with the greatest centre of its buckets; the links found make components. Buckets
that still hold several components are bundled by their least node. In a bundle, nodes outside its
largest component meet each other and that component, block against block of bounded size: a first pass
by sketches marks the nodes that may have a partner, a second gets their full sets, counts all
common shingles of two blocks in a product of matrices, and puts out only links that join two parts
of what the blocks hold. So large groups of copies cost their size, no pair that could link two
components is skipped, a group of texts that are alike but not linked puts out no pairs, and no
bucket is one task.

Defined results: NULL, empty and blank texts have no shingles and are linked with nothing; a text
of fewer words than a shingle is one shingle; equal texts, repeated rows and equal ids share a
component, whose id is the smallest that is not NULL; a NULL id is never kept by ``kept`` (it is not
the smallest id of anything), and ``kept`` marks all rows that repeat the smallest id, while
``drop_copies`` keeps one row of each component whatever the ids; an empty table gives an empty table. Only ``key`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches, text_column
from tokenloom.llm.components import components
from tokenloom.session import stage

#: Words of a shingle, and least similarity in percent, unless a caller says otherwise.
SHINGLE = 5
PERCENT = 80
CHUNKS, SYMBOLS, ERRORS = 12, 5, 1
SIGNATURE = CHUNKS * SYMBOLS
#: Candidates that differ in more symbols are not near: six standard deviations beyond a similarity of 0.8.
FAR = 30
#: Ranges of shingle codes whose least code is kept, as a byte, to estimate the similarity more closely.
BINS = 256
#: Standard deviations that an estimate may lie below the similarity asked for.
DOUBT = 6
#: Nodes of a block of the comparison across components, and columns of one product of their sets.
BLOCK = 256
COLUMNS = 4_096
#: Codes of two blocks that are compared at a time.
CODES_AT_ONCE = 1 << 19
#: Most node numbers that are broadcast to pick texts from the corpus; more are joined by a shuffle.
BROADCAST_NODES = 1_000_000
CACHED_WORDS = 100_000

LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_RANDOM = np.random.default_rng(20240229)
FACTORS = _RANDOM.integers(0, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 2**63, SIGNATURE, dtype=np.uint64)
#: The places of the symbols that each key of a chunk is made of.
KEPT = list(itertools.combinations(range(SYMBOLS), SYMBOLS - ERRORS))
KEYS = CHUNKS * len(KEPT)


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers, one to one."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)
    return values ^ (values >> np.uint64(32))


class WordCodes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


CODES = WordCodes()


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit codes."""
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(codes))
    count = len(codes) - size + 1
    # The number of words belongs to the code: a short text is no shingle of a longer one.
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = mix(total + codes[i : i + count])
    return np.unique(total)


def signature(codes: np.ndarray) -> np.ndarray:
    """The symbols of a set that is not empty."""
    lowest = np.full(SIGNATURE, 2**64 - 1, np.uint64)
    for start in range(0, len(codes), 512):
        part = codes[start : start + 512, None] * FACTORS + OFFSETS
        lowest = np.minimum(lowest, part.min(axis=0))
    return (mix(lowest) >> np.uint64(48)).astype(np.uint16)


def bins_of(codes: np.ndarray) -> np.ndarray:
    """A byte for the least code of each range, 0 where the range is empty; ``codes`` are sorted."""
    found = np.zeros(BINS, np.uint8)
    place = (codes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    found[place[first]] = 1 + (mix(codes[first]) >> np.uint64(33)) % np.uint64(255)
    return found


def alike(signs_a: np.ndarray, signs_b: np.ndarray, bins_a: np.ndarray, bins_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of sketches (or one against many) may stand for sets of that similarity."""
    near = np.atleast_1d((signs_a != signs_b).sum(axis=-1) <= FAR)
    rows = np.flatnonzero(near)
    if len(rows):
        a, b = (x if x.ndim == 1 else x[rows] for x in (bins_a, bins_b))
        held = (a | b) > 0
        used, same = held.sum(axis=-1), ((a == b) & held).sum(axis=-1)
        share = percent / 100
        near[rows] = same >= share * used - DOUBT * np.sqrt(share * (1 - share) * used)
    return near


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each signature: one per chunk and choice of symbols left in."""
    chunks = signatures.reshape(len(signatures), CHUNKS, SYMBOLS).astype(np.uint64)
    keys = np.empty((len(signatures), CHUNKS, len(KEPT)), np.uint64)
    names = np.arange(CHUNKS, dtype=np.uint64)
    for k, places in enumerate(KEPT):
        total = np.broadcast_to(mix(names * np.uint64(len(KEPT)) + np.uint64(k + 1)), keys.shape[:2]).copy()
        for place in places:
            total = mix(total + chunks[:, :, place])
        keys[:, :, k] = total
    return keys.reshape(len(signatures), KEYS)


def node_of(codes: np.ndarray) -> tuple[int, int]:
    """Number of a set, and a second digest that tells two sets of one number apart."""
    raw = codes.tobytes()
    return xxhash.xxh64_intdigest(raw, 1) - 2**63, xxhash.xxh64_intdigest(raw, 2) - 2**63


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            nodes, checks, counts, signs, bins = [], [], [], [], []
            for text in text_column(batch):
                codes = shingles(text, size)
                node, check = node_of(codes) if len(codes) else (None, None)
                nodes.append(node)
                checks.append(check)
                counts.append(len(codes))
                signs.append(signature(codes).tobytes() if len(codes) else None)
                bins.append(bins_of(codes).tobytes() if len(codes) else None)
            arrays = [pa.array(column, pa.int64()) for column in (nodes, checks, counts)] + [pa.array(column, pa.binary()) for column in (signs, bins)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("code"), *arrays], names=["key", "code", "node", "check", "n", "signature", "bins"])

    return run


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            signs = np.array([np.frombuffer(s, np.uint16) for s in batch.column("signature").to_pylist()]).reshape(-1, SIGNATURE)
            nodes = np.repeat(batch.column("node").to_numpy(), KEYS)
            yield pa.RecordBatch.from_arrays([pa.array(index_keys(signs).view(np.int64).reshape(-1)), pa.array(nodes)], names=["key", "node"])


def describe(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Rows (key, code of the text, node, check, n, signature), staged: a narrow table that everything else reads."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("code"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, code bigint, node bigint, check bigint, n bigint, signature binary, bins binary"
    return stage(rows.mapInArrow(_describe(size), schema), "near-described")


def sketches(batch: pa.RecordBatch, signs: str = "signature", bins: str = "bins") -> tuple[np.ndarray, np.ndarray]:
    """Signatures and bins of a batch, a row each."""
    symbols = np.frombuffer(b"".join(batch.column(signs).to_pylist()), np.uint16).reshape(-1, SIGNATURE)
    return symbols, np.frombuffer(b"".join(batch.column(bins).to_pylist()), np.uint8).reshape(-1, BINS)


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the similarity."""
    sided = pairs.join(nodes.toDF("a", "n_a", "signature_a", "bins_a"), "a").join(nodes.toDF("b", "n_b", "signature_b", "bins_b"), "b")
    sided = sided.where((100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (signs_a, bins_a), (signs_b, bins_b) = (sketches(batch, f"signature_{end}", f"bins_{end}") for end in "ab")
            keep = alike(signs_a, signs_b, bins_a, bins_b, percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return sided.select("a", "b", "signature_a", "signature_b", "bins_a", "bins_b").mapInArrow(run, "a bigint, b bigint")


def _texts_of(wanted: DataFrame, docs: DataFrame, described: DataFrame, text: str) -> DataFrame:
    """Rows (node, text), staged: one text stands for a node; it is found in the corpus by its digest."""
    chosen = stage(described.join(wanted, "node").groupBy("node").agg(F.min("code").alias("code")), "near-chosen")
    small = chosen.count() <= BROADCAST_NODES
    texts = docs.select(F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("code"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(chosen) if small else chosen, "code").groupBy("node").agg(F.first("text").alias("text"))
    return stage(texts, "near-texts")


def _confirm(pairs: DataFrame, docs: DataFrame, described: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links: the pairs whose full sets are similar enough."""
    pairs = stage(pairs, "near-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts_of(wanted, docs, described, text)
    # The second join leaves the rows of one ``a`` together, so its set is made once.
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", np.empty(0, np.uint64))
        for batch in small_batches(batches, "text_a"):
            keep = []
            for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if a != last[0]:
                    last = (a, shingles(a, size))
                right = shingles(b, size)
                common = len(np.intersect1d(last[1], right, assume_unique=True))
                keep.append(100 * common >= percent * (len(last[1]) + len(right) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stage(both.mapInArrow(run, "a bigint, b bigint"), "near-links")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """Rows (node, codes): the packed shingles of texts, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            codes = pa.array([shingles(text, size).tobytes() for text in text_column(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), codes], names=["node", "codes"])

    return stage(texts.select("node", "text").mapInArrow(run, "node bigint, codes binary"), "near-sets")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Runs of rows that agree in ``names``; the rows come sorted by them, a run may span batches."""
    current, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name).to_numpy() for name in names]
        borders = np.flatnonzero(np.any([np.diff(column) != 0 for column in columns], axis=0)) + 1
        for start, end in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
            group = tuple(int(column[start]) for column in columns)
            if held and group != current:
                yield current, held
                held = []
            current = group
            held.append(batch.slice(start, end - start))
    if held:
        yield current, held


def _table(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _partners(percent: int):
    """Mark the nodes of two blocks that may be near a node of another component."""

    def marks(rows: pa.RecordBatch) -> np.ndarray:
        main, roots, sizes = (rows.column(name).to_numpy(zero_copy_only=False) for name in ("main", "root", "n"))
        signs, bins = sketches(rows)
        found = np.zeros(rows.num_rows, bool)
        for i in np.flatnonzero(~main):
            places = np.flatnonzero((roots != roots[i]) & (100 * sizes >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes))
            if len(places):
                places = places[alike(signs[places], signs[i], bins[places], bins[i], percent)]
                found[places] = True
                found[i] |= bool(len(places))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _groups(batches, GROUP):
            rows = _table(parts)
            found = marks(rows)
            if found.any():
                yield rows.select([*GROUP, "node", "root"]).filter(pa.array(found))

    return run


GROUP = ("bundle", "i", "j")


def common_counts(sets: list[np.ndarray], at_once: int = CODES_AT_ONCE) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets of sorted, distinct codes.

    Counts of ranges of codes add up, so about ``at_once`` codes are compared at a time, however long the sets are.
    """
    total = np.zeros((len(sets), len(sets)), np.float64)
    ranges = 1 + sum(map(len, sets)) // at_once
    borders = np.array([i * 2**64 // ranges for i in range(1, ranges)], np.uint64)
    cuts = [np.concatenate(([0], np.searchsorted(codes, borders), [len(codes)])) for codes in sets]
    for i in range(ranges):
        total += _common_in([codes[cut[i] : cut[i + 1]] for codes, cut in zip(sets, cuts)])
    return total


def _common_in(sets: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(codes) for codes in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    fresh = np.diff(every, prepend=every[:1] + np.uint64(1)) != 0
    column = np.cumsum(fresh) - 1
    # Codes that one set only has are in no intersection.
    often = np.bincount(column)[column] > 1
    _, column = np.unique(column[often], return_inverse=True)
    owner = owner[often]
    total = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        cells = np.zeros((len(sets), COLUMNS), np.float32)
        cells[owner[low:high], column[low:high] - start] = 1
        total += cells @ cells.T
    return total


def joining_links(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between nodes of different parts, as few as join what all links between them join."""
    counts, sizes = common_counts(sets), np.array([len(codes) for codes in sets])
    linked = 100 * counts >= percent * (sizes[:, None] + sizes[None, :] - counts)
    names, part = np.unique(roots, return_inverse=True)
    up = list(range(len(names)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    a, b = np.nonzero(np.triu(linked & (part[:, None] != part[None, :]), 1))
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(part[x]), top(part[y])
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((int(nodes[x]), int(nodes[y])))
    return out


def _joined(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _groups(batches, GROUP):
            rows = _table(parts)
            sets = [np.frombuffer(codes, np.uint64) for codes in rows.column("codes").to_pylist()]
            links = joining_links(rows.column("node").to_numpy(), rows.column("root").to_numpy(), sets, percent)
            if links:
                a, b = (pa.array(column, pa.int64()) for column in zip(*links))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return run


def _across(buckets: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (bundle, i, j, main, node, root, sketches): the nodes that have to meet, block by block."""
    placed = buckets.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("bundle")).where("low < high")
    members = stage(placed.join(several.select("key", "bundle"), "key").select("bundle", "node", "root").distinct(), "near-bundles")
    parts = members.groupBy("bundle", "root").agg(F.count("*").alias("size"))
    sizes = parts.groupBy("bundle").agg(F.max(F.struct("size", "root")).alias("main"), F.sum("size").alias("size"))
    sizes = sizes.select("bundle", F.col("main.root").alias("main_root"), F.ceil(F.col("main.size") / BLOCK).alias("main_blocks"), F.ceil((F.col("size") - F.col("main.size")) / BLOCK).alias("blocks"))
    members = members.join(sizes, "bundle").withColumn("main", F.col("root") == F.col("main_root"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("main_blocks")).otherwise(F.col("blocks")))
    # Blocks of the largest component have the numbers -1, -2 and so on; they do not meet each other.
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least("own", i).alias("i"), F.greatest("own", i).alias("j")))
    with_main = F.transform(F.sequence(F.lit(1), F.col("main_blocks")), lambda m: F.struct(F.col("own").alias("i"), (-m).alias("j")))
    from_main = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(i.alias("i"), (-1 - F.col("own")).alias("j")))
    met = F.when(F.col("main"), from_main).otherwise(F.concat(others, with_main))
    dealt = members.withColumn("own", own).select("bundle", "main", "node", "root", F.explode(met).alias("met"))
    return dealt.select("bundle", "met.i", "met.j", "main", "node", "root").join(nodes, "node")


def _rest(buckets: DataFrame, roots: DataFrame, nodes: DataFrame, docs: DataFrame, described: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links between components that share a key, enough to join what all such links join."""

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)

    met = _across(buckets, roots, nodes).select(*GROUP, "main", "node", "root", "n", "signature", "bins")
    marked = stage(together(met).mapInArrow(_partners(percent), "bundle bigint, i bigint, j bigint, node bigint, root bigint"), "near-marked")
    sets = _sets(_texts_of(marked.select("node").distinct(), docs, described, text), size)
    full = marked.join(sets, "node").select(*GROUP, "node", "root", "codes")
    return stage(together(full).mapInArrow(_joined(percent), "a bigint, b bigint"), "near-links")


def _centred(buckets: DataFrame) -> DataFrame:
    """Rows (key, node, rep, gathered): the buckets with their centre, the node whose keys gather the most nodes, and that sum."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("members"))
    gathered = buckets.join(sizes, "key").groupBy("node").agg(F.sum("members").alias("gathered"))
    centres = buckets.join(gathered, "node").groupBy("key").agg(F.max(F.struct("gathered", "node")).alias("centre"))
    return buckets.join(centres.select("key", F.col("centre.node").alias("rep"), F.col("centre.gathered").alias("gathered")), "key")


def _with_centres(buckets: DataFrame) -> DataFrame:
    """Pairs of nodes with the greatest centre of their buckets."""
    found = buckets.where("node <> rep").groupBy("node").agg(F.max(F.struct("gathered", "rep")).alias("best"))
    return found.select(F.least("best.rep", "node").alias("a"), F.greatest("best.rep", "node").alias("b")).distinct()


def _placed(docs: DataFrame, described: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Rows (key, code, n, node, root) of the described ones; without shingles the root is NULL."""
    nodes = described.where("node IS NOT NULL").groupBy("node").agg(
        F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("bins").alias("bins"),
        F.when(F.min("check") == F.max("check"), F.lit(True)).otherwise(F.raise_error(F.lit("two shingle sets of one number: change the seed"))).alias("one"),
    )
    nodes = stage(nodes.where("one").select("node", "n", "signature", "bins"), "near-nodes")
    keys = nodes.select("node", "signature").mapInArrow(_index, "key bigint, node bigint")
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    buckets = stage(_centred(stage(keys.join(shared, "key"), "near-shared")), "near-buckets")
    links = _confirm(_near(_with_centres(buckets), nodes, percent), docs, described, text, size, percent)
    roots = stage(components(links), "near-roots")
    links = _rest(buckets, roots, nodes, docs, described, text, size, percent)
    if not links.isEmpty():
        roots = stage(components(roots.where("node <> root").toDF("a", "b").unionByName(links)), "near-roots")
    return described.select("key", "code", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows (key, code, n_shingles, component_id, kept); ``code`` is the xxhash64 of the text."""
    # A text without shingles is a component of its own.
    placed = _placed(docs, describe(docs, key, text, size), text, size, percent)
    linked = placed.where("root IS NOT NULL")
    lowest = linked.groupBy("root").agg(F.min("key").alias("component_id"))
    own = placed.where("root IS NULL").select("key", "code", "n", F.col("key").alias("component_id"))
    every = linked.join(lowest, "root").select("key", "code", "n", "component_id").unionByName(own)
    return every.select(
        F.col("key").alias(key), "code", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, all their columns, one of each group: a row with the smallest id, or any one where no row has an id.

    Rows without shingles stay.
    """
    # Rows are told apart by a number, as ids may repeat or be NULL; it is staged with them, so it stays the same.
    numbered = stage(docs.withColumn("_near_row", F.monotonically_increasing_id()), "near-numbered")
    pair = F.struct(F.col(key).alias("id"), F.col("_near_row").alias("row"))
    described = describe(numbered.withColumn("_near_pair", pair), "_near_pair", text, size)
    placed = stage(_placed(numbered, described, text, size, percent).where("root IS NOT NULL").select("root", F.col("key.id").isNull().alias("no_id"), "key.id", "key.row"), "near-judged")
    first = placed.groupBy("root").agg(F.min(F.struct("no_id", "id", "row")).alias("first"))
    gone = placed.join(first, "root").where(F.col("row") != F.col("first.row")).select(F.col("row").alias("_near_row"))
    gone = stage(gone, "near-gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_NODES else gone
    return numbered.join(gone, "_near_row", "left_anti").select(*(f"`{c}`" for c in docs.columns))


@query("op3_minhash_near_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document, by four-word shingles."""
    return near_duplicates(documents(spark, folder), size=4).select("doc_id", "n_shingles", "component_id", "kept")
