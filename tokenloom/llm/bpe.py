"""Operator 4, byte-level BPE: overlapping chunks, stitched where their pre-tokens resynchronise.

The split pattern reads a text from left to right and never looks back, so two runs over the
same text agree from the first boundary that both have. A long text is therefore cut into
overlapping chunks, split in parallel, and stitched at the first common boundary of each
overlap; the pieces of a chunk between its two stitches are encoded where the chunk is. A text
with an overlap without a common boundary (one giant pre-token, say) is split as a whole. Texts of
one chunk need no shuffle. A batch's distinct pieces are looked up, and those not lately seen are merged
together, in lockstep. Decoding concatenates the bytes of the ids.

Defined results: NULL and empty texts have no ids; rows are encoded row by row, so repeated rows
and equal or NULL ids do no harm; an empty table gives an empty table; only ``key`` and ``text``
are read, so other columns of the input cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import documents, query, small_batches, text_column
from tokenloom.operators.merges import Merger
from tokenloom.session import stage

#: Characters of a chunk without its overlap, and of the overlap.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
#: A boundary this near to the end of a cut text may move when more text follows.
UNSURE_CHARS = 4
#: Pieces that are encoded together.
PIECES_AT_ONCE = 1 << 17


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: lines of base64 and number."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Codec:
    """Split pattern and ranks of a byte-level vocabulary; one per worker process and file."""

    _held: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str):
        self.pieces = regex.compile(pattern)
        self.merger = Merger(read_ranks(path))

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._held:
            cls._held[path, pattern] = cls(path, pattern)
        return cls._held[path, pattern]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of texts."""
        return self.pack(self.pieces.findall(text) for text in texts)

    def pack(self, rows: Iterable[list[str]]) -> list[bytes]:
        """Packed ids of lists of pieces; no more lists are held at once than PIECES_AT_ONCE asks for."""
        out: list[bytes] = []
        held: list[str] = []
        sizes: list[int] = []
        for row in rows:
            held += row
            sizes.append(len(row))
            if len(held) >= PIECES_AT_ONCE:
                out += self._packed(held, sizes)
                held, sizes = [], []
        return out + self._packed(held, sizes) if sizes else out

    def _packed(self, pieces: list[str], sizes: list[int]) -> list[bytes]:
        """Packed ids of rows of so many pieces each."""
        ids, counts = self.merger.encode(pieces)
        packed, ends = ids.astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(counts)))
        borders = 4 * ends[np.concatenate(([0], np.cumsum(sizes)))]
        return [packed[start:end] for start, end in zip(borders[:-1].tolist(), borders[1:].tolist())]

    def boundaries(self, text: str) -> list[int]:
        """Ends of the pieces of a text, as places of characters."""
        return [match.end() for match in self.pieces.finditer(text)]

    def decode(self, packed: bytes) -> bytes:
        return self.merger.decode(np.frombuffer(packed, "<u4"))[0].tobytes()


IDS = pa.binary()


def _encode_whole(path: str, pattern: str, decoded: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in small_batches(batches, "text"):
            yield _with_ids(batch, codec.encode_many(text_column(batch)), codec if decoded else None)

    return run


def _with_ids(batch: pa.RecordBatch, ids: list[bytes], codec: Codec | None) -> pa.RecordBatch:
    """The batch with its last column replaced by ids and, given a codec, the bytes they stand for."""
    arrays, names = [*batch.columns[:-1], pa.array(ids, IDS)], [*batch.schema.names[:-1], "ids"]
    if codec:
        arrays.append(pa.array([codec.decode(packed) for packed in ids], IDS))
        names.append("raw")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _split_chunks(path: str, pattern: str):
    """Boundaries of every chunk in places of the whole text; unsure ones at a cut end are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in small_batches(batches, "text"):
            found = []
            for text, start, last in zip(text_column(batch), batch.column("start").to_pylist(), batch.column("last").to_pylist()):
                sure = len(text) if last else len(text) - UNSURE_CHARS
                found.append([start + end for end in codec.boundaries(text) if end <= sure])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, "ends"]
            )

    return run


def _encode_between(path: str, pattern: str):
    """Ids of the pieces of a chunk between its stitches; the boundaries are known, nothing is split again."""

    def between(text: str, start: int, ends: list[int], first: int, final: int) -> list[str]:
        inner = [first, *(end for end in ends if first < end <= final)]
        return [text[a - start : b - start] for a, b in zip(inner, inner[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in small_batches(batches, "text"):
            rows = zip(*(batch.column(name) for name in ("text", "start", "ends", "first", "final")))
            ids = codec.pack(between(*(value.as_py() for value in row)) for row in rows)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(ids, IDS)], names=["row", "chunk", "ids"])

    return run


def _join_ids(path: str, pattern: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern) if decoded else None
        for batch in small_batches(batches, "parts"):
            yield _with_ids(batch, [b"".join(parts) for parts in batch.column("parts").to_pylist()], codec)

    return run


def encode(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
    decoded: bool = False,
) -> DataFrame:
    """Rows (key, ids): the ids of every text as packed little-endian unsigned 32-bit numbers.

    ``decoded`` adds ``raw``, the bytes that the ids stand for, in the same pass and process.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    whole = F.length("text") <= chunk_chars + overlap_chars
    schema = f"key {kind}, ids binary" + ", raw binary" * decoded
    short = rows.where(whole).mapInArrow(_encode_whole(path, pattern, decoded), schema)
    long = _encode_long(rows.where(~whole), path, pattern, chunk_chars, overlap_chars)
    long = long.mapInArrow(_join_ids(path, pattern, decoded), schema)
    return short.unionByName(long).withColumnRenamed("key", key)


def _encode_long(rows: DataFrame, path: str, pattern: str, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """Rows (key, parts): the packed ids of every chunk of a long text, in order."""
    # The same text has the same ids, so a digest of the text names it; rows find their ids by it again.
    # The long rows are read several times, so they are written once.
    named = stage(rows.withColumn("row", F.sha2("text", 256)), "bpe-long")
    texts = named.select("row", "text").dropDuplicates(["row"])
    starts = F.sequence(F.lit(0), F.length("text") - 1, F.lit(chunk_chars))
    chunks = texts.select("row", "text", F.posexplode(starts).alias("chunk", "start")).select(
        "row", "chunk", "start", (F.col("start") + chunk_chars + overlap_chars >= F.length("text")).alias("last"),
        F.expr(f"substring(text, start + 1, {chunk_chars + overlap_chars})").alias("text"),
    )
    # A chunk whose overlap already reaches the end leaves nothing to the chunk after it.
    chunks = chunks.where((F.col("start") == 0) | (F.length("text") > overlap_chars))
    split = chunks.repartition("row", "chunk").mapInArrow(
        _split_chunks(path, pattern), "row string, chunk int, start int, last boolean, text string, ends array<int>"
    )
    # Only the boundaries of the overlaps meet; the window holds the few numbers of one text.
    order = Window.partitionBy("row").orderBy("chunk")
    near = split.select(
        "row", "chunk", "last",
        F.filter("ends", lambda e: e <= F.col("start") + overlap_chars).alias("head"),
        F.filter("ends", lambda e: e >= F.col("start") + chunk_chars).alias("tail"),
    )
    near = near.withColumn("stitch", F.array_min(F.array_intersect("tail", F.lead("head").over(order))))
    near = near.withColumns({
        "first": F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.lag("stitch").over(order)),
        "final": F.when(F.col("last"), F.lit(2**31 - 1)).otherwise(F.col("stitch")),
    })
    near = near.withColumn("bad", F.max(F.col("first").isNull() | F.col("final").isNull()).over(Window.partitionBy("row")))
    stitched = split.drop("last").join(near.where(~F.col("bad")).select("row", "chunk", "first", "final"), ["row", "chunk"])
    parts = stitched.select("row", "chunk", "start", "text", "ends", "first", "final").mapInArrow(
        _encode_between(path, pattern), "row string, chunk int, ids binary"
    )
    good = parts.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"]).alias("parts"))
    bad = texts.join(near.where("bad").select("row").distinct(), "row").mapInArrow(_encode_whole(path, pattern), "row string, ids binary")
    known = good.unionByName(bad.select("row", F.array("ids").alias("parts")))
    return named.select("key", "row").join(known, "row").select("key", "parts")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "raw") -> DataFrame:
    """Add the bytes that the packed ids stand for."""
    names = [name for name in df.columns if name != out]
    schema = ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in names) + f", `{out}` binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for batch in small_batches(batches, ids):
            raw = [None if packed is None else codec.decode(packed) for packed in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, out])

    return df.select(*names).mapInArrow(run, schema)


def default_vocabulary() -> tuple[str, str]:
    """Rank file and split pattern of the multi-language vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_tokens, ids_sha256, decoded_sha256) of every text."""
    path, pattern = default_vocabulary()
    coded = encode(docs, path, pattern, key, text, decoded=True)
    return coded.select(
        key, F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256")
    )


@query("op4_bpe_round_trip")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    return round_trip(documents(spark, folder))
