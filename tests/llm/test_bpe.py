"""Encoding against the library, chunk stitching, exact round trips."""

import hashlib
import random
import struct

import pytest
import tiktoken

from tokenloom.llm import bpe
from tokenloom.operators import merges
from tokenloom.operators.merges import Merger

PATH, PATTERN = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def ids_of(packed: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


TEXTS = [
    None, "", " ", "\n\n  \n", "hello world!", "it's we'll 'round  two 　spaces ", "Größe été ñandú 12345 ١٢٣", "a" * 300, " " * 500,
    "<|endoftext|> x", " \u0085\x00\x1f", "😀👩‍👩‍👧 ok", "hello world!", "é ﬁ Ǆ ⅷ ² ੬",
]


def test_ids_equal_the_library_and_come_back(spark, library):
    rows = [(None if i == 3 else i % 9, text, "x", b"y") for i, text in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, raw binary")
    got = bpe.decode(bpe.encode(frame, PATH, PATTERN), PATH, PATTERN).collect()
    want = sorted((str(r[0]), tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert sorted((str(r.doc_id), tuple(ids_of(r.ids)), bytes(r.raw)) for r in got) == want
    both = bpe.encode(frame, PATH, PATTERN, chunk_chars=100, overlap_chars=20, decoded=True).collect()
    assert sorted((str(r.doc_id), tuple(ids_of(r.ids)), bytes(r.raw)) for r in both) == want


def test_chunks_are_stitched(spark, library):
    draw = random.Random(5)
    words = ["the", " ", "  ", "Wort", "'ll", "été", "12", "!?", "\n", "ñ", "日本語", " ", "'", "s"]
    texts = ["".join(draw.choice(words) for _ in range(draw.randrange(50, 900))) for _ in range(60)]
    texts += ["x" * 1000, "ab " * 700 + "y" * 900 + " cd" * 300, " " * 777, texts[0]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for chunk, overlap in ((64, 16), (200, 40)):
        got = {r.doc_id: ids_of(r.ids) for r in bpe.encode(frame, PATH, PATTERN, chunk_chars=chunk, overlap_chars=overlap).collect()}
        assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_every_character_is_split_as_in_the_library(library):
    codec = bpe.Codec.of(PATH, PATTERN)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    text = "".join(f"a{c}1{c} {c}!" for c in points)
    size = 200_000
    for start in range(0, len(text), size):
        part = text[start : start + size]
        assert ids_of(codec.encode(part)) == library.encode_ordinary(part)


def merge(piece, ranks):
    """Ids of a piece by the definition: the adjacent pair of the lowest rank, first from the left, until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
        if best == 1 << 30:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


def test_merge_orders_agree():
    ranks = bpe.read_ranks(PATH)
    merger, draw = Merger(ranks), random.Random(3)
    pieces = [bytes(draw.choice(b"aabthe \xc3\xa9") for _ in range(draw.randrange(1, 120))) for _ in range(300)] + [b"a", b"the"]
    want = [merge(piece, ranks) for piece in pieces]
    assert [ids_of(packed) for packed in merger.merge(pieces)] == want
    assert [merger.merge_long(piece) for piece in pieces] == want


def test_kept_pieces_are_replaced(monkeypatch, library):
    monkeypatch.setattr(merges, "KEPT", 5)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 3)
    codec = bpe.Codec(PATH, PATTERN)
    texts = ["one two three", "", "four five six seven eight", "one nine", "two zzzqqq one"] * 3
    assert [ids_of(packed) for packed in codec.encode_many(texts)] == [library.encode_ordinary(text) for text in texts]
    assert len(codec.merger.kept) <= 5
    with pytest.raises(ValueError):
        codec.decode(struct.pack("<I", 60_000))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(frame, PATH, PATTERN), PATH, PATTERN).collect() == []


def test_query_on_the_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: r for r in bpe.op4(spark, folder).collect()}
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode_ordinary(row.text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_pieces_are_packed_in_parts(monkeypatch, library):
    texts = ["", "one two", "", "drei vier fünf " * 40, "x", ""]
    for at_once in (1, 3, 50, 1 << 17):
        monkeypatch.setattr(bpe, "PIECES_AT_ONCE", at_once)
        codec = bpe.Codec(PATH, PATTERN)
        assert [ids_of(packed) for packed in codec.encode_many(texts)] == [library.encode_ordinary(text) for text in texts]
        assert codec.encode_many([]) == [] and codec.pack(iter([[], []])) == [b"", b""]
