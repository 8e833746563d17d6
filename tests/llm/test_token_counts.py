"""Counts against the library, the splitter against its pattern, block maps against one run."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tokenloom.llm import token_counts as tc

PATH = tc.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def mixed(draw, size):
    parts = ["the", " ", "  ", "Wort", "'ll", "'r", "'re", "'v", "été", "12", "!?", "\n", "ñ", "日本語", " ", "'", "s", "'s", "\t", "'''", "Ω", "x'"]
    return "".join(draw.choice(parts) for _ in range(size))


def test_splitter_equals_the_pattern():
    splitter, draw = tc.Splitter(), random.Random(1)
    pattern = regex.compile(public_tokenizers.PATTERN)
    for size in [*range(1, 40), 200, 1000]:
        for _ in range(10):
            text = mixed(draw, size)
            points = np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), 0x110000)
            begins = np.flatnonzero(splitter.boundaries(points))[:-1].tolist()
            assert begins == [m.start() for m in pattern.finditer(text)], text


def test_counts_equal_the_library(library):
    counter, draw = tc.TokenCounter.of(PATH), random.Random(2)
    texts = [mixed(draw, draw.randrange(0, 400)) for _ in range(300)]
    texts += ["", " ", "a" * 999, " " * 300, "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "\x00a\x00", "aaaaabbbbbab" * 50, "tokenization" * 20]
    sizes, tokens = counter.count(texts)
    assert tokens.tolist() == lengths(library, texts)
    assert sizes.tolist() == [len(t.encode()) for t in texts]


def test_every_character(library):
    counter = tc.TokenCounter.of(PATH)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}!" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    assert counter.count(texts)[1].tolist() == lengths(library, texts)


def test_small_table_starts_anew(library, monkeypatch):
    monkeypatch.setattr(tc, "MAX_STATES", 50)
    counter, draw = tc.TokenCounter(PATH), random.Random(4)
    for _ in range(4):
        texts = [mixed(draw, 60) for _ in range(20)]
        assert counter.count(texts)[1].tolist() == lengths(library, texts)


def test_states_stay_bounded_inside_a_batch(library, monkeypatch):
    """Two megabytes of base64 and one pre-token of 200,000 letters, each in one text."""
    draw = random.Random(7)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    base64 = "".join(draw.choices(signs, k=2_000_000))
    letters = "".join(draw.choices(signs[:52], k=200_000))
    monkeypatch.setattr(tc, "MAX_STATES", 40_000)
    monkeypatch.setattr(tc, "TOGETHER", 16_384)
    counter = tc.TokenCounter(PATH)
    assert counter.count([base64])[1].tolist() == lengths(library, [base64])
    assert len(counter.counter.states) <= 40_000
    assert counter.count([letters, "a"])[1].tolist() == lengths(library, [letters, "a"])
    assert len(counter.counter.states) <= 40_000


def test_rows(spark):
    rows = [(1, "hello world", "x"), (1, "hello world", "y"), (None, None, "z"), (3, "", None), (4, "word " * 600, "w")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = sorted((tuple(r) for r in tc.count_tokens(frame, PATH).collect()), key=str)
    assert got == sorted([(1, 11, 2, False), (1, 11, 2, False), (None, 0, 0, False), (3, 0, 0, False), (4, 3000, 601, True)], key=str)
    assert tc.count_tokens(frame.limit(0), PATH).collect() == []


def test_query_on_the_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.op7(spark, folder).collect()}
    want = lengths(library, [r.text or "" for r in rows])
    assert got == {r.doc_id: (len((r.text or "").encode()), n, n > 512) for r, n in zip(rows, want)}
