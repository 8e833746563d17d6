"""Removed bytes against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tokenloom.llm import repeats as rp


def brute(texts, depth):
    """(bytes, removed, spans, digest) per text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + depth] for r in raws for i in range(len(r) - depth + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - depth + 1):
            if seen[r[i : i + depth]] > 1:
                gone[i : i + depth] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(frame, depth, gram):
    rows = rp.remove_repeats(frame, depth=depth, gram=gram).collect()
    return sorted(((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans or []) // 2, r.kept_sha256) for r in rows))


def corpus(seed, n=40):
    draw = random.Random(seed)
    passages = ["".join(draw.choice("abcde fgé") for _ in range(size)) for size in (30, 45, 70, 160)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            kind = draw.random()
            if kind < 0.4:
                p = draw.choice(passages)
                b = draw.randrange(len(p))
                parts.append(p[b : b + draw.randrange(10, 160)])
            elif kind < 0.5:
                parts.append(draw.choice("xy") * draw.randrange(1, 90))
            else:
                parts.append("".join(draw.choice("abcdefghijkl mnop") for _ in range(draw.randrange(5, 120))))
        texts.append("".join(parts))
    return [*texts, texts[0], texts[3], None, "", "ab", texts[5] + "z"]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("small", [64, 2])
def test_brute_force(spark, monkeypatch, seed, small):
    monkeypatch.setattr(rp, "SMALL_GROUP", small)
    texts = corpus(seed)
    frame = spark.createDataFrame([(i if i % 9 else None, t, "c", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, code string, gram int")
    want = sorted((str(i if i % 9 else None), *row) for i, row in enumerate(brute(texts, 40)))
    assert got(frame, 40, 8) == want


def test_segments_and_joins_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(rp, "SEGMENT", 128)
    monkeypatch.setattr(rp, "BROADCAST_ROWS", 0)
    texts = [*corpus(3, 12), "q" * 700, "".join(corpus(4, 12)[i] for i in range(9))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(frame, 40, 8) == sorted((str(i), *row) for i, row in enumerate(brute(texts, 40)))


def test_empty_table(spark):
    assert rp.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {r.doc_id: row for r, row in zip(docs, brute([r.text for r in docs], 200))}
    rows = rp.op8(spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert any(r.n_removed for r in rows)
