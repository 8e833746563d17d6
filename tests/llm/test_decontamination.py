"""Hits against plain windows, blocks of the benchmark, odd rows, removal."""

import random

import pytest

from tokenloom.llm import decontamination as d


def plain(docs, items):
    out = []
    for key, text in docs:
        words = d.words_of(text or "")
        hit, found = set(), set()
        for item, item_text in items:
            own = d.words_of(item_text or "")
            size = min(10, len(own))
            grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            for i in range(len(words) - size + 1):
                if size and tuple(words[i : i + size]) in grams:
                    hit.update(range(i, i + size))
                    found |= {item} - {None}
        out.append((str(key), len(words), sorted(hit), sorted(found)))
    return sorted(out)


def tables(spark):
    draw = random.Random(1)
    text = lambda n: " ".join(draw.choice("abcd") + draw.choice("Xy-9") for _ in range(n))
    items = [(i, text(draw.choice([3, 9, 10, 25]))) for i in range(12)]
    items += [(50, items[0][1]), (51, None), (52, "--"), (None, text(12))]
    docs = [(i, text(5) + " " + (draw.choice(items)[1] or "") + "! " + text(draw.randrange(40))) for i in range(40)]
    docs += [(None, items[-1][1]), (7, None), (8, ""), (9, items[4][1]), (9, items[4][1])]
    return docs, items, spark.createDataFrame([(*r, "c") for r in docs], "doc_id int, text string, spans string"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_hits(spark, block):
    docs, items, frame, bench = tables(spark)
    rows = d.contamination(frame, bench, block=block).collect()
    got = sorted((str(r.doc_id), r.n_words, sorted(i for b, e in zip(r.spans[::2], r.spans[1::2]) for i in range(b, e)), list(r["items"])) for r in rows)
    assert got == plain(docs, items)


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_removal(spark, block):
    docs, items, frame, bench = tables(spark)
    dirty = {k for k, _, hit, _ in plain(docs, items) if hit}
    kept = d.remove_documents(frame, bench, block=block)
    assert kept.columns == frame.columns
    assert not {str(r.doc_id) for r in kept.collect()} & (dirty - {"7", "8", "9", "None"})
    cut = d.remove_spans(frame, bench, block=block).collect()
    assert len(cut) == len(docs) and sum(len(r.text or "") for r in cut) < sum(len(t or "") for _, t in docs)
    assert all(r.text is None for r in cut if r.doc_id == 7 and not r.text)


def test_empty_tables(spark):
    _, _, frame, bench = tables(spark)
    assert d.contamination(frame.limit(0), bench).collect() == []
    assert all(not r.spans for r in d.contamination(frame, bench.limit(0)).collect())
    assert d.remove_documents(frame, bench.limit(0)).count() == frame.count()


def test_removal_does_not_depend_on_blocks(spark):
    # Windows of items in different blocks overlap, and cutting one joins words to a window that never stood there.
    w = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(w[5:15])), (2, " ".join(w[10:22])), (3, " ".join(w[:5] + w[22:27]))]
    rows = [(1, " ".join(w), "a"), (1, " ".join(w), "b"), (2, None, "c"), (3, "", "d"), (None, "Clean, text", "e"), (4, ", ".join(w[:16]), "f")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _kind string")
    bench = spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    whole = " ".join(w[:5]) + "  " + " ".join(w[22:])
    want = [(1, whole, "a"), (1, whole, "b"), (2, None, "c"), (3, "", "d"), (None, "Clean, text", "e"), (4, "w0, w1, w2, w3, w4, , w15", "f")]
    for block in (1_000_000, 12, 1):
        cut = d.remove_spans(frame, bench, block=block)
        assert cut.columns == frame.columns
        assert sorted(map(tuple, cut.collect()), key=str) == sorted(want, key=str)
