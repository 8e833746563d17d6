"""The audit against a plain count over all orders, and its tries against plain sets."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import filter_audit as fa

DOCS = "doc_id bigint, text string, lang string, mask int, n string"
LABELS = "doc_id bigint, quality int, toxic int"


def fails(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {
        name for name, wrong in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
        ) if wrong
    }


def plain(docs, labels):
    """{(part, order, step): counts}, order by order."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    rows = []
    for key, text, part in docs:
        wrong = fails(text or "")
        if key is not None and any(k is not None and k < key and (t or "") == (text or "") for k, t, _ in docs):
            wrong.add("E")
        rows.append((key, part or "", wrong))
    out, parts = {}, {part for _, part, _ in rows}
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    for part in parts:
        mine = [(key, wrong) for key, p, wrong in rows if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in orders:
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(k, w) for k, w in left if name in w]
                left = [(k, w) for k, w in left if name not in w]
                failing = sum(name in w for _, w in mine)
                total[name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(w == {name} for _, w in mine), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(frame, labels):
    rows = fa.audit(frame, labels).collect()
    assert len(rows) == len({(r.part, r.filter_order, r.step) for r in rows})
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}


def corpus(seed, n):
    draw = random.Random(seed)
    texts = []
    for _ in range(n):
        kind = draw.random()
        if kind < 0.3 and texts:
            texts.append(draw.choice(texts))
        elif kind < 0.4:
            texts.append("SHOUT " * draw.randrange(1, 150))
        else:
            long = draw.random() < 0.5
            texts.append(" ".join(f"w{draw.randrange(2000)}" for _ in range(draw.randrange(100, 140) if long else draw.randrange(0, 20))) + draw.choice(["", "", " #", "\n"]))
    return texts


@pytest.mark.parametrize("seed, trie_bytes", [(1, fa.TRIE_BYTES), (2, 3_000)])
def test_audit_against_plain_counts(spark, monkeypatch, seed, trie_bytes):
    monkeypatch.setattr(fa.failures, "__defaults__", (*fa.failures.__defaults__[:-1], trie_bytes))
    draw = random.Random(seed)
    texts = corpus(seed, 120)
    docs = [(i if i % 13 else None, t, draw.choice(["en", "de", None])) for i, t in enumerate(texts)]
    docs += [(5, texts[5], "en"), (5, texts[5], "de"), (500, None, "en"), (501, "", None), (502, texts[5], "en"), (None, texts[5], "en"), (503, "long " * 60_000, "xx")]
    labels = [(i, draw.randrange(2), draw.randrange(2)) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (5, None, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, lang string, mask int, n string").repartition(5)
    assert got(frame, spark.createDataFrame(labels, LABELS)) == plain(docs, labels)


def test_duplicates_in_ranges_cut_by_prefix_and_digest(spark, monkeypatch):
    """A third of all texts share a prefix beyond PREFIX, another third is one text."""
    monkeypatch.setattr(fa, "TRIE_BYTES", 2_000)
    head = "same head " * 60
    docs = [(i, head + str(i % 70)) for i in range(200)] + [(i, "one text for all of them") for i in range(200, 400)] + [(i, f"{i % 150} own words, " * 20) for i in range(400, 600)]
    random.Random(3).shuffle(docs)
    frame = spark.createDataFrame([(k, t, "en") for k, t in docs], "doc_id bigint, text string, lang string")
    ranges = fa.plan_ranges(frame, "text")
    assert max(ranges.parts) > 1 and len(ranges.borders) > 3
    rows = fa.failures(frame, trie_bytes=2_000).select("key", F.col("mask").bitwiseAND(fa.BIT["E"]).alias("e"), "n").collect()
    least = {}
    for key, text in docs:
        least[text] = min(least.get(text, key), key)
    assert sorted((r.key, r.e > 0, r.n) for r in rows) == sorted((k, k > least[t], 1) for k, t in docs)


def test_trie_splits_edges():
    trie, out = fa.Trie(), []
    for key, text in [(5, b"abcd"), (3, b"abcd"), (4, b"ab"), (9, b"abce"), (7, b""), (8, b"ab"), (2, b"b")]:
        trie.insert(text, key, "p", 0, 1, out)
    assert sorted((text, node.least) for text, node in trie.walk()) == [(b"", 7), (b"ab", 4), (b"abcd", 3), (b"abce", 9), (b"b", 2)]
    assert sorted(row[0] for row in out) == [5, 8]


def test_a_frequent_text_leaves_a_task_rarely(spark):
    """Of 30,000 copies in four tasks with tiny tries only a few travel as text."""
    frame = spark.range(30_000).selectExpr("id AS key", "if(id % 3 = 0, concat('text ', id), 'the same text everywhere') AS text", "'en' AS part").repartition(4)
    ranges = fa.Ranges([(b"t", 1)], 1, 1e9)
    dealt = frame.mapInArrow(fa._to_ranges(ranges, 20_000), "bucket int, text binary, key bigint, part string, mask int, n bigint")
    assert dealt.where(F.col("text") == F.lit(b"the same text everywhere")).count() <= 8
    assert dealt.count() == 30_000


def test_empty_table(spark):
    assert fa.audit(spark.createDataFrame([], "doc_id bigint, text string, lang string"), spark.createDataFrame([], LABELS)).collect() == []
