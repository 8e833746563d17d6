"""Fingerprints, links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tokenloom.llm import simhash as sh


def plain_fingerprint(text):
    """The fingerprint by its definition, bit by bit."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(codes, limit=3):
    """Root place of every code, over all pairs."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= limit:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def expected(rows):
    """(id, fingerprint, component id) of (id, text) rows."""
    codes = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(codes)
    least = {}
    for (key, _), root in zip(rows, roots):
        if key is not None:
            least[root] = min(least.get(root, key), key)
    return sorted((str(key), code, str(least.get(root))) for (key, _), code, root in zip(rows, codes, roots))


def got(frame, **more):
    found = sh.simhash_duplicates(frame, **more).collect()
    return sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in found)


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[draw.choice(words) for _ in range(draw.randrange(1, 120))] for _ in range(n // 3)]
    texts = []
    for _ in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.randrange(0, 3)):
            text[draw.randrange(len(text))] = draw.choice(words)
        texts.append(draw.choice([" ", "  ", "\n", "\t "]).join(text))
    return texts


def test_components_against_brute_force(spark):
    texts = [*corpus(1), None, "", " \n", "One Two", "one two", "é à b c d", "x", "word " * 30_000]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, "another text of id three")]
    frame = spark.createDataFrame([(k, t, 5, "s") for k, t in rows], "doc_id bigint, text string, fp int, region string")
    assert got(frame) == expected(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_across_small_regions(spark, monkeypatch, seed):
    """Codes of dense clusters and random ones over many regions; links connect what all pairs connect."""
    monkeypatch.setattr(sh, "LEAF", 4)
    monkeypatch.setattr(sh, "FAN", 2)
    draw = random.Random(seed)
    codes = {draw.getrandbits(64) for _ in range(150)}
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(40):
            centre ^= 1 << draw.randrange(64)
            codes.add(centre ^ (1 << draw.randrange(64)))
    codes = sorted(codes)
    frame = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "fp bigint")
    links = sh.hamming_links(frame, rows=16).collect()
    place = {c: i for i, c in enumerate(codes)}
    parent = np.arange(len(codes))
    sh.unite(parent, np.array([place[r.a % 2**64] for r in links]), np.array([place[r.b % 2**64] for r in links]))
    assert parent.tolist() == plain_components(codes)


def test_a_cluster_gives_a_link_a_member_and_region(spark):
    """2,016 codes that are all within four bits of each other: no square of pairs goes out."""
    codes = [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    frame = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "fp bigint")
    assert sh.hamming_links(frame).count() == len(codes) - 1


def test_gray_rank_orders_neighbours(spark):
    import pyspark.sql.functions as F

    frame = spark.range(16).select(F.col("id"), F.col("id").bitwiseXOR(F.shiftrightunsigned("id", 1)).alias("code"))
    ranks = [r.r + 2**63 for r in frame.orderBy("id").select(sh.gray_rank(F.col("code")).alias("r")).collect()]
    assert ranks == list(range(16))


def test_empty_table(spark):
    assert sh.simhash_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = sh.op11(spark, folder).collect()
    assert sorted((str(r.doc_id), int(r.fingerprint, 16), str(r.component_id)) for r in rows) == expected(docs)
    assert all(len(r.fingerprint) == 16 for r in rows)
