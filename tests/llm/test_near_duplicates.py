"""Components against brute force on full sets, the pigeonhole guarantee, odd rows."""

import random
import re

import numpy as np

from tokenloom.llm import near_duplicates as nd
from tokenloom.llm.components import components


def brute(rows, size, percent=80):
    """(id, n, component) by comparing all pairs of full sets."""
    sets = []
    for _, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(ids.get(find(i), key), key)
    return sorted(((key, len(sets[i]), ids.get(find(i))) for i, (key, _) in enumerate(rows)), key=str)


def corpus(seed, n=30):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefgh") + str(draw.randrange(300))
    rows, key = [], 0
    for _ in range(n):
        base = [word() for _ in range(draw.choice([3, 5, 12, 60, 200]))]
        for _ in range(draw.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, len(base) // 40 + 1])):
                copy[draw.randrange(len(copy))] = word()
            rows.append((key, " ".join(copy)))
            key += 1
    return rows


def test_index_guarantees_the_distance():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**16, (200, nd.SIGNATURE), dtype=np.uint16)
    other = base.copy()
    for i in range(200):
        places = rng.choice(nd.SIGNATURE, nd.CHUNKS * (nd.ERRORS + 1) - 1, replace=False)
        other[i, places] ^= np.uint16(1)
    a, b = nd.index_keys(base), nd.index_keys(other)
    assert (a == b).any(axis=1).all()
    assert len(np.unique(a)) > 0.99 * a.size


def test_components_of_a_graph(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (9, "one two"), (8, "One  TWO"), (None, "one two"), (3, "one two three"), (8, "One  TWO"), (None, None), (20, "x " * 30000)]
    frame = spark.createDataFrame([(k, t, "c", 1) for k, t in rows], "doc_id bigint, text string, node string, n int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(frame, size=4).collect()), key=str)
    assert got == brute(rows, 4)
    kept = nd.drop_copies(frame, size=4)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["5", "6", "7", "8", "None", "3", "20"])
    assert nd.near_duplicates(frame.limit(0), size=4).collect() == []


def test_brute_force(spark):
    rows = corpus(11)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(frame, size=4).collect()), key=str)
    assert got == brute(rows, 4)


def test_blocks_across_components(spark, monkeypatch):
    # Chains: neighbours are similar, the ends are not, and blocks are tiny.
    monkeypatch.setattr(nd, "BLOCK", 3)
    draw = random.Random(8)
    words, rows = [f"w{i}" for i in range(60)], []
    for i in range(25):
        words[draw.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(frame, size=4).collect()), key=str)
    assert got == brute(rows, 4)


def test_bins_estimate_the_similarity():
    rng = np.random.default_rng(5)
    for size, share in ((3, 1.0), (40, 0.8), (600, 0.8), (600, 0.4), (5000, 0.8)):
        both = rng.integers(0, 2**64, size, dtype=np.uint64)
        only = [rng.integers(0, 2**64, round(size * (1 / share - 1) / 2), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([both, own])) for own in only)
        found = nd.alike(nd.signature(a), nd.signature(b), nd.bins_of(a), nd.bins_of(b), 80)
        assert found.tolist() == [share >= 0.8]


def test_common_counts(monkeypatch):
    monkeypatch.setattr(nd, "COLUMNS", 7)
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, size, dtype=np.uint64)) for size in (40, 1, 25, 30, 2)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = nd.common_counts(sets)
    assert all(got[i, j] == want[i][j] for i in range(5) for j in range(5) if i != j)


def test_variants_that_are_hardly_linked_put_out_no_pairs(spark, monkeypatch):
    """400 variants of one text, nearly all pairs just below the limit: a few rows a member come out of each step."""
    draw = random.Random(4)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(400):
        words = list(base)
        for place in draw.sample(range(150), draw.choice([4, 5, 6])):
            words[place] = f"own{i}x{place}"
        rows.append((i, " ".join(words)))
    made, plain = {}, nd.stage

    def counted(df, name):
        out = plain(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(nd, "stage", counted)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(frame, size=4).collect()), key=str)
    assert got == brute(rows, 4)
    assert made["near-pairs"] <= 400 and made["near-links"] <= 800 and made["near-marked"] <= 400 * 30


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = nd.op3(spark, folder).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_drop_copies_keeps_one_of_each_group(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(k, base + end) for k in (7, 7, 4, 4, None) for end in ("", " more")] + [(None, "copies without id")] * 3 + [(None, None), (None, ""), (1, None), (1, None), (2, "alone")]
    frame = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id bigint, text string, row int").repartition(5)
    kept = nd.drop_copies(frame)
    assert kept.columns == frame.columns
    got = kept.collect()
    assert sorted(str(r.doc_id) for r in got if r.text) == ["2", "4", "None"]
    assert sorted(str(r.doc_id) for r in got if not r.text) == ["1", "1", "None", "None"]
    assert len({r.row for r in got}) == len(got) and all(rows[r.row] == (r.doc_id, r.text) for r in got)
    twice = nd.drop_copies(frame.union(frame)).where("text <> ''")
    assert twice.count() == 3


def test_drop_copies_without_ids(spark):
    # A repeated load, a third of it without ids.
    rows = [(None if k % 3 == 0 else k, t) for k, t in corpus(5, 8)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    numbered = brute([(i, t) for i, (_, t) in enumerate(rows)], nd.SHINGLE)
    assert nd.drop_copies(frame).count() == len({c for _, _, c in numbered})


def test_common_counts_add_up_over_ranges():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 5, 400, 900)]
    sets += [np.unique(np.concatenate([sets[3][::3], sets[2]])), sets[3], np.array([0, 2**64 - 1], np.uint64)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for at_once in (1, 7, 100, 1 << 20):
        got = nd.common_counts(sets, at_once)
        assert [[got[i, j] for j in range(len(sets)) if i != j] for i in range(len(sets))] == [[row[j] for j in range(len(sets)) if i != j] for i, row in enumerate(want)]
