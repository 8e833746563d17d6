"""The pipeline's stages against plain versions of what each must keep."""

import hashlib
import re

import numpy as np
from test_near_duplicates import brute

import corpus_pipeline as cp
from tokenloom.llm import bpe, pii, toxicity
from tokenloom.llm.decontamination import words_of

FOLDER = "/root/testdata/sf0.001"


def windows(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_stages_keep_what_they_must(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, function in cp.STAGES:
        tables.append(cp.stage(function(spark, tables[-1], FOLDER), name))
    rows = [{r.doc_id: r for r in table.collect()} for table in tables]
    assert all(table.columns == columns for table in tables[:-1])
    # Toxicity: the verdict of the model itself, and no more than the toxic share goes.
    chain = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), toxicity.default_categories())
    score = chain.scorer()
    assert rows[1].keys() == {k for k, r in rows[0].items() if score(words_of(r.text or ""))[1] < 0.5}
    assert len(rows[1]) > 0.8 * len(rows[0])
    # Near duplicates: the smallest id of every component of the brute-force graph.
    assert rows[2].keys() == {k for k, _, c in brute([(k, r.text) for k, r in rows[1].items()], 5) if k == c}
    # Decontamination: no window of a benchmark item.
    items = [words_of(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hits = {k for k, r in rows[2].items() if any(windows(words_of(r.text), min(10, len(i))) & windows(i, min(10, len(i))) for i in items)}
    assert hits and rows[3].keys() == rows[2].keys() - hits
    # Pseudonyms: every document stays, its text as the plain replacement has it.
    pseudonyms = pii.Pseudonyms()
    assert {k: r.text for k, r in rows[4].items()} == {k: pseudonyms.replace(r.text)[0] for k, r in rows[3].items()}
    assert all(r.n_chars == len(r.text) for r in rows[4].values())
    assert not [k for k, r in rows[4].items() if set(re.findall(r"(?<!\d)\d{16}(?!\d)", r.text)) & set(re.findall(r"\d{16}", rows[3][k].text))]
    # Tokens: one row per document, decoded to the text.
    codec = bpe.Codec.of(*bpe.default_vocabulary())
    for k, r in rows[5].items():
        packed = codec.encode(rows[4][k].text)
        assert (r.n_tokens, r.ids_sha256) == (len(packed) // 4, hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[4][k].text.encode()).hexdigest()
    assert rows[5].keys() == rows[4].keys()
    assert {r.doc_id for r in cp.run(spark, FOLDER).collect()} == rows[5].keys()


def test_odd_tables_pass_every_stage(spark):
    odd = [(1, None, "en", None, None, "x"), (None, "", None, "s", 0, "y"), (2, "same text here and there", "en", "s", 24, "z"), (2, "same text here and there", "en", "s", 24, "z")]
    frame = spark.createDataFrame(odd, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string")
    for table, left in ((frame, 3), (frame.limit(0), 0)):
        for name, function in cp.STAGES:
            table = cp.stage(function(spark, table, FOLDER), name)
        assert table.count() == left


def test_models_are_fitted_alike(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    one, two = (toxicity.fit(d, labels, toxicity.default_categories()) for d in (docs, docs.repartition(7)))
    assert [link.strings for link in one.links] == [link.strings for link in two.links]
    assert all(np.allclose(a.weights, b.weights) for a, b in zip(one.links, two.links))
