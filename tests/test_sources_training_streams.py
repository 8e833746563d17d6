import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import metrics
from tokenloom.operators import training as T
from tokenloom.operators.tokens import Vocabulary, pretokenize
from tokenloom.sources import readers, views, writers
from tokenloom.streaming import streams


def test_range_needs_a_length(spark):
    assert [r.id for r in readers.range_source(spark, 3, 7).collect()] == [3, 4, 5, 6]
    for start, end in ((3, 3), (4, 3)):
        with pytest.raises(ValueError):
            readers.range_source(spark, start, end)


def test_json_rows_arrays_and_config(spark, tmp_path):
    rows = [{"question": "q", "context": None, "answer": "a\nb"}, {"question": "r", "context": "c", "answer": "d"}]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=1))
    schema = "question string, context string, answer string"
    for name, multi in (("lines", False), ("array", True)):
        got = readers.read_json(spark, str(tmp_path / f"{name}.json"), schema, multi).collect()
        assert sorted(r.asDict()["answer"] for r in got) == ["a\nb", "d"]
    (tmp_path / "params.json").write_text(json.dumps({"dim": 64, "norm_eps": 1e-5}))
    assert readers.read_config(spark, str(tmp_path / "params.json"), "dim int, norm_eps double") == {"dim": 64, "norm_eps": 1e-5}


def test_manifest_and_blobs(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("file,class\na.txt,1\nb.txt,0\nmissing.txt,1\n")
    os.mkdir(tmp_path / "files")
    for name in ("a", "b", "c"):
        (tmp_path / "files" / f"{name}.txt").write_text(name * 3)
    manifest = readers.read_csv_manifest(spark, str(tmp_path / "labels.csv"), "name string, label int")
    blobs = readers.read_blobs(spark, str(tmp_path / "files"))
    got = readers.join_blobs(blobs, manifest, "name", "content", "label", lambda c: c.cast("string"), lambda c: c + 1, missing="drop")
    assert {(r.name, r["sample"], r.label) for r in got.collect()} == {("a.txt", "aaa", 2), ("b.txt", "bbb", 1)}


def test_split_folder_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).withColumn("split", F.when(F.col("id") < 5, "valid").otherwise("train")).write.partitionBy("split").parquet(path)
    valid = readers.load_split(spark, path, "valid")
    assert valid.count() == 5
    assert all("split=valid" in r.f for r in valid.select(F.input_file_name().alias("f")).collect())


def test_prepared_set_is_written_once_per_parameters(spark, tmp_path):
    source_path, base = str(tmp_path / "src"), str(tmp_path / "prepared")
    spark.range(10).write.parquet(source_path)
    source, built = spark.read.parquet(source_path), []

    def build(df):
        built.append(1)
        return df.withColumn("split", F.lit("train"))

    for params, count in (({"n": 1}, 1), ({"n": 1}, 1), ({"n": 2}, 2)):
        assert writers.materialize_once(spark, source, build, base, params).count() == 10
        assert len(built) == count


def test_tensor_names_and_scan(spark, tmp_path):
    df = spark.range(50).select(F.concat(F.lit("w"), F.lpad((F.col("id") % 25).cast("string"), 2, "0")).alias("name"), F.col("id").alias("i"), F.array(F.lit(1.0)).alias("vec"))
    path = writers.write_tensors(df, str(tmp_path / "w"))
    names = [r.name for r in readers.tensor_names(readers.tensor_scan(spark, path)).collect()]
    assert names == [f"w{i:02d}" for i in range(20)]
    assert sorted(r.i for r in readers.tensor_scan(spark, path, "w03").collect()) == [3, 28]


def test_pairs_skip_unanswered_and_system_turns(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 0, "user", "q3"), (2, 1, "user", "q4"), (2, 2, "assistant", "a4")]
    chat = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted(map(str, map(tuple, views.question_answer_pairs(chat).collect()))) == ["(1, 1, 'q1', 's', 'a1')", "(2, 1, 'q4', None, 'a4')"]
    assert {r.conv_id: r.turns for r in views.opening_turns(chat).collect()} == {1: ["s", "q1"], 2: ["q3", "q4"]}


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    y = x @ [1.5, -2.0] + 0.5
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "id bigint, a double, b double, y double")
    return df, x, y


def test_one_step_is_the_plain_gradient(linear):
    df, x, y = linear
    w = np.array([0.1, 0.2, -0.3])
    full = np.hstack([x, np.ones((400, 1))])
    want = w - 0.05 * 2 * full.T @ (full @ w - y) / 400
    assert np.allclose(T.gradient_step(df, ["a", "b"], "y", list(w), 0.05), want)


def test_descent_finds_the_weights_and_uses_every_row_once_per_epoch(spark, linear):
    df, _, _ = linear
    assert np.allclose(T.sgd_linear(df, ["a", "b"], "y", ["id"], 0.3, 10, 4), [1.5, -2.0, 0.5], atol=1e-3)
    dealt = df.select("id", T.batch_of(42, 0, 4, ["id"]).alias("s")).groupBy("s").count().collect()
    assert {r.s for r in dealt} == {0, 1, 2, 3} and sum(r["count"] for r in dealt) == 400


def test_resume_and_retention(spark, linear, tmp_path):
    df, _, _ = linear
    store = writers.SnapshotStore(spark, str(tmp_path / "snap"), keep=2)
    T.sgd_linear(df, ["a", "b"], "y", ["id"], 0.1, 3, 2, snapshots=store)
    assert sorted(r.step for r in store.table().collect()) == [1, 2]
    resumed = T.sgd_linear(df, ["a", "b"], "y", ["id"], 0.1, 5, 2, snapshots=store)
    assert np.allclose(resumed, T.sgd_linear(df, ["a", "b"], "y", ["id"], 0.1, 5, 2))
    assert store.latest()[:2] == (4, 5)


def test_evaluation_schedule(linear):
    df, _, _ = linear
    rows = T.train_with_eval(df, df, ["a", "b"], "y", ["id"], 0.1, max_steps=7, eval_every=3, steps_per_epoch=2).collect()
    assert [r.step for r in rows] == [3, 6] and rows[1].valid_loss < rows[0].valid_loss


def test_classifier_beats_chance(spark):
    rng = np.random.default_rng(1)
    labels = np.arange(300) % 3
    x = rng.normal(size=(300, 4)) * 0.3 + np.eye(4)[labels]
    df = spark.createDataFrame([(x[i].tolist(), int(labels[i])) for i in range(300)], "vec array<double>, label int")
    scored = T.mlp_classifier(df, "vec", "label", [4, 8, 6, 3]).transform(T.as_features(df, "vec", "label"))
    assert scored.where("prediction = label").count() > 240


def test_streams_read_every_file_once(spark, tmp_path):
    folder = str(tmp_path)
    table = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.lit("word the "), "id").alias("text"))
    table.repartition(3).write.parquet(f"{folder}/docs.parquet")
    vocab = Vocabulary.build(table)

    def run():
        stream = streams.stream_table(spark, folder, "docs", table.schema, max_files=1)
        return streams.stream_tokenize(stream, vocab, f"{folder}/out")

    want = {r.doc_id: r.i for r in table.select("doc_id", vocab.ids(pretokenize("text")).alias("i")).collect()}
    assert {r.doc_id: r.input_ids for r in run().collect()} == want
    assert run().count() == 30
    table.withColumn("doc_id", F.col("doc_id") + 100).write.mode("append").parquet(f"{folder}/docs.parquet")
    assert run().count() == 60


def test_stream_with_a_large_vocabulary_is_joined(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    table = spark.range(12).select(F.col("id").alias("doc_id"), F.concat(F.lit("word the "), "id").alias("text"))
    table.repartition(3).write.parquet(f"{folder}/docs.parquet")
    vocab = Vocabulary.build(table)
    want = {r.doc_id: r.i for r in table.select("doc_id", vocab.ids(pretokenize("text")).alias("i")).collect()}
    monkeypatch.setattr("tokenloom.operators.tokens.MAX_LOCAL_PIECES", 3)
    vocab = Vocabulary.build(table)
    assert not vocab.is_local
    for _ in range(2):  # the second run finds nothing new
        stream = streams.stream_table(spark, folder, "docs", table.schema, max_files=1)
        assert {r.doc_id: r.input_ids for r in streams.stream_tokenize(stream, vocab, f"{folder}/out").collect()} == want


def test_missing_blob(spark):
    blobs = spark.createDataFrame([("a", "x")], "name string, content string")
    manifest = spark.createDataFrame([("a", 1), ("b", 2)], "name string, label int")
    with pytest.raises(Exception, match="no blob for b"):
        readers.join_blobs(blobs, manifest, "name", "content", "label").collect()
    assert [r.name for r in readers.join_blobs(blobs, manifest, "name", "content", "label", missing="drop").collect()] == ["a"]


def test_pairs_over_gaps_and_buckets(spark):
    turns = [(1, t, "user" if i % 2 == 0 else "assistant", f"t{t}") for i, t in enumerate([0, 2, 3, 9, 10, 50, 300, 301])]
    chat = spark.createDataFrame([*turns, (2, 5, "user", "alone"), (None, 0, "user", "q"), (None, 4, "assistant", "a")], "conv_id int, turn int, role string, text string")
    for bucket in (1, 2, 7, 1024):
        got = sorted((r.conv_id or 0, r.question, r.answer) for r in views.question_answer_pairs(chat, bucket).collect())
        assert got == [(0, "q", "a"), (1, "t0", "t2"), (1, "t10", "t50"), (1, "t3", "t9"), (1, "t300", "t301")]


def test_rewritten_files_change_the_fingerprint(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).coalesce(1).write.parquet(path)
    name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    first = writers.fingerprint(spark.read.parquet(path), {})
    os.utime(os.path.join(path, name), (1, 1))
    assert writers.fingerprint(spark.read.parquet(path), {}) != first


def test_groups_without_a_name_have_latencies(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0), ("b", None)], "g string, ms double")
    got = {r.g: (r.calls, r.mean_ms, r.p50) for r in metrics.latency_stats(df, "g", "ms").collect()}
    assert got == {"a": (1, 1.0, 1.0), None: (2, 3.0, 3.0), "b": (1, None, None)}
