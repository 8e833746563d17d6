import pytest
import tiktoken
from pyspark.sql import functions as F

from tokenloom.functions import constants as C
from tokenloom.functions import prompts as P
from tokenloom.functions.constants import FULL_PATTERN
from tokenloom.functions.prompts import strip
from tokenloom.operators import tokens as T

SENTENCE = "the answer to the ultimate question of life, the universe, and everything is "


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["the cat sat on the mat, the end.", "a cat and a dog: 12345 mats!", "", "unseen zebra ölfass the", "\n the \t cat "]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_sql_prompt_bytes(spark):
    text = one(spark, P.prompt_sql(F.lit("Q?"), F.lit("CREATE TABLE t"), F.lit("SELECT 1")))
    assert "one or more tables. \n\nYou must output the SQL query that answers the question.\n\n### Input:\nQ?\n\n### Context:\n" in text
    assert text.endswith("### Context:\nCREATE TABLE t\n\n### Response:\nSELECT 1")
    assert one(spark, P.prompt_sql(F.lit("Q?"), F.lit("c"))).endswith("### Response:\n")


@pytest.mark.parametrize("context, has", [("t", True), (None, False), ("  \n", False)])
def test_context_selects_the_template(spark, context, has):
    text = one(spark, P.prompt_by_context(F.lit("Q"), F.lit(context).cast("string")))
    assert ("### Context:" in text) == has
    assert "if provided.### Question:\nQ\n\n###" in text


def test_support_prompt_bytes(spark):
    text = one(spark, P.prompt_support(F.lit("why")))
    assert text.endswith("queries.'.\n\n    <HUMAN>: why\n    <ASSISTANT>: \n    ")
    assert "\n    If you don't know" in text


def test_turns_need_two_items(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "t array<string>")
    assert [r[0] for r in df.select(P.prompt_turns(F.col("t"))).collect()] == ["### USER: a\n### ASSISTANT: b", None]


def test_template_with_an_unknown_field(spark):
    with pytest.raises(KeyError, match="context"):
        P.render_template(spark.range(1).withColumn("question", F.lit("q")), C.WITH_CONTEXT_TEMPLATE)


def test_response_extraction(spark):
    assert one(spark, P.extract_response(F.lit("no marker"))) is None
    assert one(spark, P.extract_response(F.lit("a### Response:\n\t mid \n### Response: last"))) == "mid"


def test_prompt_removal(spark):
    assert one(spark, P.strip_prompt(F.lit("abc def"), F.lit("abc"))) == " def"
    assert one(spark, P.strip_prompt(F.lit("xbc def"), F.lit("abc"))) is None


def test_full_pieces_of_the_recorded_sentence(spark):
    pieces = one(spark, T.pretokenize_full(F.lit(SENTENCE)))
    assert pieces == ["the", " answer", " to", " the", " ultimate", " question", " of", " life", ",", " the", " universe", ",", " and", " everything", " is", " "]
    assert len(pieces) == 16


def test_vocabulary_order_and_specials(spark, docs):
    table = {r.piece: r for r in T.build_vocab(docs, size=4).collect()}
    assert table["the"].id == 0 and not table["the"].is_special
    assert len(table) == 4 + 256
    vocab = T.Vocabulary.build(docs, size=4)
    assert (vocab.bos_id, vocab.eos_id, vocab.unk_id) == (4, 5, 6)
    assert table["<|begin_of_text|>"].id == 4 and table["<|eot_id|>"].id == 13
    assert table["<|reserved_special_token_250|>"].id == 4 + 255


def test_small_vocabulary_keeps_specials_after_the_last_piece(spark, docs):
    vocab = T.Vocabulary.build(docs, size=100_000)
    assert vocab.bos_id == len(vocab.pieces) < 100_000


def test_encode_and_decode_agree_with_the_joined_form(spark, docs):
    vocab = T.Vocabulary.build(docs, size=12)
    by_value = {r.doc_id: r.input_ids for r in vocab.with_ids(docs, ["doc_id"]).collect()}
    by_join = {r.doc_id: r.input_ids for r in vocab.join_ids(docs, ["doc_id"], T.pretokenize("text")).collect()}
    assert by_value == by_join
    index = {p: i for i, p in enumerate(vocab.pieces)}
    assert by_value[0][0] == index["the"] and vocab.unk_id in by_value[3] and by_value[2] == []
    rows = vocab.with_ids(docs, ["doc_id"])
    for skip in (False, True):
        a = {r.doc_id: r.pieces for r in vocab.with_texts(rows, ["doc_id"], skip_special=skip).collect()}
        b = {r.doc_id: r.pieces for r in vocab.join_texts(rows, ["doc_id"], skip_special=skip).collect()}
        assert a == b


def test_large_vocabulary_is_joined(spark, docs, monkeypatch):
    want = {r.doc_id: r.input_ids for r in T.Vocabulary.build(docs, size=12).with_ids(docs, ["doc_id"]).collect()}
    monkeypatch.setattr(T, "MAX_LOCAL_PIECES", 3)
    vocab = T.Vocabulary.build(docs, size=12)
    assert not vocab.is_local
    assert {r.doc_id: r.input_ids for r in vocab.with_ids(docs, ["doc_id"]).collect()} == want


def test_null_text_gives_null_ids(spark, docs):
    vocab = T.Vocabulary.build(docs, size=12)
    df = spark.createDataFrame([(1, None), (2, "the cat")], "doc_id bigint, text string")
    assert {r.doc_id: r.input_ids is None for r in vocab.with_ids(df, ["doc_id"]).collect()} == {1: True, 2: False}


def test_byte_pair_round_trip(spark, docs):
    vocab = T.Vocabulary.build(docs, size=12)
    texts = ["hello world!", "ölfass \U0001F600 12345\n\n  x", "", "the cat"]
    df = T.encode_bpe(spark.createDataFrame([(t,) for t in texts], "t string"), ["t"], vocab, "t", "ids")
    rows = df.select("t", "ids", T.decode_bpe(F.col("ids"), vocab).alias("back")).collect()
    assert all(r.t == r.back for r in rows)
    known = tiktoken.Encoding("own", pat_str=FULL_PATTERN, mergeable_ranks=T.bpe_ranks(vocab), special_tokens={})
    assert {r.t: r.ids for r in rows} == {t: known.encode_ordinary(t) for t in texts}
    assert len(next(r.ids for r in rows if r.t == "the cat")) < len("the cat")


def test_byte_pair_work_is_bounded_by_pieces(spark, docs, monkeypatch):
    """However many pieces a batch of rows or one row has, only ``PART_PIECES`` are merged or decoded together."""
    most = T.PART_PIECES

    class Bounded(T.Merger):
        def encode(self, pieces):
            assert len(pieces) <= most
            return super().encode(pieces)

        def decode(self, ids):
            assert len(ids) <= most
            return super().decode(ids)

    vocab = T.Vocabulary.build(docs, size=12)
    rows = [(0, "the zebra " * 20_000), (1, None), (2, ""), *((i, "the cat sat " * 5_000) for i in range(3, 14)), (14, "a dog, " * 60_000), (15, None)]
    df = spark.createDataFrame(rows, "n int, t string").coalesce(1)
    want = {r.n: r.ids for r in T.encode_bpe(df.where("n in (0, 3)"), ["n"], vocab, "t", "ids").collect()}
    monkeypatch.setattr(T, "Merger", Bounded)
    got = T.encode_bpe(df, ["n"], vocab, "t", "ids").withColumn("back", T.decode_bpe(F.col("ids"), vocab)).collect()
    assert {r.n: r.back for r in got} == dict(rows)
    assert {r.n: r.ids for r in got if r.n in want} == want


def test_byte_pair_refuses_special_names(spark, docs):
    vocab = T.Vocabulary.build(docs, size=12)
    with pytest.raises(Exception, match="special name"):
        T.encode_bpe(spark.createDataFrame([(1, "x <|end_of_text|> y")], "id int, text string"), ["id"], vocab).collect()


def test_rows_that_share_a_key_are_joined_too(spark, docs, monkeypatch):
    rows = spark.createDataFrame([(1, "the cat"), (1, "the dog sat"), (None, "a cat")], "doc_id bigint, text string")
    want = sorted(str(r.input_ids) for r in T.Vocabulary.build(docs, size=12).with_ids(rows, ["doc_id"]).collect())
    monkeypatch.setattr(T, "MAX_LOCAL_PIECES", 3)
    vocab = T.Vocabulary.build(docs, size=12)
    ids = vocab.with_ids(rows, ["doc_id"])
    assert sorted(str(r.input_ids) for r in ids.collect()) == want
    assert vocab.with_texts(ids, ["doc_id"]).where("pieces IS NULL").count() == 0


def test_unicode_blanks(spark):
    assert one(spark, strip(F.lit("\u00a0\u3000 x y\u2003"))) == "x y"
    assert one(spark, T.pretokenize_full(F.lit("mot\u00a0!"))) == ["mot", "\u00a0", "!"]


@pytest.mark.parametrize("ids, cutoff, want", [([1, 2], 3, [1, 2, 9]), ([1, 2, 3], 3, [1, 2, 3]), ([1, 9], 5, [1, 9]), ([], 5, [9])])
def test_end_marker(spark, ids, cutoff, want):
    column = F.array(*[F.lit(i) for i in ids]).cast("array<int>")
    assert one(spark, T.add_eos(column, 9, cutoff)) == want


def test_end_marker_at_the_full_length(spark):
    ids = F.array_repeat(F.lit(3), 512)
    assert one(spark, F.size(T.add_eos(ids, 9, 512))) == 512


def test_labels_and_masks(spark):
    ids = F.array(*[F.lit(i) for i in [5, 6, 7, 8]])
    assert one(spark, T.make_labels(ids)) == [5, 6, 7, 8]
    assert one(spark, T.make_labels(ids, F.lit(3))) == [-100, -100, -100, 8]
    assert one(spark, T.make_labels(ids, F.lit(3), True)) == [-100, -100, 7, 8]
    assert one(spark, T.make_labels(ids, F.lit(0), True)) == [5, 6, 7, 8]
    assert one(spark, T.attention_mask(ids)) == [1, 1, 1, 1]
    assert one(spark, T.strip_prompt_ids(ids, F.array(F.lit(5), F.lit(6)))) == [7, 8]
    assert one(spark, T.add_bos(ids, 1)) == [1, 5, 6, 7, 8]


def test_embedding_lookup_by_salted_join(spark, docs, monkeypatch):
    vocab = T.Vocabulary.build(docs, size=12)
    rows = vocab.with_ids(docs, ["doc_id"])
    table = spark.range(20).select(F.col("id").cast("int").alias("id"), F.array(F.col("id") * 1.5).alias("vec"))
    small = sorted(map(str, T.embed_tokens(rows, table, ["doc_id"]).select("doc_id", "pos", "id", "vec").collect()))
    monkeypatch.setattr("tokenloom.operators.joins.MAX_BROADCAST_VALUES", 3)
    assert sorted(map(str, T.embed_tokens(rows, table, ["doc_id"]).select("doc_id", "pos", "id", "vec").collect())) == small
