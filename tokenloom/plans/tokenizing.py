"""Vocabulary, encoding, masks and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions.constants import special_names
from tokenloom.operators import language as L
from tokenloom.operators import tokens as T
from tokenloom.plans.prompting import ANSWERED_SQL, PROMPT_SQL, answered_prompt, open_prompt
from tokenloom.plans.registry import (
    PAIR_KEY, PAIRS_SQL, pieces_sql, VOCAB_SIZE, VOCAB_SQL, documents, embeddings, ids_sql, joined, pairs, query, r6, sql_r6, sql_text, vocabulary,
)

CUTOFF = 512
DOC_IDS = f"{VOCAB_SQL}, {ids_sql('ids', 'documents', 'doc_id', 'text')}"
PAIR_IDS = f"""{PAIRS_SQL}, {VOCAB_SQL},
rendered AS MATERIALIZED (SELECT conv_id, turn, {PROMPT_SQL} AS prompt, {ANSWERED_SQL} AS answered FROM pairs),
{ids_sql('ids', 'rendered', 'conv_id, turn', 'answered')}"""
CUT_IDS = f"""{PAIR_IDS},
cut AS MATERIALIZED (
  SELECT i.conv_id, i.turn, i.ids[1:{CUTOFF}] AS ids, least(len({pieces_sql('r.prompt')}), {CUTOFF}) AS prompt_len
  FROM ids i JOIN rendered r ON r.conv_id = i.conv_id AND r.turn = i.turn),
ended AS MATERIALIZED (
  SELECT conv_id, turn, prompt_len,
         CASE WHEN len(ids) < {CUTOFF} AND ids[-1] IS DISTINCT FROM (SELECT r + 1 FROM base)
              THEN list_append(ids, (SELECT r + 1 FROM base)) ELSE ids END AS ids FROM cut)"""


@query("pretokenize", f"""SELECT doc_id, len({pieces_sql('text')}) AS pieces,
    md5(array_to_string({pieces_sql('text')}, ' ')) AS hash FROM documents""")
def pretokenize(spark, folder):
    split = documents(spark, folder).select("doc_id", T.pretokenize("text").alias("p"))
    return split.select("doc_id", F.size("p").cast("bigint").alias("pieces"), F.md5(joined("p")).alias("hash"))


_SPACES = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_BLANK, _INSIDE = rf"\t-\r {_SPACES}", rf"\t\x0B\x0C {_SPACES}"


def full_pieces_sql(text: str) -> str:
    """The pieces of ``pretokenize_full`` in SQL, which cannot look ahead: the last blank before a word is cut off beforehand."""
    pattern = (
        rf"(?i:''s|''t|''re|''ve|''m|''ll|''d)|[^\r\n\p{{L}}\p{{N}}]?\p{{L}}+|\p{{N}}{{1,3}}| ?[^{_BLANK}\p{{L}}\p{{N}}]+[\r\n]*|[{_BLANK}]*[\r\n]+|[{_BLANK}]+"
    )
    cut = f"string_split(regexp_replace({text}, '([{_BLANK}])([{_INSIDE}][^{_BLANK}])', '\\1' || chr(57344) || '\\2', 'g'), chr(57344))"
    return f"flatten(list_transform({cut}, lambda part: regexp_extract_all(part, '{pattern}')))"


FULL_SQL = f"full_pieces AS MATERIALIZED (SELECT doc_id, text, {full_pieces_sql('text')} AS p FROM documents)"


@query("pretokenize_full", f"WITH {FULL_SQL} SELECT doc_id, len(p) AS pieces, md5(array_to_string(p, '|')) AS hash, array_to_string(p, '') = text AS lossless FROM full_pieces")
def pretokenize_full(spark, folder):
    split = documents(spark, folder).select("doc_id", "text", T.pretokenize_full("text").alias("p"))
    return split.select(
        "doc_id", F.size("p").cast("bigint").alias("pieces"), F.md5(joined("p", "|")).alias("hash"), (joined("p", "") == F.col("text")).alias("lossless")
    )


@query(
    "build_vocab",
    f"""WITH {VOCAB_SQL}, names AS (SELECT unnest([{', '.join(sql_text(n) for n in special_names())}]) AS piece,
        generate_subscripts([{', '.join('0' for _ in special_names())}], 1) - 1 AS i)
        SELECT piece, id, false AS is_special FROM vocab
        UNION ALL SELECT piece, (SELECT r FROM base) + i AS id, true AS is_special FROM names""",
)
def build_vocab(spark, folder):
    return T.build_vocab(documents(spark, folder), "text", VOCAB_SIZE).withColumn("id", F.col("id").cast("bigint"))


def encoded(spark, folder):
    vocab = vocabulary(spark, folder)
    return vocab, vocab.with_ids(documents(spark, folder), ["doc_id"])


@query("encode", f"WITH {DOC_IDS} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM ids")
def encode(spark, folder):
    return encoded(spark, folder)[1].select("doc_id", joined("input_ids").alias("ids"))


@query("encode_bpe", f"WITH {FULL_SQL} SELECT doc_id, len(p) AS pieces, true AS merged, md5(text) AS decoded FROM full_pieces")
def encode_bpe(spark, folder):
    """SQL states the pieces and what the ids decode to; a test holds the ids themselves against a known encoder."""
    vocab = vocabulary(spark, folder)
    rows = T.encode_bpe(documents(spark, folder).select("doc_id", "text"), ["doc_id"], vocab, pieces="pieces")
    # No piece is left out and none has more ids than bytes.
    merged = F.size("input_ids").between(F.col("pieces"), F.octet_length("text"))
    return rows.select("doc_id", "pieces", merged.alias("merged"), F.md5(T.decode_bpe(F.col("input_ids"), vocab)).alias("decoded"))


@query(
    "add_bos",
    f"""WITH {DOC_IDS} SELECT doc_id, len(ids) + 1 AS n, list_prepend((SELECT r FROM base), ids)[1] AS first_id,
        md5(array_to_string(list_prepend((SELECT r FROM base), ids), ' ')) AS hash FROM ids""",
)
def add_bos(spark, folder):
    vocab, rows = encoded(spark, folder)
    rows = rows.select("doc_id", T.add_bos(F.col("input_ids"), vocab.bos_id).alias("ids"))
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n"), F.get("ids", F.lit(0)).cast("bigint").alias("first_id"), F.md5(joined("ids")).alias("hash")
    )


def tokenized_pairs(spark, folder, **options):
    vocab = vocabulary(spark, folder)
    return vocab, T.tokenize_pairs(pairs(spark, folder), vocab, open_prompt(), answered_prompt(), PAIR_KEY, CUTOFF, **options)


@query("add_eos", f"WITH {CUT_IDS} SELECT conv_id, turn, array_to_string(ids, ' ') AS ids FROM ended")
def add_eos(spark, folder):
    return tokenized_pairs(spark, folder)[1].select(*PAIR_KEY, joined("input_ids").alias("ids"))


@query("truncate", f"WITH {DOC_IDS} SELECT doc_id, len(ids[1:{CUTOFF}]) AS n, array_to_string(ids[1:{CUTOFF}], ' ') AS ids FROM ids")
def truncate(spark, folder):
    rows = encoded(spark, folder)[1].select("doc_id", T.truncate(F.col("input_ids"), CUTOFF).alias("ids"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n"), joined("ids").alias("ids"))


@query("attention_mask", f"WITH {CUT_IDS} SELECT conv_id, turn, array_to_string(list_transform(ids, lambda x: 1), ' ') AS mask FROM ended")
def attention_mask(spark, folder):
    return tokenized_pairs(spark, folder)[1].select(*PAIR_KEY, joined("attention_mask").alias("mask"))


def _labels_sql(hidden: str) -> str:
    return f"""array_to_string(list_concat(list_transform(range({hidden}), lambda x: -100::BIGINT), ids[{hidden} + 1:]), ' ')"""


@query(
    "labels",
    f"""WITH {CUT_IDS} SELECT conv_id, turn, array_to_string(ids, ' ') AS all_labels, {_labels_sql('prompt_len')} AS masked,
        {_labels_sql('greatest(prompt_len - 1, 0)')} AS masked_eos FROM ended""",
)
def labels(spark, folder):
    rows = tokenized_pairs(spark, folder)[1].withColumn("n", F.least(F.size(T.pretokenize(open_prompt())), F.lit(CUTOFF)))
    ids = F.col("input_ids")
    return rows.select(
        *PAIR_KEY,
        joined("labels").alias("all_labels"),
        joined(T.make_labels(ids, F.col("n"))).alias("masked"),
        joined(T.make_labels(ids, F.col("n"), prompt_has_eos=True)).alias("masked_eos"),
    )


@query(
    "decode",
    f"""WITH {VOCAB_SQL}, tok AS (
          SELECT doc_id, unnest({pieces_sql('text')}) AS piece, generate_subscripts({pieces_sql('text')}, 1) AS pos FROM documents)
        SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (
          SELECT doc_id, string_agg(piece, ' ' ORDER BY pos) AS text FROM tok JOIN vocab USING (piece) GROUP BY doc_id) t ON t.doc_id = d.doc_id""",
)
def decode(spark, folder):
    vocab, rows = encoded(spark, folder)
    shown = vocab.with_texts(rows, ["doc_id"], out="pieces", skip_special=True)
    return shown.select("doc_id", joined("pieces").alias("text"))


@query(
    "token_pieces",
    f"""WITH {VOCAB_SQL}, tok AS (
          SELECT doc_id, unnest({pieces_sql('text')}) AS piece, generate_subscripts({pieces_sql('text')}, 1) AS pos FROM documents)
        SELECT doc_id, count(*) AS n, md5(string_agg(coalesce(v.piece, {sql_text(special_names()[2])}), '|' ORDER BY pos)) AS hash
        FROM tok t LEFT JOIN vocab v ON v.piece = t.piece GROUP BY doc_id""",
)
def token_pieces(spark, folder):
    vocab, rows = encoded(spark, folder)
    shown = vocab.with_texts(rows, ["doc_id"], out="p").where(F.size("p") > 0)
    return shown.select("doc_id", F.size("p").cast("bigint").alias("n"), F.md5(joined("p", "|")).alias("hash"))


@query(
    "strip_prompt_ids",
    f"WITH {PAIR_IDS} SELECT i.conv_id, i.turn, array_to_string(i.ids[len({pieces_sql('r.prompt')}) + 1:], ' ') AS ids "
    "FROM ids i JOIN rendered r ON r.conv_id = i.conv_id AND r.turn = i.turn",
)
def strip_prompt_ids(spark, folder):
    vocab = vocabulary(spark, folder)
    rows = pairs(spark, folder)
    both = vocab.with_ids(vocab.with_ids(rows, PAIR_KEY, open_prompt(), "prompt_ids"), PAIR_KEY, answered_prompt())
    return both.select(*PAIR_KEY, joined(T.strip_prompt_ids(F.col("input_ids"), F.col("prompt_ids"))).alias("ids"))


@query(
    "embed_tokens",
    f"""WITH {DOC_IDS}, t AS (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS pos FROM ids),
        looked AS (SELECT t.doc_id, t.pos, e.embedding[1]::DOUBLE AS a, e.embedding[64]::DOUBLE AS b
                   FROM t JOIN embeddings e ON e.vec_id = t.id % (SELECT count(*) FROM embeddings))
        SELECT doc_id, count(*) AS n, {sql_r6('sum(a)')} AS first_sum, round(sum(b * pos), 4) + 0.0 AS last_by_pos
        FROM looked GROUP BY doc_id""",
)
def embed_tokens(spark, folder):
    _, rows = encoded(spark, folder)
    vectors = embeddings(spark, folder)
    ids = F.transform("input_ids", lambda i: i % F.lit(vectors.count()))
    table = vectors.select(F.col("vec_id").alias("id"), "vec")
    looked = T.embed_tokens(rows.select("doc_id", ids.alias("input_ids")), table, ["doc_id"])
    return looked.groupBy("doc_id").agg(
        F.count("*").alias("n"),
        r6(F.sum(F.get("vec", F.lit(0)))).alias("first_sum"),
        F.round(F.sum(F.get("vec", F.lit(63)) * F.col("pos")), 4).alias("last_by_pos"),
    )


@query(
    "length_stats",
    f"""WITH t AS (SELECT source, len({pieces_sql('text')}) AS n FROM documents)
        SELECT source, count(*) AS row_count, sum(n)::BIGINT AS tokens, max(n) AS longest, {sql_r6('sum(n)::DOUBLE / count(*)')} AS mean_len,
        count(*) FILTER (WHERE n > {CUTOFF}) AS truncated FROM t GROUP BY source""",
)
def length_stats(spark, folder):
    return T.length_stats(documents(spark, folder), F.size(T.pretokenize("text")), CUTOFF, "source")


MASS = 10.0
_BEFORE = "CASE WHEN i > 1 THEN ids[i - 1] ELSE -1 END AS c1, ids[i] AS id"


@query(
    "masked_token_loss",
    f"""WITH {CUT_IDS}, {ids_sql('doc', 'documents', 'doc_id', 'text')},
    seen AS MATERIALIZED (SELECT {_BEFORE} FROM (SELECT ids, unnest(range(1, len(ids) + 1)) AS i FROM doc)),
    bi AS MATERIALIZED (SELECT c1, id, count(*) AS n FROM seen GROUP BY c1, id),
    uni AS MATERIALIZED (SELECT id, count(*) AS n FROM seen GROUP BY id),
    after AS MATERIALIZED (SELECT c1, count(*) AS n FROM seen GROUP BY c1),
    labelled AS (SELECT conv_id, turn, {_BEFORE} FROM (SELECT conv_id, turn, prompt_len, ids, unnest(range(1, len(ids) + 1)) AS i FROM ended) WHERE i > prompt_len),
    losses AS (
      SELECT t.conv_id, t.turn, -ln((coalesce(bi.n, 0) + {MASS} * (coalesce(uni.n, 0) + 1)::DOUBLE
               / ((SELECT count(*) FROM seen) + (SELECT r FROM base) + {len(special_names())})) / (coalesce(after.n, 0) + {MASS})) AS loss
      FROM labelled t LEFT JOIN uni ON uni.id = t.id LEFT JOIN bi ON bi.c1 = t.c1 AND bi.id = t.id LEFT JOIN after ON after.c1 = t.c1)
    SELECT conv_id, turn, count(*) AS n_tokens, {sql_r6('avg(loss)')} AS loss, round(exp(avg(loss)), 4) + 0.0 AS perplexity
    FROM losses GROUP BY conv_id, turn""",
)
def masked_token_loss(spark, folder):
    """Loss and perplexity of the answers' tokens; the prompts' labels are ignored."""
    vocab, docs = encoded(spark, folder)
    model = L.FollowerModel.fit(docs, "input_ids", vocab.size + len(special_names()), mass=MASS)
    rows = T.tokenize_pairs(pairs(spark, folder), vocab, open_prompt(), answered_prompt(), PAIR_KEY, CUTOFF, mask_prompt=True)
    found = L.masked_loss(model.token_losses(rows, PAIR_KEY, "input_ids", "labels"), PAIR_KEY)
    return found.select(*PAIR_KEY, "n_tokens", r6("loss").alias("loss"), F.round("perplexity", 4).alias("perplexity"))
