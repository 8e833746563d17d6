"""A corpus made ready for training: five stages, each a written table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import bpe, decontamination, near_duplicates, pii, toxicity
from tokenloom.session import stage
from tokenloom.sources.readers import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones, does not call toxic."""
    chain = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), toxicity.default_categories())
    return toxicity.keep_clean(docs, chain, "toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity of 0.8 or more) the smallest id."""
    return near_duplicates.drop_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten benchmark words (or a whole shorter item)."""
    return decontamination.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of their format; lengths, and so ``n_chars``, may change for addresses only.

    ``n_chars`` follows the text.
    """
    masked = pii.pseudonymise(docs, key=pii.key_of(spark))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType.simpleString()
    return masked.selectExpr(*(f"cast(length(text) AS {kind}) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document that is left."""
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("bpe", encode_tokens),
]

#: SQL cannot state a fitted classifier; the stages are tested against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
