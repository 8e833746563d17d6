"""Operators of a training-data pipeline, with their queries and SQL; nothing else imports this."""

from tokenloom.llm import (  # noqa: F401
    bpe,
    conversation_repair,
    decontamination,
    filter_audit,
    near_duplicates,
    pii,
    preferences,
    quality,
    repeats,
    sharding,
    simhash,
    token_counts,
    toxicity,
)
from tokenloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
