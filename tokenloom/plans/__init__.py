"""Registered queries with the SQL that must give the same rows."""

from tokenloom.plans import (  # noqa: F401
    batches,
    decoding,
    evaluation,
    fitting,
    ingest,
    prompting,
    sampling,
    streamed,
    tokenizing,
    vector_tables,
)
from tokenloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
