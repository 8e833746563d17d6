"""What the operators of this subpackage share: registration, inputs, fixed word classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: White space of the word rules, as a Java pattern and as the characters themselves.
BLANKS_PATTERN = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage, with its SQL where SQL can say it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def words_of(text: Column) -> Column:
    """Words between blanks; none for NULL, empty and blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS_PATTERN))


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, NULL as the empty text."""
    return [value or "" for value in batch.column(name).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], name: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``max_bytes`` of the column, or one row."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * max_bytes // max(1, batch.column(name).nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
