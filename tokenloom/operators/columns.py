"""Columns made by user functions: formatters and row functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_text(df: DataFrame, field: str | None = None, formatter: Callable[[DataFrame], Column] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The training text as column ``text``: a field, or what ``formatter`` makes of the row.

    When both are given the formatter wins.
    """
    if formatter is None and field is None:
        raise ValueError("give a field or a formatter")
    text = formatter(df) if formatter else F.col(field)
    return df.select(*keep, text.alias("text"))


def add_columns(df: DataFrame, columns: Mapping[str, Column | Callable[[DataFrame], Column]]) -> DataFrame:
    """Add named columns; a function gets the table and returns the column."""
    return df.withColumns({name: c if isinstance(c, Column) else c(df) for name, c in columns.items()})


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a Python function to Arrow batches, for what column expressions cannot say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)
