"""Tables read as streams: every file once, progress kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tokenloom.functions.prompts import prompt_support
from tokenloom.operators.tokens import Vocabulary, pretokenize


def stream_table(spark: SparkSession, folder: str, name: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A streaming table of the files of ``name``; the trailing pattern accepts a file or a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/{name}.parquet*")


def stream_prompts(conversations: DataFrame) -> DataFrame:
    """Prompt of every arriving user turn."""
    asked = conversations.where(F.col("role") == "user")
    return asked.select("conv_id", "turn", prompt_support(F.col("text")).alias("prompt"))


def stream_tokenize(documents: DataFrame, vocab: Vocabulary, path: str, key: str = "doc_id") -> DataFrame:
    """Ids of every arriving text, as a table. A local vocabulary needs no state, so this is a plain projection; a larger one
    is joined batch by batch."""
    if vocab.is_local:
        return run_to_table(documents.select(key, vocab.ids(pretokenize("text")).alias("input_ids")), path)
    kind = documents.schema[key].dataType.simpleString()
    return run_with(documents, path, lambda batch: vocab.with_ids(batch, [key]).select(key, "input_ids"), f"`{key}` {kind}, input_ids array<int>")


def run_with(stream: DataFrame, path: str, answer: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """Process all that is there batch by batch with a table function (for example generation).

    Each batch overwrites the folder of its own number, so a repeated batch adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{path}/data/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(schema).parquet(f"{path}/data").drop("batch")


def run_to_table(stream: DataFrame, path: str) -> DataFrame:
    """Process all that is there, append it to a parquet table, stop, and read the table.

    Running it again with the same path adds only what has arrived since.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")
