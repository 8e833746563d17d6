"""Map-style datasets as Spark sources: a length, an item by number, read lazily in ranges, in batch or as a stream.

A dataset is any object with ``__len__``, ``__getitem__(i)`` giving a tuple, and ``schema`` (DDL). It is built anew from
the options wherever it is needed, so only options and ranges travel. As a stream its offset is the number of items
read; a restarted stream goes on there, also when the dataset has grown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Items of a partition, unless the option ``partition_items`` says otherwise.
PARTITION_ITEMS = 100_000


class Dataset(Protocol):
    schema: str

    def __len__(self) -> int: ...

    def __getitem__(self, i: int) -> tuple: ...


class ItemRange(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def _ranges(start: int, end: int, size: int) -> list[ItemRange]:
    return [ItemRange(at, min(end, at + size)) for at in range(start, end, size)]


def register_dataset(spark: SparkSession, name: str, build: Callable[[dict[str, str]], Dataset]) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read the dataset that ``build(options)`` gives."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.options = options

        def partitions(self) -> Sequence[InputPartition]:
            return _ranges(0, len(build(self.options)), int(self.options.get("partition_items", PARTITION_ITEMS)))

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            if partition is None or not hasattr(partition, "start"):  # an empty dataset has no range
                return
            dataset = build(self.options)
            for i in range(partition.start, partition.end):
                yield dataset[i]

    class StreamReader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]):
            self.options = options

        def initialOffset(self) -> dict:
            return {"items": 0}

        def latestOffset(self) -> dict:
            return {"items": len(build(self.options))}

        def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
            return _ranges(start["items"], end["items"], int(self.options.get("partition_items", PARTITION_ITEMS)))

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            dataset = build(self.options)
            for i in range(partition.start, partition.end):
                yield dataset[i]

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return build(dict(self.options)).schema

        def reader(self, schema: Any) -> DataSourceReader:
            return Reader(dict(self.options))

        def streamReader(self, schema: Any) -> DataSourceStreamReader:
            return StreamReader(dict(self.options))

    spark.dataSource.register(Source)


class IndexRange:
    """The integers from ``start`` up to ``end``; an empty range is an error."""

    schema = "id bigint"

    def __init__(self, start: int, end: int):
        if end <= start:
            raise ValueError(f"end must be greater than start, got [{start}, {end})")
        self.start, self.end = start, end

    def __len__(self) -> int:
        return self.end - self.start

    def __getitem__(self, i: int) -> tuple:
        if not 0 <= i < len(self):
            raise IndexError(i)
        return (self.start + i,)


def index_range(options: dict[str, str]) -> IndexRange:
    return IndexRange(int(options["start"]), int(options["end"]))


def read_range(spark: SparkSession, start: int, end: int, partition_items: int = PARTITION_ITEMS, stream: bool = False) -> DataFrame:
    """``IndexRange`` as a table or as a stream."""
    IndexRange(start, end)
    register_dataset(spark, "index_range", index_range)
    reader = (spark.readStream if stream else spark.read).format("index_range")
    return reader.option("start", start).option("end", end).option("partition_items", partition_items).load()
