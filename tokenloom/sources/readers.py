"""Sources: JSON, CSV manifests, split tables, blobs, ranges and named tensors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_json(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """JSON rows with a declared schema; ``multi_line`` for one array or object per file.

    Text files read line by line can be split over tasks, multi-line ones cannot.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_config(spark: SparkSession, path: str, schema: StructType | str) -> dict:
    """A one-object JSON file as a dict of parameters."""
    rows = read_json(spark, path, schema, multi_line=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} must hold exactly one object")
    return rows[0].asDict(recursive=True)


def load_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A table partitioned by ``split``; naming one reads only its folder."""
    table = spark.read.parquet(path)
    return table if split is None else table.where(F.col("split") == split)


def read_csv_manifest(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header, columns taken by position as declared in ``schema``."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """Files as rows (path, name, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def join_blobs(
    blobs: DataFrame, manifest: DataFrame, on: str, blob: str, label: str,
    transform: Callable[[Column], Column] | None = None,
    target_transform: Callable[[Column], Column] | None = None,
    missing: str = "error",
) -> DataFrame:
    """Samples (key, sample, label): every manifest row with its blob, optionally transformed.

    A manifest row without a blob is an error when it is read; ``missing="drop"`` leaves it out.
    """
    if missing not in ("error", "drop"):
        raise ValueError("missing must be 'error' or 'drop'")
    found = blobs.select(on, F.col(blob).alias("_blob"), F.lit(True).alias("_found"))
    joined = manifest.select(on, label).join(found, on, "inner" if missing == "drop" else "left")
    absent = F.raise_error(F.concat(F.lit("no blob for "), F.coalesce(F.col(on).cast("string"), F.lit("NULL"))))
    value = F.when(F.col("_found").isNull(), absent).otherwise(F.col("_blob"))
    sample = transform(value) if transform else value
    target = target_transform(F.col(label)) if target_transform else F.col(label)
    return joined.select(on, sample.alias("sample"), target.alias("label"))


def range_source(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Integers in [start, end); an empty range is an error."""
    if end <= start:
        raise ValueError(f"end must be greater than start, got [{start}, {end})")
    return spark.range(start, end)


def tensor_scan(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Named weights (name, i, vec) from a table partitioned by name."""
    table = spark.read.parquet(path)
    return table if name is None else table.where(F.col("name") == name)


def tensor_names(tensors: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` names in order, with their row counts."""
    return tensors.groupBy("name").agg(F.count("*").alias("row_count")).orderBy("name").limit(n)
