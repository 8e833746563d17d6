"""Sinks: prepared splits, predictions, named tensors and snapshots."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def fingerprint(source: DataFrame, params: dict) -> str:
    """Short digest of the parameters and of the files the source reads: name, length and time of change."""
    spark, files = source.sparkSession, []
    for name in sorted(source.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        files.append([name, status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps({"files": files, "params": params}, sort_keys=True, default=str).encode()).hexdigest()[:16]


def materialize_once(spark: SparkSession, source: DataFrame, build, base: str, params: dict) -> DataFrame:
    """Write ``build(source)`` partitioned by split unless that exact set exists, then load it.

    The folder name carries a fingerprint of parameters and input files, so changed
    parameters never reuse old data; an unfinished write has no success mark and is redone.
    """
    path = f"{base}/{fingerprint(source, params)}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build(source).write.mode("overwrite").partitionBy("split").parquet(path)
    return spark.read.parquet(path)


def write_predictions(df: DataFrame, path: str) -> DataFrame:
    """Store (key..., prompt, gold, base, tuned) and return the stored table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_tensors(df: DataFrame, path: str) -> str:
    """Store (name, i, vec) partitioned by name: few files per name, a large name in several."""
    df.hint("rebalance", "name").write.mode("overwrite").partitionBy("name").parquet(path)
    return path


class SnapshotStore:
    """Training snapshots under ``path/step=N``; the newest ``keep`` stay."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 5):
        self.spark, self.path, self.keep = spark, path, keep

    def _steps(self) -> list[int]:
        """Finished snapshots, newest first; one folder each, so the list stays short."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        steps = [int(name.removeprefix("step=")) for name in names if name.startswith("step=")]
        done = [s for s in steps if path_exists(self.spark, f"{self.path}/step={s}/_SUCCESS")]
        return sorted(done, reverse=True)

    def save(self, step: int, epochs_run: int, weights: list[float]) -> None:
        schema = "epochs_run int, weights array<double>"
        row = self.spark.createDataFrame([(epochs_run, [float(w) for w in weights])], schema)
        row.write.mode("overwrite").parquet(f"{self.path}/step={step}")
        for old in self._steps()[self.keep:]:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/step={old}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def table(self) -> DataFrame:
        """All kept snapshots as (step, epochs_run, weights)."""
        found = self.spark.read.schema("epochs_run int, weights array<double>, step int").parquet(self.path)
        return found.select("step", "epochs_run", "weights")

    def latest(self) -> tuple[int, int, list[float]] | None:
        """(step, epochs_run, weights) of the newest finished snapshot."""
        steps = self._steps()
        if not steps:
            return None
        row = self.table().where(F.col("step") == steps[0]).first()
        return row.step, row.epochs_run, list(row.weights)
