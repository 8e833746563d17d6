"""Session, shared folder and staging helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def get_session(app: str = "tokenloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would lose data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tokenloom-")
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tokenloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so costly columns are computed once and a lost executor
    re-reads files instead of recomputing; later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Use every core for a small input stored in few blocks.

    Inputs of more than a few partitions are returned as they are, so no text is
    shuffled at scale. Meant for a plain scan: the check then only
    plans, while a table with shuffles of its own would have to run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > max(16, cores // 4):
        return df
    return df.repartition(cores, *keys)
