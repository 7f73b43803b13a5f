"""Where jobs may write: the shared folder the cluster names, or a fresh local one in tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path no other run uses; nothing is created until something is written there."""
    return f"{shared_root(spark)}/urndraw/{label}-{uuid.uuid4().hex}"


def keeping(spark: SparkSession, label: str) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a table into the shared folder and reads it back, for what several steps read."""
    def keep(df: DataFrame) -> DataFrame:
        path = fresh_dir(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep
