"""Evaluate costly columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose results later expressions and filters reuse instead of recomputing.

    The optimizer copies a projected expression into every filter above it; it does not do so
    across a generator, and a one-element ``inline`` costs nothing else.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def fan_out(df: DataFrame, *keys: str) -> DataFrame:
    """Hash by ``keys`` into as many partitions as ``urndraw.fanOutPartitions`` says, or the shuffle's default.

    For steps whose output is many times their input: adaptive execution sizes partitions by the
    input and would merge them into a few tasks. A following group or window by ``keys`` reuses it.
    """
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get("urndraw.fanOutPartitions", conf.get("spark.sql.shuffle.partitions"))), *keys)
