"""Exact ordinals and running counts that do not put one hot key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _with_offsets(df: DataFrame, keys: list[str], part: str, weight: Column) -> DataFrame:
    """Total weight of the earlier parts of the same key (one row per key and part, so small)."""
    sums = df.groupBy(*keys, part).agg(F.sum(weight).alias("_weight"))
    earlier = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    return sums.select(*keys, part, F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_offset"))


def split_ordinal(df: DataFrame, keys: list[str], part: str, order_by: list[str], name: str) -> DataFrame:
    """``row_number() over (partition by keys order by part, order_by)``, computed part by part.

    ``part`` cuts every key into independently sorted pieces; each piece starts after the rows of
    the pieces before it. The result equals the plain window, however large one key is.
    """
    offsets = _with_offsets(df, keys, part, F.lit(1).cast("long"))
    piece = W.partitionBy(*keys, part).orderBy(*order_by)
    ranked = df.withColumn("_at", F.row_number().over(piece).cast("long"))
    return (
        ranked.join(offsets, [*keys, part])
        .withColumn(name, F.col("_at") + F.col("_offset"))
        .drop("_at", "_offset", part)
    )


def split_running_count(
    df: DataFrame, keys: list[str], part: str, order_by: list[str], flag: Column, name: str
) -> DataFrame:
    """How many earlier rows of the key (strictly before this one) carry the flag.

    ``part`` must grow with ``order_by`` (for example the minute of an event time).
    """
    flagged = F.when(flag, 1).otherwise(0).cast("long")
    offsets = _with_offsets(df, keys, part, flagged)
    before = W.partitionBy(*keys, part).orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    counted = df.withColumn("_at", F.coalesce(F.sum(flagged).over(before), F.lit(0)))
    return (
        counted.join(offsets, [*keys, part])
        .withColumn(name, F.col("_at") + F.col("_offset"))
        .drop("_at", "_offset")
    )


def first_k_per(df: DataFrame, keys: list[str], order_by: list[Column], k: int) -> DataFrame:
    """First ``k`` rows per key; Spark limits each task's groups before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")
