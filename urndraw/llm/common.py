"""Shared pieces: tables stored between steps, text clean-up, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urndraw.workdir import fresh_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back: later steps start from files,
    so a lost executor repeats one step and nothing before it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed_share(total: int, wanted: int, *columns: str) -> Column:
    """Whether a row is in a share that holds about ``wanted`` of ``total`` rows, by a hash of its columns.

    Put before an ordered limit, so that what every task sends to the one that ends it stays small however many tasks there are.
    """
    share = int((1 << 40) * min(1.0, wanted / max(1, total)))
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < share


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def connected_components(edges: DataFrame, source: str, target: str, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Alternating stars: each node hands its smaller neighbours the smallest one it knows, then the larger ones.
    Every round is two grouped minima (combined before the shuffle) and two plain joins, which adaptive
    execution may split, so a node with a third of all edges is no single task. Edges are stored between
    rounds; the number of rounds grows with the logarithm of the longest path.
    """
    links = stored(
        edges.select(F.greatest(source, target).alias("u"), F.least(source, target).alias("v"))
        .where("u <> v").distinct(), label)

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    while True:
        # every node's smallest neighbour (or itself); neighbours above the node move to it
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (
            links.select(F.col("v").alias("u"), F.col("u").alias("up")).join(hub, "u")
            .select(F.col("up").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        large = stored(large, label)
        # neighbours below a node, and the node itself, move to the smallest of them
        low = smallest(large)
        joined = large.join(low, "u")
        small = (
            joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        small = stored(small, label)
        # stars only: no centre hangs below another one, and every node has one centre
        left = small.select(F.col("v").alias("u")).distinct().join(small, "u", "left_semi").limit(1).count()
        if left == 0:
            centres = small.groupBy("u").agg(F.min("v").alias("v"), F.count("*").alias("n"))
            if centres.where("n > 1").limit(1).count() == 0:
                break
        links = small
    members = small.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionAll(members.select(F.col("component").alias("node"), "component").distinct())


def later_occurrences(units: DataFrame, digest: str, rank: list[str]) -> DataFrame:
    """The rows whose digest also occurs at a lower rank; rows of the same rank are one occurrence.

    The earliest rank is a minimum, combined before its shuffle. Only digests that occur again are joined back, from a stored
    table: both sides of the join then have exchanges of their own, which adaptive execution may split, so a digest in a
    third of all rows is no single task.
    """
    first = units.groupBy(digest).agg(F.min(F.struct(*rank)).alias("earliest"), F.count("*").alias("times"))
    again = stored(first.where("times > 1").select(F.col(digest), "earliest"), "earliest")
    return units.join(again, digest).where(~F.struct(*rank).eqNullSafe(F.col("earliest"))).drop("earliest")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, version, text): rows equal in id and text are one document listed more than once."""
    text = text_or_empty(text_column)
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
