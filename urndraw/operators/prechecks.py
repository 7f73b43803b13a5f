"""What decides whether a published release can be audited at all, as findings for many lakes at once.

A lake without a usable manifest has that one finding, and its files are not looked at. A file that is no Parquet is a finding of its
own, and the columns of its table are judged by the other files; a table none of whose files can be read has no finding on columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urndraw.operators.audit import REQUIRED

# fixed values: the published table that each set of required columns is for
TABLES = {"dim-date": "dim-date", "fact": "fact-draw-result", "loto": "fact-loto-daily", "dim-station": "dim-station"}
MANIFEST = {"schema_version": "int", "run_id": "string", "target_date": "date", "published_at": "timestamp_ntz"}
FINDING = ["lake", "code", "subject", "detail"]


def read_manifests(lakes: DataFrame, manifests: DataFrame) -> DataFrame:
    """(lake, state, detail, run_id) of every lake: state is ``missing``, ``invalid`` with what is wrong in ``detail``, or null.

    ``manifests`` has the raw text of each lake's pointer (lake, text). Null or blank text counts as invalid, as does a field of
    ``MANIFEST`` that is absent, null or of another type. Where a lake has several, none is valid.
    """
    one = manifests.groupBy("lake").agg(F.count(F.lit(1)).alias("copies"), F.min("text").alias("text"))
    schema = ", ".join(f"{name} {kind}" for name, kind in MANIFEST.items())
    parsed = F.from_json("text", f"{schema}, _damaged string", {"columnNameOfCorruptRecord": "_damaged"})
    lacking = F.filter(F.array(*[F.when(F.col(f"doc.{name}").isNull(), F.lit(name)) for name in MANIFEST]), lambda name: name.isNotNull())
    rows = lakes.select("lake").distinct().join(one, "lake", "left").withColumn("doc", parsed)
    detail = (
        F.when(F.col("copies") > 1, "several").when(F.col("doc").isNull(), "unreadable")
        .when(F.size(lacking) > 0, F.concat(F.lit("lacks "), F.array_join(lacking, ", ")))
        .when(F.col("doc._damaged").isNotNull(), "unreadable"))
    state = F.when(F.col("copies").isNull(), "missing").when(detail.isNotNull(), "invalid")
    return rows.select("lake", state.alias("state"), F.when(state == "invalid", detail).alias("detail"),
                       F.when(state.isNull(), F.col("doc.run_id")).alias("run_id"))


def placed(files: DataFrame) -> DataFrame:
    """``files`` with the lake, run id and table that their paths name."""
    def part(pattern: str) -> Column:
        return F.regexp_extract("path", pattern, 1)

    return files.withColumns({
        "lake": part("/lake=([^/]+)/"), "run_id": part("/gold/releases/run-id=([^/]+)/"),
        "table": part("/gold/releases/run-id=[^/]+/([^/]+?)[.]parquet/")})


def findings(
    lakes: DataFrame, manifests: DataFrame, files: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """(lake, code, subject, detail) of the seven pre-checks; ``files`` are footers with their lake, run id and table.

    ``keep`` writes what all checks read and reads it back, so that each manifest and footer is opened once; without one they are
    opened for each check.
    """
    pointers = keep(read_manifests(lakes, manifests))
    required = [F.when(F.col("table") == table, F.array_except(F.array(*[F.lit(c) for c in sorted(REQUIRED[name])]), "columns"))
                for name, table in TABLES.items()]
    judged = files.select(
        "lake", "run_id", "table", "error", F.when(F.col("error").isNull(), F.coalesce(*required)).alias("lacking"))
    # what is sound is not kept
    current = keep(judged.where(F.col("error").isNotNull() | (F.size("lacking") > 0)).join(
        pointers.where("state is null").select("lake", "run_id"), ["lake", "run_id"]))
    unusable = pointers.where("state is not null").select(
        "lake", F.concat(F.lit("latest-manifest-"), "state").alias("code"), F.lit("manifests/latest").alias("subject"), "detail")
    broken = current.where("error is not null").select(
        "lake", F.lit("gold-parquet-invalid").alias("code"), F.col("table").alias("subject"), F.col("error").alias("detail"))
    # no more values in a group than columns that are required
    codes = F.create_map(*[F.lit(x) for name, table in TABLES.items() for x in (table, f"{name}-columns-missing")])
    lacking = current.select("lake", "table", F.explode("lacking").alias("column")).groupBy("lake", "table").agg(
        F.array_join(F.array_sort(F.collect_set("column")), ", ").alias("detail")).select(
        "lake", codes[F.col("table")].alias("code"), F.col("table").alias("subject"), "detail")
    return reduce(DataFrame.unionByName, [unusable, broken, lacking]).select(*FINDING)
