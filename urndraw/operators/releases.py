"""Publication health of many lakes at once: pointer, run manifest, snapshot and stored objects, as one table of findings.

Nothing but manifests and object metadata is read, never the published tables. Inputs, each with any number of lakes:

- ``pointers``: one row per published lake (lake and ``POINTER``); ``references``: its objects (lake, position and ``REFERENCE``)
- ``runs``: run manifests (lake, run_key, run_id, region, target_date, status, quality_passed, covered_dates) under the run id that
  ``run_key`` holds; ``run_references``: their objects (lake, run_key and ``REFERENCE``)
- ``snapshots``: copies of pointers (lake, snapshot_key and ``POINTER``); ``snapshot_references``: (lake, snapshot_key, position and
  ``REFERENCE``)
- ``store``: metadata of stored objects, one row per lake and key (lake and ``REFERENCE``)

Nulls: an expected cache rule that is null allows any; a null or empty stored digest is ``sha256_missing``; any other null differs
from every value. A lake without a pointer has the one finding ``pointer_missing``. Empty tables give the findings that follow.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTER = ["region", "schema_version", "dataset_version", "run_id", "target_date", "published_at", "release_prefix"]
REFERENCE = ["key", "size", "sha256", "content_type", "cache_control"]
FINDING = ["lake", "issue", "key"]

# fixed values: where releases, objects of the first schema and snapshots lie
RELEASES, LEGACY, SNAPSHOTS = "gold/releases/run-id=", "gold/latest/", "gold/snapshots/as-of="
IMMUTABLE_SINCE = 2  # schema version from which a release has a folder of its own


@dataclass(frozen=True)
class Lakes:
    """The tables that describe what is published; ``lakes`` names the lakes that should be."""

    lakes: DataFrame
    pointers: DataFrame
    references: DataFrame
    runs: DataFrame
    run_references: DataFrame
    snapshots: DataFrame
    snapshot_references: DataFrame
    store: DataFrame


def _named(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that hold."""
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in conditions.items()]))


def _immutable() -> Column:
    return F.col("schema_version") >= IMMUTABLE_SINCE


def _release() -> Column:
    return F.concat(F.lit(RELEASES), "run_id", F.lit("/"))


def object_prefix() -> Column:
    """Where the objects of a pointer's row have to lie."""
    return F.when(_immutable(), _release()).otherwise(LEGACY)


def snapshot_key() -> Column:
    """Where the copy of a pointer's row has to lie."""
    of_run = F.when(_immutable(), F.concat(F.lit("run-id="), "run_id", F.lit("/"))).otherwise("")
    return F.concat(F.lit(SNAPSHOTS), F.col("target_date").cast("string"), F.lit("/"), of_run, F.lit("manifest.json"))


def object_checks(references: DataFrame, store: DataFrame) -> DataFrame:
    """Each reference with the stored size and ``problems``, the names of all that differs; none where it is sound."""
    held = store.select("lake", "key", F.struct(*REFERENCE[1:]).alias("_held"))

    def differs(name: str) -> Column:
        return ~F.col(f"_held.{name}").eqNullSafe(F.col(name))

    without_digest = F.coalesce("_held.sha256", F.lit("")) == ""
    found = _named({
        "size": differs("size"), "sha256_missing": without_digest, "sha256": ~without_digest & differs("sha256"),
        "content_type": differs("content_type"), "cache_control": F.col("cache_control").isNotNull() & differs("cache_control"),
    })
    return references.join(held, ["lake", "key"], "left").select(
        "lake", "key", F.col("_held.size").alias("stored_size"),
        F.when(F.col("_held").isNull(), F.array(F.lit("missing"))).otherwise(found).alias("problems"))


def unlike_references(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """(lake, key, n_left, n_right) of the keys whose references, repeats counted, are not the same on both sides.

    One exchange by (lake, key) serves both groupings, and a lake with most of the objects is spread by its keys.
    """
    columns = ["lake", *REFERENCE, *more]
    sides = left.select(*columns, F.lit(1).alias("_side")).unionByName(right.select(*columns, F.lit(-1).alias("_side")))
    each = sides.repartition("lake", "key").groupBy(*columns).agg(
        F.sum("_side").alias("_over"), F.count_if(F.col("_side") == 1).alias("_l"), F.count_if(F.col("_side") == -1).alias("_r"))
    return each.groupBy("lake", "key").agg(
        F.bool_or(F.col("_over") != 0).alias("_unlike"), F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right")
    ).where("_unlike").drop("_unlike")


def _of_release(x: Lakes) -> tuple[DataFrame, DataFrame]:
    """References of the pointers, and those of their run manifests that belong to the release."""
    place = x.pointers.select("lake", F.col("run_id").alias("run_key"), object_prefix().alias("_prefix"))
    written = x.runs.select("lake", "run_key").join(place, ["lake", "run_key"])
    named = x.run_references.join(written, ["lake", "run_key"]).where(F.col("key").startswith(F.col("_prefix")))
    return x.references.join(written.select("lake"), "lake", "left_semi"), named


def snapshot_state(x: Lakes) -> DataFrame:
    """(lake, snapshot): ``missing``, ``differs`` or ``equal`` for the copy of each pointer, objects and their order included."""
    wanted = x.pointers.select("lake", snapshot_key().alias("snapshot_key"), F.struct(*POINTER).alias("_latest"))
    copies = x.snapshots.select("lake", "snapshot_key", F.struct(*POINTER).alias("_copy"))
    found = wanted.join(copies, ["lake", "snapshot_key"], "left")
    kept = x.snapshot_references.join(wanted.select("lake", "snapshot_key"), ["lake", "snapshot_key"], "left_semi")
    unlike = unlike_references(x.references, kept, "position").select("lake").distinct().withColumn("_unlike", F.lit(True))
    return found.join(unlike, "lake", "left").select(
        "lake",
        F.when(F.col("_copy").isNull(), "missing")
        .when(F.col("_unlike").isNotNull() | ~F.col("_copy").eqNullSafe(F.col("_latest")), "differs").otherwise("equal").alias("snapshot"))


def publication(x: Lakes, checks: DataFrame) -> DataFrame:
    """One row per lake: pointer, run manifest and snapshot beside each other, and the sums over its ``checks``."""
    sums = checks.groupBy("lake").agg(
        F.count(F.lit(1)).alias("object_count"), F.count_if(F.size("problems") == 0).alias("verified_object_count"),
        F.sum(F.coalesce("stored_size", F.lit(0))).alias("total_size_bytes"))
    runs = x.runs.select("lake", F.col("run_key").alias("run_id"), F.struct(*[c for c in x.runs.columns if c not in ("lake", "run_key")]).alias("run"))
    rows = x.lakes.select("lake").distinct().join(x.pointers.withColumn("pointed", F.lit(True)), "lake", "left")
    rows = rows.join(runs, ["lake", "run_id"], "left").join(snapshot_state(x), "lake", "left").join(sums, "lake", "left")
    return rows.fillna(0, ["object_count", "verified_object_count", "total_size_bytes"])


def findings(x: Lakes, checks: DataFrame, published: DataFrame) -> DataFrame:
    """(lake, issue, key): all that is wrong with each lake; ``key`` is null where the lake itself is meant."""
    pointed, run = F.col("pointed").isNotNull(), F.col("run").isNotNull()

    def stated(ok: Column) -> Column:
        return ~F.coalesce(ok, F.lit(False))

    whole = _named({
        "pointer_missing": ~pointed,
        "pointer_region": pointed & stated(F.col("region") == F.col("lake")),
        "pointer_version": pointed & stated(F.col("dataset_version") == F.col("run_id")),
        "no_objects": pointed & (F.col("object_count") == 0),
        "release_prefix": pointed & _immutable() & stated(F.col("release_prefix") == _release()),
        "legacy_prefix": pointed & ~_immutable() & F.col("release_prefix").isNotNull(),
        "run_missing": pointed & ~run,
        "run_id": run & stated(F.col("run.run_id") == F.col("run_id")),
        "run_region": run & stated(F.col("run.region") == F.col("lake")),
        "run_target_date": run & stated(F.col("run.target_date") == F.col("target_date")),
        "run_status": run & stated(F.col("run.status") == "success"),
        "run_quality": run & stated(F.col("run.quality_passed")),
        "snapshot_missing": F.col("snapshot") == "missing",
        "snapshot_differs": F.col("snapshot") == "differs",
    })
    place = x.pointers.select("lake", object_prefix().alias("_prefix"))
    outside = x.references.join(place, "lake").where(~F.col("key").startswith(F.col("_prefix")))
    kind = F.when(F.col("n_left") == 0, "absent_from_latest").when(F.col("n_right") == 0, "unexpected_in_latest").otherwise("reference_differs")
    parts = [
        published.select("lake", F.explode(whole).alias("issue"), F.lit(None).cast("string").alias("key")),
        outside.select("lake", F.lit("outside_release").alias("issue"), "key"),
        checks.select("lake", F.explode("problems").alias("issue"), "key"),
        checks.groupBy("lake", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lake", F.lit("duplicate_reference").alias("issue"), "key"),
        unlike_references(*_of_release(x)).select("lake", kind.alias("issue"), "key"),
    ]
    return reduce(DataFrame.unionByName, parts).select(*FINDING)


def status(published: DataFrame, found: DataFrame) -> DataFrame:
    """One row per lake: what is published, how much of it is sound, and whether nothing is wrong."""
    counts = found.groupBy("lake").agg(F.count(F.lit(1)).alias("finding_count"))
    return published.join(counts, "lake", "left").select(
        "lake", F.col("finding_count").isNull().alias("healthy"), "run_id", "target_date", "published_at",
        F.col("run.status").alias("run_status"), F.col("run.quality_passed").alias("quality_passed"),
        F.coalesce("run.covered_dates", F.lit(0)).cast("long").alias("covered_date_count"),
        "object_count", "verified_object_count", "total_size_bytes", (F.col("snapshot") == "equal").alias("snapshot_matches_latest"),
        F.coalesce("finding_count", F.lit(0)).alias("finding_count"))


def inspect(x: Lakes, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(status, findings) of all lakes. ``keep`` writes what both read and reads it back; without one it is computed for each."""
    x = replace(x, references=x.references.join(x.pointers.select("lake"), "lake", "left_semi"))
    checks = keep(object_checks(x.references, x.store))
    published = keep(publication(x, checks))
    found = keep(findings(x, checks, published))
    return status(published, found), found
