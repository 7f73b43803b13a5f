from __future__ import annotations

import datetime
import hashlib
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from urndraw.operators import releases
from urndraw.plans.catalog import QUERIES
from urndraw.sources import tables

OBJECT = "key string, size long, sha256 string, content_type string, cache_control string"
POINTER = "region string, schema_version int, dataset_version string, run_id string, target_date date, published_at timestamp_ntz, release_prefix string"
RUN = "lake string, run_key string, run_id string, region string, target_date date, status string, quality_passed boolean, covered_dates int"
DAY, AT = datetime.date(2026, 7, 16), datetime.datetime(2026, 7, 16, 20)
PREFIX = "gold/releases/run-id=r1/"


def thing(name, prefix=PREFIX, **changed):
    row = {"key": prefix + name, "size": 10, "sha256": "ab", "content_type": "text/csv", "cache_control": "no-cache"} | changed
    return tuple(row.values())


def sound(spark, lakes=("a",), prefix=PREFIX, version=2, copy="gold/snapshots/as-of=2026-07-16/run-id=r1/manifest.json"):
    """Lakes with two objects each and nothing wrong."""
    stated = prefix if version == 2 else None
    objects = [thing("x", prefix), thing("y", prefix, cache_control=None)]
    pointer = lambda lake: (lake, version, "r1", "r1", DAY, AT, stated)
    make = spark.createDataFrame
    return releases.Lakes(
        make([(lake,) for lake in lakes], "lake string"), make([(lake, *pointer(lake)) for lake in lakes], f"lake string, {POINTER}"),
        make([(lake, at, *o) for lake in lakes for at, o in enumerate(objects)], f"lake string, position int, {OBJECT}"),
        make([(lake, "r1", "r1", lake, DAY, "success", True, 4) for lake in lakes], RUN),
        make([(lake, "r1", *o) for lake in lakes for o in [*objects, thing("bronze", "bronze/")]], f"lake string, run_key string, {OBJECT}"),
        make([(lake, copy, *pointer(lake)) for lake in lakes], f"lake string, snapshot_key string, {POINTER}"),
        make([(lake, copy, at, *o) for lake in lakes for at, o in enumerate(objects)], f"lake string, snapshot_key string, position int, {OBJECT}"),
        make([(lake, *o) for lake in lakes for o in objects], f"lake string, {OBJECT}"))


def issues(x):
    status, found = releases.inspect(x, lambda df: df.persist())
    rows = sorted(((r.lake, r.issue, r.key) for r in found.collect()), key=repr)
    for r in status.collect():
        mine = [f for f in rows if f[0] == r.lake]
        assert r.finding_count == len(mine) and r.healthy == (not mine)
    return rows


def test_sound_lakes_have_no_findings(spark):
    assert issues(sound(spark, ("a", "b"))) == []
    assert issues(sound(spark, prefix=releases.LEGACY, version=1, copy="gold/snapshots/as-of=2026-07-16/manifest.json")) == []
    row = releases.inspect(sound(spark))[0].first().asDict()
    assert row == {
        "lake": "a", "healthy": True, "run_id": "r1", "target_date": DAY, "published_at": AT, "run_status": "success", "quality_passed": True,
        "covered_date_count": 4, "object_count": 2, "verified_object_count": 2, "total_size_bytes": 20, "snapshot_matches_latest": True, "finding_count": 0}


def test_every_difference_of_one_object_is_named(spark):
    x = sound(spark, ("a", "b"))
    broken = [("a", *thing("x", size=11, sha256=None, content_type=None, cache_control="other")), ("a", *thing("y", cache_control="any"))]
    x = replace(x, store=x.store.where("lake = 'b'").union(spark.createDataFrame(broken, x.store.schema)))
    key = PREFIX + "x"
    assert issues(x) == [("a", "cache_control", key), ("a", "content_type", key), ("a", "sha256_missing", key), ("a", "size", key)]
    assert issues(replace(x, store=x.store.where("lake = 'b' or key like '%y'"))) == [("a", "missing", key)]


def test_objects_of_pointer_and_run(spark):
    x = sound(spark)
    more = [("a", 2, *thing("x")), ("a", 3, *thing("z", "elsewhere/"))]
    references = x.references.union(spark.createDataFrame(more, x.references.schema))
    kept = x.store.union(spark.createDataFrame([("a", *thing("z", "elsewhere/"))], x.store.schema))
    copies = references.select("lake", F.lit("gold/snapshots/as-of=2026-07-16/run-id=r1/manifest.json").alias("snapshot_key"), "position", *releases.REFERENCE)
    assert issues(replace(x, references=references, store=kept, snapshot_references=copies)) == [
        ("a", "duplicate_reference", PREFIX + "x"), ("a", "outside_release", "elsewhere/z"),
        ("a", "reference_differs", PREFIX + "x"), ("a", "unexpected_in_latest", "elsewhere/z")]
    fewer = replace(x, references=x.references.where("position = 0"), snapshot_references=x.snapshot_references.where("position = 0"))
    assert issues(fewer) == [("a", "absent_from_latest", PREFIX + "y")]
    # another null than a value: the run says a rule where the pointer has none
    ruled = x.run_references.withColumn("cache_control", F.coalesce("cache_control", F.lit("no-cache")))
    assert issues(replace(x, run_references=ruled)) == [("a", "reference_differs", PREFIX + "y")]


def test_snapshot_has_the_same_objects_in_the_same_order(spark):
    x = sound(spark)
    turned = x.snapshot_references.withColumn("position", 1 - F.col("position"))
    assert issues(replace(x, snapshot_references=turned)) == [("a", "snapshot_differs", None)]
    later = x.snapshots.withColumn("published_at", F.lit(None).cast("timestamp_ntz"))
    assert issues(replace(x, snapshots=later)) == [("a", "snapshot_differs", None)]
    elsewhere = x.snapshots.withColumn("snapshot_key", F.lit("gold/snapshots/as-of=2026-07-16/manifest.json"))
    assert issues(replace(x, snapshots=elsewhere)) == [("a", "snapshot_missing", None)]


def test_manifests_that_contradict_each_other(spark):
    x = sound(spark)
    bad = x.pointers.withColumns({"region": F.lit(None).cast("string"), "dataset_version": F.lit("r0"), "release_prefix": F.lit("gold/latest/")})
    got = issues(replace(x, pointers=bad, snapshots=bad.select("lake", releases.snapshot_key().alias("snapshot_key"), *releases.POINTER)))
    assert got == [("a", "pointer_region", None), ("a", "pointer_version", None), ("a", "release_prefix", None)]
    runs = x.runs.select("lake", "run_key", *[F.lit(None).cast(f.dataType).alias(f.name) for f in x.runs.schema.fields[2:]])
    assert [i for _, i, _ in issues(replace(x, runs=runs))] == ["run_id", "run_quality", "run_region", "run_status", "run_target_date"]
    assert issues(replace(x, runs=x.runs.limit(0))) == [("a", "run_missing", None)]
    assert issues(replace(x, runs=x.runs.withColumn("run_key", F.lit("r0")))) == [("a", "run_missing", None)]


def test_lakes_without_pointer_and_empty_tables(spark):
    x = sound(spark, ("a", "b"))
    gone = replace(x, pointers=x.pointers.where("lake = 'b'"))
    assert issues(gone) == [("a", "pointer_missing", None)]
    row = releases.inspect(gone)[0].where("lake = 'a'").first()
    assert row.run_id is None and row.object_count == 0 and row.snapshot_matches_latest is None and not row.healthy
    bare = replace(x, references=x.references.limit(0), run_references=x.run_references.limit(0), snapshot_references=x.snapshot_references.limit(0))
    assert issues(bare) == [("a", "no_objects", None), ("b", "no_objects", None)]
    empty = releases.Lakes(*[df.limit(0) for df in vars(x).values()])
    assert issues(empty) == []


def test_query_has_every_kind_of_finding(spark):
    kinds = Counter(r.issue for r in QUERIES["release_findings"](spark, "/root/testdata/sf0.01").collect())
    assert len(kinds) == 25 - (kinds["run_target_date"] == 0)  # every one in 37 lakes, of which one in 23 has no run manifest


def test_files_of_any_length_are_hashed_in_chunks(spark, tmp_path):
    base = tmp_path / "gold" / "releases" / "run-id=r 1"
    base.mkdir(parents=True)
    long = 2**31 + 5  # more than a binary value can hold
    with open(base / "part-long", "wb") as out:
        out.truncate(long)
    (base / "part-short").write_bytes(b"abc")
    (base / "part-empty").write_bytes(b"")  # a file without a byte is no object
    (base / "_SUCCESS").write_bytes(b"")
    digest = hashlib.sha256()
    for at in range(0, long, 1 << 20):
        digest.update(bytes(min(1 << 20, long - at)))
    got = {r.key.rsplit("/")[-1]: (r.size, r.sha256) for r in tables.stored_objects(spark, f"file://{base}").collect()}
    assert got == {
        "part-long": (long, digest.hexdigest()), "part-short": (3, hashlib.sha256(b"abc").hexdigest())}
