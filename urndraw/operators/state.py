"""Incremental state: draw status, pending dates, upserts, publication decisions, integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urndraw.spec import CLOSED_STATUSES, OPEN_STATUSES


def latest_state(events: DataFrame, keys: list[str]) -> DataFrame:
    """Latest record per key; at equal times the later record wins."""
    values = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.struct("updated_at", "seq")).alias("_r")
    ).select(*keys, "_r.*")


def lake_calendar(states: DataFrame) -> DataFrame:
    """Every calendar day between the first and last record of each lake."""
    return states.groupBy("lake").agg(F.min("draw_date").alias("a"), F.max("draw_date").alias("b")).select(
        "lake", F.explode(F.sequence("a", "b")).alias("draw_date")
    )


def status_map(calendar: DataFrame, states: DataFrame) -> DataFrame:
    return calendar.join(states.select("lake", "draw_date", "status"), ["lake", "draw_date"], "left").select(
        "lake", "draw_date", F.coalesce("status", F.lit("missing")).alias("status")
    )


def pending_dates(calendar: DataFrame, states: DataFrame, force: bool = False) -> DataFrame:
    if force:
        return calendar
    closed = states.where(F.col("status").isin(*CLOSED_STATUSES)).select("lake", "draw_date")
    return calendar.join(closed, ["lake", "draw_date"], "left_anti")


def unresolved_dates(statuses: DataFrame) -> DataFrame:
    return statuses.where(F.col("status").isin(*OPEN_STATUSES))


def record_no_draw(events: DataFrame, decisions: DataFrame) -> DataFrame:
    """Append explicit classifications; they win over older records of their date."""
    return latest_state(events.unionByName(decisions), ["lake", "draw_date"])


def manifest_to_state(manifests: DataFrame) -> DataFrame:
    """One record per covered date of a success, else one for the target date."""
    dates = F.when(
        (F.col("status") == "success") & (F.size("covered_dates") > 0), F.col("covered_dates")
    ).otherwise(F.array("target_date"))
    return manifests.select(
        "lake", F.explode(dates).alias("draw_date"), "status", "run_id",
        F.col("completed_at").alias("updated_at"), F.col("error_message").alias("detail"), "seq",
    )


def bronze_conflict(stored: DataFrame, incoming: DataFrame, keys: list[str], stable: list[str]) -> DataFrame:
    """new / reuse / conflict per incoming key."""
    held = stored.select(*keys, F.sha2(F.to_json(F.struct(*stable)), 256).alias("_held"))
    sent = incoming.select(*keys, F.sha2(F.to_json(F.struct(*stable)), 256).alias("_sent"))
    return sent.join(held, keys, "left").select(
        *keys,
        F.when(F.col("_held").isNull(), "new").when(F.col("_held") == F.col("_sent"), "reuse").otherwise("conflict").alias("decision"),
    )


def source_correction(stored: DataFrame, incoming: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose new value differs from the stored one, or that only one side has."""
    joined = stored.select(*keys, F.col(value).alias("stored_value")).join(
        incoming.select(*keys, F.col(value).alias("new_value")), keys, "full_outer"
    )
    return joined.where(~F.col("stored_value").eqNullSafe(F.col("new_value"))).withColumn(
        "change",
        F.when(F.col("stored_value").isNull(), "added").when(F.col("new_value").isNull(), "absent").otherwise("changed"),
    )


def publish_gate(candidates: DataFrame, quality: DataFrame, pointers: DataFrame) -> DataFrame:
    """publish / quality_failed / older_than_published / identity_conflict per candidate release.

    ``quality`` has one row per check; ``pointers`` has the published release per lake.
    """
    verdict = quality.groupBy("run_id").agg(
        F.count(F.when((F.col("severity") == "critical") & ~F.col("passed"), 1)).alias("critical_failures")
    )
    rows = candidates.join(verdict, "run_id", "left").join(
        pointers.select("lake", F.col("run_id").alias("_run"), F.col("target_date").alias("_target"), F.col("published_at").alias("_at")),
        "lake", "left",
    )
    order = F.struct("target_date", "published_at")
    current = F.struct(F.col("_target").alias("target_date"), F.col("_at").alias("published_at"))
    return rows.select(
        "lake", "run_id", "target_date",
        F.when(F.coalesce("critical_failures", F.lit(0)) > 0, "quality_failed")
        .when(F.col("_run").isNull() | (order > current), "publish")
        .when(order < current, "older_than_published")
        .when(F.col("_run") == F.col("run_id"), "publish")
        .otherwise("identity_conflict").alias("decision"),
    )


def release_integrity(manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """Every referenced object against the stored one; ``issue`` is NULL when it is sound."""
    refs = manifest.groupBy("key").agg(
        F.count(F.lit(1)).alias("references"), F.min("size").alias("expected_size"), F.min("sha256").alias("expected_sha256")
    )
    held = stored.select("key", F.col("size").alias("actual_size"), F.col("sha256").alias("actual_sha256"))
    issue = (
        F.when(F.col("references").isNull(), "unreferenced")
        .when(F.col("references") > 1, "duplicate_reference")
        .when(F.col("actual_size").isNull(), "missing")
        .when(F.col("actual_size") != F.col("expected_size"), "size")
        .when(F.col("actual_sha256") != F.col("expected_sha256"), "sha256")
    )
    return refs.join(held, "key", "full_outer").withColumn("issue", issue)


def manifest_match(run: DataFrame, latest: DataFrame) -> DataFrame:
    """Objects of the run manifest against the published ones: missing / unexpected / changed."""
    fields = ["size", "sha256", "content_type", "cache_control"]
    a = run.select("key", F.struct(*fields).alias("_run"))
    b = latest.select("key", F.struct(*fields).alias("_latest"))
    return (
        a.join(b, "key", "full_outer")
        .select(
            "key",
            F.when(F.col("_latest").isNull(), "missing")
            .when(F.col("_run").isNull(), "unexpected")
            .when(~F.col("_run").eqNullSafe(F.col("_latest")), "changed")
            .alias("difference"),
        )
        .where("difference is not null")
    )


def lake_object_stats(checked: DataFrame) -> DataFrame:
    return checked.where("references is not null").agg(
        F.count(F.lit(1)).alias("object_count"),
        F.count(F.when(F.col("issue").isNull(), 1)).alias("verified_object_count"),
        F.coalesce(F.sum("actual_size"), F.lit(0)).alias("total_size_bytes"),
    )


def migration_summary(rows: DataFrame, date_column: str, valid: Column) -> DataFrame:
    """Row, range, duplicate, gap and validity counts; gaps do not fail a migration."""
    good = rows.where(valid)
    per_date = good.groupBy(date_column).agg(F.count(F.lit(1)).alias("_n"))
    days = per_date.agg(
        F.min(date_column).alias("minimum_date"), F.max(date_column).alias("maximum_date"),
        F.count(F.lit(1)).alias("_dates"), F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_dates"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("valid_rows"),
    )
    source_rows = rows.agg(F.count(F.lit(1))).scalar()
    missing = F.date_diff("maximum_date", "minimum_date").cast("long") + 1 - F.col("_dates")
    return days.select(
        source_rows.alias("source_rows"), "valid_rows", "minimum_date", "maximum_date", "duplicate_dates",
        F.coalesce(missing, F.lit(0)).alias("missing_calendar_dates"),
        (source_rows - F.col("valid_rows")).alias("invalid_rows"),
        ((F.col("duplicate_dates") == 0) & (source_rows == F.col("valid_rows")) & (F.col("valid_rows") > 0)).alias("passed"),
    )
