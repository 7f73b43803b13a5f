"""Calendars against facts: expected sets, mismatches, differences. Sets stay rows, never arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.spec import Profile


def expected_stations(dates: DataFrame, weekly: DataFrame, overrides: DataFrame) -> DataFrame:
    """(region, date, station) that should draw: a dated override replaces the weekday rule.

    ``weekly`` is effective-dated, ``valid_from`` inclusive and ``valid_to`` exclusive.
    """
    overridden = overrides.select("region", "draw_date").distinct()
    ruled = dates.join(overridden, ["region", "draw_date"], "left_anti").withColumn("weekday", F.weekday("draw_date") + 1)
    by_rule = (
        # dates have one row per region and calendar day; the rules may be many, so they stay in place
        weekly.join(ruled, ["region", "weekday"])
        .where((F.col("draw_date") >= F.col("valid_from")) & (F.col("draw_date") < F.col("valid_to")))
        .select("region", "draw_date", "station_code")
    )
    by_date = overrides.join(dates, ["region", "draw_date"], "left_semi").select("region", "draw_date", "station_code")
    return by_rule.unionByName(by_date)


def set_mismatch(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Members only one side has."""
    joined = actual.select(*keys, F.lit(True).alias("_a")).distinct().join(
        expected.select(*keys, F.lit(True).alias("_e")).distinct(), keys, "full_outer"
    )
    return joined.where(F.col("_a").isNull() | F.col("_e").isNull()).select(
        *keys, F.when(F.col("_e").isNull(), "unexpected").otherwise("missing").alias("problem")
    )


def loto_vs_fact(loto: DataFrame, counts: DataFrame, profile: Profile) -> DataFrame:
    """Dense rows whose frequency differs from the one counted again from the prize fact."""
    keys = [*profile.keys, "number_2d"]
    again = counts.groupBy(*keys).agg(F.sum("frequency").alias("_expected"))
    joined = loto.join(again, keys, "left").select(
        *keys, F.col("frequency").alias("actual"), F.coalesce("_expected", F.lit(0)).alias("expected")
    )
    return joined.where(~F.col("actual").eqNullSafe(F.col("expected")))


def status_fact_alignment(statuses: DataFrame, fact: DataFrame, loto: DataFrame) -> DataFrame:
    """The four contradictions between a date's status and the presence of facts."""
    rows = (
        statuses.join(fact.select(F.col("draw_date").alias("date"), F.lit(True).alias("_f")).distinct(), "date", "left")
        .join(loto.select(F.col("draw_date").alias("date"), F.lit(True).alias("_l")).distinct(), "date", "left")
    )
    has_fact, has_loto, status = F.col("_f").isNotNull(), F.col("_l").isNotNull(), F.col("status")
    problems = F.array_compact(
        F.array(
            F.when((status == "success") & ~has_fact, F.lit("success-date-missing-draw-facts")),
            F.when((status == "success") & ~has_loto, F.lit("success-date-missing-loto-facts")),
            F.when((status == "no_draw") & (has_fact | has_loto), F.lit("no-draw-has-facts")),
            F.when(status.isin("missing", "failed") & (has_fact | has_loto), F.lit("incomplete-date-has-facts")),
        )
    )
    return rows.select("date", F.explode(problems).alias("problem"))


def station_dim_mismatch(actual: DataFrame, dimension: DataFrame) -> DataFrame:
    """Codes only one side has, and codes whose date range differs."""
    a = actual.select("station_code", F.struct("first_draw_date", "latest_draw_date").alias("_a"))
    d = dimension.select("station_code", F.struct("first_draw_date", "latest_draw_date").alias("_d"))
    problem = (
        F.when(F.col("_d").isNull(), "missing")
        .when(F.col("_a").isNull(), "extra")
        .when(F.col("_a") != F.col("_d"), "range")
    )
    return a.join(d, "station_code", "full_outer").select("station_code", problem.alias("problem")).where("problem is not null")


def code_set_diff(left: DataFrame, right: DataFrame, code: str) -> DataFrame:
    a, b = left.select(code).distinct(), right.select(code).distinct()
    return a.join(b, code, "left_anti").withColumn("side", F.lit("missing")).unionByName(
        b.join(a, code, "left_anti").withColumn("side", F.lit("extra"))
    )


def calendar_except(drawn: DataFrame, grain: list[str]) -> DataFrame:
    """Calendar days between the first and last draw without a draw."""
    ends = drawn.groupBy(*grain).agg(F.min("draw_date").alias("a"), F.max("draw_date").alias("b"))
    days = ends.select(*grain, F.explode(F.sequence("a", "b")).alias("draw_date"))
    return days.join(drawn.select(*grain, "draw_date").distinct(), [*grain, "draw_date"], "left_anti")
