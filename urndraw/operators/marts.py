"""Dimensions and star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urndraw.functions.dates import calendar_columns
from urndraw.operators.facts import special_prize, stamp_run_id
from urndraw.operators.grid import draw_counts, loto_daily
from urndraw.spec import Profile


def dim_number(spark: SparkSession) -> DataFrame:
    n = F.col("id")
    tens, ones = F.expr("id div 10"), n % 10
    return spark.range(100).select(
        F.lpad(n.cast("string"), 2, "0").alias("number_2d"), n.alias("numeric_value"),
        tens.alias("tens_digit"), ones.alias("ones_digit"), (tens + ones).alias("digit_sum"),
        (n % 2 == 0).alias("is_even"), (tens == ones).alias("is_double"),
    )


def calendar(dates: DataFrame, column: str = "draw_date") -> DataFrame:
    """Every calendar day from the first to the last date of the column."""
    ends = dates.agg(F.min(column).alias("_from"), F.max(column).alias("_to")).where("_from is not null")
    return ends.select(F.explode(F.sequence("_from", "_to")).alias("date"))


def dim_date(draw_dates: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """One row per calendar day. A day with facts is a success; otherwise its state, else missing."""
    days = draw_dates.select("draw_date").distinct()
    out = calendar(days).join(days.withColumn("_drawn", F.lit(True)), F.col("date") == F.col("draw_date"), "left").drop("draw_date")
    known = F.lit("missing")
    if states is not None:
        named = states.select(F.col("draw_date").alias("date"), F.col("status").alias("_status"))
        out = out.join(named, "date", "left")
        known = F.coalesce("_status", F.lit("missing"))
    return out.select(
        "date",
        *[column.alias(name) for name, column in calendar_columns(F.col("date")).items()],
        F.when(F.col("_drawn"), "success").otherwise(known).alias("draw_status"),
    )


def dim_station(fact: DataFrame) -> DataFrame:
    """Per station the name and url of its last row in fact order, and its date range."""
    last = F.struct("draw_date", "prize_group", "prize_order")
    return fact.groupBy("station_code").agg(
        F.max_by("station_name", last).alias("station_name"),
        F.max_by("station_url", last).alias("station_url"),
        F.min("draw_date").alias("first_draw_date"),
        F.max("draw_date").alias("latest_draw_date"),
    )


def special_by_weekday(special: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        special.join(dates, special.draw_date == dates.date)
        .groupBy("day_name", "tail_2d")
        .agg(F.count(F.lit(1)).alias("observations"))
    )


def star_summary(loto: DataFrame, numbers: DataFrame, dates: DataFrame, stations: DataFrame) -> DataFrame:
    """A report over the star: frequency by station name, weekday and tens digit.

    The number table has 100 rows; the other dimensions are left to the planner, which broadcasts
    them only while they are small.
    """
    return (
        loto.join(F.broadcast(numbers.select("number_2d", "tens_digit")), "number_2d")
        .groupBy("station_code", "draw_date", "tens_digit").agg(F.sum("frequency").alias("frequency"))
        .join(dates.select(F.col("date").alias("draw_date"), "day_name"), "draw_date")
        .join(stations.select("station_code", F.col("station_name").alias("current_name")), "station_code")
        .groupBy("station_code", "current_name", "day_name", "tens_digit")
        .agg(F.sum("frequency").alias("total_frequency"))
    )


def build_gold(fact: DataFrame, profile: Profile, run_id: str, states: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every published table from the whole stored fact. ``fact`` should be a stored table."""
    if fact.isEmpty():
        raise ValueError("cannot build the published tables from an empty fact")
    stamped = stamp_run_id(fact, run_id)
    counts = draw_counts(stamped, profile, "loto_2d")
    tables = {
        "fact-draw-result": stamped,
        "fact-loto-daily": loto_daily(counts, profile, run_id),
        "fact-special-prize": special_prize(stamped, profile),
        "dim-date": dim_date(stamped, states),
        "dim-number": dim_number(fact.sparkSession),
    }
    if profile.grain:
        tables["dim-station"] = dim_station(stamped)
    return tables
