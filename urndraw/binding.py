"""Read the given tables as draws.

An order is a draw session of a station (300 customers per station, so stations grow with the
data), its date is the draw date and its line items are prizes. A draw is ``(station, date)``;
the daily profile ignores the station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urndraw.functions.ranking import split_ordinal
from urndraw.functions.text import tail_2d, zero_pad
from urndraw.operators.facts import trailing_years
from urndraw.spec import DAILY, STATION, Profile

CUSTOMERS_PER_STATION = 300
#: Parts of one (day, group) of the daily profile, whose groups grow with the data.
ORDER_PARTS = 32
RUN_ID = "run-0001"
NAME_CHANGE = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as draw sessions."""
    number = F.expr(f"o_custkey div {CUSTOMERS_PER_STATION}")
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        day.alias("draw_date"),
        number.alias("station_no"),
        F.concat(F.lit("S"), number.cast("string")).alias("station_code"),
        F.concat(
            F.when(day < F.lit(NAME_CHANGE).cast("date"), "Stn ").otherwise("Station "), number.cast("string")
        ).alias("station_name"),
    )


def sessions_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that have at least one prize."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return sessions(spark, sf_dir).join(lines, "o_orderkey", "left_semi")


def observations(spark: SparkSession, sf_dir: str, years: int | None = None) -> DataFrame:
    """One row per drawn number; no prize order, so nothing has to be sorted.

    ``years`` keeps the last ones only: sessions are filtered by date before they meet their prizes.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.lpad((F.col("l_partkey") % 100).cast("string"), 2, "0").alias("number_2d"),
    )
    draws = sessions(spark, sf_dir).select("o_orderkey", "draw_date", "station_code", "station_name")
    if years is not None:
        draws = trailing_years(draws, "draw_date", years, sessions_drawn(spark, sf_dir))
    return lines.join(draws, "o_orderkey")


def line_group(line: Column) -> Column:
    return F.when(line == 1, "special").otherwise(F.concat(F.lit("prize"), (line - 1).cast("string")))


def draw_fact(spark: SparkSession, sf_dir: str, profile: Profile = STATION, keep: tuple[str, ...] = ()) -> DataFrame:
    """The long prize fact. Orders are consecutive inside (draw, group).

    A station's draw has the few prizes of its customers' orders of one day, however much data there is, as stations grow
    with it: a plain window numbers them. A day of the daily profile has a share of all prizes and is numbered in parts.
    """
    sort_columns = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    lines = table(spark, sf_dir, "lineitem")
    joined = lines.join(sessions(spark, sf_dir), lines.l_orderkey == F.col("o_orderkey")).drop("o_orderkey")
    joined = joined.withColumn("prize_group", line_group(F.col("l_linenumber")))
    if profile.grain:
        place = F.row_number().over(W.partitionBy(*profile.keys, "prize_group").orderBy(*sort_columns))
        ranked = joined.withColumn("prize_order", place.cast("long"))
    else:
        parts = joined.withColumn("_part", (F.col("l_orderkey") + F.col("l_partkey") + F.col("l_suppkey")) % ORDER_PARTS)
        ranked = split_ordinal(parts, [*profile.keys, "prize_group"], "_part", sort_columns, "prize_order")
    width = profile.width_of(F.col("prize_group"))
    ranked = (
        ranked.withColumn("prize_width", width)
        .withColumn(
            "full_number",
            (F.col("l_orderkey") * 31 + F.col("l_suppkey")) % F.pow(F.lit(10), F.col("prize_width") - 2).cast("long") * 100
            + F.col("l_partkey") % 100,
        )
        .withColumn("formatted_number", zero_pad(F.col("full_number"), F.col("prize_width")))
        .withColumn("loto_2d", tail_2d(F.col("formatted_number")))
    )
    station = [
        F.col("station_code"),
        (F.col("station_no") + 1).alias("station_order"),
        F.col("station_name"),
        F.concat(F.lit("https://draws.example/"), F.lower("station_code")).alias("station_url"),
    ]
    return ranked.select(
        "draw_date",
        *(station if profile.grain else []),
        "prize_group",
        "prize_order",
        "prize_width",
        "full_number",
        "formatted_number",
        "loto_2d",
        F.substring("loto_2d", 1, 1).cast("long").alias("tens_digit"),
        F.substring("loto_2d", 2, 1).cast("long").alias("ones_digit"),
        F.concat(F.lit("https://draws.example/day/"), F.date_format("draw_date", "yyyy-MM-dd")).alias("source_url"),
        F.lit(RUN_ID).alias("run_id"),
        *keep,
    )


def control_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as control-state records: one lake per user; signups and clicks record a date as missing."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "success").when(kind == "view", "no_draw").when(kind == "error", "failed")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("lake"),
        F.to_date("ts").alias("draw_date"),
        status.otherwise("missing").alias("status"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
        F.col("props").alias("detail"),
    )


def health_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        F.col("ts"),
        (F.col("event_type") != "error").alias("healthy"),
        (F.col("event_id") % 5 != 0).alias("delivered"),
    )
