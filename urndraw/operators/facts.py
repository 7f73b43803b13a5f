"""Long prize facts: from nested draws, back to nested draws, wide and normalised forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urndraw.functions.text import digit_sum, tail_2d, zero_pad
from urndraw.spec import Profile


def canonical_draws(fact: DataFrame, profile: Profile, per_row: int = 1000) -> DataFrame:
    """Long fact to nested rows with one array of values per prize group.

    A row holds the orders ``part * per_row + 1`` to ``(part + 1) * per_row`` of every group, so arrays are bounded
    and a draw has as many rows as it needs; a valid draw has one, with ``part`` 0. ``result_count`` is the row's own.
    """
    place = F.struct("prize_order", "prize_group", "formatted_number")
    station = [
        F.min("station_order").alias("station_order"),
        F.max("station_name").alias("station_name"),
        F.min("station_url").alias("station_url"),
    ] if profile.named else []

    def values(name: str) -> Column:
        own = F.filter("_places", lambda p: p["prize_group"] == name)
        return F.transform(own, lambda p: p["formatted_number"])

    return (
        fact.groupBy(*profile.keys, part_of("prize_order", per_row).alias("part"))
        .agg(
            F.min("source_url").alias("source_url"),
            *station,
            F.count(F.lit(1)).alias("result_count"),
            F.array_sort(F.collect_list(place)).alias("_places"),
        )
        .withColumns({name: values(name) for name in profile.group_names})
        .drop("_places")
    )


def part_of(order: str, per_row: int) -> Column:
    return F.floor((F.col(order) - 1) / per_row).cast("long")


def draw_results(draws: DataFrame, profile: Profile, run_id: str, per_row: int = 1000) -> DataFrame:
    """Nested draws (one array of text values per group, see ``canonical_draws``) to one typed row per prize."""
    start = F.col("part") * per_row if "part" in draws.columns else F.lit(0)

    def prizes(name: str, width: int) -> Column:
        return F.transform(
            F.col(name),
            lambda value, at: F.struct(
                F.lit(name).alias("prize_group"),
                (start + at + 1).cast("long").alias("prize_order"),
                F.lit(width).cast("long").alias("prize_width"),
                value.alias("value"),
            ),
        )

    entries = F.flatten(F.array(*[prizes(name, width) for name, _, width in profile.groups]))
    station = [*profile.grain, *(["station_order", "station_name", "station_url"] if profile.named else [])]
    long = draws.select("draw_date", *station, "source_url", F.explode(entries).alias("p")).select(
        "draw_date", *station, "p.prize_group", "p.prize_order", "p.prize_width", "source_url",
        F.expr("try_cast(p.value as bigint)").alias("full_number"),
    )
    long = long.withColumn("formatted_number", zero_pad(F.col("full_number"), F.col("prize_width"))).withColumn(
        "loto_2d", tail_2d(F.col("formatted_number"))
    )
    return long.select(
        "draw_date", *station, "prize_group", "prize_order", "prize_width", "full_number", "formatted_number",
        "loto_2d",
        F.substring("loto_2d", 1, 1).cast("long").alias("tens_digit"),
        F.substring("loto_2d", 2, 1).cast("long").alias("ones_digit"),
        "source_url", F.lit(run_id).alias("run_id"),
    )


def legacy_wide(fact: DataFrame, profile: Profile) -> DataFrame:
    """One row per draw, one column per prize, and ``result_count``, the prizes the draw has in all.

    Prizes beyond the layout's places are the rows of ``legacy_beyond``; together they are the whole fact.
    """
    cells = [
        F.max(F.when((F.col("prize_group") == group) & (F.col("prize_order") == order), F.col("full_number"))).alias(name)
        for name, group, order in profile.wide_columns()
    ]
    return fact.groupBy(*profile.grain, F.col("draw_date").alias("date")).agg(*cells, F.count(F.lit(1)).alias("result_count"))


def legacy_beyond(fact: DataFrame, profile: Profile) -> DataFrame:
    """The prizes that have no place in the wide row, in long form."""
    placed = F.col("prize_order") <= F.coalesce(profile.count_of(F.col("prize_group")), F.lit(0))
    return fact.where(~placed).select(*profile.grain, F.col("draw_date").alias("date"), "prize_group", "prize_order", "full_number")


def legacy_long(wide: DataFrame, profile: Profile) -> DataFrame:
    """The wide row back to (date, group, order, value); absent values disappear."""
    columns = [name for name, _, _ in profile.wide_columns()]
    parts = F.split("column", "_")
    return (
        wide.unpivot([*profile.grain, "date"], columns, "column", "full_number")
        .where(F.col("full_number").isNotNull())
        .select(
            *profile.grain, "date", parts[0].alias("prize_group"),
            F.coalesce(F.try_element_at(parts, F.lit(2)).cast("long"), F.lit(1).cast("long")).alias("prize_order"),
            "full_number",
        )
    )


def to_two_digit(wide: DataFrame, profile: Profile) -> DataFrame:
    return wide.select(
        *profile.grain, "date", *[F.pmod(F.col(name), F.lit(100)).alias(name) for name, _, _ in profile.wide_columns()],
        "result_count",
    )


def sparse_matrix(counts: DataFrame, profile: Profile) -> DataFrame:
    """Date x 100 count columns, from counts that are already one row per (draw, number)."""
    cells = [
        F.coalesce(F.max(F.when(F.col("number_2d") == f"{n:02d}", F.col("frequency"))), F.lit(0)).alias(f"n{n:02d}")
        for n in range(100)
    ]
    return counts.groupBy(*profile.grain, F.col("draw_date").alias("date")).agg(*cells)


def special_prize(fact: DataFrame, profile: Profile) -> DataFrame:
    text = F.col("formatted_number")
    last = F.right(text, F.lit(1)).cast("long")
    return fact.where(F.col("prize_group") == "special").select(
        "draw_date",
        *profile.grain, *(["station_name"] if profile.named else []),
        "full_number",
        "formatted_number",
        tail_2d(text).alias("tail_2d"),
        F.substring(text, 1, 1).cast("long").alias("first_digit"),
        last.alias("last_digit"),
        digit_sum(text).alias("digit_sum"),
        (last % 2 == 0).alias("is_even_tail"),
        "run_id",
    )


def stamp_run_id(fact: DataFrame, run_id: str) -> DataFrame:
    return fact.withColumn("run_id", F.lit(run_id))


def trailing_years(rows: DataFrame, date_column: str, years: int, of: DataFrame | None = None) -> DataFrame:
    """Rows of the last N years, start exclusive; the latest date, of ``of`` or the rows themselves, is a scalar subquery."""
    day = F.col(date_column)
    last = (rows if of is None else of).agg(F.max(date_column)).scalar()
    return rows.where((day > F.add_months(last, -12 * years)) & (day <= last))


def date_range(rows: DataFrame, date_column: str, start: str, end: str) -> DataFrame:
    return rows.where(F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def normalize_fact(fact: DataFrame, profile: Profile, station_code: str, station_name: str) -> DataFrame:
    """Serving form: a synthetic station for the daily profile, serving order, unknown groups marked."""
    rows = fact if profile.grain else fact.withColumns(
        {"station_code": F.lit(station_code), "station_name": F.lit(station_name)}
    )
    order = profile.order_of(F.col("prize_group"))
    return rows.select(
        F.to_date("draw_date").alias("draw_date"), "station_code", "station_name", "prize_group",
        order.alias("group_order"), "prize_order", "formatted_number",
        zero_pad(F.col("loto_2d"), 2).alias("loto_2d"),
        order.isNotNull().alias("known_group"),
    )


def upper_code(text: Column) -> Column:
    return F.upper(F.trim(text))
