"""Descriptive analytics over per-draw counts: totals, heat maps, gaps, momentum, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urndraw.operators.grid import fold_draws, newest_draws
from urndraw.operators.marts import dim_number
from urndraw.spec import Profile, numbers_column


def total_frequency(rows: DataFrame, *grain: str) -> DataFrame:
    """Totals of drawn numbers, or of their counts per draw; drawn numbers need no count per draw before."""
    total = F.sum("frequency") if "frequency" in rows.columns else F.count(F.lit(1))
    return rows.groupBy(*grain, "number_2d").agg(total.alias("total_frequency"))


def dense_totals(rows: DataFrame, profile: Profile) -> DataFrame:
    """Totals for all 100 numbers, 0 where a number never came up."""
    return fill_numbers(total_frequency(rows, *profile.grain), profile, ["total_frequency"]).select(
        *profile.grain, "number_2d", F.coalesce("found.total_frequency", F.lit(0)).alias("total_frequency")
    )


def frequency_map(totals: DataFrame, *grain: str) -> DataFrame:
    """All 100 totals as one map per station (or one for everything)."""
    entries = F.array_sort(F.collect_list(F.struct("number_2d", "total_frequency")))
    return totals.groupBy(*grain).agg(F.map_from_entries(entries).alias("frequency_map"))


def column_stats(totals: DataFrame) -> DataFrame:
    """Max, min, mean and sample deviation of the totals, from exact integer sums."""
    n, s, q = F.count(F.lit(1)), F.sum("total_frequency"), F.sum(F.col("total_frequency") * F.col("total_frequency"))
    return totals.agg(
        F.max("total_frequency").alias("max_count"), F.min("total_frequency").alias("min_count"),
        n.alias("n"), s.alias("s"), q.alias("q"),
    ).select(
        "max_count", "min_count",
        (F.col("s").cast("double") / F.col("n").cast("double")).alias("mean"),
        F.sqrt(
            (F.col("n") * F.col("q") - F.col("s") * F.col("s")).cast("double")
            / (F.col("n") * (F.col("n") - 1)).cast("double")
        ).alias("std"),
    )


def freq_histogram(totals: DataFrame) -> DataFrame:
    """One bin per integer total between the smallest and the largest."""
    return totals.groupBy(F.col("total_frequency").alias("bin")).agg(F.count(F.lit(1)).alias("numbers"))


def heatmap(values: DataFrame, value: str) -> DataFrame:
    """10 x 10 pivot (tens down, ones across), 0 where absent. Input: at most one row per number."""
    tens, ones = F.substring("number_2d", 1, 1), F.substring("number_2d", 2, 1)
    spark = values.sparkSession
    cells = [
        F.coalesce(F.max(F.when(ones == str(digit), F.col(value))), F.lit(0)).alias(f"ones_{digit}")
        for digit in range(10)
    ]
    filled = dim_number(spark).select("number_2d").join(values, "number_2d", "left")
    return filled.groupBy(tens.cast("long").alias("tens")).agg(*cells)


def heat_intensity(totals: DataFrame, *grain: str) -> DataFrame:
    """Total over the largest total of the station (or of all numbers)."""
    if grain:
        top = F.max("total_frequency").over(W.partitionBy(*grain))
    else:
        top = totals.agg(F.max("total_frequency")).scalar()
    return totals.select(
        *grain, "number_2d",
        (F.col("total_frequency").cast("double") / F.greatest(top, F.lit(1)).cast("double")).alias("intensity"),
    )


def head_tail_table(counts: DataFrame) -> DataFrame:
    """Latest draw of each station: the sorted ones digits under each tens digit, or ``-``.

    A digit is repeated as often as it came up.
    """
    last = counts.groupBy("station_code").agg(F.max("draw_date").alias("draw_date"))
    ones = F.substring("number_2d", 2, 1)
    latest = counts.join(last, ["station_code", "draw_date"]).select(
        "station_code",
        F.substring("number_2d", 1, 1).cast("long").alias("tens"),
        ones.alias("ones"),
        F.array_join(F.array_repeat(ones, F.col("frequency").cast("int")), ", ").alias("text"),
    )
    cells = latest.groupBy("station_code", "tens").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ones", "text"))), lambda p: p["text"]), ", ").alias("text")
    )
    rows = cells.groupBy("station_code").agg(F.map_from_entries(F.collect_list(F.struct("tens", "text"))).alias("_m"))
    return rows.select(
        "station_code", "_m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("tens")
    ).select("station_code", "tens", F.coalesce(F.try_element_at("_m", F.col("tens")), F.lit("-")).alias("ones_digits"))


def _entries(folded: DataFrame, profile: Profile) -> DataFrame:
    """Folded draws back to (draw, draw_index, number, frequency)."""
    return folded.select(*profile.keys, "draw_index", F.explode("counts").alias("number_2d", "frequency"))


def recent_draws(counts: DataFrame, profile: Profile, last: int) -> DataFrame:
    """Counts of the last N draws of each station, with ``draw_index`` 1 for the newest."""
    return _entries(newest_draws(fold_draws(counts, profile), profile, last), profile)


def trailing_window_freq(counts: DataFrame, profile: Profile, windows: tuple[int, ...]) -> DataFrame:
    """Frequency in the last 30 / 90 / 180 / 365 draws, one column per window."""
    recent = recent_draws(counts, profile, max(windows))
    return recent.groupBy(*profile.grain, "number_2d").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("draw_index") <= n, F.col("frequency"))), F.lit(0)).alias(f"last_{n}")
            for n in windows
        ]
    )


def fill_numbers(rows: DataFrame, profile: Profile, values: list[str], **extra: Column) -> DataFrame:
    """All 100 numbers per station; ``found`` is the struct of the number's values, or NULL.

    ``rows`` has one row per (station, number), so a station folds into at most 100 entries.
    """
    folded = rows.groupBy(*profile.grain).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("number_2d"), F.struct(*values)))).alias("_m"),
        *[column.alias(name) for name, column in extra.items()],
    )
    return folded.select(*profile.grain, *extra, "_m", F.explode(numbers_column()).alias("number_2d")).select(
        *profile.grain, *extra, "number_2d", F.try_element_at("_m", F.col("number_2d")).alias("found")
    )


def momentum(counts: DataFrame, profile: Profile, top: int = 5) -> DataFrame:
    """Rate over the last 7 draws minus the rate over the 30 draws before them; the top few.

    Numbers absent from all 37 draws score 0 and compete with negative scores.
    """
    recent = recent_draws(counts, profile, 37)
    at = F.col("draw_index")
    sums = recent.groupBy(*profile.grain, "number_2d").agg(
        F.coalesce(F.sum(F.when(at <= 7, F.col("frequency"))), F.lit(0)).alias("seven"),
        F.coalesce(F.sum(F.when(at > 7, F.col("frequency"))), F.lit(0)).alias("thirty"),
    )
    scored = fill_numbers(sums, profile, ["seven", "thirty"]).select(
        *profile.grain, "number_2d",
        (
            F.coalesce("found.seven", F.lit(0)).cast("double") / F.lit(7.0)
            - F.coalesce("found.thirty", F.lit(0)).cast("double") / F.lit(30.0)
        ).alias("score"),
    )
    w = W.partitionBy(*profile.grain).orderBy(F.desc("score"), F.asc("number_2d"))
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)


def last_appearing_delta(counts: DataFrame, profile: Profile) -> DataFrame:
    """Distance from the next draw to the last appearance: 1 if in the latest draw; absent if never."""
    indexed = _entries(newest_draws(fold_draws(counts, profile), profile), profile)
    return indexed.groupBy(*profile.grain, "number_2d").agg(F.min("draw_index").alias("delta"))


def current_gap(counts: DataFrame, profile: Profile) -> DataFrame:
    """Draws since the number last came up: 0 if in the latest draw, N (all draws) if never."""
    indexed = _entries(newest_draws(fold_draws(counts, profile), profile), profile)
    seen = indexed.groupBy(*profile.grain, "number_2d").agg(
        (F.min("draw_index") - 1).alias("gap"), F.max("draw_index").alias("oldest")
    )
    # the first draw has at least one number, so the largest index is the number of draws
    return fill_numbers(seen, profile, ["gap"], draws=F.max("oldest")).select(
        *profile.grain, "number_2d", F.coalesce("found.gap", "draws").alias("current_gap")
    )


def top_k(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def hot_cold(totals: DataFrame, k: int = 5) -> DataFrame:
    hot = totals.orderBy(F.desc("total_frequency"), "number_2d").limit(k).withColumn("kind", F.lit("hot"))
    cold = totals.orderBy("total_frequency", "number_2d").limit(k).withColumn("kind", F.lit("cold"))
    return hot.unionByName(cold)


def dataset_summary(fact: DataFrame, profile: Profile, target_date: str) -> DataFrame:
    """Range, draws, rows and the freshness flag of a fact."""
    per_draw = fact.groupBy(*profile.keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_draw.agg(
        F.min("draw_date").alias("range_from"), F.max("draw_date").alias("range_to"),
        F.count(F.lit(1)).alias("draw_count"), F.sum("_rows").alias("result_count"),
        (F.max("draw_date") == F.lit(target_date).cast("date")).alias("matches_target"),
    )


def station_metadata(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Per station of the dimension or the fact: draws, results, years and range; 0 and no years without a draw."""
    per_draw = fact.groupBy("station_code", "draw_date").agg(F.count(F.lit(1)).alias("_rows"))
    stats = per_draw.groupBy("station_code").agg(
        F.count(F.lit(1)).alias("draw_count"), F.sum("_rows").alias("result_count"),
        F.sort_array(F.collect_set(F.year("draw_date"))).alias("years"),
    )
    none = F.array().cast("array<int>")
    return stations.join(stats, "station_code", "full_outer").withColumns({
        "draw_count": F.coalesce("draw_count", F.lit(0).cast("long")), "result_count": F.coalesce("result_count", F.lit(0).cast("long")),
        "years": F.coalesce("years", none),
    })

