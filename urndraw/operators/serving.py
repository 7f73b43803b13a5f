"""Serving records: nested draws, station/year shards, contracts and the paged explorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urndraw.operators.facts import part_of
from urndraw.spec import Profile


def draw_sizes(counts: DataFrame) -> DataFrame:
    return counts.groupBy("station_code", "draw_date").agg(F.sum("frequency").alias("result_count"))


def shard_counts(drawn: DataFrame) -> DataFrame:
    """Draws, results and range per (station, year)."""
    return drawn.groupBy("station_code", F.year("draw_date").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("draw_count"), F.sum("result_count").alias("result_count"),
        F.min("draw_date").alias("range_from"), F.max("draw_date").alias("range_to"),
    )


def shard_totals(shards: DataFrame, declared: DataFrame) -> DataFrame:
    """Sums over the shards of a station against what the release declares; ``agrees`` is false where one side is missing."""
    return (
        shards.groupBy("station_code")
        .agg(
            F.sum("draw_count").alias("draw_count"), F.sum("result_count").alias("result_count"),
            F.min("range_from").alias("range_from"), F.max("range_to").alias("range_to"), F.count(F.lit(1)).alias("shards"),
        )
        .join(declared, "station_code", "full_outer")
        .withColumn("agrees", F.col("draw_count").eqNullSafe(F.col("declared_draws")) & F.col("result_count").eqNullSafe(F.col("declared_results")))
        .drop("declared_draws", "declared_results")
    )


def draw_records(normal: DataFrame, profile: Profile, per_row: int = 1000) -> DataFrame:
    """Nested records: special value, tail, numbers with the special first, prizes by group.

    A record holds the orders ``part * per_row + 1`` to ``(part + 1) * per_row`` of every group, so it stays bounded and a draw
    has as many as it needs; one that fits its layout has one. ``status`` is ``ok``, ``no_special``, ``many_specials`` (a record
    needs exactly one), or ``continued`` for the later records of a draw. All numbers and prizes are in some record.
    """
    is_special = F.col("prize_group") == "special"
    place = F.struct((~is_special).cast("int").alias("later"), "group_order", "prize_order", "loto_2d", "formatted_number", "prize_group")
    rows = normal.groupBy("station_code", "draw_date", part_of("prize_order", per_row).alias("part")).agg(
        F.max("station_name").alias("station_name"),
        F.count(F.lit(1)).alias("result_count"),
        F.count(F.when(is_special, 1)).alias("specials"),
        F.array_sort(F.collect_list(place)).alias("_p"),
    )
    status = (
        F.when(F.col("part") > 0, "continued")
        .when(F.col("specials") == 0, "no_special")
        .when(F.col("specials") > 1, "many_specials")
        .otherwise("ok")
    )
    rows = rows.withColumn("status", status)
    groups = F.array_distinct(F.transform(F.array_sort("_p", _by_group), lambda p: p["prize_group"]))
    prizes = F.map_from_arrays(
        groups,
        F.transform(groups, lambda g: F.transform(F.filter("_p", lambda p: p["prize_group"] == g), lambda p: p["formatted_number"])),
    )
    ok = F.col("status") == "ok"
    special = F.col("_p")[0]["formatted_number"]
    return rows.select(
        "station_code", "draw_date", "part", "station_name", "result_count", "status",
        F.when(ok, special).alias("special_prize"),
        F.when(ok, F.right(special, F.lit(2))).alias("special_tail"),
        F.transform("_p", lambda p: p["loto_2d"]).alias("numbers"),
        prizes.alias("prizes"),
    )


def _by_group(a, b):
    return F.when(a["group_order"] < b["group_order"], -1).when(a["group_order"] > b["group_order"], 1).otherwise(0)


def draw_contract(records: DataFrame, expected: int) -> DataFrame:
    """Violations of a draw's first record: size, number form, special, multiset of tails against numbers.

    A draw with further records has more prizes in the first than any layout, which its size shows.
    """
    tails = F.transform(F.flatten(F.map_values("prizes")), lambda v: F.lpad(F.right(v, F.lit(2)), 2, "0"))
    problems = F.array_compact(
        F.array(
            F.when(F.col("status") != "ok", F.col("status")),
            F.when(F.col("result_count") != expected, F.lit("result_count")),
            F.when(~F.forall("numbers", lambda n: n.rlike("^[0-9]{2}$")), F.lit("number_form")),
            F.when(~F.endswith(F.col("special_prize"), F.col("special_tail")), F.lit("special_tail")),
            F.when(F.array_sort(tails) != F.array_sort("numbers"), F.lit("tails")),
            F.when(
                F.coalesce(F.size(F.try_element_at("prizes", F.lit("special"))) != 1, F.lit(True))
                | (F.get(F.try_element_at("prizes", F.lit("special")), F.lit(0)) != F.col("special_prize")),
                F.lit("special_prize"),
            ),
        )
    )
    return records.where("part = 0").select("station_code", "draw_date", F.array_join(problems, ",").alias("problems"))


def year_shards(records: DataFrame, stations: DataFrame) -> DataFrame:
    """Records with the shard they belong to, under the station's current name, or their own if the dimension lacks it.

    A shard is a folder of records (see ``write_shards``), not one nested value, so its size is free.
    """
    names = stations.select("station_code", F.col("station_name").alias("_current"))
    return (
        records.join(names, "station_code", "left").withColumn("station_name", F.coalesce("_current", "station_name"))
        .drop("_current").withColumn("year", F.year("draw_date").cast("long"))
    )


def shard_contract(records: DataFrame, declared: DataFrame) -> DataFrame:
    """Per (station, year): dates strictly rise in stored order inside the year, range, counts and name agree.

    ``position`` is a record's place in its shard; a shard has at most one record per day of its year. A shard that nobody
    declared is ``undeclared``, a declared one without records ``absent``.
    """
    before = F.lag("draw_date").over(W.partitionBy("station_code", "year").orderBy("position"))
    checked = records.withColumn("_rises", F.coalesce(before < F.col("draw_date"), F.lit(True)))
    stats = checked.groupBy("station_code", "year").agg(
        F.count(F.lit(1)).alias("_draws"), F.sum("result_count").alias("_results"),
        F.min("draw_date").alias("_from"), F.max("draw_date").alias("_to"),
        F.count(F.when(~F.col("_rises"), 1)).alias("_falls"),
        F.count(F.when(F.year("draw_date") != F.col("year"), 1)).alias("_outside"),
        F.min("station_name").alias("_low"), F.max("station_name").alias("_high"),
    )
    undeclared, absent = F.col("draw_count").isNull(), F.col("_draws").isNull()
    problems = F.array_compact(
        F.array(
            F.when(undeclared, F.lit("undeclared")),
            F.when(absent, F.lit("absent")),
            F.when(F.col("_falls") > 0, F.lit("dates_not_rising")),
            F.when(F.col("_outside") > 0, F.lit("outside_year")),
            F.when((F.col("_from") != F.col("range_from")) | (F.col("_to") != F.col("range_to")), F.lit("range")),
            F.when(F.col("_draws") != F.col("draw_count"), F.lit("draw_count")),
            F.when(F.col("_results") != F.col("result_count"), F.lit("result_count")),
            F.when((F.col("_low") != F.col("station_name")) | (F.col("_high") != F.col("station_name")), F.lit("name")),
        )
    )
    both = stats.join(declared, ["station_code", "year"], "full_outer")
    return both.select("station_code", "year", F.array_join(problems, ",").alias("problems"))


def release_contract(
    stations: DataFrame, declared_draws: int | None, declared_results: int | None, per_draw: int,
    release_from: str | None = None, release_to: str | None = None,
) -> DataFrame:
    """Per station: one entry, years match the range, results = draws x prizes, dates inside the release; and the release's totals
    and range."""
    years = F.col("years")
    start, end = F.lit(release_from).cast("date"), F.lit(release_to).cast("date")
    problems = F.array_compact(
        F.array(
            F.when(F.col("_entries") > 1, F.lit("duplicate_code")),
            F.when(F.size(years) == 0, F.lit("no_years")),
            F.when(years != F.array_sort(F.array_distinct(years)), F.lit("years_unsorted")),
            F.when((F.get(years, F.lit(0)) != F.year("first_draw_date")) | (F.try_element_at(years, F.lit(-1)) != F.year("latest_draw_date")), F.lit("years_range")),
            F.when(F.col("result_count") != F.col("draw_count") * per_draw, F.lit("result_count")),
            F.when((F.col("first_draw_date") < start) | (F.col("latest_draw_date") > end), F.lit("outside_release")),
        )
    )
    entries = stations.groupBy("station_code").agg(F.count(F.lit(1)).alias("_entries"))
    per_station = stations.join(entries, "station_code").select("station_code", F.array_join(problems, ",").alias("problems"))
    totals = stations.agg(
        F.sum("draw_count").alias("d"), F.sum("result_count").alias("r"), F.min("first_draw_date").alias("a"), F.max("latest_draw_date").alias("b"),
    ).select(
        F.lit("*").alias("station_code"),
        F.array_join(
            F.array_compact(
                F.array(
                    F.when(~F.col("d").eqNullSafe(F.lit(declared_draws).cast("long")), F.lit("total_draws")),
                    F.when(~F.col("r").eqNullSafe(F.lit(declared_results).cast("long")), F.lit("total_results")),
                    F.when((F.col("a") != start) | (F.col("b") != end), F.lit("release_range")),
                )
            ),
            ",",
        ).alias("problems"),
    )
    return per_station.unionByName(totals)


def explorer_page(
    shards: DataFrame, station: str, start: str | None = None, end: str | None = None, number: str | None = None,
    before: str | None = None, limit: int = 25,
) -> DataFrame:
    """One page of a station's records, newest first, with whether there is a next page.

    ``shards`` are the stored records with the folders station_code and year. The station and the years of the dates asked for
    are filters on folders, so only those are opened. One record more than the page tells whether there is a next one.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be 1..100")
    rows = shards.where(F.col("station_code") == station)
    for text, keep in ((start, lambda column, value: column >= value), (end, lambda column, value: column <= value),
                       (before, lambda column, value: column < value)):
        if text:
            year = int(text[:4])
            rows = rows.where(F.col("year") >= year if text is start else F.col("year") <= year)
            rows = rows.where(keep(F.col("draw_date"), F.lit(text).cast("date")))
    if number is not None:
        rows = rows.where(F.array_contains("numbers", number))
    found = rows.orderBy(F.desc("draw_date"), "part").limit(limit + 1)  # at most 101 records from here on
    ranked = found.withColumn("position", F.row_number().over(W.orderBy(F.desc("draw_date"), "part")).cast("long"))
    more = F.max("position").over(W.partitionBy(F.lit(1))) > limit
    return ranked.withColumn("has_more", more).where(F.col("position") <= limit)


def explorer_merge(pages: DataFrame) -> DataFrame:
    """Appended pages: the last occurrence of a (station, date) wins."""
    values = [c for c in pages.columns if c not in ("station_code", "draw_date")]
    return pages.groupBy("station_code", "draw_date").agg(F.max_by(F.struct(*values), "page").alias("_r")).select(
        "station_code", "draw_date", "_r.*"
    )


def recent_records(records: DataFrame, last: int) -> DataFrame:
    """The records of the last ``last`` draws of each station, newest first by ``back``; a record is one bounded row."""
    newest = F.dense_rank().over(W.partitionBy("station_code").orderBy(F.desc("draw_date")))
    return records.withColumn("back", newest.cast("long")).where(F.col("back") <= last)


def compact_payload(records: DataFrame, totals: DataFrame, last: int, target_date: str, run_id: str) -> DataFrame:
    """The dashboard's content, one row per station and one (``*``) for all: manifest and freshness, latest results, recent
    draws by date and the frequency map of all 100 numbers.

    ``totals`` has (station_code, number_2d, total_frequency) for all numbers. A row has at most ``last`` dates, the numbers of
    one draw's first record and 100 totals; the records themselves are the rows of ``recent_records``.
    """
    per_draw = records.groupBy("station_code", "draw_date").agg(
        F.sum("result_count").alias("result_count"),
        F.min_by(F.struct("special_prize", "numbers"), "part").alias("first"),
    )
    newest = F.row_number().over(W.partitionBy("station_code").orderBy(F.desc("draw_date")))
    ranked = per_draw.withColumn("_back", newest)
    recent = F.when(F.col("_back") <= last, F.struct("_back", "draw_date", F.col("first.special_prize").alias("special_prize")))
    stations = ranked.groupBy("station_code").agg(
        F.min("draw_date").alias("range_from"), F.max("draw_date").alias("range_to"),
        F.count(F.lit(1)).alias("draw_count"), F.sum("result_count").alias("result_count"),
        F.sum(F.when(F.col("_back") <= last, F.col("result_count"))).alias("recent_results"),
        F.array_sort(F.collect_list(recent)).alias("_recent"),
        F.max(F.when(F.col("_back") == 1, F.col("first.numbers"))).alias("latest_numbers"),
    )
    stations = stations.select(
        "station_code", "range_from", "range_to", "draw_count", "result_count", "recent_results",
        F.transform("_recent", lambda r: F.struct(r["draw_date"].alias("draw_date"), r["special_prize"].alias("special_prize"))).alias("recent_draws"),
        "latest_numbers")
    entry = F.struct("number_2d", "total_frequency")
    maps = totals.groupBy("station_code").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("frequency"))
    whole = totals.groupBy("number_2d").agg(F.sum("total_frequency").alias("total_frequency")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("frequency"))
    everything = stations.agg(
        F.min("range_from").alias("range_from"), F.max("range_to").alias("range_to"), F.sum("draw_count").alias("draw_count"),
        F.sum("result_count").alias("result_count"), F.sum("recent_results").alias("recent_results"))
    star = F.lit("*").alias("station_code")
    overall = everything.select(star, "*").join(whole.select(star, "frequency"), "station_code")
    rows = stations.join(maps, "station_code", "left").unionByName(overall, allowMissingColumns=True)
    return rows.withColumns({
        "run_id": F.lit(run_id), "target_date": F.lit(target_date).cast("date"),
        "matches_target": F.col("range_to") == F.lit(target_date).cast("date"),
    })
