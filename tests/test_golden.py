"""Exact cells on the golden draw."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from urndraw.functions import dates, text
from urndraw.functions.ranking import split_ordinal, split_running_count
from urndraw.operators import calendars, descriptive, facts, grid, marts, serving
from urndraw.spec import DAILY, STATION, prize_spec, published_calendar

GOLDEN = {
    "special": ["96763"], "prize1": ["16246"], "prize2": ["56517", "64137"],
    "prize3": ["43177", "31665", "74360", "98165", "59063", "00916"], "prize4": ["2733", "2653", "2083", "1856"],
    "prize5": ["0452", "6287", "6628", "4037", "3904", "7946"], "prize6": ["329", "663", "879"],
    "prize7": ["66", "80", "49", "61"],
}


def draws(spark, *rows):
    schema = "draw_date string, source_url string, " + ", ".join(f"{g} array<string>" for g in GOLDEN)
    data = [(day, "https://x", *[({**GOLDEN, **changed})[g] for g in GOLDEN]) for day, changed in rows]
    return spark.createDataFrame(data, schema).withColumn("draw_date", F.to_date("draw_date"))


@pytest.fixture(scope="module")
def fact(spark):
    return facts.draw_results(draws(spark, ("2026-07-16", {"special": ["96700"]}), ("2026-07-14", {})), DAILY, "r1").cache()


@pytest.fixture(scope="module")
def loto(fact):
    return grid.loto_daily(grid.draw_counts(fact, DAILY, "loto_2d"), DAILY, "r1").cache()


def test_long_fact_keeps_leading_zeros(fact):
    assert fact.count() == 54 and len(fact.columns) == 11
    row = fact.where("formatted_number = '00916'").first()
    assert (row.full_number, row.loto_2d, row.tens_digit, row.ones_digit, row.prize_order) == (916, "16", 1, 6, 6)


def test_first_draw_is_never_seen(loto):
    first = loto.where("draw_date = '2026-07-14'")
    assert first.count() == 100
    assert first.agg(F.sum("frequency")).first()[0] == 27
    assert first.where("number_2d = '63'").first().frequency == 3
    assert first.where("previous_appearance_status <> 'never_seen' or draws_since_previous is not null").count() == 0


def test_second_draw_gaps(loto):
    row = loto.where("draw_date = '2026-07-16' and number_2d = '63'").first()
    assert (row.draws_since_previous, row.calendar_days_since_previous, row.rolling_7_frequency) == (1, 2, 5)
    assert loto.where("draw_date = '2026-07-16' and number_2d = '99'").first().draws_since_previous is None


def test_order_of_input_does_not_matter(spark, fact, loto):
    shuffled = grid.loto_daily(grid.draw_counts(fact.orderBy(F.rand(7)), DAILY, "loto_2d"), DAILY, "r1")
    assert shuffled.exceptAll(loto).count() == 0


def test_rolling_sums_grow_with_the_window(loto):
    assert loto.where("rolling_7_frequency > rolling_30_frequency or rolling_30_frequency > rolling_90_frequency").count() == 0


def test_nested_form_round_trips(fact):
    nested = facts.canonical_draws(fact, DAILY)
    again = facts.draw_results(nested, DAILY, "r1")
    assert again.exceptAll(fact).count() == 0 and fact.exceptAll(again).count() == 0


def many(spark, per_group=1101):
    """One draw with far more prizes in a group than any layout."""
    return spark.range(1, per_group + 1).select(
        F.lit("S1").alias("station_code"), F.lit("2026-07-14").cast("date").alias("draw_date"), F.lit(1).cast("long").alias("station_order"),
        F.lit("One").alias("station_name"), F.lit("u").alias("station_url"), F.lit("s").alias("source_url"),
        F.lit("prize4").alias("prize_group"), F.col("id").alias("prize_order"), (F.col("id") % 90000).alias("full_number"),
        F.lpad(F.col("id").cast("string"), 5, "0").alias("formatted_number"), F.lpad((F.col("id") % 100).cast("string"), 2, "0").alias("loto_2d"))


def test_large_draws_take_as_many_rows_as_they_need(spark, fact):
    rows = many(spark)
    nested = facts.canonical_draws(rows, STATION)
    assert sorted((r.part, r.result_count, len(r.prize4)) for r in nested.collect()) == [(0, 1000, 1000), (1, 101, 101)]
    again = facts.draw_results(nested, STATION, "r1")
    assert again.count() == 1101 and again.select("prize_order", "full_number").exceptAll(rows.select("prize_order", "full_number")).count() == 0
    small = facts.draw_results(facts.canonical_draws(fact, DAILY, 3), DAILY, "r1", 3)
    assert small.exceptAll(fact).count() == 0 and small.count() == fact.count()


def test_large_records_keep_every_number(spark):
    records = serving.draw_records(facts.normalize_fact(many(spark), STATION, "", ""), STATION)
    got = {r.part: (r.status, len(r.numbers), len(r.prizes["prize4"])) for r in records.collect()}
    assert got == {0: ("no_special", 1000, 1000), 1: ("continued", 101, 101)}
    assert serving.draw_contract(records, 18).count() == 1


def test_wide_row_and_the_rows_beyond_are_everything(spark):
    rows = many(spark, 40)
    wide, beyond = facts.legacy_wide(rows, STATION), facts.legacy_beyond(rows, STATION)
    assert wide.first().result_count == 40
    assert facts.legacy_long(wide, STATION).count() == 7 and beyond.count() == 33


def test_repeated_digits_are_written_out(spark):
    counts = spark.createDataFrame([("S1", "2026-07-14", "07", 30), ("S1", "2026-07-14", "01", 1)],
                                   "station_code string, draw_date string, number_2d string, frequency long")
    cells = {r.tens: r.ones_digits for r in descriptive.head_tail_table(counts).collect()}
    assert cells[0] == ", ".join(["1"] + ["7"] * 30) and cells[1] == "-"


def test_wide_and_sparse_shapes(fact):
    wide = facts.legacy_wide(fact, DAILY)
    assert len(wide.columns) == 29 and wide.where("result_count = 27").count() == 2
    assert wide.where("date = '2026-07-14'").first().prize3_6 == 916
    sparse = facts.sparse_matrix(grid.draw_counts(fact, DAILY, "loto_2d"), DAILY)
    assert len(sparse.columns) == 101
    assert sparse.where("date = '2026-07-14'").first().n63 == 3
    assert facts.legacy_long(wide, DAILY).count() == 54


def test_a_draw_under_two_names_is_counted_once(spark):
    rows = spark.createDataFrame(
        [("S1", "2026-07-14", "Old", "07"), ("S1", "2026-07-14", "New", "07"), ("S1", "2026-07-14", "New", "08")],
        "station_code string, draw_date string, station_name string, number_2d string",
    ).withColumn("draw_date", F.to_date("draw_date"))
    dense = grid.dense_grid(grid.draw_counts(rows, STATION), STATION)
    assert dense.count() == 100
    assert {r.number_2d: r.frequency for r in dense.where("frequency > 0").collect()} == {"07": 2, "08": 1}


def test_three_gap_definitions(fact):
    counts = grid.draw_counts(fact, DAILY, "loto_2d")
    gap = {r.number_2d: r.current_gap for r in descriptive.current_gap(counts, DAILY).collect()}
    delta = {r.number_2d: r.delta for r in descriptive.last_appearing_delta(counts, DAILY).collect()}
    assert gap["66"] == 0 and delta["66"] == 1  # in the latest draw
    assert gap["99"] == 2 and "99" not in delta  # never
    assert gap["00"] == 0 and delta["00"] == 1  # only the changed special


def test_special_prize_columns(fact):
    row = facts.special_prize(fact, DAILY).where("draw_date = '2026-07-14'").first()
    assert (row.tail_2d, row.first_digit, row.last_digit, row.digit_sum, row.is_even_tail) == ("63", 9, 3, 31, False)


def test_calendar_dimension(fact):
    rows = {str(r.date): r for r in marts.dim_date(fact).collect()}
    assert [rows[d].draw_status for d in ("2026-07-14", "2026-07-15", "2026-07-16")] == ["success", "missing", "success"]
    assert (rows["2026-07-14"].day_of_week, rows["2026-07-14"].day_name, rows["2026-07-14"].iso_week) == (2, "Tuesday", 29)


def test_gold_needs_rows(fact):
    with pytest.raises(ValueError):
        marts.build_gold(fact.limit(0), DAILY, "r1")


def test_spec_table(spark):
    assert DAILY.prize_count == 27 and STATION.prize_count == 18
    assert prize_spec(spark, DAILY, STATION).count() == 17


def test_published_calendar_rules(spark):
    weekly, overrides = published_calendar(spark)
    dates_ = ["2021-12-26", "2022-01-02", "2021-08-21", "2026-07-16"]
    days = spark.createDataFrame([(r, d) for r in ("south", "central") for d in dates_], "region string, d string").select(
        "region", F.to_date("d").alias("draw_date"))
    found = {}
    for r in calendars.expected_stations(days, weekly, overrides).collect():
        found.setdefault((r.region, str(r.draw_date)), set()).add(r.station_code)
    assert found["central", "2021-12-26"] == {"KH", "KT"}
    assert found["central", "2022-01-02"] == {"KH", "KT", "TTH"}
    assert found["central", "2021-08-21"] == {"DNO", "QNG"}
    assert found["south", "2026-07-16"] == {"TN", "AG", "BTH"}


def test_padding_never_truncates(spark):
    row = spark.range(1).select(text.zero_pad(F.lit(12345), 3).alias("a"), text.zero_pad(F.lit(7), 3).alias("b")).first()
    assert (row.a, row.b) == ("12345", "007")


def test_date_rules(spark):
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    row = spark.range(1).select(
        dates.expected_date(at("2026-07-16 12:59:00")).alias("before"), dates.expected_date(at("2026-07-16 13:00:00")).alias("after"),
        dates.alert_window(at("2026-07-16 13:29:59")).alias("w"), dates.alert_window(at("2026-07-16 13:30:00")).alias("c"),
        dates.batch_year_end(F.lit(2025), F.lit("2026-07-16").cast("date")).alias("past"),
        dates.batch_year_end(F.lit(2026), F.lit("2026-01-01").cast("date")).alias("new_year"),
        dates.batch_year_end(F.lit(2027), F.lit("2026-01-01").cast("date")).alias("future"),
        dates.parse_display(F.lit("31"), F.lit("2"), F.lit("2026")).alias("no_date"),
    ).first()
    assert str(row.before) == "2026-07-15" and str(row.after) == "2026-07-16"
    assert (row.w, row.c) == ("warning", "critical")
    assert row.past == datetime.date(2025, 12, 31) and row.new_year is None and row.future is None and row.no_date is None


def test_split_ordinal_equals_plain_window(spark):
    from pyspark.sql import Window as W

    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 16).alias("part"), F.col("id").alias("v"))
    plain = rows.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("part", "v")).cast("long")).drop("part")
    split = split_ordinal(rows, ["k"], "part", ["v"], "n")
    assert split.select(plain.columns).exceptAll(plain).count() == 0 and split.count() == 2000


def test_split_running_count_equals_plain_window(spark):
    from pyspark.sql import Window as W

    rows = spark.range(1500).select(
        (F.col("id") % 3).alias("k"), F.expr("id div 50").alias("part"), F.col("id").alias("v"), (F.col("id") % 7 == 0).alias("f"))
    before = W.partitionBy("k").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    plain = rows.withColumn("n", F.coalesce(F.sum(F.when(F.col("f"), 1).otherwise(0)).over(before), F.lit(0)))
    split = split_running_count(rows, ["k"], "part", ["v"], F.col("f"), "n")
    assert split.select(plain.columns).exceptAll(plain).count() == 0
