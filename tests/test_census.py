"""Counts that stand side by side in a few sums are those of a group for each number."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from urndraw.operators import census, quality
from urndraw.spec import STATION

KEYS = ["station_code", "draw_date"]


def made(n):
    random.seed(3)
    numbers = [f"{i:02d}" for i in range(100)] + ["A1", None, "7", "12\n", " 1", "+5", "100", ""]
    return [(random.choice(["a", "b", None]), random.choice(["x", None]), random.choice(numbers), random.choice([0, 1, 2, None])) for _ in range(n)]


@pytest.mark.parametrize("stretch", [census.STRETCH, 3])
def test_counts_by_draw_and_number(spark, monkeypatch, stretch):
    monkeypatch.setattr(census, "STRETCH", stretch)
    rows = made(3000)
    df = spark.createDataFrame(rows, "station_code string, draw_date string, number_2d string, frequency long").repartition(3)
    counted = census.count_numbers(df, KEYS, F.col("frequency"))
    wanted, sums = Counter(r[:3] for r in rows), defaultdict(list)
    for r in rows:
        sums[r[:2], r[2] if r[2] not in census.NUMBERS else "."].append(r[3])
    found = Counter()
    for r in counted.collect():
        key = (r.station_code, r.draw_date)
        for number, n in [(r.number, r.rows)] if r.odd else zip(census.NUMBERS, r.counts):
            found[(*key, number)] += n
        listed = sums.pop((key, r.number if r.odd else "."))
        known = [f for f in listed if f is not None]
        assert (r.rows, r.value) == (len(listed), sum(known) if known else None)
    assert +found == wanted and not sums
    repeated = {(r.station_code, r.draw_date, r.number_2d): r.rows for r in census.repeated_numbers(counted, KEYS).collect()}
    assert repeated == {k: n for k, n in wanted.items() if n > 1}
    assert counted.agg(F.sum(census.repeated())).first()[0] == sum(repeated.values())
    assert counted.agg(F.sum(census.different())).first()[0] == sum(k[2] in census.NUMBERS for k in wanted)


def test_a_report_has_no_group_for_each_number(spark):
    loto = spark.range(20000).select(
        F.concat(F.lit("S"), (F.col("id") % 2).cast("string")).alias("station_code"), F.lit("2000-01-01").cast("date").alias("draw_date"),
        F.lpad((F.col("id").cast("int") % 100).cast("string"), 2, "0").alias("number_2d"), F.lit(1).cast("long").alias("frequency"))
    fact = spark.createDataFrame([], "station_code string, draw_date date, prize_group string, prize_order long, prize_width long, full_number long")
    statuses = spark.createDataFrame([], "status string")
    report = quality.quality_report(fact, loto, statuses, STATION, "r", "2001-01-01")
    found = {r.check_name: r.finding_count for r in report.collect()}
    assert (found["loto-business-key-unique"], found["loto-frequency-sum"], found["loto-number-coverage"]) == (20000, 2, 2)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [" in line and "number_2d" in line.split("Aggregate [")[1].split("]")[0]]
