"""State, stored tables, releases, audits, serving pages and streams on small fixtures."""

from __future__ import annotations

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F
from test_backtest import START, observations, synthetic

from urndraw.operators import audit, grid, health, marts, quality, serving, state
from urndraw.plans import q_quality
from urndraw.sources import tables
from urndraw.spec import DAILY, STATION
from urndraw.streaming import jobs, late


def events(spark, *rows):
    schema = "lake long, draw_date string, status string, run_id string, updated_at string, seq long, detail string"
    df = spark.createDataFrame([(1, d, s, f"r{i}", t, i, None) for i, (d, s, t) in enumerate(rows)], schema)
    return df.withColumn("draw_date", F.to_date("draw_date")).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def test_failed_middle_date_stays_pending(spark):
    log = events(spark, ("2026-07-14", "success", "2026-07-14 20:00:00"), ("2026-07-15", "failed", "2026-07-15 20:00:00"),
                 ("2026-07-16", "success", "2026-07-16 20:00:00"))
    states = state.latest_state(log, ["lake", "draw_date"])
    pending = state.pending_dates(state.lake_calendar(log), states)
    assert [str(r.draw_date) for r in pending.collect()] == ["2026-07-15"]
    assert state.pending_dates(state.lake_calendar(log), states, force=True).count() == 3


def test_equal_times_later_record_wins(spark):
    log = events(spark, ("2026-07-14", "failed", "2026-07-14 20:00:00"), ("2026-07-14", "success", "2026-07-14 20:00:00"))
    assert state.latest_state(log, ["lake", "draw_date"]).first().status == "success"


def fact(spark, shift=0):
    rows = [(START + datetime.timedelta(days=i), "S1", "special", 1, i + shift, 1 + bool(shift)) for i in range(0, 90, 3)]
    return spark.createDataFrame(rows, "draw_date date, station_code string, prize_group string, prize_order long, full_number long, seq long")


KEY = ["draw_date", "station_code", "prize_group", "prize_order"]


def test_upsert_touches_only_its_months_and_repeats_safely(spark, tmp_path):
    path = f"file://{tmp_path}/silver"
    tables.write_silver(fact(spark), path)
    untouched = set(glob.glob(f"{tmp_path}/silver/year=2026/month=1/*.parquet"))
    new = fact(spark, shift=1000).where("month(draw_date) = 2")
    for attempt in range(2):
        tables.upsert_silver(spark, path, new, KEY, ["seq"], f"file://{tmp_path}/staging-{attempt}")
    stored = tables.read_silver(spark, path)
    assert stored.count() == 30
    assert stored.where("full_number >= 1000").count() == new.count()
    assert set(glob.glob(f"{tmp_path}/silver/year=2026/month=1/*.parquet")) == untouched


def test_release_is_immutable_and_verified(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    numbers = marts.dim_number(spark)
    tables.write_release({"dim-number": numbers}, root, "r1")
    tables.write_manifest(spark, root, "r1", "2026-07-16", "2026-07-16T20:00:00Z")
    assert tables.read_release(spark, root, ["dim-number"])["dim-number"].count() == 100
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_release({"dim-number": numbers}, root, "r1")
    with pytest.raises(ValueError):
        tables.write_release({"dim-number": numbers}, root, "r2", ("xlsx",))
    with pytest.raises(ValueError):
        tables.release_path(root, "../r1")
    part = glob.glob(f"{tmp_path}/lake/gold/releases/run-id=r1/dim-number.parquet/part-*")[0]
    os.unlink(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))  # the local file system's own check
    with open(part, "r+b") as f:
        f.seek(10)
        f.write(b"\0\1\2")
    with pytest.raises(ValueError, match="damaged"):
        tables.read_release(spark, root, ["dim-number"])


def test_newest_pointer_wins(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    for run, target in (("r2", "2026-07-17"), ("r1", "2026-07-16")):
        tables.write_release({"dim-number": marts.dim_number(spark)}, root, run)
        tables.write_manifest(spark, root, run, target, "2026-07-18T00:00:00Z")
    assert tables.latest_pointer(spark, root).first().run_id == "r2"


def test_every_audit_rule_fires_on_the_damaged_tables(spark):
    found = {r.code: r for r in audit.findings(q_quality.published(spark, "/root/testdata/sf0.001", stored=True), list(audit.RULES)).collect()}
    assert len(found) == 38
    # one station at this scale, and every calendar day inside the range keeps its facts
    quiet = {code for code, r in found.items() if r.passed}
    assert quiet <= {"dim-station-code-invalid", "dim-station-business-key-duplicate", "dim-station-range-invalid",
                     "dim-station-code-set-mismatch", "dim-station-range-mismatch"}
    assert all(len(r.samples.split("; ")) <= 25 for r in found.values() if r.samples)


def sound_release(spark):
    draws = [[(i * 18 + j) % 100 for j in range(18)] for i in range(3)]
    rows = []
    for i, numbers in enumerate(draws):
        at = iter(numbers)
        for group, count, width in STATION.groups:
            for order in range(1, count + 1):
                n = next(at)
                rows.append((START + datetime.timedelta(days=i), "S1", "S1", group, order, width, n, f"{n:0{width}d}"))
    long = spark.createDataFrame(rows, "draw_date date, station_code string, station_name string, prize_group string, prize_order long, prize_width long, full_number long, formatted_number string")
    long = long.withColumns({"loto_2d": F.right("formatted_number", F.lit(2)), "run_id": F.lit("r1")}).withColumns(
        {"tens_digit": F.substring("loto_2d", 1, 1).cast("long"), "ones_digit": F.substring("loto_2d", 2, 1).cast("long")})
    loto = grid.loto_daily(grid.draw_counts(long, STATION, "loto_2d"), STATION, "r1")
    dates = marts.dim_date(long).withColumn("seq", F.lit(1))
    stations = long.groupBy("station_code").agg(F.min("draw_date").alias("first_draw_date"), F.max("draw_date").alias("latest_draw_date"))
    objects = spark.createDataFrame([("gold/releases/run-id=r1/a", 1, "x")], "key string, size long, sha256 string")
    return long, loto, {
        "dates": lambda: dates, "fact": lambda: long, "loto": lambda: loto, "stations": lambda: stations,
        "expected": lambda: long.select("draw_date", "station_code").distinct(), "manifest": lambda: objects, "store": lambda: objects,
        "required": lambda: objects.select("key"),
    }


def test_sound_release_has_no_findings(spark):
    long, loto, named = sound_release(spark)
    p = audit.Published(STATION, "r1", "2026-01-01", "2026-01-03", named)
    assert [r.code for r in audit.findings(p, list(audit.RULES)).where("not passed").collect()] == []
    nobody = long.select("draw_date", "station_code").limit(0)
    report = quality.quality_report(long, loto, marts.dim_date(long).select("date", F.col("draw_status").alias("status")),
                                    STATION, "r1", "2026-01-03", nobody, [long, loto])
    assert report.count() == 23 and report.where("not passed").count() == 0
    assert quality.quality_gate(report).first().passed is True
    empty = quality.quality_report(long.limit(0), loto.limit(0), named["dates"]().select("date", F.col("draw_status").alias("status")),
                                   STATION, "r1", "2026-01-03", nobody, [long])
    assert quality.quality_gate(empty).first().passed is False


def test_malformed_values_become_findings(spark):
    _, _, named = sound_release(spark)
    broken = named["fact"]().withColumn("draw_date", F.lit("not a date")).withColumn("full_number", F.lit("x"))
    p = audit.Published(STATION, "r1", "2026-01-01", "2026-01-03", {**named, "fact": lambda: broken})
    codes = {r.code for r in audit.findings(p, list(audit.RULES)).where("not passed").collect()}
    assert {"fact-draw-date-invalid", "success-date-missing-draw-facts", "station-set-mismatch"} <= codes
    assert audit.missing_columns({"fact": broken.drop("run_id")}) == {"fact": ["run_id"]}


def test_pages_continue_over_a_year_boundary(spark, tmp_path):
    draws = [[7] * 3 for _ in range(10)]
    rows = observations(spark, draws).withColumn("draw_date", F.date_add(F.lit("2025-12-27").cast("date"), F.date_diff("draw_date", F.lit(START))))
    counts = grid.draw_counts(rows, STATION)
    shards = f"file://{tmp_path}/shards"
    records = counts.groupBy("station_code", "draw_date").agg(F.sum("frequency").alias("result_count"), F.collect_list("number_2d").alias("numbers"))
    tables.write_shards(records.withColumn("part", F.lit(0)), shards)
    stored = tables.read_shards(spark, shards)
    opened = serving.explorer_page(stored, "S1", start="2026-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station_code" in opened and "year#" in opened.split("PartitionFilters:")[1].split("]")[0]
    assert serving.explorer_page(stored, "S1", start="2026-01-02").inputFiles()
    seen, before = [], None
    while True:
        page = sorted(serving.explorer_page(stored, "S1", number="07", before=before, limit=5).collect(), key=lambda r: r.position)
        seen += [str(r.draw_date) for r in page]
        before = seen[-1]
        if not page[-1].has_more:
            break
    assert len(seen) == 10 and seen == sorted(seen, reverse=True) and seen[4] == "2026-01-01"


def test_contracts_see_what_only_one_side_has(spark):
    day = START
    records = spark.createDataFrame([("S1", 2026, day, 18, "One", 2), ("S1", 2026, day + datetime.timedelta(days=1), 18, "One", 1), ("S3", 2026, day, 18, "Three", 1)],
                                    "station_code string, year long, draw_date date, result_count long, station_name string, position long")
    declared = spark.createDataFrame([("S1", 2026, 2, 36, day, day + datetime.timedelta(days=1), "One"), ("S2", 2026, 1, 18, day, day, "Two")],
                                     "station_code string, year long, draw_count long, result_count long, range_from date, range_to date, station_name string")
    got = {r.station_code: r.problems for r in serving.shard_contract(records, declared).collect()}
    assert got == {"S1": "dates_not_rising", "S2": "absent", "S3": "undeclared"}
    shards = serving.shard_counts(records)
    totals = serving.shard_totals(shards, spark.createDataFrame([("S1", 2, 36), ("S2", 1, 18)], "station_code string, declared_draws long, declared_results long"))
    assert {r.station_code: r.agrees for r in totals.collect()} == {"S1": True, "S2": False, "S3": False}


def test_late_draw_equals_full_rebuild(spark):
    counts = grid.draw_counts(observations(spark, synthetic(30)), STATION)
    late = counts.where("day(draw_date) = 11")
    stored = grid.loto_daily(counts.where("day(draw_date) <> 11"), STATION, "r1")
    merged = jobs.late_recompute(stored, counts, late, STATION, "r1")
    whole = grid.loto_daily(counts, STATION, "r1")
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0
    assert stored.where("draw_date > '2026-01-11'").exceptAll(whole).count() > 0


TICKS = [("2026-07-16 12:00:00", False), ("2026-07-16 13:15:00", False), ("2026-07-16 13:25:00", False),
         ("2026-07-16 13:45:00", False), ("2026-07-16 14:00:00", True), ("2026-07-16 14:15:00", True),
         ("2026-07-17 13:40:00", False), ("2026-07-17 20:00:00", False), ("2026-07-18 13:05:00", False), ("2026-07-18 13:50:00", True)]
EXPECTED = [("2026-07-16 13:15:00", "warning", "alert"), ("2026-07-16 13:45:00", "critical", "alert"), ("2026-07-16 14:00:00", "healthy", "recovery"),
            ("2026-07-17 13:40:00", "critical", "alert"), ("2026-07-18 13:05:00", "warning", "alert"), ("2026-07-18 13:50:00", "healthy", "recovery")]


def ticks(spark, rows, first=0):
    return spark.createDataFrame([(1, first + i, t, h) for i, (t, h) in enumerate(rows)], "key long, seq long, ts string, healthy boolean").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))


def seen(df):
    return [(str(r.ts), r.severity, r.event) for r in df.orderBy("ts").collect()]


def test_incident_history(spark):
    assert seen(health.incident_events(ticks(spark, TICKS))) == EXPECTED


def drained(spark, tmp_path, batches, delay="2 hours"):
    """Batches of ticks (seq, time, healthy, delivered), each drained by a query that starts anew from its checkpoint."""
    incoming, out = f"file://{tmp_path}/ticks", None
    schema = "key long, seq long, ts timestamp_ntz, healthy boolean, delivered boolean"
    with jobs.managed_state(spark):
        for rows in batches:
            given = spark.createDataFrame([(1, s, datetime.datetime.fromisoformat(t), h, d) for s, t, h, d in rows], schema)
            given.coalesce(1).write.mode("append").parquet(incoming)
            source = spark.readStream.schema(schema).parquet(incoming)
            out = jobs.drain_to(jobs.incident_stream(source, delay), f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint")
    return out


def state_rows(spark, tmp_path, variable):
    with jobs.managed_state(spark):
        return spark.read.format("statestore").option("stateVarName", variable).load(f"file://{tmp_path}/checkpoint").count()


END = (99, "2026-07-25 00:00:00", None, True)


def test_incident_stream_takes_late_ticks_in_their_order_and_ends_without_state(spark, tmp_path):
    rows = [(i, t, h, True) for i, (t, h) in enumerate(TICKS)]
    # the tick of 13:15 comes after that of 13:25, the one of 13:45 after a restart
    batches = [[rows[0], rows[2]], [rows[1], rows[4]], [rows[3], rows[5], rows[6]], rows[7:], [END]]
    out = drained(spark, tmp_path, batches)
    assert seen(out) == EXPECTED
    assert state_rows(spark, tmp_path, "incident") == 0


def test_an_open_incident_is_the_only_state(spark, tmp_path):
    rows = [(i, t, h, True) for i, (t, h) in enumerate(TICKS)]
    assert seen(drained(spark, tmp_path, [rows[:4], [END]])) == EXPECTED[:2]
    assert state_rows(spark, tmp_path, "incident") == 1


def test_stream_ingest_equals_batch(spark, tmp_path):
    incoming, path = f"file://{tmp_path}/in", f"file://{tmp_path}/silver"
    first, second = fact(spark), fact(spark, shift=500).where("day(draw_date) < 10")
    for batch in (first, second):
        batch.write.mode("append").parquet(incoming)
        jobs.ingest(spark.readStream.schema(batch.schema).parquet(incoming), path, KEY, ["seq"], f"file://{tmp_path}/checkpoint")
    expected = tables.upsert(first, second, KEY, ["seq"])
    stored = tables.read_silver(spark, path).select(expected.columns)
    assert stored.exceptAll(expected).count() == 0 and stored.count() == expected.count()


def test_daily_profile_has_no_station(spark):
    rows = observations(spark, synthetic(5)).drop("station_code", "station_name")
    loto = grid.loto_daily(grid.draw_counts(rows, DAILY), DAILY, "r1")
    assert "station_code" not in loto.columns and loto.count() == 500


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path, staging = f"file://{tmp_path}/silver", f"file://{tmp_path}/staging"
    rows = fact(spark)
    tables.write_silver(rows, path)
    tables.upsert_silver(spark, path, rows.limit(0), KEY, ["seq"], staging)
    tables.upsert_silver(spark, path, rows.where("day(draw_date) < 3"), KEY, ["seq"], staging)
    tables.upsert_silver(spark, path, rows.limit(0), KEY, ["seq"], staging)
    stored = tables.read_silver(spark, path).select(rows.columns)
    assert stored.exceptAll(rows).count() == 0 and stored.count() == rows.count()


def test_late_first_records_are_kept(spark, tmp_path):
    incoming, path, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/seen", f"file://{tmp_path}/checkpoint"
    schema = "lake long, draw_date date, seq long"
    day = datetime.date(2024, 1, 20)
    arrivals = [[(1, day, 5), (1, day, 4)], [(1, datetime.date(2023, 1, 1), 9), (1, day, 1)], [], [(2, day, 7)]]
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(incoming)
        seen = jobs.first_seen(spark.readStream.schema(schema).parquet(incoming), ["lake", "draw_date"], ["seq"], path, checkpoint)
    got = sorted((r.lake, str(r.draw_date), r.seq) for r in seen.collect())
    assert got == [(1, "2023-01-01", 9), (1, "2024-01-20", 4), (2, "2024-01-20", 7)]


def test_several_late_draws_use_what_is_carried(spark):
    counts = grid.draw_counts(observations(spark, synthetic(130)), STATION)
    is_late = F.date_diff("draw_date", F.lit(START)).isin(100, 117)
    stored = grid.loto_daily(counts.where(~is_late), STATION, "r1")
    first = START + datetime.timedelta(days=100)
    merged = jobs.late_recompute(stored, counts.where(F.col("draw_date") >= F.lit(first)), counts.where(is_late), STATION, "r1")
    whole = grid.loto_daily(counts, STATION, "r1")
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


UNDELIVERED = [("2026-07-16 13:05:00", False, False), ("2026-07-16 13:15:00", False, True), ("2026-07-16 13:20:00", False, True),
               ("2026-07-16 13:45:00", False, False), ("2026-07-16 13:50:00", False, True), ("2026-07-16 14:00:00", True, False),
               ("2026-07-16 14:15:00", True, True), ("2026-07-16 14:20:00", True, True)]


def test_failed_notifications_are_sent_again(spark, tmp_path):
    rows = spark.createDataFrame([(1, i, t, h, d) for i, (t, h, d) in enumerate(UNDELIVERED)],
                                 "key long, seq long, ts string, healthy boolean, delivered boolean").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = [("2026-07-16 13:05:00", "warning", "alert"), ("2026-07-16 13:15:00", "warning", "alert"), ("2026-07-16 13:45:00", "critical", "alert"),
            ("2026-07-16 13:50:00", "critical", "alert"), ("2026-07-16 14:00:00", "healthy", "recovery"), ("2026-07-16 14:15:00", "healthy", "recovery")]
    assert seen(health.incident_events(rows)) == want
    listed = [(i, t, h, d) for i, (t, h, d) in enumerate(UNDELIVERED)]
    assert seen(drained(spark, tmp_path, [listed[:3], listed[3:6], listed[6:], [END]])) == want


def test_a_merge_reads_only_the_months_it_touches(spark, tmp_path):
    path = f"file://{tmp_path}/silver"
    tables.write_silver(fact(spark), path)
    assert tables.stored_months(spark, path) == [(2026, 1), (2026, 2), (2026, 3)]
    new = fact(spark, shift=1000).where("month(draw_date) = 2")
    assert tables.months_of(new) == [(2026, 2)]
    old = tables.read_months(spark, path, new.schema, tables.months_of(new))
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "(year" in plan and "= 2026" in plan and "month" in plan.split("PartitionFilters")[1] and len(old.inputFiles()) <= 3
    for month in (1, 3):  # other months can not be read at all, and the merge does not notice
        for name in glob.glob(f"{tmp_path}/silver/year=2026/month={month}/*.parquet"):
            with open(name, "wb") as f:
                f.write(b"no table")
            os.unlink(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
    tables.upsert_silver(spark, path, new, KEY, ["seq"], f"file://{tmp_path}/staging")
    stored = tables.read_months(spark, path, new.schema, [(2026, 2)])
    assert stored.exceptAll(new).count() == 0 and stored.count() == new.count()


def test_the_state_of_dedupe_levels_off_and_nothing_is_lost(spark, tmp_path):
    incoming, path, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/seen", f"file://{tmp_path}/checkpoint"
    schema = "lake long, draw_date date, seq long, at timestamp"
    sizes, day = [], datetime.date(2024, 1, 1)
    for batch in range(10):
        at = datetime.datetime(2024, 5, 1) + datetime.timedelta(hours=batch)
        rows = [(lake, day + datetime.timedelta(days=batch), 100 * batch + lake, at) for lake in range(20)]
        rows += [(lake, day, lake, at) for lake in range(5)] + [(50 + batch, datetime.date(2020, 2, 1 + batch), batch, at)]  # repeats, and very late ones
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(incoming)
        source = spark.readStream.schema(schema).parquet(incoming)
        seen_rows = jobs.first_seen(source, ["lake", "draw_date"], ["seq"], path, checkpoint, arrived="at", delay="2 hours")
        sizes.append(spark.read.format("statestore").load(checkpoint).count())
    assert sizes[-1] <= sizes[4] and max(sizes) < 130
    got = sorted((r.lake, r.draw_date, r.seq) for r in seen_rows.collect())
    want = [(lake, day + datetime.timedelta(days=b), 100 * b + lake) for b in range(10) for lake in range(20)]
    assert got == sorted(want + [(50 + b, datetime.date(2020, 2, 1 + b), b) for b in range(10)])


def test_late_draws_in_a_stream_equal_a_rebuild_and_leave_other_months_alone(spark, tmp_path):
    counts = grid.draw_counts(observations(spark, synthetic(200)), STATION)
    day = F.date_diff("draw_date", F.lit(START))
    incoming, root, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/lake", f"file://{tmp_path}/checkpoint"
    arrivals = [counts.where((day < 150) & ~day.isin(40, 41, 90)), counts.where(day >= 150), counts.where(day == 90), counts.where(day.isin(40, 41))]
    whole = grid.loto_daily(counts, STATION, "r1")
    files = {}
    for i, arrival in enumerate(arrivals):
        arrival.coalesce(1).write.mode("append").parquet(incoming)
        late.follow(spark.readStream.schema(counts.schema).parquet(incoming), root, STATION, "r1", checkpoint)
        files[i] = {m: set(glob.glob(f"{tmp_path}/lake/fact/year=2026/month={m}/*.parquet")) for m in range(1, 8)}
    stored = tables.read_silver(spark, f"{root}/fact").select(whole.columns)
    assert stored.exceptAll(whole).count() == 0 and whole.exceptAll(stored).count() == 0
    assert files[2][1] == files[0][1] and files[2][3] == files[0][3] and files[2][4] != files[0][4]  # day 90 is in April


def test_effects_of_a_late_draw_end(spark, tmp_path):
    counts = grid.draw_counts(observations(spark, synthetic(330)), STATION)
    day = F.date_diff("draw_date", F.lit(START))
    # every number comes up on some day after the late one
    every = counts.select("station_code", "draw_date", "station_name").distinct().where(day.isin(70, 71)).withColumn(
        "number_2d", F.explode(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.lpad(i.cast("string"), 2, "0")))).withColumn("frequency", F.lit(1).cast("long"))
    counts = counts.where(~day.isin(70, 71)).unionByName(every.select(counts.columns))
    root = f"file://{tmp_path}/lake"
    late.take_draws(spark, root, counts.where(day != 35), STATION, "r1", f"file://{tmp_path}/staging")
    written = late.take_draws(spark, root, counts.where(day == 35), STATION, "r1", f"file://{tmp_path}/staging")
    assert written == [(2026, m) for m in range(2, 6)] or written == [(2026, m) for m in range(2, 7)]
    whole = grid.loto_daily(counts, STATION, "r1")
    stored = tables.read_silver(spark, f"{root}/fact").select(whole.columns)
    assert stored.exceptAll(whole).count() == 0 and whole.exceptAll(stored).count() == 0


def test_late_draws_in_the_layout_by_draw_equal_a_rebuild(spark):
    counts = grid.draw_counts(observations(spark, synthetic(130)), STATION)
    is_late = F.date_diff("draw_date", F.lit(START)).isin(100, 117)
    stored = grid.loto_daily(counts.where(~is_late), STATION, "r1", by_draw=True)
    first = START + datetime.timedelta(days=100)
    merged = jobs.late_recompute(stored, counts.where(F.col("draw_date") >= F.lit(first)), counts.where(is_late), STATION, "r1")
    whole, rows = grid.loto_daily(counts, STATION, "r1"), grid.spread_dense(merged, STATION)
    assert merged.count() * 100 == rows.count() == whole.count()
    assert rows.exceptAll(whole).count() == 0 and whole.exceptAll(rows).count() == 0
    for df in (whole, rows):  # a number's history is no window over dense rows
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Window" in line and "number_2d" in line]


def test_a_batch_of_draws_writes_its_dense_rows_once(spark, tmp_path):
    counts = grid.draw_counts(observations(spark, synthetic(70)), STATION)
    root = f"file://{tmp_path}/lake"
    day = F.date_diff("draw_date", F.lit(START))
    for batch in (counts.where(day != 40), counts.where(day == 40)):
        late.take_draws(spark, root, batch, STATION, "r1", f"file://{tmp_path}/staging")
    assert os.listdir(tmp_path / "staging") == ["counts"]
    carried = tables.read_silver(spark, f"{root}/carried")
    stations, months = counts.select("station_code").distinct().count(), len(tables.months_of(counts))
    assert carried.count() == stations * months  # not one for each number
    whole, stored = grid.loto_daily(counts, STATION, "r1"), tables.read_silver(spark, f"{root}/fact")
    assert stored.select(whole.columns).exceptAll(whole).count() == 0 and stored.count() == whole.count()
