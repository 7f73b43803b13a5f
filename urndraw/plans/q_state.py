"""Incremental state, publication, serving records, health and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import CUSTOMERS_PER_STATION, RUN_ID, STATION, control_events, draw_fact, health_ticks, observations, sessions, table
from urndraw.functions import dates, text
from urndraw.functions.once import with_once
from urndraw.functions.text import zero_pad
from urndraw.operators import descriptive, facts, grid, health, lakes, marts, serving, state
from urndraw.plans.q_facts import FACT_COLUMNS, counts_of, lake_states, month_summary
from urndraw.plans.q_parse import daily_pages, station_markup, value
from urndraw.plans.registry import cte, query
from urndraw.sources import tables
from urndraw.spec import DRAW_CUTOFFS, RECENT_DRAWS
from urndraw.streaming import jobs, late
from urndraw.workdir import fresh_dir, keeping

KEY = ["draw_date", "station_code", "prize_group", "prize_order"]

# ---- control state


@query("latest_state", "SELECT lake, draw_date, status, run_id, seq, detail FROM states")
def _(spark, sf):
    return lake_states(spark, sf)[1].drop("updated_at")


@query("record_no_draw", """
SELECT d.lake, d.draw_date, CASE WHEN dayofyear(d.draw_date) % 5 = 0 AND d.status IN ('missing', 'failed') THEN 'no_draw' ELSE s.status END AS status
FROM statusmap d LEFT JOIN states s ON s.lake = d.lake AND s.draw_date = d.draw_date
WHERE s.status IS NOT NULL OR dayofyear(d.draw_date) % 5 = 0""")
def _(spark, sf):
    events, states = lake_states(spark, sf)
    statuses = state.status_map(state.lake_calendar(events), states)
    decided = state.unresolved_dates(statuses).where(F.dayofyear("draw_date") % 5 == 0).select(
        "lake", "draw_date", F.lit("no_draw").alias("status"), F.lit("manual").alias("run_id"),
        F.lit("2100-01-01").cast("timestamp_ntz").alias("updated_at"), F.lit(0).cast("long").alias("seq"), F.lit("holiday").alias("detail"))
    return state.record_no_draw(events, decided).select("lake", "draw_date", "status")


cte("manifests", """
SELECT user_id AS lake, 'run-' || CAST(event_id AS VARCHAR) AS run_id, CAST(ts AS DATE) AS target_date,
  CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'no_draw' WHEN 'error' THEN 'failed' ELSE 'missing' END AS status, event_id % 4 AS span, ts, event_id
FROM events""")


@query("manifest_to_state", """
SELECT lake, CAST(CASE WHEN status = 'success' AND span > 0 THEN unnest(generate_series(target_date - CAST(span - 1 AS INTEGER), target_date, INTERVAL 1 DAY)) ELSE target_date END AS DATE) AS draw_date,
  status, run_id, event_id AS seq FROM manifests WHERE status = 'success' AND span > 0
UNION ALL SELECT lake, target_date, status, run_id, event_id FROM manifests WHERE NOT (status = 'success' AND span > 0)""")
def _(spark, sf):
    span = (F.col("seq") % 4).cast("int")
    manifests = control_events(spark, sf).select(
        "lake", "run_id", F.col("draw_date").alias("target_date"), "status",
        F.when(span > 0, F.sequence(F.date_sub("draw_date", span - 1), F.col("draw_date"))).otherwise(F.array().cast("array<date>")).alias("covered_dates"),
        F.col("updated_at").alias("completed_at"), F.lit(None).cast("string").alias("error_message"), "seq")
    return state.manifest_to_state(manifests).select("lake", "draw_date", "status", "run_id", "seq")


# ---- stored facts

UPSERT = f"""
SELECT {FACT_COLUMNS.replace('full_number,', "CASE WHEN l_orderkey % 5 = 0 AND year(draw_date) = 1997 THEN full_number + 1 ELSE full_number END AS full_number,")} FROM fact"""


def versions(spark, sf):
    """The fact as first stored, and a later batch that corrects part of 1997."""
    rows = draw_fact(spark, sf, STATION, keep=("l_orderkey",)).withColumn("seq", F.lit(1).cast("long"))
    fixed = rows.where((F.col("l_orderkey") % 5 == 0) & (F.year("draw_date") == 1997)).withColumns(
        {"full_number": F.col("full_number") + 1, "seq": F.lit(2).cast("long")})
    return rows.drop("l_orderkey"), fixed.drop("l_orderkey")


@query("upsert_silver", f"SELECT CAST(year(draw_date) AS BIGINT) AS year, CAST(month(draw_date) AS BIGINT) AS month, count(*) AS row_count, CAST(sum(full_number) AS BIGINT) AS total, count(DISTINCT station_code) AS stations FROM ({UPSERT}) GROUP BY 1, 2")
def _(spark, sf):
    path = fresh_dir(spark, "silver")
    first, later = versions(spark, sf)
    tables.write_silver(first, path)
    tables.upsert_silver(spark, path, later, KEY, ["seq"], fresh_dir(spark, "staging"))
    return month_summary(tables.read_silver(spark, path))


@query("upsert_rows", UPSERT)
def _(spark, sf):
    first, later = versions(spark, sf)
    return tables.upsert(first, later, KEY, ["seq"]).drop("seq")


@query("replace_silver", f"SELECT CAST(year(draw_date) AS BIGINT) AS year, count(*) AS row_count, CAST(sum(full_number) AS BIGINT) AS total FROM ({UPSERT}) GROUP BY 1")
def _(spark, sf):
    path = fresh_dir(spark, "silver")
    first, later = versions(spark, sf)
    tables.write_silver(first, path)
    both = tables.upsert(first.where("year(draw_date) = 1997"), later, KEY, ["seq"])
    tables.write_silver(both, path)
    return tables.read_silver(spark, path).groupBy(F.year("draw_date").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("full_number").alias("total"))


@query("bronze_conflict", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' WHEN o_orderkey % 7 = 0 THEN 'conflict' ELSE 'reuse' END AS decision FROM orders""")
def _(spark, sf):
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(key, "o_custkey", "o_totalprice")
    sent = orders.withColumn("o_custkey", F.when(key % 7 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return state.bronze_conflict(orders.where(key % 3 != 0), sent, ["o_orderkey"], ["o_custkey", "o_totalprice"])


@query("source_correction", """
SELECT draw_date, station_code, prize_group, prize_order, full_number AS stored_value, CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE full_number + 1 END AS new_value,
  CASE WHEN l_orderkey % 11 = 0 THEN 'absent' ELSE 'changed' END AS change FROM fact WHERE l_orderkey % 11 = 0 OR l_orderkey % 13 = 0""")
def _(spark, sf):
    key = F.col("l_orderkey")
    stored = draw_fact(spark, sf, STATION, keep=("l_orderkey",))
    sent = stored.where(key % 11 != 0).withColumn(
        "full_number", F.when(key % 13 == 0, F.col("full_number") + 1).otherwise(F.col("full_number")))
    return state.source_correction(stored, sent, KEY, "full_number")


cte("gold1", """
SELECT 'fact-draw-result' AS table_name, count(*) AS row_count, CAST(sum(full_number) AS BIGINT) AS total FROM fact
UNION ALL SELECT 'fact-loto-daily', count(*), CAST(sum(rolling_90_frequency) AS BIGINT) FROM loto
UNION ALL SELECT 'fact-special-prize', count(*), CAST(sum(digit_sum) AS BIGINT) FROM special
UNION ALL SELECT 'dim-date', count(*), CAST(sum(iso_week) AS BIGINT) FROM dimdate
UNION ALL SELECT 'dim-number', count(*), CAST(sum(digit_sum) AS BIGINT) FROM dimnumber
UNION ALL SELECT 'dim-station', count(*), CAST(sum(length(station_name)) AS BIGINT) FROM dimstation""")


@query("build_gold", "SELECT * FROM gold1")
def _(spark, sf):
    path = fresh_dir(spark, "silver")
    tables.write_silver(draw_fact(spark, sf), path)
    gold = marts.build_gold(tables.read_silver(spark, path), STATION, RUN_ID)
    measure = {
        "fact-draw-result": "full_number", "fact-loto-daily": "rolling_90_frequency", "fact-special-prize": "digit_sum",
        "dim-date": "iso_week", "dim-number": "digit_sum", "dim-station": "length(station_name)"}
    out = None
    for name, df in gold.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.expr(measure[name])).cast("long").alias("total")).select(
            F.lit(name).alias("table_name"), "row_count", "total")
        out = row if out is None else out.unionByName(row)
    return out


# Lakes are groups of customers; every order's page is read, and a lake may have several pages for a date.
cte("pagelakes", """
SELECT page_id, selected_date, v, m, status, reason, 'S' || CAST(o_custkey // 300 AS VARCHAR) AS lake, (page_id // 70) % 5 AS damage
FROM pg JOIN outcome USING (page_id) JOIN orders ON o_orderkey = page_id""")
cte("pagedays", """
SELECT lake, selected_date AS draw_date, count(*) AS pages,
  arg_min(row(status, reason), row(CASE status WHEN 'success' THEN 0 WHEN 'no_draw' THEN 1 ELSE 2 END, page_id)) AS o
FROM pagelakes WHERE dayofyear(selected_date) % 4 <> 0 GROUP BY ALL""")
cte("pagestored", "SELECT lake, count(*) * 27 AS stored FROM pagedays WHERE o[1] = 'success' GROUP BY 1")


def in_lakes(spark, sf, pages):
    lake = F.concat(F.lit("S"), F.expr(f"o_custkey div {CUSTOMERS_PER_STATION}").cast("string"))
    return pages.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), lake.alias("lake")), "page_id")


def with_decisions(spark, root, done):
    """The outcome per lake and date with the release that the lake's pointer names and its stored rows, read back."""
    released = lakes.read_published(spark, root, "fact-draw-result").groupBy("lake").agg(F.count(F.lit(1)).alias("released_rows"))
    pointers = lakes.latest_pointers(spark, root).select("lake", F.col("run_id").alias("published_run"))
    return done.join(pointers, "lake", "left").join(released, "lake", "left").withColumn(
        "released_rows", F.coalesce("released_rows", F.lit(0).cast("long")))


@query("backfill", """
SELECT d.lake, draw_date, pages, o[1] AS status, o[2] AS reason, false AS repaired, CAST(CASE WHEN o[1] = 'success' THEN 27 ELSE 0 END AS BIGINT) AS prize_rows,
  CASE WHEN stored IS NULL THEN 'nothing_stored' WHEN old THEN 'older_than_published' ELSE 'publish' END AS decision,
  CASE WHEN old THEN 'run-0003' WHEN stored IS NOT NULL THEN 'run-0005' END AS published_run, CASE WHEN old THEN 0 ELSE coalesce(stored, 0) END AS released_rows
FROM (SELECT *, CAST(substr(lake, 2) AS BIGINT) % 5 = 4 AS old FROM pagedays) d LEFT JOIN pagestored s ON s.lake = d.lake""")
def _(spark, sf):
    """A quarter of the dates are closed by an earlier run, a quarter failed in it, and some lakes have a newer release."""
    root = fresh_dir(spark, "lakes")
    pages = in_lakes(spark, sf, daily_pages(spark, sf)).withColumn("url", F.lit("https://site.example/day.html"))
    kind = F.dayofyear("draw_date") % 4
    days = in_lakes(spark, sf, table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.to_date("o_orderdate").alias("draw_date"))).select("lake", "draw_date").distinct()
    days.where(kind < 2).select(
        "lake", "draw_date", F.when(kind == 0, "success").otherwise("failed").alias("status"), F.lit("run-0004").alias("run_id"),
        F.lit("2002-01-01").cast("timestamp_ntz").alias("updated_at"), F.lit(0).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("detail")).write.json(f"{root}/state/run=run-0004")
    old = days.where(F.substring("lake", 2, 9).cast("long") % 5 == 4).select("lake").distinct()
    old.select("lake", F.lit("run-0003").alias("run_id"), F.lit("2030-01-01").cast("date").alias("target_date"),
               F.lit("2001-12-01").cast("timestamp_ntz").alias("published_at")).write.json(f"{root}/manifests/lakes")
    return with_decisions(spark, root, lakes.backfill_daily(spark, root, pages, "run-0005", "2002-02-01T00:00:00", "2002-02-01"))


cte("pagefirst", """
SELECT lake, selected_date AS draw_date, count(*) AS pages,
  arg_min(row(page_id, v, damage), row(CASE WHEN v <= 4 THEN 0 WHEN v = 8 THEN 1 ELSE 2 END, page_id)) AS o FROM pagelakes GROUP BY ALL""")
cte("pagesecond", "SELECT lake, selected_date AS draw_date, min(page_id) AS page_id FROM pagelakes WHERE (v <= 4 OR v = 8) AND day(selected_date) % 10 <> 0 GROUP BY ALL")
cte("pagerepair", """
SELECT f.lake, f.draw_date, pages, CASE WHEN o[2] = 8 THEN 'no_draw_notice' WHEN o[2] > 4 THEN CASE o[2] WHEN 5 THEN 'station_columns' WHEN 6 THEN 'station_code_unknown' WHEN 7 THEN 'table_missing' ELSE 'date_mismatch' END
  WHEN o[3] = 0 THEN NULL WHEN o[3] = 3 THEN 'not_recoverable' WHEN s.page_id IS NULL THEN 'second_source_missing'
  WHEN s.page_id <> o[1] OR o[3] = 4 THEN 'values_differ' END AS reason, o[2] <= 4 AND o[3] > 0 AS damaged, o[1] AS first_page
FROM pagefirst f LEFT JOIN pagesecond s ON s.lake = f.lake AND s.draw_date = f.draw_date""")


def damaged_sources(spark, sf):
    """Pages of both sources: a fifth each with a cut special prize, a placeholder, a short value, and sources that differ.

    The second source lacks every tenth day of a month.
    """
    damage, key = F.expr("(page_id div 70) % 5"), F.col("page_id")
    at = {name: (gi, w) for gi, (name, _, w) in enumerate(STATION.groups)}

    def shown(name, station):
        gi, width = at[name]
        return value(key, gi, 1, width, station)

    special = shown("special", 0)
    cut, blot, short = damage.isin(1, 4), damage == 2, damage == 3
    old = F.when(cut, special).when(blot, shown("prize4", 1)).when(short, shown("prize5", 0)).otherwise("none")
    new = F.when(cut, F.right(special, F.lit(5))).when(blot, ".....").when(short, F.substring(shown("prize5", 0), 2, 9)).otherwise("none")
    wrong = F.when(damage == 4, zero_pad((special.cast("long") + 1) % 1000000, 6)).otherwise(special)

    def put(html, before, was, now, after):
        return F.replace(html, F.concat(F.lit(before), was, F.lit(after)), F.concat(F.lit(before), now, F.lit(after)))

    # the value stands after the tag, or after the blank that some pages have there
    first = with_once(station_markup(spark, sf, False), {"old": old, "new": new}).withColumn(
        "html", put(put("html", ">", F.col("old"), F.col("new"), "</span>"), ";", F.col("old"), F.col("new"), "</span>")).drop("old", "new")
    second = with_once(station_markup(spark, sf, True).where("day(selected_date) % 10 <> 0"), {"old": special, "new": wrong}).withColumn(
        "html", put("html", "<td>", F.col("old"), F.col("new"), "</td>")).drop("old", "new")
    # both sources are stored, as fetched pages would be
    path = fresh_dir(spark, "pages")
    for name, pages in (("first", first), ("second", second)):
        in_lakes(spark, sf, pages).write.parquet(f"{path}/{name}")
    return spark.read.parquet(f"{path}/first"), spark.read.parquet(f"{path}/second")


@query("backfill_stations", """
SELECT r.lake, draw_date, pages, CASE WHEN reason IS NULL THEN 'success' WHEN reason = 'no_draw_notice' THEN 'no_draw' ELSE 'failed' END AS status, reason,
  reason IS NULL AND damaged AS repaired, CAST(CASE WHEN reason IS NULL THEN 54 ELSE 0 END AS BIGINT) AS prize_rows,
  CASE WHEN n > 0 THEN 'publish' ELSE 'nothing_stored' END AS decision, CASE WHEN n > 0 THEN 'run-0005' END AS published_run, n * 54 AS released_rows,
  CASE WHEN reason IS NULL THEN array_to_string(list_transform([0, 1, 2], lambda i: lpad(CAST(((first_page + 1) * 7919 + i * 15485863 + 8 * 104729 + 1299709) % 1000000 AS VARCHAR), 6, '0')), ',') END AS specials
FROM pagerepair r JOIN (SELECT lake, count(*) FILTER (reason IS NULL) AS n FROM pagerepair GROUP BY 1) t ON t.lake = r.lake""")
def _(spark, sf):
    """Published special prizes are whole again, whether the page had them or the second source."""
    root = fresh_dir(spark, "lakes")
    done = lakes.backfill_stations(spark, root, *damaged_sources(spark, sf), "run-0005", "2002-02-01T00:00:00", "2002-02-01")
    specials = lakes.read_published(spark, root, "fact-draw-result").where("prize_group = 'special'").groupBy("lake", "draw_date").agg(
        F.array_sort(F.collect_list(F.struct("station_order", "formatted_number"))).alias("s"))
    listed = specials.select("lake", "draw_date", F.array_join(F.transform("s", lambda p: p["formatted_number"]), ",").alias("specials"))
    return with_decisions(spark, root, done).join(listed, ["lake", "draw_date"], "left")


@query("publish_gate", """
SELECT lake, run_id, target_date, CASE WHEN event_id % 5 = 0 THEN 'quality_failed' WHEN cur IS NULL THEN 'publish' WHEN target_date > cur THEN 'publish'
  WHEN target_date < cur THEN 'older_than_published' ELSE 'identity_conflict' END AS decision
FROM manifests m LEFT JOIN (SELECT user_id AS l, DATE '2024-01-15' AS cur FROM events WHERE user_id % 2 = 0 GROUP BY 1) ON l = m.lake WHERE status = 'success'""")
def _(spark, sf):
    runs = control_events(spark, sf).where("status = 'success'").select(
        "lake", "run_id", F.col("draw_date").alias("target_date"), F.lit("2024-02-01").alias("published_at"), "seq")
    checks = runs.select("run_id", F.explode(F.array(
        F.struct(F.lit("critical").alias("severity"), (F.col("seq") % 5 != 0).alias("passed")),
        F.struct(F.lit("warning").alias("severity"), F.lit(False).alias("passed")))).alias("c")).select("run_id", "c.*")
    current = table(spark, sf, "events").where("user_id % 2 = 0").select(F.col("user_id").alias("lake")).distinct().select(
        "lake", F.lit("run-x").alias("run_id"), F.lit("2024-01-15").cast("date").alias("target_date"), F.lit("2024-02-01").alias("published_at"))
    return state.publish_gate(runs, checks, current)


@query("manifest_match", """
SELECT 'part-' || CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_orderkey % 13 = 0 THEN 'unexpected' ELSE 'changed' END AS difference
FROM orders WHERE (o_orderkey % 11 = 0 AND o_orderkey % 13 <> 0) OR (o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0) OR (o_orderkey % 17 = 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)""")
def _(spark, sf):
    k = F.col("o_orderkey")
    objects = table(spark, sf, "orders").select(
        k, F.concat(F.lit("part-"), k.cast("string")).alias("key"), F.col("o_custkey").alias("size"),
        F.sha2(k.cast("string"), 256).alias("sha256"), F.lit("application/vnd.apache.parquet").alias("content_type"),
        F.lit(None).cast("string").alias("cache_control"))
    latest = objects.where(k % 11 != 0).withColumn("size", F.col("size") + F.when(k % 17 == 0, 1).otherwise(0))
    return state.manifest_match(objects.where(k % 13 != 0), latest)


# ---- serving

cte("recs", """
SELECT station_code, draw_date, (prize_order - 1) // 1000 AS part, max(station_name) AS station_name, count(*) AS result_count, count(*) FILTER (prize_group = 'special') AS specials,
  max(CASE WHEN prize_group = 'special' THEN formatted_number END) AS special_prize,
  string_agg(loto_2d, ',' ORDER BY prize_group <> 'special', CASE prize_group WHEN 'special' THEN 0 ELSE -CAST(right(prize_group, 1) AS BIGINT) END, prize_order) AS numbers,
  string_agg(prize_group || ':' || formatted_number, ',' ORDER BY prize_group, prize_order) AS prizes, count(DISTINCT prize_group) AS group_count
FROM fact GROUP BY 1, 2, 3""")
cte("recok", """
SELECT *, CASE WHEN part > 0 THEN 'continued' WHEN specials = 0 THEN 'no_special' WHEN specials > 1 THEN 'many_specials' ELSE 'ok' END AS status FROM recs""")


def records(spark, sf):
    normal = facts.normalize_fact(draw_fact(spark, sf), STATION, "", "")
    return serving.draw_records(normal, STATION)


@query("draw_records", """
SELECT station_code, draw_date, part, station_name, result_count, status, CASE WHEN status = 'ok' THEN special_prize END AS special_prize,
  CASE WHEN status = 'ok' THEN right(special_prize, 2) END AS special_tail, numbers, prizes FROM recok""")
def _(spark, sf):
    groups = F.array_sort(F.map_keys("prizes"))
    listed = F.flatten(F.transform(groups, lambda g: F.transform(F.try_element_at("prizes", g), lambda v: F.concat(g, F.lit(":"), v))))
    return records(spark, sf).select(
        "station_code", "draw_date", "part", "station_name", "result_count", "status", "special_prize", "special_tail",
        F.array_join("numbers", ",").alias("numbers"), F.array_join(listed, ",").alias("prizes"))


@query("draw_records_json", """
SELECT station_code, count(*) AS records, CAST(sum(result_count) AS BIGINT) AS numbers FROM recok GROUP BY 1""")
def _(spark, sf):
    """Records through their JSON form and back."""
    rows = records(spark, sf)
    shape = rows.select("station_code", "numbers", "prizes").schema.simpleString()
    text_rows = rows.select(F.to_json(F.struct("station_code", "numbers", "prizes")).alias("payload"))
    back = text_rows.select(F.from_json("payload", shape).alias("r")).select("r.*")
    return back.groupBy("station_code").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.coalesce(F.size(F.flatten(F.map_values("prizes"))), F.lit(0))).cast("long").alias("numbers"))


@query("draw_contract", """
SELECT station_code, draw_date, concat_ws(',', CASE WHEN status <> 'ok' THEN status END, CASE WHEN result_count <> 18 THEN 'result_count' END,
  CASE WHEN specials <> 1 THEN 'special_prize' END) AS problems FROM recok WHERE part = 0""")
def _(spark, sf):
    return serving.draw_contract(records(spark, sf), 18)


cte("paydraws", """
SELECT station_code, draw_date, sum(result_count) AS n, arg_min(special_prize, part) FILTER (part = 0 AND status = 'ok') AS special, arg_min(numbers, part) AS numbers,
  row_number() OVER (PARTITION BY station_code ORDER BY draw_date DESC) AS b FROM recok GROUP BY 1, 2""")
cte("paystations", f"""
SELECT station_code, min(draw_date) AS range_from, max(draw_date) AS range_to, count(*) AS draw_count, sum(n) AS result_count, sum(n) FILTER (b <= {RECENT_DRAWS}) AS recent_results,
  string_agg(CAST(draw_date AS VARCHAR) || ':' || coalesce(special, ''), ',' ORDER BY draw_date DESC) FILTER (b <= {RECENT_DRAWS}) AS recent_draws, max(numbers) FILTER (b = 1) AS latest_numbers
FROM paydraws GROUP BY 1""")
cte("paytotals", """
SELECT s.station_code, n.number_2d, coalesce(t.total_frequency, 0) AS f FROM (SELECT DISTINCT station_code FROM obs) s CROSS JOIN numbers n LEFT JOIN totals t USING (station_code, number_2d)""")
cte("payrows", """
SELECT p.*, (SELECT string_agg(number_2d || '=' || f, ',' ORDER BY number_2d) FROM paytotals t WHERE t.station_code = p.station_code) AS frequency FROM paystations p
UNION ALL SELECT '*', min(range_from), max(range_to), sum(draw_count), sum(result_count), sum(recent_results), NULL, NULL,
  (SELECT string_agg(number_2d || '=' || f, ',' ORDER BY number_2d) FROM (SELECT number_2d, sum(f) AS f FROM paytotals GROUP BY 1)) FROM paystations""")


@query("compact_payload", """
SELECT station_code, range_from, range_to, CAST(draw_count AS BIGINT) AS draw_count, CAST(result_count AS BIGINT) AS result_count, CAST(recent_results AS BIGINT) AS recent_results,
  recent_draws, latest_numbers, frequency, 'run-0001' AS run_id, DATE '2001-08-01' AS target_date, range_to = DATE '2001-08-01' AS matches_target FROM payrows""")
def _(spark, sf):
    totals = descriptive.dense_totals(observations(spark, sf), STATION)
    payload = serving.compact_payload(records(spark, sf), totals, RECENT_DRAWS, "2001-08-01", RUN_ID)
    day = F.transform("recent_draws", lambda r: F.concat(r["draw_date"].cast("string"), F.lit(":"), F.coalesce(r["special_prize"], F.lit(""))))
    pairs = F.transform(F.array_sort(F.map_entries("frequency")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return payload.withColumns({
        "recent_draws": F.array_join(day, ","), "latest_numbers": F.array_join("latest_numbers", ","), "frequency": F.array_join(pairs, ",")})


@query("recent_records", f"""
SELECT station_code, draw_date, part, back, numbers FROM (
  SELECT *, dense_rank() OVER (PARTITION BY station_code ORDER BY draw_date DESC) AS back FROM recok) WHERE back <= {RECENT_DRAWS}""")
def _(spark, sf):
    rows = serving.recent_records(records(spark, sf), RECENT_DRAWS)
    return rows.select("station_code", "draw_date", "part", "back", F.array_join("numbers", ",").alias("numbers"))


@query("year_shards", """
SELECT r.station_code, s.station_name, CAST(year(draw_date) AS BIGINT) AS year, draw_date, result_count, status FROM recok r JOIN dimstation s USING (station_code)""")
def _(spark, sf):
    fact = draw_fact(spark, sf)
    normal = facts.normalize_fact(fact, STATION, "", "")
    shards = serving.year_shards(serving.draw_records(normal, STATION), marts.dim_station(fact))
    return shards.select("station_code", "station_name", "year", "draw_date", "result_count", "status")


@query("sink_shards", """
SELECT station_code, CAST(year(draw_date) AS BIGINT) AS year, count(DISTINCT draw_date) AS draw_count, CAST(sum(result_count) AS BIGINT) AS result_count FROM recok GROUP BY 1, 2""")
def _(spark, sf):
    path = fresh_dir(spark, "shards")
    tables.write_shards(records(spark, sf), path)
    return tables.read_shards(spark, path).groupBy("station_code", F.col("year").cast("long").alias("year")).agg(
        F.countDistinct("draw_date").alias("draw_count"), F.sum("result_count").alias("result_count"))


@query("shard_contract", """
SELECT station_code, CAST(y AS BIGINT) AS year, CASE WHEN y = 1999 THEN 'undeclared' ELSE concat_ws(',', CASE WHEN y = 1997 THEN 'dates_not_rising' END, CASE WHEN y % 5 = 1 THEN 'range' END,
  CASE WHEN y % 3 = 1 THEN 'draw_count' END, CASE WHEN y < 1998 THEN 'name' END) END AS problems FROM (SELECT DISTINCT station_code, year(draw_date) AS y FROM obs)
UNION ALL SELECT DISTINCT station_code, 1990, 'absent' FROM obs""")
def _(spark, sf):
    """Declared shards of which one has the wrong range, one the wrong count, one no records, and one that nobody declared."""
    drawn = serving.draw_sizes(counts_of(spark, sf))
    names = sessions(spark, sf).select("station_code", "draw_date", "station_name").distinct()
    year = F.col("year")
    days = F.unix_date("draw_date")
    shards = drawn.join(names, ["station_code", "draw_date"]).withColumn("year", F.year("draw_date").cast("long")).withColumn(
        "position", F.when(year == 1997, -days).otherwise(days))
    declared = serving.shard_counts(drawn).where(year != 1999).select(
        "station_code", "year", (F.col("draw_count") + F.when(year % 3 == 1, 1).otherwise(0)).alias("draw_count"), "result_count",
        F.when(year % 5 == 1, F.date_sub("range_from", 1)).otherwise(F.col("range_from")).alias("range_from"), "range_to",
        F.concat(F.lit("Station "), F.substring("station_code", 2, 9)).alias("station_name"))
    ghost = declared.groupBy("station_code", "station_name").agg(F.min("range_from").alias("range_from")).select(
        "station_code", F.lit(1990).cast("long").alias("year"), F.lit(1).cast("long").alias("draw_count"), F.lit(18).cast("long").alias("result_count"),
        "range_from", F.col("range_from").alias("range_to"), "station_name")
    return serving.shard_contract(shards, declared.unionByName(ghost))


@query("release_contract", """
SELECT station_code, concat_ws(',', CASE WHEN CAST(substr(station_code, 2) AS BIGINT) % 4 = 3 THEN 'duplicate_code' END, CASE WHEN CAST(substr(station_code, 2) AS BIGINT) % 3 = 1 THEN 'years_range' END,
  CASE WHEN r <> d * 18 THEN 'result_count' END, CASE WHEN a < DATE '1995-01-05' OR b > DATE '2001-07-25' THEN 'outside_release' END) AS problems
FROM (SELECT station_code, count(DISTINCT draw_date) AS d, count(*) AS r, min(draw_date) AS a, max(draw_date) AS b, CASE WHEN CAST(substr(station_code, 2) AS BIGINT) % 4 = 3 THEN 2 ELSE 1 END AS k FROM obs GROUP BY 1), range(2) c
WHERE c.range < k
UNION ALL SELECT '*', 'total_draws,total_results,release_range'""")
def _(spark, sf):
    fact = draw_fact(spark, sf)
    number = F.substring("station_code", 2, 9).cast("long")
    meta = descriptive.station_metadata(fact, marts.dim_station(fact)).withColumn(
        "years", F.when(number % 3 == 1, F.slice("years", 2, 100)).otherwise(F.col("years")))
    return serving.release_contract(meta.unionByName(meta.where(number % 4 == 3)), 1, 1, 18, "1995-01-05", "2001-07-25")


@query("explorer_page", """
SELECT station_code, draw_date, row_number() OVER (ORDER BY draw_date DESC, part) AS position, true AS has_more, result_count, numbers, special_prize FROM (
  SELECT station_code, draw_date, part, result_count, numbers, CASE WHEN status = 'ok' THEN special_prize END AS special_prize FROM recok
  WHERE station_code = 'S1' AND draw_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND draw_date < DATE '2000-06-01'
    AND list_contains(string_split(numbers, ','), '07') ORDER BY draw_date DESC, part LIMIT 25)""")
def _(spark, sf):
    path = fresh_dir(spark, "shards")
    tables.write_shards(records(spark, sf), path)
    page = serving.explorer_page(tables.read_shards(spark, path), "S1", "1996-01-01", "2000-12-31", "07", "2000-06-01", 25)
    return page.select("station_code", "draw_date", "position", "has_more", "result_count", F.array_join("numbers", ",").alias("numbers"), "special_prize")


@query("explorer_merge", """
SELECT station_code, draw_date, CASE WHEN dayofyear(draw_date) % 3 = 0 THEN 2 ELSE 1 END AS page FROM draws""")
def _(spark, sf):
    drawn = serving.draw_sizes(counts_of(spark, sf)).withColumn("page", F.lit(1).cast("long"))
    again = drawn.where(F.dayofyear("draw_date") % 3 == 0).withColumn("page", F.lit(2).cast("long"))
    return serving.explorer_merge(drawn.unionByName(again)).select("station_code", "draw_date", "page")


# ---- health and streams

cte("report", """
SELECT station_code, no, m AS target_date, m - CAST(CASE WHEN no % 4 = 1 THEN 1 ELSE 0 END AS INTEGER) AS freshness_target,
  m - CAST(CASE WHEN no % 3 = 1 THEN 1 ELSE 0 END AS INTEGER) AS latest_draw, m AS latest_payload, m - CAST(CASE WHEN no % 5 = 2 THEN 1 ELSE 0 END AS INTEGER) AS range_to
FROM (SELECT station_code, station_no AS no, max(draw_date) AS m FROM sess GROUP BY 1, 2)""")


@query("health_flags", """
SELECT station_code, concat_ws(',', CASE WHEN target_date < DATE '2001-08-01' OR target_date > DATE '2001-08-02' THEN 'target_date_mismatch' END,
  CASE WHEN freshness_target <> target_date THEN 'manifest_freshness_mismatch' END, CASE WHEN latest_draw <> target_date THEN 'latest_draw_date_mismatch' END,
  CASE WHEN range_to <> target_date THEN 'range_end_mismatch' END, CASE WHEN no % 2 = 1 THEN 'freshness_flag_false' END) AS issues FROM report""")
def _(spark, sf):
    no, m = F.col("station_no"), F.col("m")
    reports = sessions(spark, sf).groupBy("station_code", "station_no").agg(F.max("draw_date").alias("m")).select(
        "station_code", m.alias("target_date"), F.date_sub(m, F.when(no % 4 == 1, 1).otherwise(0)).alias("freshness_target"),
        F.date_sub(m, F.when(no % 3 == 1, 1).otherwise(0)).alias("latest_draw"), m.alias("latest_payload"),
        F.date_sub(m, F.when(no % 5 == 2, 1).otherwise(0)).alias("range_to"), (no % 2 == 0).alias("matches_target"))
    flags = health.health_flags(reports, F.lit("2001-08-01").cast("date"), F.lit("2001-08-02").cast("date"))
    return flags.select("station_code", F.array_join("issues", ",").alias("issues"))


@query("release_boundary_check", """
SELECT station_code, concat_ws(',', CASE WHEN no % 3 = 1 THEN 'range_to' END, CASE WHEN no % 2 = 1 THEN 'draw_count' END) AS mismatch FROM report""")
def _(spark, sf):
    no = F.substring("station_code", 2, 9).cast("long")
    drawn = serving.draw_sizes(counts_of(spark, sf))
    summary = drawn.groupBy("station_code").agg(
        F.min("draw_date").alias("range_from"), F.max("draw_date").alias("range_to"), F.count(F.lit(1)).alias("draw_count"),
        F.sum("result_count").alias("result_count")).withColumns({"run_id": F.lit(RUN_ID), "published_at": F.lit("2001-08-02")})
    other = summary.withColumns({
        "range_to": F.when(no % 3 == 1, F.date_add("range_to", 1)).otherwise(F.col("range_to")),
        "draw_count": F.col("draw_count") + F.when(no % 2 == 1, 1).otherwise(0)})
    return health.release_boundary_check(summary, other, "station_code")


cte("ticks", """
SELECT user_id AS key, event_id AS seq, ts, event_type <> 'error' AS healthy, CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day,
  hour(ts + INTERVAL 7 HOUR) * 60 + minute(ts + INTERVAL 7 HOUR) AS mod, event_id % 5 <> 0 AS delivered FROM events""")
cte("sched", """
SELECT *, CASE WHEN mod >= 1200 THEN local_day ELSE local_day - 1 END AS expected_date,
  CASE WHEN mod < 1200 THEN 'pre_warning' WHEN mod < 1230 THEN 'warning' ELSE 'critical' END AS alert_window FROM ticks""")


@query("tick_schedule", "SELECT seq, expected_date, alert_window FROM sched")
def _(spark, sf):
    return health.tick_schedule(health_ticks(spark, sf)).select("seq", "expected_date", "alert_window")


@query("tick_delay", """
SELECT event_id, greatest(date_sub('second', s, ts), 0) AS delay FROM (
  SELECT event_id, ts, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 5 MINUTE ELSE date_trunc('hour', ts) END AS s FROM events)""")
def _(spark, sf):
    hour = F.to_date("ts").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour("ts"))
    late = F.col("ts") + F.make_dt_interval(mins=F.lit(5))
    rows = table(spark, sf, "events").select("event_id", "ts", F.when(F.col("event_id") % 7 == 0, late).otherwise(hour).alias("s"))
    return rows.select("event_id", health.tick_delay("s", "ts").alias("delay"))


@query("latest_completed_date", """
SELECT event_id, CASE WHEN hour(l) * 60 + minute(l) >= CASE user_id % 3 WHEN 0 THEN 995 WHEN 1 THEN 1055 ELSE 1115 END THEN CAST(l AS DATE) ELSE CAST(l AS DATE) - 1 END AS completed,
  CASE WHEN event_id % 30 + 1996 < year(ts) THEN make_date(event_id % 30 + 1996, 12, 31)
    WHEN event_id % 30 + 1996 = year(ts) AND year(CAST(ts AS DATE) - 1) = year(ts) THEN CAST(ts AS DATE) - 1 END AS batch_end,
  CASE WHEN event_id % 30 + 1996 > year(ts) THEN 'future_year' WHEN event_id % 30 + 1996 = year(ts) AND month(ts) = 1 AND day(ts) = 1 THEN 'nothing_completed' END AS batch_problem
FROM (SELECT *, ts + INTERVAL 7 HOUR AS l FROM events)""")
def _(spark, sf):
    kind = F.col("user_id") % 3
    cutoff = F.when(kind == 0, DRAW_CUTOFFS["south"]).when(kind == 1, DRAW_CUTOFFS["central"]).otherwise(DRAW_CUTOFFS["north"])
    return table(spark, sf, "events").select(
        "event_id", dates.latest_completed(F.col("ts"), cutoff).alias("completed"),
        dates.batch_year_end((F.col("event_id") % 30 + 1996).cast("int"), F.to_date("ts")).alias("batch_end"),
        dates.batch_year_problem((F.col("event_id") % 30 + 1996).cast("int"), F.to_date("ts")).alias("batch_problem"))


_INCIDENTS = """
SELECT key, expected_date, opened_at, ts, alert_window AS severity, 'alert' AS event, delivered FROM (
  SELECT *, min(ts) OVER (PARTITION BY key, island, expected_date) AS opened_at,
    coalesce(sum(CASE WHEN delivered THEN 1 ELSE 0 END) OVER g, 0) AS any_before, coalesce(sum(CASE WHEN delivered AND alert_window = 'critical' THEN 1 ELSE 0 END) OVER g, 0) AS critical_before
  FROM unhealthy WINDOW g AS (PARTITION BY key, island, expected_date ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE any_before = 0 OR (alert_window = 'critical' AND critical_before = 0)
UNION ALL SELECT h.key, i.d, (SELECT min(u.ts) FROM unhealthy u WHERE u.key = h.key AND u.island = h.island AND u.expected_date = i.d), h.ts, 'healthy', 'recovery', h.delivered
FROM islands h, LATERAL (SELECT max(u.expected_date) AS d FROM unhealthy u WHERE u.key = h.key AND u.island = h.island AND (u.ts < h.ts OR (u.ts = h.ts AND u.seq < h.seq))) i
WHERE h.healthy AND i.d IS NOT NULL"""
cte("islands", """
SELECT *, coalesce(sum(CASE WHEN healthy AND delivered THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM sched""")
cte("unhealthy", "SELECT * FROM islands WHERE NOT healthy AND alert_window <> 'pre_warning'")


@query("incident_fsm", _INCIDENTS)
def _(spark, sf):
    return health.incident_events(health_ticks(spark, sf))


@query("incident_stream", _INCIDENTS)
def _(spark, sf):
    """Ticks in files of some days each, two of them late; a last one only carries time. Drained twice, as after a restart."""
    incoming, out, checkpoint = fresh_dir(spark, "ticks"), fresh_dir(spark, "incidents"), fresh_dir(spark, "checkpoint")
    ticks = health_ticks(spark, sf)
    part = F.expr("least(7, day(ts) div 4)")
    # of every tenth tick it is only known one part later
    part = F.when(F.col("seq") % 10 == 0, part + 1).otherwise(part)
    clock = ticks.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("key"), F.lit(-1).cast("long").alias("seq"), (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        F.lit(None).cast("boolean").alias("healthy"), F.lit(True).alias("delivered"))
    events = None
    with jobs.managed_state(spark):
        for arrival in (range(5), range(5, 9)):
            for first in arrival:
                ticks.where(part == first).write.mode("append").parquet(incoming)
            if 8 in arrival:
                clock.write.mode("append").parquet(incoming)
            source = spark.readStream.schema(ticks.schema).option(
                "maxFilesPerTrigger", 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))).parquet(incoming)
            events = jobs.drain_to(jobs.incident_stream(source, "20 days"), out, checkpoint)
    return events


@query("stream_dedupe", """
SELECT lake, draw_date, event_type, arg_min(seq, row(late, seq)) AS seq FROM (
  SELECT user_id AS lake, CAST(ts AS DATE) AS draw_date, event_type, event_id AS seq, CASE WHEN day(ts) < 15 THEN 1 ELSE 0 END AS late FROM events) GROUP BY ALL""")
def _(spark, sf):
    """Two arrivals out of order, each drained: the second half of the month comes first, and repeats of it later."""
    incoming, path, checkpoint = fresh_dir(spark, "incoming"), fresh_dir(spark, "seen"), fresh_dir(spark, "checkpoint")
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("lake"), F.to_date("ts").alias("draw_date"), "event_type", F.col("event_id").alias("seq"))
    seen = None
    for arrival in (events.where(F.dayofmonth("draw_date") >= 15), events):
        arrival.write.mode("append").parquet(incoming)
        source = spark.readStream.schema(events.schema).parquet(incoming)
        seen = jobs.first_seen(source, ["lake", "draw_date", "event_type"], ["seq"], path, checkpoint)
    return seen.select("lake", "draw_date", "event_type", "seq")


@query("stream_ingest", "SELECT CAST(year(draw_date) AS BIGINT) AS year, CAST(month(draw_date) AS BIGINT) AS month, count(*) AS row_count, CAST(sum(full_number) AS BIGINT) AS total, count(DISTINCT station_code) AS stations FROM (" + UPSERT + ") GROUP BY 1, 2")
def _(spark, sf):
    """Two arrivals: the first version of the fact, then the corrections; both drained twice."""
    incoming, path, checkpoint = fresh_dir(spark, "incoming"), fresh_dir(spark, "silver"), fresh_dir(spark, "checkpoint")
    for batch in versions(spark, sf):
        batch.write.mode("append").parquet(incoming)
        for _again in range(2):
            source = spark.readStream.schema(batch.schema).parquet(incoming)
            jobs.ingest(source, path, KEY, ["seq"], checkpoint)
    return month_summary(tables.read_silver(spark, path))


@query("late_recompute", """
SELECT station_code, number_2d, CAST(sum(draws_since_previous) AS BIGINT) AS gap_sum, CAST(sum(calendar_days_since_previous) AS BIGINT) AS day_sum,
  CAST(sum(rolling_7_frequency) AS BIGINT) AS r7, CAST(sum(rolling_90_frequency) AS BIGINT) AS r90, count(*) AS draws FROM loto GROUP BY ALL""")
def _(spark, sf):
    every = keeping(spark, "counts")(counts_of(spark, sf))
    is_late = (F.dayofyear("draw_date") % 50 == 0) & (F.year("draw_date") >= 1999) & (F.substring("station_code", 2, 9).cast("long") % 2 == 0)
    path = fresh_dir(spark, "loto")
    grid.loto_daily(every.where(~is_late), STATION, RUN_ID, by_draw=True).write.parquet(path)
    late = every.where(is_late)
    first = late.agg(F.min("draw_date")).scalar()
    merged = jobs.late_recompute(spark.read.parquet(path), every.where(F.col("draw_date") >= first), late, STATION, RUN_ID)
    return grid.spread_dense(merged, STATION).groupBy("station_code", "number_2d").agg(
        F.sum("draws_since_previous").alias("gap_sum"), F.sum("calendar_days_since_previous").alias("day_sum"),
        F.sum("rolling_7_frequency").alias("r7"), F.sum("rolling_90_frequency").alias("r90"), F.count(F.lit(1)).alias("draws"))


@query("late_stream", """
SELECT station_code, number_2d, CAST(sum(draws_since_previous) AS BIGINT) AS gap_sum, CAST(sum(calendar_days_since_previous) AS BIGINT) AS day_sum,
  CAST(sum(rolling_7_frequency) AS BIGINT) AS r7, CAST(sum(rolling_90_frequency) AS BIGINT) AS r90, count(*) AS draws FROM loto GROUP BY ALL""")
def _(spark, sf):
    """Most draws first, then two arrivals of late ones, each drained by the stream."""
    every = keeping(spark, "counts")(counts_of(spark, sf))
    kind = F.when((F.dayofyear("draw_date") % 50 == 0) & (F.year("draw_date") >= 1999) & (F.substring("station_code", 2, 9).cast("long") % 2 == 0), F.month("draw_date") % 2 + 1).otherwise(0)
    incoming, root, checkpoint = fresh_dir(spark, "draws"), fresh_dir(spark, "lake"), fresh_dir(spark, "checkpoint")
    for arrival in range(3):
        every.where(kind == arrival).write.mode("append").parquet(incoming)
        late.follow(spark.readStream.schema(every.schema).parquet(incoming), root, STATION, RUN_ID, checkpoint)
    return tables.read_silver(spark, f"{root}/fact").groupBy("station_code", "number_2d").agg(
        F.sum("draws_since_previous").alias("gap_sum"), F.sum("calendar_days_since_previous").alias("day_sum"),
        F.sum("rolling_7_frequency").alias("r7"), F.sum("rolling_90_frequency").alias("r90"), F.count(F.lit(1)).alias("draws"))


@query("scalar_functions", """
SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(3, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS padded, right(CAST(p_partkey AS VARCHAR), 2) AS tail,
  regexp_full_match(p_name, '[0-9]+') AS digits, lower(trim(p_name)) AS name, CAST(p_partkey % 10 + (p_partkey // 10) % 10 + (p_partkey // 100) % 10 + (p_partkey // 1000) % 10 + (p_partkey // 10000) % 10 + (p_partkey // 100000) % 10 AS BIGINT) AS digit_total,
  upper(trim(p_brand)) AS code, CASE WHEN p_size BETWEEN 1 AND 31 AND TRY_CAST('2023-02-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DATE) IS NOT NULL THEN CAST('2023-02-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DATE) END AS parsed,
  p_partkey % 100 AS two_digit, (p_partkey % 100) // 10 AS tens FROM part""")
def _(spark, sf):
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(
        key, text.zero_pad(key, 3).alias("padded"), text.tail_2d(key.cast("string")).alias("tail"),
        text.is_digits(F.col("p_name")).alias("digits"),
        text.normal_name(F.concat(F.lit("  "), F.regexp_replace("p_name", " ", "   "))).alias("name"),
        text.digit_sum(key.cast("string")).alias("digit_total"),
        facts.upper_code(F.concat(F.lit(" "), "p_brand")).alias("code"),
        dates.parse_display(F.col("p_size").cast("string"), F.lit("2"), F.lit("2023")).alias("parsed"),
        F.pmod(key, F.lit(100)).alias("two_digit"), F.expr("(p_partkey % 100) div 10").alias("tens"))


