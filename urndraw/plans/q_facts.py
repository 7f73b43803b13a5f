"""Sources, sinks, projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import DAILY, RUN_ID, STATION, control_events, draw_fact, observations, sessions, sessions_drawn, table
from urndraw.operators import calendars, descriptive, facts, grid, marts, state
from urndraw.plans.registry import cte, query
from urndraw.sources import tables
from urndraw.spec import published_calendar
from urndraw.workdir import fresh_dir

FACT_COLUMNS = """draw_date, station_code, station_order, station_name, station_url, prize_group, prize_order, prize_width,
  full_number, formatted_number, loto_2d, tens_digit, ones_digit, source_url, run_id"""
SUMMARY = """CAST(year(draw_date) AS BIGINT) AS year, CAST(month(draw_date) AS BIGINT) AS month, count(*) AS row_count,
  CAST(sum(full_number) AS BIGINT) AS total, count(DISTINCT station_code) AS stations"""


def counts_of(spark, sf, profile=STATION, years=None):
    return grid.draw_counts(observations(spark, sf, years), profile)


def month_summary(fact):
    return fact.groupBy(F.year("draw_date").cast("long").alias("year"), F.month("draw_date").cast("long").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("full_number").alias("total"),
        F.countDistinct("station_code").alias("stations"),
    )


def wide_day(spark, sf):
    return facts.legacy_wide(draw_fact(spark, sf, DAILY), DAILY)


# ---- sources and sinks


@query("src_raw_pages", "SELECT page_id, url, sha256(html) AS sha256, CAST(length(html) AS BIGINT) AS chars FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", "url", F.sha2(F.col("html").cast("binary"), 256).alias("sha256"), F.length("html").cast("long").alias("chars")
    )


@query("src_silver_read", f"SELECT {SUMMARY} FROM fact GROUP BY 1, 2")
def _(spark, sf):
    path = fresh_dir(spark, "silver")
    tables.write_silver(draw_fact(spark, sf), path)
    return month_summary(tables.read_silver(spark, path))


PLACED = """prize_order <= CASE prize_group WHEN 'special' THEN 1 WHEN 'prize1' THEN 1 WHEN 'prize2' THEN 2 WHEN 'prize3' THEN 6
  WHEN 'prize4' THEN 4 WHEN 'prize5' THEN 6 WHEN 'prize6' THEN 3 ELSE 4 END"""
# every prize is either in a place of the wide row or among the rows beyond it
WIDE_LONG = f"""
SELECT prize_group, prize_order, {PLACED} AS placed, count(*) AS draws, CAST(sum({{value}}) AS BIGINT) AS total, any_value(n) AS results FROM factday,
  (SELECT count(*) AS n FROM factday)
GROUP BY ALL"""


def _long_totals(spark, wide, beyond, value="full_number"):
    """Totals by place of what was stored in two tables, and the stored count of all results."""
    results = wide.agg(F.sum("result_count").alias("results")).scalar()
    placed = facts.legacy_long(wide, DAILY).withColumn("placed", F.lit(True))
    both = placed.unionByName(beyond.withColumn("placed", F.lit(False)).withColumn("full_number", F.expr(value)))
    return both.groupBy("prize_group", "prize_order", "placed").agg(
        F.count(F.lit(1)).alias("draws"), F.sum("full_number").alias("total")).withColumn("results", results)


def beyond_day(spark, sf):
    return facts.legacy_beyond(draw_fact(spark, sf, DAILY), DAILY)


BEYOND = "date date, prize_group string, prize_order long, full_number long"


@query("src_wide_json", WIDE_LONG.format(value="full_number"))
def _(spark, sf):
    path = fresh_dir(spark, "wide-json")
    tables.write_wide_json(wide_day(spark, sf), f"{path}/wide")
    tables.write_wide_json(beyond_day(spark, sf), f"{path}/beyond")
    return _long_totals(spark, tables.read_wide_json(spark, f"{path}/wide", DAILY), spark.read.schema(BEYOND).json(f"{path}/beyond"))


@query("src_wide_csv", WIDE_LONG.format(value="full_number % 100"))
def _(spark, sf):
    path = fresh_dir(spark, "wide-csv")
    facts.to_two_digit(wide_day(spark, sf), DAILY).write.option("header", True).csv(f"{path}/wide")
    beyond_day(spark, sf).write.option("header", True).csv(f"{path}/beyond")
    beyond = spark.read.schema(BEYOND).option("header", True).csv(f"{path}/beyond")
    return _long_totals(spark, tables.read_wide_csv(spark, f"{path}/wide", DAILY), beyond, "full_number % 100")


def _publish(spark, sf):
    root = fresh_dir(spark, "lake")
    tables.write_silver(draw_fact(spark, sf), f"{root}/silver")
    gold = marts.build_gold(tables.read_silver(spark, f"{root}/silver"), STATION, "run-0002")
    tables.write_release(gold, root, "run-0002")
    tables.write_manifest(spark, root, "run-0002", "2001-08-01", "2001-08-02T00:00:00Z")
    return root


RELEASE_SQL = """
SELECT 'dim-date' AS table_name, count(*) AS row_count FROM days
UNION ALL SELECT 'dim-number', 100
UNION ALL SELECT 'dim-station', count(DISTINCT station_code) FROM obs
UNION ALL SELECT 'fact-draw-result', count(*) FROM obs
UNION ALL SELECT 'fact-loto-daily', count(*) * 100 FROM draws
UNION ALL SELECT 'fact-special-prize', count(*) FROM obs WHERE prize_group = 'special'"""
RELEASE_TABLES = ["dim-date", "dim-number", "dim-station", "fact-draw-result", "fact-loto-daily", "fact-special-prize"]


def _table_counts(read):
    out = None
    for name, df in read.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("src_release_read", RELEASE_SQL)
def _(spark, sf):
    return _table_counts(tables.read_release(spark, _publish(spark, sf), RELEASE_TABLES))


@query("sink_silver", f"SELECT {SUMMARY} FROM fact GROUP BY 1, 2")
def _(spark, sf):
    path = fresh_dir(spark, "silver")
    tables.write_silver(draw_fact(spark, sf), path)
    months = spark.read.parquet(path)
    return months.groupBy(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("full_number").alias("total"),
        F.countDistinct("station_code").alias("stations"),
    )


@query("sink_gold", "SELECT format, table_name, row_count FROM (SELECT unnest(['csv', 'parquet']) AS format), (" + RELEASE_SQL + ")")
def _(spark, sf):
    root = fresh_dir(spark, "lake")
    tables.write_silver(draw_fact(spark, sf), f"{root}/silver")
    gold = marts.build_gold(tables.read_silver(spark, f"{root}/silver"), STATION, "run-0003")
    base = tables.write_release(gold, root, "run-0003", ("parquet", "csv"))
    as_csv = _table_counts({name: spark.read.option("header", True).csv(f"{base}/{name}.csv") for name in gold})
    as_parquet = _table_counts({name: spark.read.parquet(f"{base}/{name}.parquet") for name in gold})
    return as_csv.withColumn("format", F.lit("csv")).unionByName(as_parquet.withColumn("format", F.lit("parquet")))


@query("sink_csv_export", f"SELECT {SUMMARY} FROM fact GROUP BY 1, 2")
def _(spark, sf):
    path = fresh_dir(spark, "csv")
    fact = draw_fact(spark, sf)
    fact.write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return month_summary(spark.read.schema(fact.schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path))


@query("sink_three_formats", """
SELECT format, prize_group, prize_order, count(*) AS draws, CAST(sum(full_number) AS BIGINT) AS total, any_value(n) AS results
FROM (SELECT unnest(['csv', 'json', 'parquet']) AS format), factday, (SELECT count(*) AS n FROM factday) WHERE """ + PLACED + " GROUP BY ALL")
def _(spark, sf):
    path = fresh_dir(spark, "formats")
    tables.write_three_formats(wide_day(spark, sf), path)
    read = {
        "csv": tables.read_wide_csv(spark, f"{path}/csv", DAILY),
        "json": tables.read_wide_json(spark, f"{path}/json", DAILY),
        "parquet": spark.read.parquet(f"{path}/parquet"),
    }
    out = None
    for name, df in read.items():
        row = facts.legacy_long(df, DAILY).groupBy("prize_group", "prize_order").agg(
            F.count(F.lit(1)).alias("draws"), F.sum("full_number").alias("total")
        ).withColumns({"format": F.lit(name), "results": df.agg(F.sum("result_count")).scalar()})
        out = row if out is None else out.unionByName(row)
    return out


# ---- projections and filters


@query("draw_results", f"SELECT {FACT_COLUMNS} FROM fact")
def _(spark, sf):
    return facts.draw_results(facts.canonical_draws(draw_fact(spark, sf), STATION), STATION, RUN_ID)


@query("canonical_draws", """
SELECT station_code, draw_date, min(source_url) AS source_url, min(station_order) AS station_order, max(station_name) AS station_name,
  count(*) AS result_count, (prize_order - 1) // 1000 AS part, """ + ", ".join(
    f"coalesce(string_agg(formatted_number, ',' ORDER BY prize_order) FILTER (prize_group = '{g}'), '') AS {g}"
    for g in STATION.group_names) + " FROM fact GROUP BY station_code, draw_date, part")
def _(spark, sf):
    nested = facts.canonical_draws(draw_fact(spark, sf), STATION)
    return nested.select(
        "station_code", "draw_date", "part", "source_url", "station_order", "station_name", "result_count",
        *[F.array_join(g, ",").alias(g) for g in STATION.group_names],
    )


cte("special", """
SELECT draw_date, station_code, station_name, full_number, formatted_number, right(formatted_number, 2) AS tail_2d,
  CAST(substr(formatted_number, 1, 1) AS BIGINT) AS first_digit, CAST(right(formatted_number, 1) AS BIGINT) AS last_digit,
  CAST(list_sum(list_transform(string_split(formatted_number, ''), lambda d: CAST(d AS BIGINT))) AS BIGINT) AS digit_sum,
  CAST(right(formatted_number, 1) AS BIGINT) % 2 = 0 AS is_even_tail, run_id
FROM fact WHERE prize_group = 'special'""")


@query("special_prize", "SELECT * FROM special")
def _(spark, sf):
    return facts.special_prize(draw_fact(spark, sf), STATION)


@query("dim_number", "SELECT n.*, CAST(coalesce(c.total, 0) AS BIGINT) AS total FROM dimnumber n LEFT JOIN (SELECT number_2d, count(*) AS total FROM obs GROUP BY 1) c USING (number_2d)")
def _(spark, sf):
    totals = descriptive.total_frequency(observations(spark, sf)).withColumnRenamed("total_frequency", "total")
    return marts.dim_number(spark).join(totals, "number_2d", "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))


@query("dim_date", "SELECT * FROM dimdate")
def _(spark, sf):
    return marts.dim_date(sessions_drawn(spark, sf))


@query("stamp_run_id", "SELECT 'run-0009' AS run_id, count(*) AS row_count FROM fact")
def _(spark, sf):
    return facts.stamp_run_id(draw_fact(spark, sf), "run-0009").groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))


def _wide_cells(value):
    return ", ".join(
        f"max(CASE WHEN prize_group = '{g}' AND prize_order = {o} THEN {value} END) AS {name}"
        for name, g, o in DAILY.wide_columns()
    )


@query("legacy_wide", f"SELECT draw_date AS date, {_wide_cells('full_number')}, count(*) AS result_count FROM factday GROUP BY draw_date")
def _(spark, sf):
    return wide_day(spark, sf)


@query("to_two_digit", f"SELECT draw_date AS date, {_wide_cells('full_number % 100')}, count(*) AS result_count FROM factday GROUP BY draw_date")
def _(spark, sf):
    return facts.to_two_digit(wide_day(spark, sf), DAILY)


@query("legacy_long", f"SELECT draw_date AS date, prize_group, prize_order, full_number, {PLACED} AS placed FROM factday")
def _(spark, sf):
    placed = facts.legacy_long(wide_day(spark, sf), DAILY).withColumn("placed", F.lit(True))
    return placed.unionByName(beyond_day(spark, sf).withColumn("placed", F.lit(False)))


@query("trailing_years", """
SELECT station_code, draw_date, number_2d, frequency FROM counts
WHERE draw_date > (SELECT max(draw_date) FROM counts) - INTERVAL 2 YEAR AND draw_date <= (SELECT max(draw_date) FROM counts)""")
def _(spark, sf):
    return counts_of(spark, sf, STATION, 2).drop("station_name")


@query("date_range_filter", """
SELECT station_code, draw_date, number_2d, frequency FROM counts WHERE draw_date BETWEEN DATE '1996-02-29' AND DATE '1997-02-28'""")
def _(spark, sf):
    return facts.date_range(counts_of(spark, sf), "draw_date", "1996-02-29", "1997-02-28").drop("station_name")


@query("normalize_fact", """
SELECT draw_date, 'NORTH' AS station_code, 'North' AS station_name, prize_group,
  CAST(CASE prize_group WHEN 'special' THEN 0 ELSE CAST(right(prize_group, 1) AS BIGINT) END AS BIGINT) AS group_order, prize_order,
  formatted_number, lpad(loto_2d, 2, '0') AS loto_2d, true AS known_group FROM factday""")
def _(spark, sf):
    return facts.normalize_fact(draw_fact(spark, sf, DAILY), DAILY, "NORTH", "North")


# ---- joins


@query("dense_grid", "SELECT draw_date, number_2d, frequency FROM gridday")
def _(spark, sf):
    return grid.dense_grid(counts_of(spark, sf, DAILY), DAILY)


@query("special_by_weekday", """
SELECT d.day_name, s.tail_2d, count(*) AS observations FROM special s JOIN dimdate d ON s.draw_date = d.date GROUP BY ALL""")
def _(spark, sf):
    special = facts.special_prize(draw_fact(spark, sf), STATION)
    return marts.special_by_weekday(special, marts.dim_date(sessions_drawn(spark, sf)))


@query("bi_star_join", """
SELECT c.station_code, s.station_name AS current_name, d.day_name, n.tens_digit, CAST(sum(c.frequency) AS BIGINT) AS total_frequency
FROM grid c JOIN dimnumber n USING (number_2d) JOIN dimdate d ON d.date = c.draw_date JOIN dimstation s ON s.station_code = c.station_code
GROUP BY ALL""")
def _(spark, sf):
    fact = draw_fact(spark, sf)
    dense = grid.dense_grid(counts_of(spark, sf), STATION)
    return marts.star_summary(dense, marts.dim_number(spark), marts.dim_date(sessions_drawn(spark, sf)), marts.dim_station(fact))


@query("loto_vs_fact", """
SELECT g.station_code, g.draw_date, g.number_2d, CASE WHEN (dayofyear(g.draw_date) + CAST(g.number_2d AS BIGINT)) % 59 = 0 THEN g.frequency + 1
  ELSE g.frequency END AS actual, g.frequency AS expected
FROM grid g WHERE (dayofyear(g.draw_date) + CAST(g.number_2d AS BIGINT)) % 59 = 0""")
def _(spark, sf):
    counts = counts_of(spark, sf)
    damaged = (F.dayofyear("draw_date") + F.col("number_2d").cast("long")) % 59 == 0
    loto = grid.dense_grid(counts, STATION).withColumn("frequency", F.when(damaged, F.col("frequency") + 1).otherwise(F.col("frequency")))
    return calendars.loto_vs_fact(loto, counts, STATION)


# Stations are expected on five weekdays out of seven; from 1998-07-01 the free days move by one.
cte("expectedset", """
SELECT d.date AS draw_date, s.station_code
FROM days d CROSS JOIN (SELECT DISTINCT station_code, station_no FROM obs) s
WHERE CASE WHEN dayofyear(d.date) % 97 = 0 THEN s.station_no % 2 = 0
  WHEN d.date < DATE '1998-07-01' THEN (s.station_no + isodow(d.date)) % 4 <> 0
  ELSE (s.station_no + isodow(d.date) + 1) % 4 <> 0 END""")


def expected_sets(spark, sf):
    """Calendar of the given tables: weekday rules in two validity ranges, and dated overrides."""
    drawn = sessions_drawn(spark, sf)
    stations = drawn.select("station_code", "station_no").distinct()
    weekdays = stations.select(
        F.lit("given").alias("region"), "station_code", "station_no", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("weekday")
    )
    first = weekdays.where((F.col("station_no") + F.col("weekday")) % 4 != 0).select(
        "region", "weekday", "station_code", F.lit("1900-01-01").cast("date").alias("valid_from"),
        F.lit("1998-07-01").cast("date").alias("valid_to"))
    second = weekdays.where((F.col("station_no") + F.col("weekday") + 1) % 4 != 0).select(
        "region", "weekday", "station_code", F.lit("1998-07-01").cast("date").alias("valid_from"),
        F.lit("9999-12-31").cast("date").alias("valid_to"))
    ends = [drawn.agg(end("draw_date")).scalar() for end in (F.min, F.max)]
    overrides = stations.where(F.col("station_no") % 2 == 0).select(
        F.lit("given").alias("region"), F.explode(F.sequence(*ends)).alias("draw_date"), "station_code"
    ).where(F.dayofyear("draw_date") % 97 == 0)
    dates = marts.calendar(drawn).select(F.lit("given").alias("region"), F.col("date").alias("draw_date"))
    return calendars.expected_stations(dates, first.unionByName(second), overrides)


@query("station_calendar", "SELECT draw_date, station_code FROM expectedset")
def _(spark, sf):
    return expected_sets(spark, sf).select("draw_date", "station_code")


@query("station_calendar_published", """
SELECT region, date AS draw_date, unnest(string_split(codes, ',')) AS station_code FROM (
SELECT 'south' AS region, date, CASE isodow(date) WHEN 1 THEN 'HCM,DT,CM' WHEN 2 THEN 'BTR,VT,BL' WHEN 3 THEN 'DN,CT,ST' WHEN 4 THEN 'TN,AG,BTH'
  WHEN 5 THEN 'VL,BD,TV' WHEN 6 THEN 'HCM,LA,BP,HG' ELSE 'TG,KG,DL' END AS codes FROM days
UNION ALL
SELECT 'central', date, CASE isodow(date) WHEN 1 THEN 'TTH,PY' WHEN 2 THEN 'DLK,QNA' WHEN 3 THEN 'DNA,KH' WHEN 4 THEN 'BDI,QB,QT'
  WHEN 5 THEN 'GL,NT' WHEN 6 THEN 'DNA,QNG,DNO' ELSE CASE WHEN date < DATE '2022-01-02' THEN 'KH,KT' ELSE 'KH,KT,TTH' END END FROM days)""")
def _(spark, sf):
    weekly, overrides = published_calendar(spark)
    days = marts.calendar(sessions_drawn(spark, sf)).select(
        F.explode(F.array(F.lit("south"), F.lit("central"))).alias("region"), F.col("date").alias("draw_date"))
    return calendars.expected_stations(days, weekly, overrides)


@query("station_set_mismatch", """
SELECT draw_date, station_code, CASE WHEN a THEN 'unexpected' ELSE 'missing' END AS problem FROM (
  SELECT coalesce(e.draw_date, a.draw_date) AS draw_date, coalesce(e.station_code, a.station_code) AS station_code, e.draw_date IS NULL AS a
  FROM (SELECT * FROM expectedset WHERE draw_date IN (SELECT draw_date FROM drawsday)) e
  FULL OUTER JOIN draws a ON a.draw_date = e.draw_date AND a.station_code = e.station_code
  WHERE e.draw_date IS NULL OR a.draw_date IS NULL)""")
def _(spark, sf):
    drawn = sessions_drawn(spark, sf).select("draw_date", "station_code").distinct()
    expected = expected_sets(spark, sf).join(drawn.select("draw_date").distinct(), "draw_date", "left_semi")
    return calendars.set_mismatch(drawn, expected.select("draw_date", "station_code"), ["draw_date", "station_code"])


cte("allevents", """
SELECT user_id AS lake, CAST(ts AS DATE) AS draw_date,
  CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'no_draw' WHEN 'error' THEN 'failed' ELSE 'missing' END AS status,
  'run-' || CAST(event_id AS VARCHAR) AS run_id, ts AS updated_at, event_id AS seq, props AS detail
FROM events""")
cte("states", """
SELECT lake, draw_date, status, run_id, updated_at, seq, detail
FROM (SELECT *, row_number() OVER (PARTITION BY lake, draw_date ORDER BY updated_at DESC, seq DESC) AS rn FROM allevents) WHERE rn = 1""")
cte("lakedays", """
SELECT lake, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS draw_date
FROM (SELECT lake, min(draw_date) AS a, max(draw_date) AS b FROM allevents GROUP BY 1)""")
cte("statusmap", """
SELECT d.lake, d.draw_date, coalesce(s.status, 'missing') AS status
FROM lakedays d LEFT JOIN states s ON s.lake = d.lake AND s.draw_date = d.draw_date""")


def lake_states(spark, sf):
    events = control_events(spark, sf)
    return events, state.latest_state(events, ["lake", "draw_date"])


@query("pending_dates", "SELECT lake, draw_date FROM statusmap WHERE status NOT IN ('success', 'no_draw')")
def _(spark, sf):
    events, states = lake_states(spark, sf)
    return state.pending_dates(state.lake_calendar(events), states)


@query("pending_dates_forced", "SELECT lake, draw_date FROM lakedays")
def _(spark, sf):
    events, states = lake_states(spark, sf)
    return state.pending_dates(state.lake_calendar(events), states, force=True)


@query("status_map", "SELECT * FROM statusmap")
def _(spark, sf):
    events, states = lake_states(spark, sf)
    return state.status_map(state.lake_calendar(events), states)


@query("unresolved_dates", "SELECT lake, draw_date, status FROM statusmap WHERE status IN ('missing', 'failed')")
def _(spark, sf):
    events, states = lake_states(spark, sf)
    return state.unresolved_dates(state.status_map(state.lake_calendar(events), states))


@query("status_fact_alignment", """
SELECT problem, date FROM (
  SELECT s.date, unnest([CASE WHEN status = 'success' AND f.d IS NULL THEN 'success-date-missing-draw-facts' END,
    CASE WHEN status = 'success' AND l.d IS NULL THEN 'success-date-missing-loto-facts' END,
    CASE WHEN status = 'no_draw' AND (f.d IS NOT NULL OR l.d IS NOT NULL) THEN 'no-draw-has-facts' END,
    CASE WHEN status IN ('missing', 'failed') AND (f.d IS NOT NULL OR l.d IS NOT NULL) THEN 'incomplete-date-has-facts' END]) AS problem
  FROM (SELECT date, CASE dayofyear(date) % 23 WHEN 0 THEN 'no_draw' WHEN 1 THEN 'failed' WHEN 2 THEN 'missing' ELSE 'success' END AS status FROM days) s
  LEFT JOIN (SELECT DISTINCT draw_date AS d FROM obs WHERE l_orderkey % 5 <> 0) f ON f.d = s.date
  LEFT JOIN (SELECT DISTINCT draw_date AS d FROM obs WHERE l_orderkey % 7 <> 0) l ON l.d = s.date)
WHERE problem IS NOT NULL""")
def _(spark, sf):
    drawn = sessions_drawn(spark, sf)
    kind = F.dayofyear("date") % 23
    statuses = marts.calendar(drawn).withColumn(
        "status", F.when(kind == 0, "no_draw").when(kind == 1, "failed").when(kind == 2, "missing").otherwise("success")
    )
    return calendars.status_fact_alignment(
        statuses, drawn.where(F.col("o_orderkey") % 5 != 0), drawn.where(F.col("o_orderkey") % 7 != 0)
    )


cte("dimstationbad", """
SELECT station_code, CASE WHEN CAST(substr(station_code, 2) AS BIGINT) % 3 = 1 THEN first_draw_date + 1 ELSE first_draw_date END AS first_draw_date, latest_draw_date
FROM dimstation WHERE CAST(substr(station_code, 2) AS BIGINT) % 4 <> 3
UNION ALL SELECT 'X' || substr(station_code, 2), first_draw_date, latest_draw_date FROM dimstation WHERE CAST(substr(station_code, 2) AS BIGINT) % 4 = 2""")


def bad_stations(spark, sf):
    fact = observations(spark, sf)
    stations = fact.groupBy("station_code").agg(F.min("draw_date").alias("first_draw_date"), F.max("draw_date").alias("latest_draw_date"))
    number = F.substring("station_code", 2, 9).cast("long")
    moved = F.when(number % 3 == 1, F.date_add("first_draw_date", 1)).otherwise(F.col("first_draw_date"))
    known = stations.where(number % 4 != 3).withColumn("first_draw_date", moved)
    extra = stations.where(number % 4 == 2).withColumn("station_code", F.concat(F.lit("X"), F.substring("station_code", 2, 9)))
    return stations, known.unionByName(extra)


@query("station_dim_mismatch", """
SELECT station_code, problem FROM (
SELECT coalesce(f.station_code, d.station_code) AS station_code,
  CASE WHEN d.station_code IS NULL THEN 'missing' WHEN f.station_code IS NULL THEN 'extra'
    WHEN f.first_draw_date <> d.first_draw_date OR f.latest_draw_date <> d.latest_draw_date THEN 'range' END AS problem
FROM dimstation f FULL OUTER JOIN dimstationbad d ON d.station_code = f.station_code) WHERE problem IS NOT NULL""")
def _(spark, sf):
    actual, dimension = bad_stations(spark, sf)
    return calendars.station_dim_mismatch(actual, dimension)


@query("code_set_diff", """
SELECT station_code, 'missing' AS side FROM (SELECT station_code FROM dimstation EXCEPT SELECT station_code FROM dimstationbad)
UNION ALL SELECT station_code, 'extra' FROM (SELECT station_code FROM dimstationbad EXCEPT SELECT station_code FROM dimstation)""")
def _(spark, sf):
    actual, dimension = bad_stations(spark, sf)
    return calendars.code_set_diff(actual, dimension, "station_code")


@query("union_partitions", """
SELECT station_code, draw_date, prize_group, prize_order, full_number FROM fact""")
def _(spark, sf):
    fact = draw_fact(spark, sf).select("station_code", "draw_date", "prize_group", "prize_order", "full_number")
    even = F.month("draw_date") % 2 == 0
    return fact.where(even).unionByName(fact.where(~even).select(*reversed(fact.columns)))


@query("calendar_except", "SELECT station_code, date AS draw_date FROM (SELECT station_code, CAST(unnest(generate_series(first_draw_date, latest_draw_date, INTERVAL 1 DAY)) AS DATE) AS date FROM dimstation) EXCEPT SELECT station_code, draw_date FROM draws")
def _(spark, sf):
    drawn = sessions_drawn(spark, sf).select("station_code", "draw_date")
    return calendars.calendar_except(drawn, ["station_code"])
