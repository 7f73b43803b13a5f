"""Aggregations, window columns, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import DAILY, RUN_ID, STATION, draw_fact, observations, table
from urndraw.operators import descriptive as d
from urndraw.operators import facts, grid, marts, serving, state
from urndraw.plans.q_facts import counts_of, lake_states
from urndraw.plans.registry import cte, query
from urndraw.spec import MODEL_WINDOWS, RECENT_DRAWS

cte("totals", "SELECT station_code, number_2d, CAST(sum(frequency) AS BIGINT) AS total_frequency FROM counts GROUP BY ALL")
cte("totalsday", "SELECT number_2d, CAST(sum(frequency) AS BIGINT) AS total_frequency FROM gridday GROUP BY ALL")
cte("yearday", """
SELECT * FROM gridday WHERE draw_date > (SELECT max(draw_date) FROM drawsday) - INTERVAL 1 YEAR""")
cte("yeartotals", "SELECT number_2d, CAST(sum(frequency) AS BIGINT) AS total_frequency FROM yearday GROUP BY ALL")


def year_totals(spark, sf):
    """Totals of all 100 numbers over the last year, daily profile."""
    return d.dense_totals(observations(spark, sf, 1), DAILY)


@query("freq_by_draw", "SELECT station_code, draw_date, number_2d, frequency FROM counts")
def _(spark, sf):
    return counts_of(spark, sf).drop("station_name")


@query("total_frequency", "SELECT number_2d, CAST(sum(frequency) AS BIGINT) AS total_frequency FROM counts GROUP BY ALL")
def _(spark, sf):
    return d.total_frequency(observations(spark, sf)).orderBy(F.desc("total_frequency"), "number_2d")


@query("station_frequency", "SELECT * FROM totals")
def _(spark, sf):
    return d.total_frequency(observations(spark, sf), "station_code")


@query("frequency_map", """
SELECT s.station_code, n.number_2d, coalesce(t.total_frequency, 0) AS total_frequency
FROM (SELECT DISTINCT station_code FROM obs) s CROSS JOIN numbers n LEFT JOIN totals t ON t.station_code = s.station_code AND t.number_2d = n.number_2d""")
def _(spark, sf):
    maps = d.frequency_map(d.dense_totals(observations(spark, sf), STATION), "station_code")
    return maps.select("station_code", F.explode("frequency_map").alias("number_2d", "total_frequency"))


@query("frequency_map_overall", "SELECT * FROM totalsday")
def _(spark, sf):
    maps = d.frequency_map(d.dense_totals(observations(spark, sf), DAILY))
    return maps.select(F.explode("frequency_map").alias("number_2d", "total_frequency"))


@query("sparse_matrix", "SELECT draw_date AS date, " + ", ".join(
    f"CAST(coalesce(max(frequency) FILTER (number_2d = '{n:02d}'), 0) AS BIGINT) AS n{n:02d}" for n in range(100)) + " FROM countsday GROUP BY draw_date")
def _(spark, sf):
    return facts.sparse_matrix(counts_of(spark, sf, DAILY), DAILY)


@query("column_stats", """
SELECT max(total_frequency) AS max_count, min(total_frequency) AS min_count, CAST(sum(total_frequency) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean,
  sqrt(CAST(count(*) * sum(total_frequency * total_frequency) - sum(total_frequency) * sum(total_frequency) AS DOUBLE) / CAST(count(*) * (count(*) - 1) AS DOUBLE)) AS std
FROM yeartotals""")
def _(spark, sf):
    return d.column_stats(year_totals(spark, sf))


@query("freq_histogram", "SELECT total_frequency AS bin, count(*) AS numbers FROM yeartotals GROUP BY 1")
def _(spark, sf):
    return d.freq_histogram(year_totals(spark, sf))


@query("heatmap_10x10", "SELECT CAST(substr(number_2d, 1, 1) AS BIGINT) AS tens, " + ", ".join(
    f"coalesce(max(total_frequency) FILTER (right(number_2d, 1) = '{k}'), 0) AS ones_{k}" for k in range(10)) + " FROM yeartotals GROUP BY 1")
def _(spark, sf):
    return d.heatmap(year_totals(spark, sf), "total_frequency")


@query("heat_intensity", """
SELECT station_code, number_2d, CAST(total_frequency AS DOUBLE) / CAST(greatest(max(total_frequency) OVER (PARTITION BY station_code), 1) AS DOUBLE) AS intensity
FROM totals""")
def _(spark, sf):
    return d.heat_intensity(d.total_frequency(observations(spark, sf), "station_code"), "station_code")


@query("heat_intensity_overall", """
SELECT number_2d, CAST(total_frequency AS DOUBLE) / CAST(greatest((SELECT max(total_frequency) FROM totalsday), 1) AS DOUBLE) AS intensity FROM totalsday""")
def _(spark, sf):
    return d.heat_intensity(d.dense_totals(observations(spark, sf), DAILY))


@query("head_tail_table", """
SELECT s.station_code, t.range AS tens, coalesce(string_agg(right(o.number_2d, 1), ', ' ORDER BY right(o.number_2d, 1)), '-') AS ones_digits
FROM (SELECT station_code, max(draw_date) AS last_date FROM obs GROUP BY 1) s CROSS JOIN range(10) t
LEFT JOIN obs o ON o.station_code = s.station_code AND o.draw_date = s.last_date AND CAST(substr(o.number_2d, 1, 1) AS BIGINT) = t.range
GROUP BY 1, 2""")
def _(spark, sf):
    return d.head_tail_table(counts_of(spark, sf))


@query("dim_station", "SELECT * FROM dimstation")
def _(spark, sf):
    return marts.dim_station(draw_fact(spark, sf))


@query("station_metadata", """
SELECT s.*, m.draw_count, m.result_count, m.years FROM dimstation s JOIN (
  SELECT station_code, count(DISTINCT draw_date) AS draw_count, count(*) AS result_count,
    array_to_string(list_sort(list(DISTINCT year(draw_date))), ',') AS years FROM obs GROUP BY 1) m USING (station_code)""")
def _(spark, sf):
    fact = draw_fact(spark, sf)
    return d.station_metadata(fact, marts.dim_station(fact)).withColumn("years", F.array_join("years", ","))


@query("dataset_summary", """
SELECT min(draw_date) AS range_from, max(draw_date) AS range_to, count(DISTINCT (station_code, draw_date)) AS draw_count, count(*) AS result_count,
  max(draw_date) = DATE '2001-08-01' AS matches_target FROM obs""")
def _(spark, sf):
    return d.dataset_summary(draw_fact(spark, sf), STATION, "2001-08-01")


cte("mig", """
SELECT o_orderkey, CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date, o_orderkey % 131 <> 0 AS complete FROM orders""")


def migration_rows(spark, sf):
    """Sessions as wide source rows; some have no date or are incomplete."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key, F.when(key % 113 != 0, F.to_date("o_orderdate")).alias("date"), (key % 131 != 0).alias("complete"))


@query("migration_summary", """
SELECT (SELECT count(*) FROM mig) AS source_rows, CAST(sum(n) AS BIGINT) AS valid_rows, min(date) AS minimum_date, max(date) AS maximum_date,
  count(*) FILTER (n > 1) AS duplicate_dates, CAST(max(date) - min(date) + 1 - count(*) AS BIGINT) AS missing_calendar_dates,
  (SELECT count(*) FROM mig) - CAST(sum(n) AS BIGINT) AS invalid_rows, false AS passed
FROM (SELECT date, count(*) AS n FROM mig WHERE complete AND date IS NOT NULL GROUP BY 1)""")
def _(spark, sf):
    return state.migration_summary(migration_rows(spark, sf), "date", F.col("complete") & F.col("date").isNotNull())


@query("migration_status", """
SELECT date, CASE WHEN date IN (SELECT date FROM mig WHERE complete AND date IS NOT NULL) THEN 'success' ELSE 'missing' END AS status
FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM mig WHERE complete AND date IS NOT NULL)""")
def _(spark, sf):
    good = migration_rows(spark, sf).where("complete and date is not null").select(F.col("date").alias("draw_date"))
    return marts.dim_date(good).select("date", F.col("draw_status").alias("status"))


@query("status_counts", "SELECT lake, status, count(*) AS dates FROM statusmap GROUP BY ALL")
def _(spark, sf):
    events, states = lake_states(spark, sf)
    return state.status_map(state.lake_calendar(events), states).groupBy("lake", "status").agg(F.count(F.lit(1)).alias("dates"))


@query("shard_totals", """
SELECT station_code, sum(draws)::BIGINT AS draw_count, sum(results)::BIGINT AS result_count, min(a) AS range_from, max(b) AS range_to, count(*) AS shards,
  sum(draws) = max(declared_draws) AND sum(results) = max(declared_results) + CAST(substr(station_code, 2) AS BIGINT) % 2 AS agrees
FROM (SELECT station_code, year(draw_date) AS y, count(DISTINCT draw_date) AS draws, count(*) AS results, min(draw_date) AS a, max(draw_date) AS b FROM obs GROUP BY 1, 2)
JOIN (SELECT station_code, count(DISTINCT draw_date) AS declared_draws, count(*) AS declared_results FROM obs GROUP BY 1) USING (station_code)
GROUP BY station_code""")
def _(spark, sf):
    drawn = serving.draw_sizes(counts_of(spark, sf))
    declared = drawn.groupBy("station_code").agg(
        F.count(F.lit(1)).alias("declared_draws"),
        (F.sum("result_count") + F.substring("station_code", 2, 9).cast("long") % 2).alias("declared_results"))
    return serving.shard_totals(serving.shard_counts(drawn), declared)


# ---- windows


@query("draw_position", """
SELECT station_code, draw_date, row_number() OVER (PARTITION BY station_code ORDER BY draw_date) AS draw_position FROM draws""")
def _(spark, sf):
    return grid.draw_positions(counts_of(spark, sf), STATION)


def history(spark, sf, profile=STATION):
    return grid.loto_daily(counts_of(spark, sf, profile), profile, RUN_ID)


@query("draws_since_previous", """
SELECT station_code, draw_date, CAST(sum(draws_since_previous) AS BIGINT) AS gap_sum, max(draws_since_previous) AS gap_max, count(draws_since_previous) AS seen
FROM loto GROUP BY ALL""")
def _(spark, sf):
    return history(spark, sf).groupBy("station_code", "draw_date").agg(
        F.sum("draws_since_previous").alias("gap_sum"), F.max("draws_since_previous").alias("gap_max"),
        F.count("draws_since_previous").alias("seen"))


@query("calendar_days_since_previous", """
SELECT station_code, number_2d, CAST(sum(calendar_days_since_previous) AS BIGINT) AS day_sum, max(calendar_days_since_previous) AS day_max FROM loto GROUP BY ALL""")
def _(spark, sf):
    return history(spark, sf).groupBy("station_code", "number_2d").agg(
        F.sum("calendar_days_since_previous").alias("day_sum"), F.max("calendar_days_since_previous").alias("day_max"))


@query("appearance_status", """
SELECT station_code, draw_date, previous_appearance_status, count(*) AS numbers FROM loto GROUP BY ALL""")
def _(spark, sf):
    return history(spark, sf).groupBy("station_code", "draw_date", "previous_appearance_status").agg(F.count(F.lit(1)).alias("numbers"))


@query("rolling_frequency", """
SELECT station_code, draw_date, CAST(sum(rolling_7_frequency) AS BIGINT) AS r7, CAST(sum(rolling_30_frequency) AS BIGINT) AS r30,
  CAST(sum(rolling_90_frequency) AS BIGINT) AS r90, max(rolling_90_frequency) AS top90 FROM loto GROUP BY ALL""")
def _(spark, sf):
    return history(spark, sf).groupBy("station_code", "draw_date").agg(
        F.sum("rolling_7_frequency").alias("r7"), F.sum("rolling_30_frequency").alias("r30"),
        F.sum("rolling_90_frequency").alias("r90"), F.max("rolling_90_frequency").alias("top90"))


@query("loto_daily", "SELECT * EXCLUDE (draw_position) FROM loto")
def _(spark, sf):
    return history(spark, sf)


@query("loto_daily_no_station", "SELECT * EXCLUDE (draw_position) FROM lotoday")
def _(spark, sf):
    return history(spark, sf, DAILY)


cte("lasttwo", """
SELECT *, dense_rank() OVER (ORDER BY draw_date DESC) AS back FROM obs
WHERE draw_date > (SELECT max(draw_date) FROM obs) - INTERVAL 2 YEAR""")


@query("last_appearing_delta", "SELECT number_2d, min(back) AS delta FROM lasttwo GROUP BY 1")
def _(spark, sf):
    return d.last_appearing_delta(counts_of(spark, sf, DAILY, 2), DAILY)


@query("last_appearing_delta_special", """
SELECT number_2d, min(back) AS delta FROM (SELECT *, dense_rank() OVER (ORDER BY draw_date DESC) AS back
  FROM obs WHERE prize_group = 'special' AND draw_date > (SELECT max(draw_date) FROM obs WHERE prize_group = 'special') - INTERVAL 2 YEAR) GROUP BY 1""")
def _(spark, sf):
    special = draw_fact(spark, sf, DAILY).where("prize_group = 'special'")
    counts = grid.draw_counts(special, DAILY, "loto_2d")
    return d.last_appearing_delta(facts.trailing_years(counts, "draw_date", 2), DAILY)


@query("delta_heatmap", "SELECT CAST(substr(n.number_2d, 1, 1) AS BIGINT) AS tens, " + ", ".join(
    f"coalesce(max(delta) FILTER (right(n.number_2d, 1) = '{k}'), 0) AS ones_{k}" for k in range(10)) + """
FROM numbers n LEFT JOIN (SELECT number_2d, min(back) AS delta FROM lasttwo GROUP BY 1) x ON x.number_2d = n.number_2d GROUP BY 1""")
def _(spark, sf):
    counts = counts_of(spark, sf, DAILY, 2)
    return d.heatmap(d.last_appearing_delta(counts, DAILY), "delta")


@query("current_gap", """
SELECT station_code, number_2d, max(draw_position) - coalesce(max(draw_position) FILTER (frequency > 0), 0) AS current_gap FROM loto GROUP BY ALL""")
def _(spark, sf):
    return d.current_gap(counts_of(spark, sf), STATION)


cte("back", """
SELECT *, row_number() OVER (PARTITION BY station_code, number_2d ORDER BY draw_date DESC) AS draw_index FROM grid""")


@query("momentum", """
SELECT station_code, number_2d, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY station_code ORDER BY score DESC, number_2d) AS rank FROM (
    SELECT station_code, number_2d, CAST(sum(frequency) FILTER (draw_index <= 7) AS DOUBLE) / 7.0::DOUBLE
      - CAST(sum(frequency) FILTER (draw_index BETWEEN 8 AND 37) AS DOUBLE) / 30.0::DOUBLE AS score FROM back GROUP BY ALL)) WHERE rank <= 5""")
def _(spark, sf):
    return d.momentum(counts_of(spark, sf), STATION)


@query("recent_draws", f"""
SELECT station_code, draw_date, number_2d, frequency, draw_index FROM back WHERE frequency > 0 AND draw_index <= {RECENT_DRAWS}""")
def _(spark, sf):
    return d.recent_draws(counts_of(spark, sf), STATION, RECENT_DRAWS)


@query("trailing_window_freq", "SELECT station_code, number_2d, " + ", ".join(
    f"CAST(coalesce(sum(frequency) FILTER (draw_index <= {n}), 0) AS BIGINT) AS last_{n}" for n in MODEL_WINDOWS)
    + f" FROM back WHERE frequency > 0 AND draw_index <= {max(MODEL_WINDOWS)} GROUP BY ALL")
def _(spark, sf):
    return d.trailing_window_freq(counts_of(spark, sf), STATION, MODEL_WINDOWS)


@query("dup_rows_all", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(spark, sf):
    from urndraw.operators.quality import duplicate_rows

    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber"), "l_partkey", "l_suppkey")
    return duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query("waiting_time_dist", """
SELECT draws_since_previous, count(*) AS appearances FROM loto WHERE appeared AND draws_since_previous IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return grid.waiting_times(history(spark, sf))


# ---- top-k


@query("top_k_numbers", "SELECT number_2d, total_frequency FROM totalsday ORDER BY total_frequency DESC, number_2d LIMIT 10")
def _(spark, sf):
    return d.top_k(d.total_frequency(observations(spark, sf)), [F.desc("total_frequency"), F.asc("number_2d")], 10)


@query("top_delta", "SELECT number_2d, min(back) AS delta FROM lasttwo GROUP BY 1 ORDER BY delta DESC, number_2d LIMIT 10")
def _(spark, sf):
    delta = d.last_appearing_delta(counts_of(spark, sf, DAILY, 2), DAILY)
    return d.top_k(delta, [F.desc("delta"), F.asc("number_2d")], 10)


@query("hot_cold", """
SELECT * FROM (SELECT number_2d, total_frequency, 'hot' AS kind FROM totalsday ORDER BY total_frequency DESC, number_2d LIMIT 5)
UNION ALL SELECT * FROM (SELECT number_2d, total_frequency, 'cold' AS kind FROM totalsday ORDER BY total_frequency, number_2d LIMIT 5)""")
def _(spark, sf):
    return d.hot_cold(d.dense_totals(observations(spark, sf), DAILY))


@query("layout_equality", """
SELECT station_code, draw_date, missing, unexpected FROM (
  SELECT station_code, draw_date, 18 - count(*) FILTER (known) AS missing, count(*) FILTER (NOT known) AS unexpected FROM (
    SELECT *, prize_order <= CASE prize_group WHEN 'prize3' THEN 2 WHEN 'prize4' THEN 7 WHEN 'prize6' THEN 3 ELSE 1 END AS known FROM fact) GROUP BY 1, 2)
WHERE missing > 0 OR unexpected > 0""")
def _(spark, sf):
    from urndraw.operators.quality import layout_difference

    return layout_difference(draw_fact(spark, sf), STATION)

