"""Quality checks and the history audit over deliberately damaged copies of the facts.

Every table is damaged by key modulus, with the same expression in the check SQL, so each rule has
rows to find.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import DAILY, RUN_ID, STATION, draw_fact, table
from urndraw.operators import audit, calendars, facts, grid, marts, quality, state
from urndraw.plans.q_facts import counts_of, expected_sets, sessions_drawn
from urndraw.plans.registry import cte, query
from urndraw.workdir import fresh_dir

# ---- quality checks

cte("qfact", """
SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE prize_order END AS prize_order,
  CASE WHEN l_orderkey % 101 = 0 THEN full_number + 10000000 ELSE full_number END AS full_number) FROM fact""")
cte("qfactday", """
SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE prize_order END AS prize_order,
  CASE WHEN l_orderkey % 101 = 0 THEN full_number + 10000000 ELSE full_number END AS full_number) FROM factday""")
cte("qgrid", """
SELECT * FROM (SELECT * REPLACE (CASE WHEN k % 211 = 0 THEN 'A1' ELSE number_2d END AS number_2d)
  FROM (SELECT *, dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT) AS k FROM grid) WHERE k % 307 <> 0)
UNION ALL SELECT *, dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT) AS k FROM grid WHERE (dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT)) % 313 = 0""")
cte("qgridday", """
SELECT * FROM (SELECT * REPLACE (CASE WHEN k % 211 = 0 THEN 'A1' ELSE number_2d END AS number_2d)
  FROM (SELECT *, dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT) AS k FROM gridday) WHERE k % 307 <> 0)
UNION ALL SELECT *, dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT) AS k FROM gridday WHERE (dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT)) % 313 = 0""")


def damaged_fact(spark, sf, profile=STATION):
    key = F.col("l_orderkey")
    return draw_fact(spark, sf, profile, keep=("l_orderkey",)).withColumns({
        "prize_order": F.when(key % 97 == 0, F.lit(1).cast("long")).otherwise(F.col("prize_order")),
        "full_number": F.when(key % 101 == 0, F.col("full_number") + 10000000).otherwise(F.col("full_number")),
    })


def damaged_grid(spark, sf, profile=STATION):
    rows = grid.dense_grid(counts_of(spark, sf, profile), profile).withColumn(
        "k", F.dayofyear("draw_date") * 100 + F.col("number_2d").cast("long"))
    kept = rows.where("k % 307 <> 0").withColumn("number_2d", F.when(F.col("k") % 211 == 0, "A1").otherwise(F.col("number_2d")))
    return kept.unionByName(rows.where("k % 313 = 0"))


def _checks(profile, fact, loto, keys):
    place = f"{keys}, prize_group, prize_order"
    groups = "\nUNION ALL ".join(
        f"SELECT '{g}-count' AS check_name, count(*) FILTER (n <> {c}) AS n FROM (SELECT {keys}, count(*) FILTER (prize_group = '{g}') AS n FROM {fact} GROUP BY {keys})"
        for g, c, _ in profile.groups)
    total = profile.prize_count
    return f"""
SELECT 'requested-date-validated' AS check_name, 0 AS n
UNION ALL {groups}
UNION ALL SELECT unnest(['total-result-count', 'fact-draw-result-row-count']), count(*) FILTER (n <> {total}) FROM (SELECT count(*) AS n FROM {fact} GROUP BY {keys})
UNION ALL SELECT 'prize-value-range', count(*) FROM {fact} WHERE full_number >= pow(10, prize_width)
UNION ALL SELECT 'draw-date-not-future', count(DISTINCT ({keys},)) FROM {fact} WHERE draw_date > DATE '2001-06-30'
UNION ALL SELECT unnest(['fact-loto-daily-row-count', 'loto-frequency-sum', 'loto-number-coverage']),
  unnest([count(*) FILTER (n <> 100), count(*) FILTER (s <> {total}), count(*) FILTER (n <> 100 OR v <> 100)])
  FROM (SELECT count(*) AS n, sum(frequency) AS s, count(DISTINCT number_2d) FILTER (number_2d SIMILAR TO '[0-9][0-9]') AS v FROM {loto} GROUP BY {keys})
UNION ALL SELECT 'loto-business-key-unique', coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {loto} GROUP BY {keys}, number_2d HAVING count(*) > 1)
UNION ALL SELECT 'draw-business-key-unique', count(*) FROM (SELECT 1 FROM {fact} GROUP BY {place} HAVING count(*) > 1)
UNION ALL SELECT 'unclassified-calendar-gaps', count(*) FROM dimdate WHERE draw_status = 'missing'
UNION ALL SELECT 'gold-run-id-consistent', (SELECT count(*) FROM {fact} WHERE run_id <> 'run-0001')
  + 100 * (SELECT count(*) FROM {'draws' if profile is STATION else 'drawsday'} WHERE draw_date = DATE '1996-03-01')"""


def _report(body):
    return f"""SELECT check_name, CASE WHEN check_name = 'unclassified-calendar-gaps' THEN 'warning' ELSE 'critical' END AS severity,
  CAST(n AS BIGINT) AS finding_count, n = 0 AS passed FROM ({body})"""


STATION_CHECKS = _checks(STATION, "qfact", "qgrid", "station_code, draw_date") + """
UNION ALL SELECT 'station-count-per-day', count(DISTINCT draw_date) FROM (
  SELECT coalesce(e.draw_date, a.draw_date) AS draw_date FROM (SELECT * FROM expectedset WHERE draw_date IN (SELECT draw_date FROM drawsday)) e
  FULL OUTER JOIN draws a ON a.draw_date = e.draw_date AND a.station_code = e.station_code WHERE e.draw_date IS NULL OR a.draw_date IS NULL)
UNION ALL SELECT 'station-code-unique-per-day', count(*) FROM (SELECT 1 FROM fact GROUP BY draw_date, station_code HAVING count(DISTINCT station_name) > 1)"""


def published_tables(spark, sf, fact, profile):
    """All published tables that carry a run id; the dense fact has one draw day of an older run."""
    loto = grid.loto_daily(counts_of(spark, sf, profile), profile, RUN_ID)
    mixed = loto.withColumn("run_id", F.when(F.col("draw_date") == F.lit("1996-03-01").cast("date"), "run-old").otherwise(F.col("run_id")))
    return [fact, mixed, facts.special_prize(fact, profile)]


def station_report(spark, sf):
    (fact,) = store(spark, damaged_fact(spark, sf))
    drawn = sessions_drawn(spark, sf).select("draw_date", "station_code").distinct()
    expected = expected_sets(spark, sf).join(drawn.select("draw_date").distinct(), "draw_date", "left_semi").drop("region")
    mismatch = calendars.set_mismatch(drawn, expected, ["draw_date", "station_code"])
    statuses = marts.dim_date(drawn).select("date", F.col("draw_status").alias("status"))
    return quality.quality_report(
        fact, damaged_grid(spark, sf), statuses, STATION, RUN_ID, "2001-06-30", mismatch, published_tables(spark, sf, fact, STATION))


def daily_report(spark, sf):
    (fact,) = store(spark, damaged_fact(spark, sf, DAILY))
    statuses = marts.dim_date(sessions_drawn(spark, sf)).select("date", F.col("draw_status").alias("status"))
    return quality.quality_report(
        fact, damaged_grid(spark, sf, DAILY), statuses, DAILY, RUN_ID, "2001-06-30", None, published_tables(spark, sf, fact, DAILY))


query("quality_report", _report(STATION_CHECKS))(station_report)
query("quality_report_no_station", _report(_checks(DAILY, "qfactday", "qgridday", "draw_date")))(daily_report)


@query("quality_gate", f"""
SELECT count(*) FILTER (NOT passed AND severity = 'critical') AS critical_failures, count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
  count(*) FILTER (NOT passed AND severity = 'critical') = 0 AS passed FROM ({_report(STATION_CHECKS)})""")
def _(spark, sf):
    return quality.quality_gate(station_report(spark, sf))


@query("quality_row_counts", "SELECT station_code, draw_date, count(*) AS row_count FROM fact GROUP BY ALL HAVING count(*) <> 18")
def _(spark, sf):
    return quality.row_counts(draw_fact(spark, sf), STATION, STATION.prize_count)


@query("quality_freq_sum", """
SELECT station_code, draw_date, count(*) AS row_count, CAST(sum(frequency) AS BIGINT) AS frequency_sum FROM qgrid GROUP BY ALL
HAVING count(*) <> 100 OR sum(frequency) <> 18""")
def _(spark, sf):
    return quality.frequency_sums(damaged_grid(spark, sf), STATION, STATION.prize_count)


@query("quality_dup_keys", """
SELECT draw_date, station_code, prize_group, prize_order, count(*) AS duplicate_count FROM qfact GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    return quality.duplicate_keys(damaged_fact(spark, sf), ["draw_date", "station_code", "prize_group", "prize_order"])


@query("quality_coverage", """
SELECT station_code, draw_date, count(*) AS row_count, count(DISTINCT number_2d) FILTER (number_2d SIMILAR TO '[0-9][0-9]') AS valid_numbers FROM qgrid GROUP BY ALL
HAVING count(*) <> 100 OR count(DISTINCT number_2d) FILTER (number_2d SIMILAR TO '[0-9][0-9]') <> 100""")
def _(spark, sf):
    return quality.coverage(damaged_grid(spark, sf), STATION)


# ---- history audit

START, END = "1996-01-01", "2000-12-31"
IN_RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"

cte("afact", """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'bad-date' ELSE CAST(draw_date AS VARCHAR) END AS draw_date,
  TRY_CAST(CASE WHEN l_orderkey % 97 = 0 THEN 'bad-date' ELSE CAST(draw_date AS VARCHAR) END AS DATE) AS d,
  station_code, CASE WHEN l_orderkey % 67 = 0 THEN 'prize9' ELSE prize_group END AS prize_group,
  CASE WHEN l_orderkey % 101 = 0 THEN '1' WHEN l_orderkey % 103 = 0 THEN '1.5' ELSE CAST(prize_order AS VARCHAR) END AS prize_order,
  prize_width + CASE WHEN l_orderkey % 61 = 0 THEN 1 ELSE 0 END AS prize_width,
  CASE WHEN l_orderkey % 79 = 0 THEN NULL ELSE CAST(full_number AS VARCHAR) END AS full_number,
  CASE WHEN l_orderkey % 73 = 0 THEN 'x' || formatted_number ELSE formatted_number END AS formatted_number,
  loto_2d, tens_digit + CASE WHEN l_orderkey % 71 = 0 THEN 1 ELSE 0 END AS tens_digit, ones_digit,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL WHEN l_orderkey % 83 = 0 THEN 'run-old' ELSE run_id END AS run_id
FROM fact""")
cte("aloto1", """
SELECT CASE WHEN k % 301 = 0 THEN 'bad' ELSE CAST(draw_date AS VARCHAR) END AS draw_date,
  TRY_CAST(CASE WHEN k % 301 = 0 THEN 'bad' ELSE CAST(draw_date AS VARCHAR) END AS DATE) AS d, station_code,
  CASE WHEN k % 311 = 0 THEN 'A1' ELSE number_2d END AS number_2d,
  CASE WHEN k % 313 = 0 THEN NULL WHEN k % 317 = 0 THEN '-1' ELSE CAST(frequency AS VARCHAR) END AS frequency,
  CAST(CASE WHEN k % 331 = 0 THEN frequency = 0 ELSE frequency > 0 END AS VARCHAR) AS appeared,
  CASE WHEN k % 337 = 0 THEN NULL ELSE 'run-0001' END AS run_id, k
FROM (SELECT *, dayofyear(draw_date) * 100 + CAST(number_2d AS BIGINT) AS k FROM grid)
WHERE dayofyear(draw_date) NOT IN (103, 206, 309)""")
cte("aloto", "SELECT * FROM aloto1 UNION ALL SELECT * FROM aloto1 WHERE k % 347 = 0")
cte("adate1", """
SELECT CASE WHEN e % 61 = 0 THEN 'bad' ELSE CAST(date AS VARCHAR) END AS date, TRY_CAST(CASE WHEN e % 61 = 0 THEN 'bad' ELSE CAST(date AS VARCHAR) END AS DATE) AS d,
  CASE WHEN e % 47 = 0 THEN 'weird' WHEN e % 43 = 0 THEN 'failed' WHEN e % 41 = 0 THEN NULL WHEN e % 37 = 0 THEN 'no_draw' ELSE draw_status END AS draw_status, e
FROM (SELECT *, dayofyear(date) + year AS e FROM dimdate) WHERE e % 53 <> 0""")
cte("adate", "SELECT * FROM adate1 UNION ALL SELECT * FROM adate1 WHERE e % 59 = 0")
cte("astatus", f"""
SELECT x.day, a.draw_status AS raw, a.d IS NOT NULL AS present, CASE WHEN a.draw_status IN ('success', 'no_draw', 'missing', 'failed') THEN a.draw_status ELSE 'missing' END AS status
FROM (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS day) x
LEFT JOIN (SELECT DISTINCT d, draw_status FROM adate WHERE d IS NOT NULL) a ON a.d = x.day""")
cte("astation1", """
SELECT CASE WHEN n % 5 = 4 THEN lower(station_code) ELSE station_code END AS station_code,
  CASE WHEN n % 5 = 3 THEN NULL WHEN n % 5 = 1 THEN first_draw_date + 1 ELSE first_draw_date END AS first_draw_date, latest_draw_date, n
FROM (SELECT *, CAST(substr(station_code, 2) AS BIGINT) AS n FROM dimstation)""")
cte("astation", "SELECT * FROM astation1 UNION ALL SELECT * FROM astation1 WHERE n % 5 = 2")
_OBJ = "'gold/releases/run-id=run-0001/part-' || CAST(o_orderkey AS VARCHAR)"
cte("amanifest1", f"""
SELECT CASE WHEN o_orderkey % 223 = 0 THEN 'gold/latest/part-' || CAST(o_orderkey AS VARCHAR) ELSE {_OBJ} END AS key,
  CAST(o_custkey * 1000 + o_orderkey % 1000 AS BIGINT) AS size, sha256(CAST(o_orderkey AS VARCHAR)) AS sha256, o_orderkey
FROM orders WHERE o_orderkey % 199 <> 0""")
cte("amanifest", "SELECT * FROM amanifest1 UNION ALL SELECT * FROM amanifest1 WHERE o_orderkey % 211 = 0")
cte("astore", f"""
SELECT CASE WHEN o_orderkey % 223 = 0 THEN 'gold/latest/part-' || CAST(o_orderkey AS VARCHAR) ELSE {_OBJ} END AS key,
  CAST(o_custkey * 1000 + o_orderkey % 1000 + CASE WHEN o_orderkey % 193 = 0 THEN 1 ELSE 0 END AS BIGINT) AS size,
  sha256(CAST(o_orderkey + CASE WHEN o_orderkey % 191 = 0 THEN 1 ELSE 0 END AS VARCHAR)) AS sha256
FROM orders WHERE o_orderkey % 197 <> 0""")
cte("achecked", """
SELECT key, refs, asize, CASE WHEN refs IS NULL THEN 'unreferenced' WHEN refs > 1 THEN 'duplicate_reference' WHEN asize IS NULL THEN 'missing'
  WHEN asize <> esize THEN 'size' WHEN asha <> esha THEN 'sha256' END AS issue
FROM (SELECT coalesce(m.key, s.key) AS key, m.refs, m.esize, m.esha, s.size AS asize, s.sha256 AS asha
  FROM (SELECT key, count(*) AS refs, min(size) AS esize, min(sha256) AS esha FROM amanifest GROUP BY 1) m FULL OUTER JOIN astore s ON s.key = m.key)""")


def objects(spark, sf):
    """Manifest references, stored objects and required keys, one per order, partly damaged."""
    key = F.col("o_orderkey")
    path = F.concat(F.when(key % 223 == 0, "gold/latest/part-").otherwise("gold/releases/run-id=run-0001/part-"), key.cast("string"))
    size = F.col("o_custkey") * 1000 + key % 1000
    rows = table(spark, sf, "orders")
    named = rows.where(key % 199 != 0).select(path.alias("key"), size.alias("size"), F.sha2(key.cast("string").cast("binary"), 256).alias("sha256"), key)
    manifest = named.unionByName(named.where(key % 211 == 0)).drop("o_orderkey")
    store = rows.where(key % 197 != 0).select(
        path.alias("key"), (size + F.when(key % 193 == 0, 1).otherwise(0)).alias("size"),
        F.sha2((key + F.when(key % 191 == 0, 1).otherwise(0)).cast("string").cast("binary"), 256).alias("sha256"))
    return manifest, store, rows.select(path.alias("key"))


def damaged_dates(spark, sf):
    e = F.dayofyear("date") + F.col("year")
    rows = marts.dim_date(sessions_drawn(spark, sf)).withColumn("e", e).where("e % 53 <> 0").select(
        F.when(F.col("e") % 61 == 0, "bad").otherwise(F.col("date").cast("string")).alias("date"),
        F.when(F.col("e") % 47 == 0, "weird").when(F.col("e") % 43 == 0, "failed").when(F.col("e") % 41 == 0, F.lit(None))
        .when(F.col("e") % 37 == 0, "no_draw").otherwise(F.col("draw_status")).alias("draw_status"),
        F.lit(1).alias("seq"), "e")
    return rows.unionByName(rows.where("e % 59 = 0").withColumn("seq", F.lit(2))).drop("e")


def audit_fact(spark, sf):
    k = F.col("l_orderkey")
    return draw_fact(spark, sf, STATION, keep=("l_orderkey",)).select(
        F.when(k % 97 == 0, "bad-date").otherwise(F.col("draw_date").cast("string")).alias("draw_date"),
        "station_code",
        F.when(k % 67 == 0, "prize9").otherwise(F.col("prize_group")).alias("prize_group"),
        F.when(k % 101 == 0, "1").when(k % 103 == 0, "1.5").otherwise(F.col("prize_order").cast("string")).alias("prize_order"),
        (F.col("prize_width") + F.when(k % 61 == 0, 1).otherwise(0)).alias("prize_width"),
        F.when(k % 79 != 0, F.col("full_number").cast("string")).alias("full_number"),
        F.when(k % 73 == 0, F.concat(F.lit("x"), "formatted_number")).otherwise(F.col("formatted_number")).alias("formatted_number"),
        "loto_2d",
        (F.col("tens_digit") + F.when(k % 71 == 0, 1).otherwise(0)).alias("tens_digit"), "ones_digit",
        F.when(k % 89 == 0, F.lit(None)).when(k % 83 == 0, "run-old").otherwise(F.col("run_id")).alias("run_id"))


def audit_loto(spark, sf):
    k = F.col("k")
    # rows that stand twice are doubled in place: a union would compute the grid twice and lose that it lies by station
    twice = F.array_repeat(F.lit(True), F.when(k % 347 == 0, 2).otherwise(1))
    rows = grid.dense_grid(counts_of(spark, sf), STATION).withColumn(
        "k", F.dayofyear("draw_date") * 100 + F.col("number_2d").cast("long")).where(~F.dayofyear("draw_date").isin(103, 206, 309)).select(
        F.when(k % 301 == 0, "bad").otherwise(F.col("draw_date").cast("string")).alias("draw_date"), "station_code",
        F.when(k % 311 == 0, "A1").otherwise(F.col("number_2d")).alias("number_2d"),
        F.when(k % 313 == 0, F.lit(None)).when(k % 317 == 0, "-1").otherwise(F.col("frequency").cast("string")).alias("frequency"),
        F.when(k % 331 == 0, F.col("frequency") == 0).otherwise(F.col("frequency") > 0).cast("string").alias("appeared"),
        F.when(k % 337 != 0, F.lit("run-0001")).alias("run_id"), "k")
    return rows.select("*", F.explode(twice).alias("_again")).drop("k", "_again")


def damaged_stations(spark, sf):
    n = F.col("n")
    stations = sessions_drawn(spark, sf).groupBy("station_code").agg(
        F.min("draw_date").alias("first_draw_date"), F.max("draw_date").alias("latest_draw_date"))
    rows = stations.withColumn("n", F.substring("station_code", 2, 9).cast("long")).select(
        F.when(n % 5 == 4, F.lower("station_code")).otherwise(F.col("station_code")).alias("station_code"),
        F.when(n % 5 == 3, F.lit(None)).when(n % 5 == 1, F.date_add("first_draw_date", 1)).otherwise(F.col("first_draw_date")).alias("first_draw_date"),
        "latest_draw_date", "n")
    return rows.unionByName(rows.where("n % 5 = 2")).drop("n")


def store(spark, *frames):
    """Write frames that several checks read, and read them back."""
    path = fresh_dir(spark, "stored")
    for at, df in enumerate(frames):
        df.write.parquet(f"{path}/{at}")
    return [spark.read.parquet(f"{path}/{at}") for at in range(len(frames))]


def published(spark, sf, stored=False):
    """The damaged release. ``stored`` writes both facts first, for audits that read them many times."""
    tables = {
        "dates": lambda: damaged_dates(spark, sf), "fact": lambda: audit_fact(spark, sf), "loto": lambda: audit_loto(spark, sf),
        "stations": lambda: damaged_stations(spark, sf), "expected": lambda: expected_sets(spark, sf),
        "manifest": lambda: objects(spark, sf)[0], "store": lambda: objects(spark, sf)[1], "required": lambda: objects(spark, sf)[2],
    }
    if not stored:
        return audit.Published(STATION, RUN_ID, START, END, tables)
    fact, loto = store(spark, audit_fact(spark, sf), audit_loto(spark, sf))
    tables |= {"fact": lambda: fact, "loto": lambda: loto}
    return audit.Published(STATION, RUN_ID, START, END, tables, lambda df: store(spark, df)[0])


_FR = f"(SELECT * FROM afact WHERE d {IN_RANGE})"
_LR = f"(SELECT * FROM aloto WHERE d {IN_RANGE})"
_KEY = "CAST(d AS VARCHAR) || '/' || station_code"
_FKEY = _KEY + " || '/' || prize_group || '/' || prize_order"
_LKEY = _KEY + " || '/' || number_2d"
_DAY = "CAST(day AS VARCHAR)"
_HASF = f"day IN (SELECT d FROM {_FR})"
_HASL = f"day IN (SELECT d FROM {_LR})"
_ANY = f"({_HASF} OR {_HASL})"
_WIDTH = "CASE prize_group WHEN 'prize8' THEN 2 WHEN 'prize7' THEN 3 WHEN 'prize6' THEN 4 WHEN 'prize5' THEN 4 WHEN 'special' THEN 6 WHEN 'prize9' THEN NULL ELSE 5 END"
_COUNT = "CASE prize_group WHEN 'prize3' THEN 2 WHEN 'prize4' THEN 7 WHEN 'prize6' THEN 3 WHEN 'prize9' THEN 0 ELSE 1 END"
_EXP = f"(SELECT draw_date AS d, station_code FROM expectedset WHERE draw_date IN (SELECT day FROM astatus WHERE status = 'success'))"


def _setdiff(rows):
    actual = f"(SELECT DISTINCT d, station_code FROM {rows} WHERE d IN (SELECT day FROM astatus WHERE status = 'success'))"
    return f"SELECT d FROM ((SELECT * FROM {actual} EXCEPT SELECT * FROM {_EXP}) UNION ALL (SELECT * FROM {_EXP} EXCEPT SELECT * FROM {actual}))"


RULE_SQL = {
    "lake-publication-invalid": """SELECT 'outside ' || key AS txt FROM amanifest WHERE NOT starts_with(key, 'gold/releases/run-id=run-0001/')
      UNION ALL SELECT issue || ' ' || key FROM achecked WHERE issue IN ('missing', 'size', 'sha256')
      UNION ALL SELECT 'duplicate object keys' WHERE EXISTS (SELECT 1 FROM achecked WHERE issue = 'duplicate_reference')""",
    "gold-reference-duplicate": "SELECT key AS txt FROM achecked WHERE issue = 'duplicate_reference'",
    "gold-reference-missing": "SELECT key AS txt FROM (SELECT CASE WHEN o_orderkey % 223 = 0 THEN 'gold/latest/part-' || CAST(o_orderkey AS VARCHAR) ELSE "
        + _OBJ + " END AS key FROM orders) WHERE key NOT IN (SELECT key FROM amanifest)",
    "gold-object-missing": "SELECT key AS txt FROM achecked WHERE issue = 'missing'",
    "gold-object-size-mismatch": "SELECT key AS txt FROM achecked WHERE issue = 'size'",
    "gold-object-checksum-mismatch": "SELECT key AS txt FROM achecked WHERE issue = 'sha256'",
    "dim-date-values-invalid": "SELECT date AS txt FROM adate WHERE d IS NULL",
    "dim-date-business-key-duplicate": f"SELECT CAST(d AS VARCHAR) AS txt FROM adate WHERE d {IN_RANGE} GROUP BY d HAVING count(*) > 1",
    "dim-date-calendar-gap": f"SELECT {_DAY} AS txt FROM astatus WHERE NOT present",
    "draw-status-invalid": f"SELECT {_DAY} AS txt FROM astatus WHERE raw = 'weird'",
    "draw-status-missing": f"SELECT {_DAY} AS txt FROM astatus WHERE status = 'missing'",
    "draw-status-failed": f"SELECT {_DAY} AS txt FROM astatus WHERE status = 'failed'",
    "fact-run-id-mismatch": """SELECT draw_date || '/' || station_code || '/' || prize_group || '/' || prize_order || '/' || coalesce(run_id, '<null>') AS txt
      FROM afact WHERE run_id IS DISTINCT FROM 'run-0001'""",
    "loto-run-id-mismatch": "SELECT draw_date || '/' || station_code || '/' || number_2d || '/' || coalesce(run_id, '<null>') AS txt FROM aloto WHERE run_id IS DISTINCT FROM 'run-0001'",
    "fact-draw-date-invalid": "SELECT draw_date || '/' || station_code || '/' || prize_group || '/' || prize_order AS txt FROM afact WHERE d IS NULL",
    "loto-draw-date-invalid": "SELECT draw_date || '/' || station_code || '/' || number_2d AS txt FROM aloto WHERE d IS NULL",
    "success-date-missing-draw-facts": f"SELECT {_DAY} AS txt FROM astatus WHERE status = 'success' AND NOT {_HASF}",
    "success-date-missing-loto-facts": f"SELECT {_DAY} AS txt FROM astatus WHERE status = 'success' AND NOT {_HASL}",
    "no-draw-has-facts": f"SELECT {_DAY} AS txt FROM astatus WHERE status = 'no_draw' AND {_ANY}",
    "incomplete-date-has-facts": f"SELECT {_DAY} AS txt FROM astatus WHERE status IN ('missing', 'failed') AND {_ANY}",
    "fact-business-key-duplicate": f"SELECT {_FKEY} AS txt FROM (SELECT *, count(*) OVER (PARTITION BY d, station_code, prize_group, prize_order) AS n FROM {_FR}) WHERE n > 1",
    "fact-row-count-invalid": f"SELECT {_KEY} || '=' || CAST(count(*) AS VARCHAR) AS txt FROM {_FR} GROUP BY d, station_code HAVING count(*) <> 18",
    "fact-prize-layout-invalid": f"""SELECT {_KEY} AS txt FROM {_FR} GROUP BY d, station_code
      HAVING count(DISTINCT (prize_group, prize_order)) FILTER (prize_order <> '1.5' AND TRY_CAST(prize_order AS BIGINT) <= {_COUNT}) <> 18
        OR count(*) FILTER (prize_order <> '1.5' AND TRY_CAST(prize_order AS BIGINT) > {_COUNT}) > 0""",
    "fact-prize-integrity-invalid": f"""SELECT {_FKEY} AS txt FROM {_FR} WHERE NOT coalesce(prize_group <> 'prize9' AND prize_order <> '1.5' AND prize_width = {_WIDTH}
      AND CAST(full_number AS BIGINT) < pow(10, {_WIDTH}) AND formatted_number = lpad(full_number, CAST({_WIDTH} AS INTEGER), '0') AND loto_2d = right(formatted_number, 2)
      AND tens_digit = CAST(substr(loto_2d, 1, 1) AS BIGINT), false)""",
    "loto-business-key-duplicate": f"SELECT {_LKEY} AS txt FROM (SELECT *, count(*) OVER (PARTITION BY d, station_code, number_2d) AS n FROM {_LR}) WHERE n > 1",
    "loto-row-count-invalid": f"SELECT {_KEY} || '=' || CAST(count(*) AS VARCHAR) AS txt FROM {_LR} GROUP BY d, station_code HAVING count(*) <> 100",
    "loto-number-invalid": f"SELECT {_LKEY} AS txt FROM {_LR} WHERE number_2d = 'A1'",
    "loto-number-coverage-invalid": f"""SELECT {_KEY} AS txt FROM {_LR} GROUP BY d, station_code
      HAVING count(DISTINCT number_2d) FILTER (number_2d <> 'A1') <> 100 OR count(*) FILTER (number_2d = 'A1') > 0""",
    "loto-frequency-invalid": f"SELECT {_LKEY} AS txt FROM {_LR} WHERE frequency IS NULL OR CAST(frequency AS BIGINT) < 0",
    "loto-frequency-sum-invalid": f"""SELECT {_KEY} || '=' || coalesce(CAST(sum(CAST(frequency AS BIGINT)) AS VARCHAR), '<null>') AS txt FROM {_LR} GROUP BY d, station_code
      HAVING sum(CAST(frequency AS BIGINT)) IS DISTINCT FROM 18""",
    "loto-appeared-invalid": f"SELECT {_LKEY} AS txt FROM {_LR} WHERE CAST(appeared AS BOOLEAN) <> coalesce(CAST(frequency AS BIGINT) > 0, false)",
    "loto-frequency-fact-mismatch": f"""SELECT CAST(l.d AS VARCHAR) || '/' || l.station_code || '/' || l.number_2d AS txt FROM {_LR} l
      LEFT JOIN (SELECT d, station_code, loto_2d, count(*) AS n FROM {_FR} GROUP BY ALL) f ON f.d = l.d AND f.station_code = l.station_code AND f.loto_2d = l.number_2d
      WHERE CAST(l.frequency AS BIGINT) IS DISTINCT FROM coalesce(f.n, 0)""",
    "station-set-mismatch": f"SELECT DISTINCT CAST(d AS VARCHAR) AS txt FROM ({_setdiff(_FR)} UNION ALL {_setdiff(_LR)})",
    "dim-station-code-invalid": "SELECT station_code AS txt FROM astation WHERE NOT regexp_full_match(station_code, '[A-Z0-9]{2,8}')",
    "dim-station-business-key-duplicate": "SELECT station_code AS txt FROM astation GROUP BY 1 HAVING count(*) > 1",
    "dim-station-range-invalid": "SELECT station_code AS txt FROM astation WHERE first_draw_date IS NULL OR latest_draw_date IS NULL OR first_draw_date > latest_draw_date",
    "dim-station-code-set-mismatch": """SELECT 'missing ' || station_code AS txt FROM (SELECT DISTINCT station_code FROM afact EXCEPT SELECT station_code FROM astation)
      UNION ALL SELECT 'extra ' || station_code FROM (SELECT station_code FROM astation EXCEPT SELECT station_code FROM afact)""",
    "dim-station-range-mismatch": """SELECT s.station_code || '/' || CAST(a AS VARCHAR) || '/' || CAST(b AS VARCHAR) AS txt FROM astation s
      JOIN (SELECT station_code, min(d) AS a, max(d) AS b FROM afact WHERE d IS NOT NULL GROUP BY 1) f ON f.station_code = s.station_code
      WHERE s.first_draw_date IS NOT NULL AND (s.first_draw_date <> a OR s.latest_draw_date <> b)""",
}


def _finding_sql(code):
    count = "least(count(*), 1)" if code in audit.SINGLE else "count(*)"
    return f"""SELECT '{code}' AS code, 'critical' AS severity, count(*) = 0 AS passed, {count} AS finding_count,
  (SELECT string_agg(txt, '; ' ORDER BY txt) FROM (SELECT txt FROM ({RULE_SQL[code]}) ORDER BY txt LIMIT 25)) AS samples
FROM ({RULE_SQL[code]})"""


def _register(code):
    # offences are stored, so that counting them and taking samples do not work them out twice
    query("audit_" + code.replace("-", "_"), _finding_sql(code))(
        lambda spark, sf: audit.findings(published(spark, sf), [code], fresh_dir(spark, "offences")))


for _code in audit.RULES:
    _register(_code)


@query("audit_samples", "\nUNION ALL ".join(_finding_sql(c) for c in ("fact-draw-date-invalid", "fact-run-id-mismatch", "loto-number-invalid")))
def _(spark, sf):
    return audit.findings(published(spark, sf), ["fact-draw-date-invalid", "fact-run-id-mismatch", "loto-number-invalid"])


@query("history_audit", "\nUNION ALL ".join(_finding_sql(c) for c in audit.RULES))
def _(spark, sf):
    return audit.findings(published(spark, sf, stored=True), list(audit.RULES), fresh_dir(spark, "offences"))


@query("release_integrity", "SELECT key, issue FROM achecked WHERE issue IS NOT NULL")
def _(spark, sf):
    manifest, store, _required = objects(spark, sf)
    return state.release_integrity(manifest, store).where("issue is not null").select("key", "issue")


@query("lake_object_stats", """
SELECT count(*) AS object_count, count(*) FILTER (issue IS NULL) AS verified_object_count, CAST(sum(asize) AS BIGINT) AS total_size_bytes
FROM achecked WHERE refs IS NOT NULL""")
def _(spark, sf):
    manifest, store, _required = objects(spark, sf)
    return state.lake_object_stats(state.release_integrity(manifest, store))
