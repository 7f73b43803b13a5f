"""Ranking models, walk-forward backtests, bootstrap intervals and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import STATION, sessions
from urndraw.operators import rank
from urndraw.plans.q_facts import counts_of
from urndraw.plans.registry import cte, query
from urndraw.spec import BOOTSTRAP_SAMPLES, EVALUATION_LIMIT, MODEL_KINDS, MODEL_WINDOWS, TOP_K

KEYS = ["station_code", "kind", "window"]
CONFIG = {"dataset": "given", "evaluation_limit": EVALUATION_LIMIT, "samples": BOOTSTRAP_SAMPLES, "top_k": TOP_K}
_W = "PARTITION BY station_code, number_2d ORDER BY draw_date"


def _series_sql(windows, kinds, limit, top_k=TOP_K, where="true"):
    """Walk-forward series with explicit training frames."""
    parts = []
    for w in windows:
        score = {
            "frequency": "fs", "gap": "gs", "balanced": "fs * 0.6::DOUBLE + gs * 0.4::DOUBLE",
        }
        features = f"""
SELECT *, CAST(f AS DOUBLE) / CAST(greatest(max(f) OVER d, 1) AS DOUBLE) AS fs, CAST(g AS DOUBLE) / CAST(greatest(max(g) OVER d, 1) AS DOUBLE) AS gs
FROM (SELECT station_code, draw_date, draw_position, number_2d, frequency,
    coalesce(sum(frequency) OVER ({_W} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0) AS f,
    CASE WHEN draws_since_previous IS NULL OR draws_since_previous > {w} THEN {w} ELSE draws_since_previous - 1 END AS g,
    lag(draw_date, {w}) OVER ({_W}) AS training_from, lag(draw_date, 1) OVER ({_W}) AS training_to FROM loto)
WHERE draw_position > {w} AND {where} WINDOW d AS (PARTITION BY station_code, draw_date)"""
        for kind in kinds:
            parts.append(f"""
SELECT station_code, draw_date AS evaluation_date, max(training_from) AS training_from, max(training_to) AS training_to, '{kind}' AS kind,
  CAST({w} AS BIGINT) AS "window", CAST(sum(CASE WHEN r <= {top_k} THEN frequency ELSE 0 END) AS BIGINT) AS covered_results,
  CAST(sum(frequency) AS BIGINT) AS total_results, max(draw_position) AS p
FROM (SELECT *, row_number() OVER (PARTITION BY station_code, draw_date ORDER BY s DESC, f DESC, number_2d) AS r
  FROM (SELECT *, {score[kind]} AS s FROM ({features})))
GROUP BY station_code, draw_date""")
    body = "\nUNION ALL ".join(parts)
    if limit is None:
        return f"SELECT * EXCLUDE (p) FROM ({body})"
    return f'SELECT * EXCLUDE (p, newest) FROM (SELECT *, max(p) OVER (PARTITION BY station_code, kind, "window") AS newest FROM ({body})) WHERE newest - p < {limit}'


cte("series", _series_sql(MODEL_WINDOWS, MODEL_KINDS, EVALUATION_LIMIT))
cte("series30", _series_sql((30,), MODEL_KINDS, None))


def series(spark, sf, **options):
    options = {"windows": MODEL_WINDOWS, **options}
    return rank.walk_forward(counts_of(spark, sf), STATION, **options)


cte("train90", """
SELECT station_code, number_2d, CAST(sum(frequency) FILTER (draw_index <= 90) AS BIGINT) AS frequency,
  least(coalesce(min(draw_index) FILTER (frequency > 0 AND draw_index <= 90) - 1, 90), 90) AS gap FROM back GROUP BY ALL""")
cte("scores90", """
SELECT *, CAST(frequency AS DOUBLE) / CAST(greatest(max(frequency) OVER d, 1) AS DOUBLE) AS frequency_score,
  CAST(gap AS DOUBLE) / CAST(greatest(max(gap) OVER d, 1) AS DOUBLE) AS gap_score,
  CAST(frequency AS DOUBLE) / CAST(greatest(max(frequency) OVER d, 1) AS DOUBLE) * 0.6::DOUBLE
    + CAST(gap AS DOUBLE) / CAST(greatest(max(gap) OVER d, 1) AS DOUBLE) * 0.4::DOUBLE AS balanced_score
FROM train90 WINDOW d AS (PARTITION BY station_code)""")


@query("model_scores", "SELECT * FROM scores90")
def _(spark, sf):
    return rank.model_scores(counts_of(spark, sf), STATION, 90)


@query("pick_top_k", """
SELECT station_code, number_2d, frequency, gap, balanced_score AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY station_code ORDER BY balanced_score DESC, frequency DESC, number_2d) AS rank FROM scores90) WHERE rank <= 10""")
def _(spark, sf):
    return rank.current_picks(counts_of(spark, sf), STATION, "balanced", 90)


@query("walk_forward", "SELECT * FROM series30 WHERE kind = 'balanced'")
def _(spark, sf):
    return series(spark, sf, windows=(30,), kinds=("balanced",), limit=None)


@query("evaluation_slice", _series_sql((90,), ("gap",), 60, 5, "draw_date BETWEEN DATE '1999-01-01' AND DATE '1999-06-30'"))
def _(spark, sf):
    return series(spark, sf, windows=(90,), kinds=("gap",), limit=60, top_k=5, start="1999-01-01", end="1999-06-30")


def _summary_sql(source, extra=""):
    return f"""
SELECT station_code, kind, "window", evaluation_count, covered_results, total_results, hit_count, training_from, training_to, evaluation_from, evaluation_to,
  coverage, CAST(hit_count AS DOUBLE) / CAST(evaluation_count AS DOUBLE) AS hit_rate, 0.1::DOUBLE AS baseline, coverage / 0.1::DOUBLE AS lift {extra}
FROM (SELECT *, CAST(covered_results AS DOUBLE) / CAST(total_results AS DOUBLE) AS coverage FROM (
  SELECT station_code, kind, "window", count(*) AS evaluation_count, CAST(sum(covered_results) AS BIGINT) AS covered_results,
    CAST(sum(total_results) AS BIGINT) AS total_results, count(*) FILTER (covered_results > 0) AS hit_count, min(training_from) AS training_from,
    max(training_to) AS training_to, min(evaluation_date) AS evaluation_from, max(evaluation_date) AS evaluation_to
  FROM {source} GROUP BY station_code, kind, "window"))"""


@query("backtest_summary", _summary_sql("series30"))
def _(spark, sf):
    return rank.backtest_summary(series(spark, sf, windows=(30,), limit=None), STATION)


@query("model_grid", _summary_sql("series", ", CAST(12 AS BIGINT) AS configurations"))
def _(spark, sf):
    size = len(MODEL_KINDS) * len(MODEL_WINDOWS)
    return rank.backtest_summary(series(spark, sf), STATION).withColumn("configurations", F.lit(size).cast("long"))


cte("prints", """
SELECT station_code, kind, "window", list(row(covered_results, total_results) ORDER BY evaluation_date) AS points,
  sha256('urndraw-1|dataset=given|evaluation_limit=90|samples=2000|top_k=10|' || station_code || '|' || kind || '|' || CAST("window" AS VARCHAR) || '|'
    || string_agg(CAST(evaluation_date AS VARCHAR) || ':' || CAST(covered_results AS VARCHAR) || ':' || CAST(total_results AS VARCHAR), ',' ORDER BY evaluation_date)) AS fingerprint,
  list(CAST(covered_results AS DOUBLE) / CAST(total_results AS DOUBLE) ORDER BY evaluation_date) AS coverages,
  list(evaluation_date ORDER BY evaluation_date) AS dates
FROM series GROUP BY station_code, kind, "window" """)


def marked(spark, sf, **options):
    return rank.with_fingerprint(rank.pack_series(series(spark, sf, **options), KEYS), KEYS, CONFIG)


@query("fingerprint", 'SELECT station_code, kind, "window", fingerprint FROM prints')
def _(spark, sf):
    return marked(spark, sf).select(*KEYS, "fingerprint")


def _imul(a, b):
    return f"((({a}) & 65535) * ({b}) + ((((({a}) >> 16) * ({b})) & 65535) * 65536)) & 4294967295"


def _draws_sql(source, keys):
    """Random draw positions: state of draw k is seed + (k + 1) * step."""
    return f"""
SELECT *, CAST(floor((xor(v2, v2 >> 14)) / 4294967296.0::DOUBLE * n) AS BIGINT) + 1 AS pick FROM (
 SELECT *, xor(v1, (v1 + ({_imul('xor(v1, v1 >> 7)', 'v1 | 61')})) & 4294967295) AS v2 FROM (
  SELECT *, {_imul('xor(st, st >> 15)', 'st | 1')} AS v1 FROM (
   SELECT {keys}, n, s.range AS sample, i.range AS i, (seed + (s.range * n + i.range + 1) * 1831565813) & 4294967295 AS st
   FROM {source} CROSS JOIN range(2000) s CROSS JOIN range(90) i WHERE i.range < n)))"""


# linear interpolation between order statistics, from the nearer one
_AT = "CAST(floor({p}::DOUBLE * 1999) AS BIGINT)"
_T = "({p}::DOUBLE * 1999 - floor({p}::DOUBLE * 1999))"
_PCT = f"""CASE WHEN {_T} < 0.5 THEN l[{_AT} + 1] + (l[{_AT} + 2] - l[{_AT} + 1]) * {_T}
  ELSE l[{_AT} + 2] - (l[{_AT} + 2] - l[{_AT} + 1]) * (1 - {_T}) END"""
cte("seeds", """
SELECT *, len(points) AS n, CASE WHEN seed0 = 0 THEN 1831565813 ELSE seed0 END AS seed
FROM (SELECT *, CAST('0x' || substr(fingerprint, 1, 8) AS BIGINT) AS seed0 FROM prints)""")


@query("bootstrap_ci", f"""
SELECT station_code, kind, "window", fingerprint, CAST(2000 AS BIGINT) AS samples, {_PCT.format(p='0.025')} AS lower, {_PCT.format(p='0.975')} AS upper
FROM (SELECT station_code, kind, "window", fingerprint, list(e ORDER BY e) AS l FROM (
  SELECT station_code, kind, "window", fingerprint, sample, CAST(sum(points[pick][1]) AS DOUBLE) / CAST(sum(points[pick][2]) AS DOUBLE) AS e
  FROM ({_draws_sql('seeds', 'station_code, kind, "window", fingerprint, points')}) GROUP BY station_code, kind, "window", fingerprint, sample)
  GROUP BY station_code, kind, "window", fingerprint)""")
def _(spark, sf):
    return rank.bootstrap_ci(marked(spark, sf), KEYS)


cte("pairdelta", """
SELECT a.station_code, len(a.dates) AS n, list_transform(list_zip(a.coverages, b.coverages), lambda z: z[1] - z[2]) AS deltas,
  sha256('compare|' || least(a.fingerprint, b.fingerprint) || '|' || greatest(a.fingerprint, b.fingerprint) || '|2000') AS fp
FROM prints a JOIN prints b ON b.station_code = a.station_code AND b.kind = 'frequency' AND b."window" = 30
WHERE a.kind = 'balanced' AND a."window" = 30""")
cte("pairseed", """
SELECT station_code, n, deltas, CAST('0x' || substr(fp, 1, 8) AS BIGINT) AS seed FROM pairdelta""")


@query("compare_models", f"""
SELECT d.station_code, true AS comparable, d.n AS evaluation_count, list_reduce(deltas, lambda x, y: x + y) / CAST(d.n AS DOUBLE) AS mean_coverage_delta,
  {_PCT.format(p='0.025')} AS lower, {_PCT.format(p='0.975')} AS upper,
  CAST(len(list_filter(deltas, lambda x: x > 0)) AS BIGINT) AS left_wins, CAST(len(list_filter(deltas, lambda x: x < 0)) AS BIGINT) AS right_wins,
  CAST(len(list_filter(deltas, lambda x: x = 0)) AS BIGINT) AS ties
FROM pairdelta d JOIN (SELECT station_code, list(e ORDER BY e) AS l FROM (
  SELECT station_code, sample, list_reduce(list(deltas[pick] ORDER BY i), lambda x, y: x + y) / CAST(count(*) AS DOUBLE) AS e
  FROM ({_draws_sql('pairseed', 'station_code, deltas')}) GROUP BY station_code, sample) GROUP BY station_code) c ON c.station_code = d.station_code""")
def _(spark, sf):
    every = marked(spark, sf, windows=(30,), kinds=("balanced", "frequency"))
    return rank.compare_models(every.where("kind = 'balanced'"), every.where("kind = 'frequency'"), STATION)


@query("paired_dates", """
SELECT coalesce(a.station_code, b.station_code) AS station_code, coalesce(a.evaluation_date, b.evaluation_date) AS evaluation_date,
  a.covered_results AS left_covered, a.total_results AS left_total, b.covered_results AS right_covered, b.total_results AS right_total,
  a.total_results IS NOT NULL AND b.total_results IS NOT NULL AS paired
FROM (SELECT * FROM series30 WHERE kind = 'balanced') a
FULL OUTER JOIN (SELECT * FROM series WHERE kind = 'frequency' AND "window" = 365) b ON a.station_code = b.station_code AND a.evaluation_date = b.evaluation_date""")
def _(spark, sf):
    left = series(spark, sf, windows=(30,), kinds=("balanced",), limit=None)
    right = series(spark, sf, windows=(365,), kinds=("frequency",))
    return rank.paired_dates(left, right, STATION)


@query("lineage_guard", """
SELECT station_code, count(*) AS draws, count(*) FILTER (n > 1) AS duplicate_dates, concat_ws(',', CASE WHEN count(*) FILTER (n > 1) > 0 THEN 'duplicate_dates' END,
  CASE WHEN count(*) <= 1700 THEN 'insufficient_history' END, CASE WHEN CAST(substr(station_code, 2) AS BIGINT) % 3 = 2 THEN 'unknown_station' END) AS problems
FROM (SELECT station_code, draw_date, count(*) AS n FROM sess GROUP BY 1, 2) GROUP BY station_code""")
def _(spark, sf):
    draws = sessions(spark, sf)
    known = draws.where("station_no % 3 <> 2").select("station_code").distinct()
    return rank.lineage_guard(draws.select("station_code", "draw_date"), STATION, 1700, known)


