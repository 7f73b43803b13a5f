"""Named queries and the SQL each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Shared table expressions of the check SQL, in dependency order.
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the shared expressions it mentions, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    if not needed:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed) + "\n" + body.strip()


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return build

    return wrap


STN = "o.o_custkey // 300"
cte("sess", f"""
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS draw_date, {STN} AS station_no,
  'S' || CAST({STN} AS VARCHAR) AS station_code,
  (CASE WHEN CAST(o.o_orderdate AS DATE) < DATE '1998-01-01' THEN 'Stn ' ELSE 'Station ' END) || CAST({STN} AS VARCHAR) AS station_name
FROM orders o""")
cte("obs", """
SELECT s.*, l.*, lpad(CAST(l.l_partkey % 100 AS VARCHAR), 2, '0') AS number_2d,
  CASE l.l_linenumber WHEN 1 THEN 'special' ELSE 'prize' || CAST(l.l_linenumber - 1 AS VARCHAR) END AS prize_group
FROM lineitem l JOIN sess s ON s.o_orderkey = l.l_orderkey""")
_PART = "(l_orderkey + l_partkey + l_suppkey) % 32, "
_ORDER = """l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""


def _fact(keys: str, widths: str, station: str, part: str = "") -> str:
    return f"""
SELECT draw_date, {station} prize_group, prize_order, prize_width, full_number, formatted_number,
  right(formatted_number, 2) AS loto_2d,
  CAST(substr(right(formatted_number, 2), 1, 1) AS BIGINT) AS tens_digit,
  CAST(right(formatted_number, 1) AS BIGINT) AS ones_digit,
  'https://draws.example/day/' || CAST(draw_date AS VARCHAR) AS source_url, 'run-0001' AS run_id, l_orderkey
FROM (SELECT *, lpad(CAST(full_number AS VARCHAR), CAST(prize_width AS INTEGER), '0') AS formatted_number
  FROM (SELECT *, CAST((l_orderkey * 31 + l_suppkey) % CAST(pow(10, prize_width - 2) AS BIGINT) * 100 + l_partkey % 100 AS BIGINT) AS full_number
    FROM (SELECT *, CAST({widths} AS BIGINT) AS prize_width,
        row_number() OVER (PARTITION BY {keys}, l_linenumber ORDER BY {part}{_ORDER}) AS prize_order
      FROM obs)))"""


cte("fact", _fact(
    "draw_date, station_code", "CASE l_linenumber WHEN 1 THEN 6 WHEN 6 THEN 4 WHEN 7 THEN 4 ELSE 5 END",
    "station_code, station_no + 1 AS station_order, station_name, 'https://draws.example/' || lower(station_code) AS station_url,"))
cte("factday", _fact(
    "draw_date", "CASE l_linenumber WHEN 5 THEN 4 WHEN 6 THEN 4 WHEN 7 THEN 3 ELSE 5 END", "", _PART))
cte("numbers", "SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS number_2d FROM range(100)")
cte("counts", """
SELECT station_code, draw_date, number_2d, count(*) AS frequency, max(station_name) AS station_name
FROM obs GROUP BY ALL""")
cte("countsday", "SELECT draw_date, number_2d, count(*) AS frequency FROM obs GROUP BY ALL")
cte("draws", "SELECT station_code, draw_date, max(station_name) AS station_name FROM obs GROUP BY ALL")
cte("drawsday", "SELECT DISTINCT draw_date FROM obs")
cte("grid", """
SELECT d.station_code, d.draw_date, d.station_name, n.number_2d, coalesce(c.frequency, 0) AS frequency
FROM draws d CROSS JOIN numbers n
LEFT JOIN counts c ON c.station_code = d.station_code AND c.draw_date = d.draw_date AND c.number_2d = n.number_2d""")
cte("gridday", """
SELECT d.draw_date, n.number_2d, coalesce(c.frequency, 0) AS frequency
FROM drawsday d CROSS JOIN numbers n LEFT JOIN countsday c ON c.draw_date = d.draw_date AND c.number_2d = n.number_2d""")


def _loto(grid: str, keys: str, station: str) -> str:
    return f"""
SELECT draw_date, {station} number_2d, frequency, frequency > 0 AS appeared,
  draw_position - prev_position AS draws_since_previous,
  CAST(draw_date - prev_date AS BIGINT) AS calendar_days_since_previous,
  CASE WHEN prev_position IS NULL THEN 'never_seen' ELSE 'seen_before' END AS previous_appearance_status,
  rolling_7_frequency, rolling_30_frequency, rolling_90_frequency, 'run-0001' AS run_id, draw_position
FROM (SELECT *,
  last_value(CASE WHEN frequency > 0 THEN draw_position END IGNORE NULLS) OVER earlier AS prev_position,
  last_value(CASE WHEN frequency > 0 THEN draw_date END IGNORE NULLS) OVER earlier AS prev_date,
  CAST(sum(frequency) OVER (PARTITION BY {keys} ORDER BY draw_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_7_frequency,
  CAST(sum(frequency) OVER (PARTITION BY {keys} ORDER BY draw_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_30_frequency,
  CAST(sum(frequency) OVER (PARTITION BY {keys} ORDER BY draw_date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_90_frequency
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY draw_date) AS draw_position FROM {grid})
  WINDOW earlier AS (PARTITION BY {keys} ORDER BY draw_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


cte("loto", _loto("grid", "station_code, number_2d", "station_code, station_name,"))
cte("lotoday", _loto("gridday", "number_2d", ""))
cte("dimnumber", """
SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS number_2d, range AS numeric_value, range // 10 AS tens_digit,
  range % 10 AS ones_digit, range // 10 + range % 10 AS digit_sum, range % 2 = 0 AS is_even, range // 10 = range % 10 AS is_double
FROM range(100)""")
cte("days", """
SELECT CAST(unnest(generate_series(min(draw_date), max(draw_date), INTERVAL 1 DAY)) AS DATE) AS date FROM drawsday""")
cte("dimdate", """
SELECT date, CAST(isodow(date) AS BIGINT) AS day_of_week, dayname(date) AS day_name, CAST(weekofyear(date) AS BIGINT) AS iso_week,
  CAST(month(date) AS BIGINT) AS month, CAST(quarter(date) AS BIGINT) AS quarter, CAST(year(date) AS BIGINT) AS year,
  isodow(date) >= 6 AS is_weekend,
  CASE WHEN date IN (SELECT draw_date FROM drawsday) THEN 'success' ELSE 'missing' END AS draw_status
FROM days""")
cte("dimstation", """
SELECT station_code, arg_max(station_name, row(draw_date, prize_group, prize_order)) AS station_name,
  arg_max(station_url, row(draw_date, prize_group, prize_order)) AS station_url,
  min(draw_date) AS first_draw_date, max(draw_date) AS latest_draw_date
FROM fact GROUP BY station_code""")
