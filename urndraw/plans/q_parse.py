"""Page parsing and two-source reconciliation over pages that Spark renders from the given orders.

Values follow a formula of the order key, group and order, so the check SQL states what a correct
parser must return instead of parsing again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import DAILY, STATION, sessions, table
from urndraw.functions.once import fan_out, with_once
from urndraw.functions.text import zero_pad
from urndraw.operators import parse, reconcile
from urndraw.plans.registry import cte, query
from urndraw.workdir import fresh_dir, keeping

NOTICE = "Ngày này  không mở\n thưởng do nghỉ lễ"


def value(seed, group_index, order, width, station=0):
    number = ((seed + 1) * 7919 + station * 15485863 + group_index * 104729 + order * 1299709) % (10**width)
    return zero_pad(number, width)


def _display(day):
    return F.date_format(day, "d/M/yyyy")


def _from_orders(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.to_date("o_orderdate").alias("selected_date"),
        (F.col("o_orderkey") % 10).alias("v"), F.expr("(o_orderkey div 10) % 7").alias("m"))
    return fan_out(orders, "page_id")


def daily_pages(spark, sf):
    """One page per order: five ways to state the date, a notice, three damaged layouts and another region's page (``v``),
    in seven spellings of the same markup (``m``): quotes, comments, entities, nested sections."""
    v, m, day, key = F.col("v"), F.col("m"), F.col("selected_date"), F.col("page_id")
    shown = F.when(v == 5, F.date_add(day, 1)).otherwise(day)
    spans = []
    for gi, (name, count, width) in enumerate(DAILY.groups):
        css = "special-prize" if name == "special" else name
        swapped = {"prize5": "prize6", "prize6": "prize5"}.get(name, css)
        shown_class = F.when(v == 8, F.lit(swapped)).otherwise(F.lit(css))
        plain = F.when(m == 1, F.concat(F.lit("class='x "), shown_class, F.lit("'"))).when(m == 2, F.concat(F.lit("class="), shown_class)).otherwise(
            F.concat(F.lit('class="'), shown_class, F.lit('"')))
        attribute = F.when(v == 9, F.lit(f'data-prize="{css}"')).otherwise(plain)
        for j in range(1, count + 1):
            span = F.concat(F.lit("<span "), attribute, F.lit(">"), F.when(m == 4, "&nbsp;").otherwise(" "), value(key, gi, j, width), F.lit("</span>\n"))
            last = name == "prize7" and j == count
            spans.append(F.when(v == 7, F.lit("")).otherwise(span) if last else span)
    body = F.concat(*spans)
    dated = v.isin(0, 5, 6, 7, 8, 9)
    html = F.concat(
        F.lit("<!doctype html><html><head><title>"),
        F.when(v == 3, F.concat(F.lit("Results "), F.date_format(day, "dd-MM-yyyy"))).otherwise("Results"), F.lit("</title>"),
        F.when(v == 1, F.concat(F.lit('<link href="https://site.example/xsaa-'), F.date_format(day, "dd-MM-yyyy"), F.lit('.html" rel="canonical">'))).when((v == 3) & (m == 0), F.lit('<link rel=canonical href="/xsbb-01-01-2001.html">')).otherwise(""),
        F.lit("</head><body>"),
        F.when(v == 2, F.concat(F.lit("<h1>Draw <b>"), _display(day), F.lit("</b></h1>"))).otherwise("<h1>Draw</h1>"),
        F.when(v == 6, F.lit(f"<div><p>{NOTICE}</p></div>")).otherwise(""),
        F.when(dated, F.concat(F.lit('<section id="kqngay_'), F.date_format(shown, "ddMMyyyy"), F.lit('">\n'))).otherwise("<section>"),
        F.when(m == 3, F.lit('<!-- <span class="prize1">00000</span> -->')).when(m == 5, F.lit("<section><p>ad</p></section>")).otherwise(""),
        body, F.lit("</section></body></html>"),
    )
    return with_once(_from_orders(spark, sf), {"html": html}).drop("v", "m")


def _spec_sql(profile):
    rows = ", ".join(f"('{n}', {i}, {c}, {w})" for i, (n, c, w) in enumerate(profile.groups))
    return f"(VALUES {rows}) AS sp(g, gi, c, w)"


def _value_sql(seed, station="0"):
    return f"lpad(CAST((({seed} + 1) * 7919 + {station} * 15485863 + gi * 104729 + j * 1299709) % CAST(pow(10, w) AS BIGINT) AS VARCHAR), w, '0')"


cte("pg", "SELECT o_orderkey AS page_id, CAST(o_orderdate AS DATE) AS selected_date, o_orderkey % 10 AS v, (o_orderkey // 10) % 7 AS m FROM orders")
cte("pgvals", f"""
SELECT page_id, v, g, string_agg({_value_sql('page_id')}, ',' ORDER BY j) AS vals
FROM pg CROSS JOIN {_spec_sql(DAILY)} CROSS JOIN (SELECT range AS j FROM range(1, 7)) WHERE j <= c AND NOT (v = 7 AND g = 'prize7' AND j = 4) GROUP BY ALL""")
cte("outcome", """
SELECT page_id, CASE WHEN v IN (4, 5, 7, 9) OR (v = 3 AND m = 0) THEN 'failed' WHEN v = 6 THEN 'no_draw' ELSE 'success' END AS status,
  CASE v WHEN 3 THEN CASE WHEN m = 0 THEN 'region_mismatch' END WHEN 4 THEN 'date_unknown' WHEN 5 THEN 'date_mismatch' WHEN 6 THEN 'no_draw_notice' WHEN 7 THEN 'prize7_count' WHEN 9 THEN 'special_count' END AS reason
FROM pg""")


def parsed_pages(spark, sf):
    return parse.parse_pages(daily_pages(spark, sf))


@query("page_date", "SELECT page_id, CASE WHEN v = 4 THEN NULL WHEN v = 5 THEN selected_date + 1 ELSE selected_date END AS page_date FROM pg")
def _(spark, sf):
    return parsed_pages(spark, sf).select("page_id", "page_date")


@query("page_date_check", "SELECT page_id, CASE v WHEN 4 THEN 'date_unknown' WHEN 5 THEN 'date_mismatch' END AS problem FROM pg")
def _(spark, sf):
    return parsed_pages(spark, sf).select(
        "page_id", parse.date_problem(F.col("page_date"), F.col("selected_date")).alias("problem"))


def _given_text(tag):
    inner = f"regexp_extract(html, '<{tag}>([^<]*)</{tag}>', 1)"
    return f"replace(trim(regexp_replace({inner}, '\\s+', ' ', 'g')), '&amp;', '&')"


@query("page_outlines_given_pages", f"""
SELECT page_id, {_given_text('title')} AS title, {_given_text('h1')} AS heading, len(regexp_extract_all(html, '<a href="')) AS links,
  array_to_string(list_sort(list_distinct(list_append(regexp_extract_all(html, '<a href="https?://([^/"?#]+)', 1), lower(regexp_extract(url, 'https?://([^/?#]+)', 1))))), ',') AS hosts
FROM pages""")
def _(spark, sf):
    return parse.page_outlines(table(spark, sf, "pages")).select("page_id", "title", "heading", "links", F.array_join("hosts", ",").alias("hosts"))


@query("page_date_given_pages", """
SELECT page_id, CASE WHEN regexp_matches(html, 'kqngay_|<link') THEN DATE '1900-01-01' END AS page_date, CASE WHEN contains(lower(html), 'thưởng') THEN '?' END AS notice FROM pages""")
def _(spark, sf):
    """The given pages are no result pages: whatever names no date and no notice must give neither."""
    found = parse.parse_pages(table(spark, sf, "pages").withColumn("selected_date", F.lit("2000-01-01").cast("date")))
    return found.select("page_id", "page_date", "notice")


@query("no_draw_notice", "SELECT page_id, CASE WHEN v = 6 THEN 'Ngày này không mở thưởng do nghỉ lễ' END AS notice FROM pg")
def _(spark, sf):
    return parsed_pages(spark, sf).select("page_id", "notice")


@query("page_prizes", "SELECT page_id, " + ", ".join(
    "coalesce(max(CASE WHEN v <> 9 AND g = " + (f"CASE WHEN v = 8 THEN '{ {'prize5': 'prize6', 'prize6': 'prize5'}.get(n, n) }' ELSE '{n}' END") + f" THEN vals END), '') AS {n}"
    for n in DAILY.group_names) + " FROM pgvals GROUP BY page_id")
def _(spark, sf):
    return parsed_pages(spark, sf).select("page_id", *[F.array_join(f"raw_{n}", ",").alias(n) for n in DAILY.group_names])


@query("swap_p5_p6", "SELECT page_id, max(v) = 8 AS swapped, max(CASE WHEN g = 'prize5' AND v <> 9 THEN vals ELSE '' END) AS prize5, max(CASE WHEN g = 'prize6' AND v <> 9 THEN vals ELSE '' END) AS prize6 FROM pgvals GROUP BY page_id")
def _(spark, sf):
    return parsed_pages(spark, sf).select(
        "page_id", "swapped", F.array_join("prize5", ",").alias("prize5"), F.array_join("prize6", ",").alias("prize6"))


@query("prize_validate", "SELECT page_id, 'prize7_count' AS violation FROM pg WHERE v = 7 UNION ALL SELECT page_id, unnest(["
       + ", ".join(f"'{n}_count'" for n in DAILY.group_names) + "]) FROM pg WHERE v = 9")
def _(spark, sf):
    return parse.prize_violations(parsed_pages(spark, sf))


@query("parse_outcome", "SELECT * FROM outcome")
def _(spark, sf):
    return parsed_pages(spark, sf).select("page_id", "status", "reason")


# ---- pages with one column per station


def station_markup(spark, sf, fallback):
    v, m, day, key = F.col("v"), F.col("m"), F.col("selected_date"), F.col("page_id")
    labels = {**{f"prize{n}": (f"G.{n}" if fallback else str(n)) for n in range(1, 9)}, "special": "ĐB"}
    rows = []
    for gi, (name, count, width) in enumerate(STATION.groups):
        cells = []
        for i in range(3):
            texts = [value(key, gi, j, width, i) for j in range(1, count + 1)]
            if fallback:
                cell = F.concat(F.lit("<td>"), F.concat_ws("<br>", *texts), F.lit("</td>"))
            else:
                opened = F.when(m == 1, "<span class='xs_prize1'>").when(m == 2, "<span class=xs_prize1>&nbsp;").otherwise('<span class="xs_prize1">')
                cell = F.concat(F.lit("<td>"), *[F.concat(opened, t, F.lit("</span>")) for t in texts], F.lit("</td>"))
            cells.append(F.when(v == 5, F.lit("")).otherwise(cell) if (i == 2 and name == "prize1") else cell)
        tag = "td" if fallback else "th"
        # an advertisement's own table, and a second body, in the middle of the rows
        between = F.when(m == 3, F.lit("<tr><td><table><tr><th>1</th><td>x</td></tr></table></td></tr>")).when(
            (m == 4) & F.lit(not fallback), F.lit("</tbody><tbody>")).otherwise("") if gi == 4 else F.lit("")
        rows.append(F.concat(between, F.lit(f"<tr><{tag}>{labels[name]}</{tag}>"), *cells, F.lit("</tr>\n")))
    broken = F.when(v == 6, F.lit("/other")).otherwise(F.lit("/xsst2" if fallback else "/x/xsst2-p1.html"))
    links = [F.lit("/xsst0" if fallback else "/x/xsst0-p1.html"), F.lit("/xsst1" if fallback else "/x/xsst1-p1.html"), broken]
    if not fallback:  # absolute, from the root, and relative to the page
        links[0] = F.when(m % 2 == 1, F.lit("https://site.example/x/xsst0-p1.html")).otherwise(links[0])
        links[1] = F.when(m % 3 == 1, F.lit("../x/xsst1-p1.html")).otherwise(links[1])
    origin = "https://second.example" if fallback else "https://site.example"
    head = [F.concat(F.lit('<a href="'), link, F.lit(f'">Station  {i}</a>')) for i, link in enumerate(links)]
    shown = F.when(v == 9, F.date_add(day, 1)).otherwise(day)
    if fallback:
        kind = F.when(v == 7, "other").otherwise("tbl-xsaa")
        table_markup = F.concat(
            F.lit('<table class="'), kind, F.lit('"><tr><th>day</th>'), *[F.concat(F.lit("<th>"), h, F.lit("</th>")) for h in head],
            F.lit("</tr>"), *rows, F.lit("</table>"))
        html = F.concat(F.lit("<html><head><title>Results of "), F.date_format(shown, "dd/MM/yyyy"), F.lit("</title></head><body>"), table_markup, F.lit("</body></html>"))
    else:
        kind = F.when(v == 7, "other").otherwise("table-result table-xsaa wide")
        table_markup = F.concat(
            F.lit('<table class="'), kind, F.lit('"><thead><tr><th>G</th>'), *[F.concat(F.lit("<th><h3>"), h, F.lit("</h3></th>")) for h in head],
            F.lit("</tr></thead><tbody>"), *rows, F.lit("</tbody></table>"))
        html = F.concat(
            F.lit("<html><body>"), F.when(v == 8, F.lit(f"<p>{NOTICE}</p>")).otherwise(""),
            F.lit('<div id="aa_kqngay_'), F.date_format(shown, "ddMMyyyy"), F.lit('_kq">'), table_markup, F.lit("</div></body></html>"))
    return with_once(_from_orders(spark, sf), {"html": html}).drop("v", "m").withColumn("url", F.lit(f"{origin}/day/page.html"))


def _station_sql(good, url):
    return f"""
SELECT page_id, 'ST' || CAST(i AS VARCHAR) AS station_code, 'Station ' || CAST(i AS VARCHAR) AS station_name, {url} AS station_url,
  count(*) AS result_count, string_agg(val, ',' ORDER BY gi, j) AS results
FROM (SELECT page_id, i, gi, j, {_value_sql('page_id', 'i')} AS val FROM pg CROSS JOIN (SELECT range AS i FROM range(3)) CROSS JOIN {_spec_sql(STATION)}
  CROSS JOIN (SELECT range AS j FROM range(1, 8)) WHERE j <= c AND v IN ({good})) GROUP BY page_id, i"""


def _per_station(rows):
    at = STATION.order_of(F.col("prize_group"))
    return rows.groupBy("page_id", "station_code", "station_name", "station_url").agg(
        F.count(F.lit(1)).alias("result_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("a"), "prize_order", "value"))), lambda p: p["value"]), ",").alias("results"))


@query("page_station_table", _station_sql("0, 1, 2, 3, 4", "'https://site.example/x/xsst' || CAST(i AS VARCHAR) || '-p1.html'"))
def _(spark, sf):
    return _per_station(parse.page_station_table(parse.station_tables(station_markup(spark, sf, False))))


@query("page_fallback_table", _station_sql("0, 1, 2, 3, 4, 8", "'https://second.example/xsst' || CAST(i AS VARCHAR)"))
def _(spark, sf):
    return _per_station(parse.page_fallback_table(parse.fallback_tables(station_markup(spark, sf, True))))


@query("station_violations", """
SELECT page_id, 'ST' || CAST(i.range AS VARCHAR) AS station_code, unnest(['prize8_count', 'special_width']) AS violation FROM pg, range(3) i WHERE v IN (0, 1, 2, 3, 4) AND page_id % 3 = 0""")
def _(spark, sf):
    """Parsed station draws, a third of them damaged: a value too many and one digit too few."""
    rows = parse.page_station_table(parse.station_tables(station_markup(spark, sf, False)))
    damaged = F.col("page_id") % 3 == 0
    short = rows.withColumn("value", F.when(damaged & (F.col("prize_group") == "special"), F.substring("value", 2, 9)).otherwise(F.col("value")))
    more = short.where(damaged & (F.col("prize_group") == "prize8")).withColumn("prize_order", F.lit(2).cast("long"))
    draws = parse.group_columns(short.unionByName(more), ["page_id", "station_code"])
    return parse.station_violations(draws, ["page_id", "station_code"])


@query("page_station_problems", """
SELECT page_id, CASE v WHEN 5 THEN 'station_columns' WHEN 6 THEN 'station_code_unknown' WHEN 7 THEN 'table_missing' WHEN 8 THEN 'no_draw_notice'
  WHEN 9 THEN 'date_mismatch' END AS problem FROM pg""")
def _(spark, sf):
    return parse.station_tables(station_markup(spark, sf, False)).select("page_id", "problem")


# ---- two sources

_DD = "date_diff('day', DATE '1995-01-01', draw_date)"
cte("rdraws", f"""
SELECT *, dd * 1000 + no AS seed, (dd + no * 7) % 13 AS c, no = 0 AND dd % 31 = 0 AS twice, no % 5 = 2 AND dd % 29 = 0 AS gone FROM (
  SELECT DISTINCT draw_date, station_code, station_no AS no, station_name, {_DD} AS dd FROM sess)""")
cte("rbase", f"""
SELECT d.*, g, gi, w, coalesce(list({_value_sql('seed')} ORDER BY j) FILTER (g <> 'prize1' OR c <> 6), []) AS f FROM rdraws d CROSS JOIN {_spec_sql(STATION).replace(', c, w)', ', cnt, w)')}
CROSS JOIN (SELECT range AS j FROM range(1, 8)) WHERE j <= cnt GROUP BY ALL""")
cte("rprim", """
SELECT a.*, CASE
  WHEN a.g = 'special' AND a.dd % 17 = 0 AND a.no % 5 = 1 THEN [substr(right(a.f[1], 5), 1, 4) || CAST((CAST(right(a.f[1], 1) AS BIGINT) + 1) % 10 AS VARCHAR)]
  WHEN a.g = 'special' AND (a.c = 2 OR a.dd % 17 = 0) THEN [right(a.f[1], 5)]
  WHEN a.g = 'prize4' AND a.c = 3 THEN [a.f[1], '.....', a.f[3], a.f[4], a.f[5], a.f[6], a.f[7]]
  WHEN a.g IN ('prize8', 'prize7') AND a.c = 4 THEN b.f
  WHEN a.g = 'prize2' AND a.c = 5 THEN [lpad(CAST((CAST(a.f[1] AS BIGINT) + 1) % 100000 AS VARCHAR), 5, '0')]
  ELSE a.f END AS p
FROM rbase a LEFT JOIN rbase b ON b.draw_date = a.draw_date AND b.station_code = a.station_code
  AND b.g = CASE a.g WHEN 'prize8' THEN 'prize7' WHEN 'prize7' THEN 'prize8' END""")
cte("rmatch", """
SELECT draw_date, station_code, CASE WHEN NOT gone THEN CASE WHEN no % 3 = 1 THEN 'F' || CAST(no AS VARCHAR) ELSE station_code END END AS fallback_code,
  CASE WHEN NOT gone THEN CASE WHEN no % 3 = 1 THEN 'name' ELSE 'code' END END AS how
FROM rdraws WHERE NOT twice
UNION ALL SELECT draw_date, unnest([station_code, station_code, NULL]), unnest([NULL, NULL, station_code]), NULL FROM rdraws WHERE twice""")
cte("rday", """
SELECT draw_date, count(*) >= 4 AND count(*) FILTER (len(p[1]) = 5) = count(*) AND count(*) FILTER (len(p[1]) = 5 AND suffix(f[1], p[1])) >= count(*) - 1 AND bool_and(NOT gone AND NOT twice) AS daywide,
  bool_or(gone OR twice) AS alone
FROM rprim WHERE g = 'special' GROUP BY 1""")
cte("rrule", """
SELECT r.draw_date, r.station_code, r.gone, r.twice, r.g AS prize_group, r.p, r.f, CASE WHEN len(f) = 0 THEN 'reject' WHEN p = f THEN 'equal'
  WHEN g IN ('prize8', 'prize7') AND c = 4 THEN 'transposed'
  WHEN g = 'special' AND len(p[1]) = 5 AND suffix(f[1], p[1]) THEN 'truncated'
  WHEN g = 'special' AND d.daywide THEN 'daywide'
  WHEN g = 'prize4' AND c = 3 THEN 'placeholder' ELSE 'reject' END AS rule, d.alone
FROM rprim r JOIN rday d ON d.draw_date = r.draw_date""")
cte("rverdict", """
SELECT draw_date, CASE WHEN bool_or(alone) THEN 'station_sets_differ' WHEN bool_or(rule = 'reject') THEN 'values_differ' ELSE 'accepted' END AS verdict
FROM rrule GROUP BY 1""")
cte("rlong", """
SELECT r.draw_date, r.station_code, r.prize_group, r.rule, v.verdict FROM rrule r JOIN rverdict v ON v.draw_date = r.draw_date
WHERE NOT r.gone AND NOT r.twice""")


def two_sources(spark, sf):
    """Primary and fallback arrays per (date, station); the primary is damaged by date and station number.

    Also a prize that both lack, and a station that the primary lists twice.
    """
    no, dd = F.col("no"), F.col("dd")
    draws = sessions(spark, sf).select(
        "draw_date", "station_code", "station_name", F.col("station_no").alias("no"),
        F.date_diff("draw_date", F.lit("1995-01-01").cast("date")).cast("long").alias("dd")).distinct()
    draws = draws.withColumn("seed", dd * 1000 + no).withColumn("c", (dd + no * 7) % 13)
    truth = with_once(fan_out(draws, "draw_date", "station_code"), {
        name: F.array(*[value(F.col("seed"), gi, j, w) for j in range(1, count + 1)])
        for gi, (name, count, w) in enumerate(STATION.groups)})
    # neither source has this prize
    truth = truth.withColumn("prize1", F.when(F.col("c") == 6, F.array().cast("array<string>")).otherwise(F.col("prize1")))
    c, special = F.col("c"), F.col("special")[0]
    tail = F.right(special, F.lit(5))
    wrong = F.concat(F.substring(tail, 1, 4), ((F.right(special, F.lit(1)).cast("long") + 1) % 10).cast("string"))
    primary = truth.withColumn("station_order", no + 1).select(
        "draw_date", "station_code", "station_name", "station_order",
        F.when(c == 4, F.col("prize7")).otherwise(F.col("prize8")).alias("prize8"),
        F.when(c == 4, F.col("prize8")).otherwise(F.col("prize7")).alias("prize7"),
        "prize6", "prize5",
        F.when(c == 3, F.transform("prize4", lambda x, at: F.when(at == 1, ".....").otherwise(x))).otherwise(F.col("prize4")).alias("prize4"),
        "prize3",
        F.when(c == 5, F.array(zero_pad((F.col("prize2")[0].cast("long") + 1) % 100000, 5))).otherwise(F.col("prize2")).alias("prize2"),
        "prize1",
        F.when((dd % 17 == 0) & (no % 5 == 1), F.array(wrong)).when((c == 2) | (dd % 17 == 0), F.array(tail)).otherwise(F.col("special")).alias("special"))
    listed = F.when(F.expr("station_code = 'S0' and date_diff(draw_date, date '1995-01-01') % 31 = 0"), 2).otherwise(1)
    primary = primary.withColumn("_listed", F.explode(F.sequence(F.lit(1), listed))).drop("_listed")
    gone = (no % 5 == 2) & (dd % 29 == 0)
    fallback = truth.where(~gone).select(
        "draw_date",
        F.when(no % 3 == 1, F.concat(F.lit("F"), no.cast("string"))).otherwise(F.col("station_code")).alias("station_code"),
        F.upper(F.regexp_replace("station_name", " ", "   ")).alias("station_name"), *STATION.group_names)
    # both sources are stored tables, as fetched pages would be
    path = fresh_dir(spark, "sources")
    primary.write.parquet(f"{path}/primary")
    fallback.write.parquet(f"{path}/fallback")
    return spark.read.parquet(f"{path}/primary"), spark.read.parquet(f"{path}/fallback")


def reconciled(spark, sf):
    primary, fallback = two_sources(spark, sf)
    return reconcile.reconcile(primary, fallback, reconcile.match_fallback(primary, fallback), keeping(spark, "reconciled"))


@query("match_fallback", "SELECT * FROM rmatch")
def _(spark, sf):
    return reconcile.match_fallback(*two_sources(spark, sf))


@query("rec_classify", """
SELECT draw_date, station_code, kind, coalesce(first_kind IN ('truncated_special', 'recoverable'), false) AS needs_fallback FROM (
  SELECT *, min(row(no, kind)) FILTER (kind <> 'ok') OVER (PARTITION BY draw_date)[2] AS first_kind FROM (
    SELECT draw_date, station_code, no, CASE WHEN c = 6 THEN 'not_recoverable' WHEN c = 3 OR c = 4 THEN 'recoverable' WHEN c = 2 OR dd % 17 = 0 THEN 'truncated_special' ELSE 'ok' END AS kind FROM rdraws, range(2) k WHERE k.range = 0 OR twice))""")
def _(spark, sf):
    return reconcile.classify(two_sources(spark, sf)[0]).select("draw_date", "station_code", "kind", "needs_fallback")


@query("reconcile", """
SELECT r.draw_date, r.station_code, v.verdict, max(CASE WHEN v.verdict = 'accepted' AND prize_group = 'special' THEN f[1] END) AS special,
  max(CASE WHEN v.verdict = 'accepted' AND prize_group = 'prize8' THEN f[1] END) AS prize8,
  max(CASE WHEN v.verdict = 'accepted' AND prize_group = 'prize4' THEN array_to_string(f, ',') END) AS prize4
FROM rrule r JOIN rverdict v ON v.draw_date = r.draw_date GROUP BY ALL
UNION ALL SELECT draw_date, station_code, 'station_sets_differ', NULL, NULL, NULL FROM rdraws WHERE twice""")
def _(spark, sf):
    return reconciled(spark, sf).select(
        "draw_date", "station_code", "verdict", F.col("final_special")[0].alias("special"),
        F.col("final_prize8")[0].alias("prize8"), F.array_join("final_prize4", ",").alias("prize4"))


def _rule(name, rule):
    @query(name, f"SELECT draw_date, station_code, prize_group, verdict FROM rlong WHERE rule = '{rule}'")
    def _(spark, sf):
        return reconcile.rules_long(reconciled(spark, sf)).where(F.col("rule") == rule).drop("rule")


for _name, _r in (("rec_equal", "equal"), ("rec_transposed", "transposed"), ("rec_truncated", "truncated"),
                  ("rec_daywide", "daywide"), ("rec_placeholder", "placeholder")):
    _rule(_name, _r)


@query("rec_reject", "SELECT draw_date, verdict FROM rverdict WHERE verdict <> 'accepted'")
def _(spark, sf):
    return reconciled(spark, sf).where("verdict <> 'accepted'").select("draw_date", "verdict").distinct()
