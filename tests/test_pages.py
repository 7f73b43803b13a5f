"""Golden pages and two-source repair cases."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from test_golden import GOLDEN

from urndraw.operators import parse, reconcile
from urndraw.spec import STATION

DAY = datetime.date(2026, 7, 16)


def page(groups=None, section='id="kqngay_16072026"', head="", extra=""):
    groups = {**GOLDEN, **(groups or {})}
    spans = "".join(
        f'<span class="{"special-prize" if g == "special" else g}">{v}</span>\n' for g, values in groups.items() for v in values)
    return f"<html><head>{head}</head><body>{extra}<section {section}>{spans}</section></body></html>"


def outcome(spark, html, day=DAY):
    rows = spark.createDataFrame([(1, day, html)], "page_id long, selected_date date, html string")
    return parse.parse_pages(rows).first()


def test_complete_page(spark):
    row = outcome(spark, page())
    assert (row.status, row.reason, row.page_date) == ("success", None, DAY)
    assert row.prize3 == GOLDEN["prize3"] and row.special == ["96763"]


@pytest.mark.parametrize("head, extra", [
    ('<link rel="canonical" href="https://x/xsaa-16-07-2026.html">', ""),
    ("", "<h1>Draw 16/7/2026</h1>"),
    ("<title>Results 16-07-2026</title>", ""),
])
def test_other_ways_to_state_the_date(spark, head, extra):
    assert outcome(spark, page(section="", head=head, extra=extra)).page_date == DAY


@pytest.mark.parametrize("html, status, reason", [
    (page(), "failed", "date_mismatch"),
    (page(section=""), "failed", "date_unknown"),
])
def test_wrong_dates(spark, html, status, reason):
    row = outcome(spark, html, datetime.date(2026, 7, 15))
    assert (row.status, row.reason) == (status, reason)


def test_no_draw_notice(spark):
    row = outcome(spark, page(extra="<div><p>Hôm nay\n Không  mở thưởng</p></div>"))
    assert (row.status, row.notice) == ("no_draw", "Hôm nay Không mở thưởng")


def test_incomplete_page(spark):
    assert outcome(spark, page({"prize7": ["66"]})).reason == "prize7_count"
    assert outcome(spark, page({"prize1": ["1624"]})).reason == "prize1_width"
    assert outcome(spark, page({"prize1": ["1624x"]})).reason == "prize1_digits"


def test_swapped_groups_are_repaired_only_when_proven(spark):
    swapped = {"prize5": GOLDEN["prize6"], "prize6": GOLDEN["prize5"]}
    row = outcome(spark, page(swapped))
    assert row.status == "success" and row.prize5 == GOLDEN["prize5"] and row.prize6 == GOLDEN["prize6"]
    near = {"prize5": ["329", "663", "8790"], "prize6": GOLDEN["prize5"]}
    assert outcome(spark, page(near)).status == "failed"
    assert outcome(spark, page({**swapped, "prize7": ["66"]})).status == "failed"


SHAPE = {name: (count, width) for name, count, width in STATION.groups}


def station(code, name, order, **changed):
    values = {g: [f"{(order * 37 + i * 11 + 5) % 10 ** w:0{w}d}" for i in range(c)] for g, (c, w) in SHAPE.items()}
    values["special"] = [f"{100000 * order + 54321}"]
    values.update(changed)
    return (DAY, code, name, order, *[values[g] for g in STATION.group_names])


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "draw_date date, station_code string, station_name string, station_order long, "
        + ", ".join(f"{g} array<string>" for g in STATION.group_names))


def repair(spark, primary, fallback):
    a, b = frame(spark, primary), frame(spark, fallback)
    return {r.station_code: r for r in reconcile.reconcile(a, b, reconcile.match_fallback(a, b)).collect()}


def test_truncated_special_is_taken_from_the_second_source(spark):
    rows = repair(spark, [station("A1", "Alpha", 1, special=["54321"]), station("B1", "Beta", 2)], [station("A1", "Alpha", 1), station("B1", "Beta", 2)])
    assert rows["A1"].verdict == "accepted" and rows["A1"].final_special == ["154321"] and rows["A1"].rule_special == "truncated"


def test_transposed_small_prizes(spark):
    good = station("A1", "Alpha", 1, prize8=["88"], prize7=["303"])
    rows = repair(spark, [station("A1", "Alpha", 1, prize8=["303"], prize7=["88"])], [good])
    assert (rows["A1"].final_prize8, rows["A1"].final_prize7, rows["A1"].verdict) == (["88"], ["303"], "accepted")


def test_placeholders(spark):
    good = station("A1", "Alpha", 1)
    dotted = list(good[4 + STATION.group_names.index("prize3")])
    dotted[0] = "....."
    rows = repair(spark, [station("A1", "Alpha", 1, prize3=dotted)], [good])
    assert rows["A1"].rule_prize3 == "placeholder" and rows["A1"].final_prize3 == good[4 + STATION.group_names.index("prize3")]


@pytest.mark.parametrize("damaged, verdict", [(1, "accepted"), (2, "values_differ")])
def test_daywide_truncation_allows_one_damaged_suffix(spark, damaged, verdict):
    names = ["A1", "B1", "C1", "D1"]
    primary = [station(n, n, i + 1, special=["99999" if i < damaged else "54321"]) for i, n in enumerate(names)]
    rows = repair(spark, primary, [station(n, n, i + 1) for i, n in enumerate(names)])
    assert {r.verdict for r in rows.values()} == {verdict}


def test_other_difference_rejects_the_whole_date(spark):
    rows = repair(spark, [station("A1", "Alpha", 1, prize1=["00000"]), station("B1", "Beta", 2)], [station("A1", "Alpha", 1), station("B1", "Beta", 2)])
    assert {r.verdict for r in rows.values()} == {"values_differ"} and rows["B1"].final_special is None


def test_stations_pair_by_name_and_leftovers_reject(spark):
    rows = repair(spark, [station("A1", "Bình  Phước", 1)], [station("X9", "bình phước", 1)])
    assert rows["A1"].verdict == "accepted" and rows["A1"].fallback_code == "X9"
    rows = repair(spark, [station("A1", "Alpha", 1)], [station("A1", "Alpha", 1), station("Z1", "Zeta", 2)])
    assert rows["A1"].verdict == "station_sets_differ"


def test_classification_uses_the_first_faulty_station(spark):
    rows = frame(spark, [station("A1", "A", 1, prize1=["0"]), station("B1", "B", 2, special=["54321"])])
    kinds = {r.station_code: (r.kind, r.needs_fallback) for r in reconcile.classify(rows).collect()}
    assert kinds == {"A1": ("not_recoverable", False), "B1": ("truncated_special", False)}


def station_page(spark, head='<a href="/a/xstn-p1.html">Tây Ninh</a>', body="", region="aa", url="https://x/day/p.html"):
    html = (
        f'<section id="{region}_kqngay_16072026"><table class="table-result table-xs{region} table-city3"><thead><tr><th>G</th>'
        f'<th><h3>{head}</h3></th><th><h3><a href="/b/xsag-p1.html">An Giang</a></h3></th></tr></thead><tbody>'
        f'<tr><th>8</th><td><span class="xs_prize1">07</span></td><td><span class="xs_prize1">54</span></td></tr>{body}'
        '<tr><th>ĐB</th><td><span class="xs_prize1 prize_db">005113</span></td><td><span class=xs_prize1>830834</span></td></tr></tbody></table></section>')
    return parse.station_tables(spark.createDataFrame([(1, DAY, html, url)], "page_id long, selected_date date, html string, url string"))


def test_station_page_columns(spark):
    rows = parse.page_station_table(station_page(spark))
    values = parse.group_columns(rows, ["page_id", "station_code", "station_name", "station_url"])
    got = {r.station_code: (r.station_name, r.station_url, r.prize8, r.special) for r in values.collect()}
    assert got == {"TN": ("Tây Ninh", "https://x/a/xstn-p1.html", ["07"], ["005113"]), "AG": ("An Giang", "https://x/b/xsag-p1.html", ["54"], ["830834"])}
    assert rows.where(F.col("value").isNull()).count() == 0
    broken = {(r.station_code, r.violation) for r in parse.station_violations(values, ["station_code"]).collect()}
    assert ("TN", "prize7_count") in broken and not any(v.startswith(("prize8", "special")) for _, v in broken)


@pytest.mark.parametrize("href, url", [
    ("https://y/xstn-p1.html", "https://y/xstn-p1.html"), ("xstn-p1.html", "https://x/day/xstn-p1.html"), ("../q/xstn-p1.html", "https://x/q/xstn-p1.html"),
])
def test_links_are_resolved_against_the_page(spark, href, url):
    # a code is read from the path, so a relative link needs one in front
    rows = parse.page_station_table(station_page(spark, head=f"<a href='/z/{href}'>Tây Ninh</a>" if "/" not in href else f"<a href={href}>Tây Ninh</a>"))
    urls = {r.station_code: r.station_url for r in rows.collect()}
    assert urls["TN"] == ("https://x/z/xstn-p1.html" if "/" not in href else url)


@pytest.mark.parametrize("body", [
    "<tr><td><table><tr><th>7</th><td>x</td></tr></table></td></tr>", "</tbody><tbody>", "<!-- <tr><th>7</th></tr> -->",
])
def test_markup_inside_the_table(spark, body):
    rows = parse.page_station_table(station_page(spark, body=body)).collect()
    assert sorted((r.station_code, r.prize_group, r.value) for r in rows) == [
        ("AG", "prize8", "54"), ("AG", "special", "830834"), ("TN", "prize8", "07"), ("TN", "special", "005113")]


def test_station_page_problems(spark):
    twice = '<a href="/a/xsag-p1.html">An Giang</a>'
    assert station_page(spark, head=twice).first().problem == "station_code_duplicate"
    assert station_page(spark, region="bb").first().problem == "date_unknown"
    uneven = "<tr><th>7</th><td></td></tr>"
    assert station_page(spark, body=uneven).first().problem == "station_columns"
    again = '<tr><th>8</th><td><span class="xs_prize1">07</span></td><td></td></tr>'
    assert station_page(spark, body=again).first().problem == "row_duplicate"


@pytest.mark.parametrize("change", [
    lambda h: h.replace('<span class="prize1">', '<section><p>ad</p></section><span class="prize1">'),
    lambda h: h.replace('class="special-prize"', "class=special-prize").replace('class="prize3"', "class='x prize3'"),
    lambda h: h.replace('<span class="prize1">', '<!-- <span class="prize1">99999</span> --><span class="prize1">'),
    lambda h: h.replace(">16246<", ">&nbsp;16246 <"),
    lambda h: h.replace(">16246<", "><b>16</b>246<"),
])
def test_other_spellings_of_a_good_page(spark, change):
    row = outcome(spark, change(page()))
    assert (row.status, row.prize1, row.special) == ("success", ["16246"], ["96763"])


def test_a_page_of_another_region_is_refused(spark):
    html = page(head='<link rel="x canonical" href="https://x/xsbb-16-07-2026.html">')
    row = outcome(spark, html)
    assert (row.status, row.reason) == ("failed", "region_mismatch")
    own = parse.parse_pages(spark.createDataFrame([(1, DAY, html)], "page_id long, selected_date date, html string"), parse.PageSource("bb")).first()
    assert own.status == "success"


def test_two_equally_incomplete_sources_are_rejected(spark):
    rows = repair(spark, [station("A1", "Alpha", 1, prize1=[])], [station("A1", "Alpha", 1, prize1=[])])
    assert (rows["A1"].verdict, rows["A1"].rule_prize1, rows["A1"].final_prize1) == ("values_differ", "reject", None)


def test_a_station_listed_twice_is_rejected(spark):
    a = frame(spark, [station("A1", "Alpha", 1), station("A1", "Alpha", 1), station("B1", "Beta", 2)])
    b = frame(spark, [station("A1", "Alpha", 1), station("B1", "Beta", 2)])
    matches = reconcile.match_fallback(a, b)
    got = reconcile.reconcile(a, b, matches).collect()
    assert len(got) == 3 and {r.verdict for r in got} == {"station_sets_differ"}
    twice = frame(spark, [station("A1", "Alpha", 1), station("A1", "Alpha", 1)])
    assert {r.verdict for r in reconcile.reconcile(b, twice, reconcile.match_fallback(b, twice)).collect()} == {"station_sets_differ"}
