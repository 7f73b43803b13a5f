"""Result pages to draws: each page is parsed once into a tree, and a bad page becomes a reason code, never an error."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from urndraw.functions import markup
from urndraw.functions.markup import Element, Page
from urndraw.functions.text import is_digits
from urndraw.spec import DAILY, STATION, Profile

# Formats of the source pages.
DISPLAY_DATE = re.compile(r"\b(\d{1,2})[/-](\d{1,2})[/-](\d{4})\b")
NO_DRAW = re.compile(r"không\s+mở\s+thưởng", re.IGNORECASE)
ANY_REGION = re.compile(r"/xs[a-z]{2}-\d{2}-\d{2}-\d{4}\.html")
STATION_LINK = r"(?i)/xs([a-z0-9]+)-p\d+\.html$"
FALLBACK_LINK = r"(?i)^/xs([a-z0-9]+)(?:-[a-z0-9]+)*$"
ROW_LABELS = {**{str(n): f"prize{n}" for n in range(8, 0, -1)}, "ĐB": "special", "DB": "special"}
FALLBACK_ROW_LABELS = {**{f"G.{n}": f"prize{n}" for n in range(8, 0, -1)}, "ĐB": "special", "DB": "special"}


#: Elements of a page by their tag.
Named = dict[str, list[Element]]
#: Pages whose values a task holds as objects at a time.
PAGES = 512
#: Where a page may state its date and region.
STATED = ("link", "h1", "title")


@dataclass(frozen=True)
class PageSource:
    """The region whose pages are accepted: its letters stand in section ids, canonical links and table classes."""

    region: str
    per_station: bool = False

    @cached_property
    def section(self) -> re.Pattern[str]:
        return re.compile(rf"{self.region}_kqngay_(\d{{8}})(?:_kq)?" if self.per_station else r"kqngay_(\d{8})")

    @cached_property
    def canonical(self) -> re.Pattern[str]:
        return re.compile(rf"/xs{self.region}-(\d{{2}})-(\d{{2}})-(\d{{4}})\.html")


def _date(year: str, month: str, day: str) -> datetime.date | None:
    try:
        return datetime.date(int(year), int(month), int(day))
    except ValueError:
        return None


def _shown_date(text: str) -> datetime.date | None:
    found = DISPLAY_DATE.search(text)
    return _date(found[3], found[2], found[1]) if found else None


def _canonical(named: Named) -> str:
    link = next((e for e in named.get("link", ()) if "canonical" in e.attributes.get("rel", "").lower().split()), None)
    return link.attributes.get("href", "") if link else ""


def _result_section(page: Page, source: PageSource) -> Element | None:
    section = source.section
    for e in page.once("sections", lambda: [e for e in page.all("section", "div") if "id" in e.attributes]):
        if section.fullmatch(e.attributes["id"]):
            return e
    return None


def _stated(page: Page) -> Named:
    return page.once("stated", lambda: _named(page, *STATED))


def _named(page: Element, *tags: str) -> Named:
    """The elements with these tags, in document order."""
    found: Named = {}
    for e in page.all(*tags):
        found.setdefault(e.tag, []).append(e)
    return found


def represented_date(section: Element | None, named: Named, source: PageSource) -> datetime.date | None:
    """The date a page represents: section id, else canonical link, else h1, else title."""
    digits = source.section.fullmatch(section.attributes["id"])[1] if section else ""
    link = source.canonical.search(_canonical(named))
    return (
        (_date(digits[4:], digits[2:4], digits[:2]) if digits else None)
        or (_date(link[3], link[2], link[1]) if link else None) or headed_date(named)
    )


def headed_date(named: Named) -> datetime.date | None:
    for tag in ("h1", "title"):
        date = _shown_date(named[tag][0].text()) if tag in named else None
        if date:
            return date
    return None


def other_region(named: Named, source: PageSource) -> bool:
    link = _canonical(named)
    return ANY_REGION.search(link) is not None and source.canonical.search(link) is None


def notice_of(page: Element) -> str | None:
    """Text of the innermost element that says there was no draw, its first 500 characters."""
    if not NO_DRAW.search(" ".join(page.strings())):  # any white space stands between its words
        return None
    at = page
    while True:
        inner = next((c for c in at.children if isinstance(c, Element) and c.tag not in markup.HIDDEN and NO_DRAW.search(c.text())), None)
        if inner is None:
            return at.text()[:500]
        at = inner


def _parsed(pages: DataFrame, read: Callable[[Page, str], dict], types: dict[str, str]) -> DataFrame:
    """``pages`` without html and with what ``read`` finds on each, parsed once per page in Arrow batches.

    ``read`` looks up once (``Page.once``) which elements it wants, by their tags and classes, and reads texts and addresses of every page.
    """
    kept = [f for f in pages.schema if f.name not in ("html", *types)]
    names = [f.name for f in kept]
    url = F.col("url") if "url" in names else F.lit("")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{n} {t}" for n, t in types.items())])
    wanted = to_arrow_schema(StructType.fromDDL(", ".join(f"{n} {t}" for n, t in types.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = markup.Pages()
        for batch in (whole.slice(at, PAGES) for whole in batches for at in range(0, whole.num_rows, PAGES)):
            read_of = zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist())
            found = [read(trees.page(html), base or "") for html, base in read_of]
            columns = [pa.array([f[n] for f in found], wanted.field(n).type) for n in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *columns], [*names, *types])

    return pages.select(*[F.col(f"`{n}`") for n in names], "html", url.alias("__base")).mapInArrow(run, schema)


def date_problem(represented: Column, selected: Column) -> Column:
    return F.when(represented.isNull(), "date_unknown").when(represented != selected, "date_mismatch")


def _all_width(values: Column, count: int, width: int) -> Column:
    return (F.size(values) == count) & F.forall(values, lambda v: is_digits(v, width))


def swap_is_proven(groups: dict[str, Column], profile: Profile = DAILY) -> Column:
    """Prize 5 and 6 are exchanged: each matches the other's count and width, all other counts hold."""
    shape = {name: (count, width) for name, count, width in profile.groups}
    others = [F.size(groups[n]) == c for n, (c, _) in shape.items() if n not in ("prize5", "prize6")]
    proven = _all_width(groups["prize5"], *shape["prize6"]) & _all_width(groups["prize6"], *shape["prize5"])
    for other in others:
        proven = proven & other
    return proven


def group_problem(values: Column, count: int, width: int) -> Column:
    """Why a group's values are not acceptable, NULL when they are."""
    return (
        F.when(F.coalesce(F.size(values), F.lit(0)) != count, "count")
        .when(~F.forall(values, lambda v: is_digits(v)), "digits")
        .when(~F.forall(values, lambda v: F.length(v) == width), "width")
    )


def parse_pages(pages: DataFrame, source: PageSource = PageSource("aa")) -> DataFrame:
    """(page_id, selected_date, html) to one row per page: date, notice, raw and repaired groups, outcome."""

    def prizes(part: Element) -> dict[str, list[Element]]:
        by_class: dict[str, list[Element]] = {name: [] for name in DAILY.group_names}
        for element in part.walk():
            if "class" not in element.attributes:
                continue
            for css in element.classes():
                name = "special" if css == "special-prize" else css
                if name in by_class and name != "special" or css == "special-prize":
                    by_class[name].append(element)
        return by_class

    def read(page: Page, url: str) -> dict:
        section, named = _result_section(page, source), _stated(page)
        by_class = page.once(("prizes", section), lambda: prizes(section or page))
        return {
            "page_date": represented_date(section, named, source), "other_region": other_region(named, source), "notice": notice_of(page),
            **{f"raw_{name}": [e.joined() for e in elements] for name, elements in by_class.items()},
        }

    raw = _parsed(pages, read, {"page_date": "date", "other_region": "boolean", "notice": "string",
                                **{f"raw_{name}": "array<string>" for name in DAILY.group_names}})
    swapped = F.col("swapped")
    raw = raw.withColumn("swapped", swap_is_proven({n: F.col(f"raw_{n}") for n in DAILY.group_names}))
    repaired = {n: F.col(f"raw_{n}") for n in DAILY.group_names}
    repaired["prize5"], repaired["prize6"] = (
        F.when(swapped, F.col("raw_prize6")).otherwise(F.col("raw_prize5")),
        F.when(swapped, F.col("raw_prize5")).otherwise(F.col("raw_prize6")),
    )
    parsed = raw.withColumns(repaired)
    problems = F.array(
        *[F.concat(F.lit(f"{n}_"), group_problem(F.col(n), c, w)) for n, c, w in DAILY.groups]
    )
    parsed = parsed.withColumn("violations", F.array_compact(problems))
    first = F.try_element_at("violations", F.lit(1))
    wrong_date = F.when(F.col("other_region"), "region_mismatch").otherwise(date_problem(F.col("page_date"), F.col("selected_date")))
    return parsed.withColumns(
        {
            "status": F.when(wrong_date.isNotNull(), "failed").when(F.col("notice").isNotNull(), "no_draw")
            .when(first.isNotNull(), "failed").otherwise("success"),
            "reason": F.coalesce(wrong_date, F.when(F.col("notice").isNotNull(), "no_draw_notice"), first),
        }
    )


def prize_violations(parsed: DataFrame) -> DataFrame:
    return parsed.select("page_id", F.explode("violations").alias("violation"))


def _label(text: Column, labels: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(known, F.upper(text))


def _station_rows(table: DataFrame, profile_labels: dict[str, str], link_pattern: str) -> DataFrame:
    """(page_id, links, rows(label, cells as arrays of texts)) to one row per station value."""
    stations = table.select("*", F.posexplode("links").alias("station_index", "l"))
    values = stations.select(
        "page_id", "station_index", _code(F.col("l.href"), link_pattern).alias("station_code"), F.col("l.name").alias("station_name"),
        F.col("l.url").alias("station_url"), F.explode("rows").alias("r"),
    )
    return values.select(
        "page_id", "station_index", "station_code", "station_name", "station_url",
        _label(F.col("r.label"), profile_labels).alias("prize_group"),
        F.posexplode(F.try_element_at("r.cells", F.col("station_index") + 1)).alias("_at", "value"),
    ).where("prize_group is not null").withColumn("prize_order", (F.col("_at") + 1).cast("long")).drop("_at")


def _code(href: Column, link_pattern: str) -> Column:
    return F.upper(F.regexp_extract(href, link_pattern, 1))


def _table_problem(labels: dict[str, str], link_pattern: str) -> Column:
    links, rows = F.col("links"), F.col("rows")
    n = F.size(links)
    named = F.filter(F.transform(rows, lambda r: _label(r["label"], labels)), lambda g: g.isNotNull())
    codes = F.transform(links, lambda a: _code(a["href"], link_pattern))
    uneven = F.exists(rows, lambda r: _label(r["label"], labels).isNotNull() & (F.size(r["cells"]) != n))
    return (
        F.when(~F.col("has_table"), "table_missing").when(n == 0, "no_station_headers")
        .when(F.exists(codes, lambda c: c == ""), "station_code_unknown")
        .when(F.size(F.array_distinct(codes)) != n, "station_code_duplicate")
        .when(uneven, "station_columns").when(F.size(F.array_distinct(named)) != F.size(named), "row_duplicate")
    )


_TABLE = {"page_date": "date", "other_region": "boolean", "notice": "string", "has_table": "boolean",
          "links": "array<struct<href:string,url:string,name:string>>", "rows": "array<struct<label:string,cells:array<array<string>>>>"}


_joined = lru_cache(maxsize=8192)(urljoin)


def _links(anchors: list[Element], url: str) -> list[dict]:
    return [{"href": a.attributes.get("href", ""), "url": _joined(url, a.attributes.get("href", "")), "name": a.text()} for a in anchors]


def _own_rows(table: Element, *parts: str) -> list[Element]:
    """Rows of the table itself, in the parts named; a nested table's rows are its own."""
    return [r for r in table.all("tr") if (not parts or r.parent.tag in parts) and r.owner("table") is table]


def _direct(row: Element, *tags: str) -> list[Element]:
    return [c for c in row.children if isinstance(c, Element) and c.tag in tags]


def station_tables(pages: DataFrame, source: PageSource = PageSource("aa", per_station=True)) -> DataFrame:
    """Pages with one column per station: header links, labelled rows and the first problem found."""

    def layout(part: Element) -> tuple[bool, list[Element], list[tuple[Element, list[list[Element]]]]]:
        """Whether there is a table, its links, and its rows: label and the values' elements for each cell."""
        table = part.find(lambda e: e.tag == "table" and {"table-result", f"table-xs{source.region}"} <= set(e.classes()))
        if table is None:
            return False, [], []
        heads = [h for h in table.all("h3") if h.owner("thead") is not None and h.owner("thead").owner("table") is table]
        rows = [(label[0], _direct(row, "td")) for row in _own_rows(table, "tbody") if (label := _direct(row, "th"))]
        return True, [a for h in heads for a in h.all("a") if "href" in a.attributes], [
            (label, [[s for s in c.walk() if s.tag == "span" and "xs_prize1" in s.classes()] for c in cells]) for label, cells in rows]

    def read(page: Page, url: str) -> dict:
        section, named = _result_section(page, source), _stated(page)
        has_table, anchors, rows = page.once(("table", section), lambda: layout(section or page))
        return {"page_date": represented_date(section, named, source), "other_region": other_region(named, source), "notice": notice_of(page),
                "has_table": has_table, "links": _links(anchors, url),
                "rows": [{"label": label.text(), "cells": [[s.joined() for s in c] for c in cells]} for label, cells in rows]}

    out = _parsed(pages, read, _TABLE)
    problem = F.coalesce(
        F.when(F.col("other_region"), "region_mismatch"),
        date_problem(F.col("page_date"), F.col("selected_date")),
        F.when(F.col("notice").isNotNull(), "no_draw_notice"),
        _table_problem(ROW_LABELS, STATION_LINK),
    )
    return out.withColumn("problem", problem).drop("has_table")


def page_station_table(tables: DataFrame) -> DataFrame:
    """Sound pages to one row per (page, station, group, order); links are resolved against the page's own ``url``."""
    return _station_rows(tables.where("problem is null"), ROW_LABELS, STATION_LINK)


def fallback_tables(pages: DataFrame, source: PageSource = PageSource("aa", per_station=True)) -> DataFrame:
    """The second source: plain cells with values separated by markup; only digit texts count."""

    def layout(page: Page) -> tuple[bool, list[Element], list[tuple[Element | None, list[list[tuple[list, int]]]]]]:
        """Whether there is a table, its links, and its rows: label and where the texts of each cell stand."""
        table = page.find(lambda e: e.tag == "table" and f"tbl-xs{source.region}" in e.classes())
        if table is None:
            return False, [], []
        own = _own_rows(table)
        heads = _direct(own[0], "th")[1:] if own else []
        rows = [_direct(row, "th", "td") for row in own[1:]]
        return True, [a for h in heads for a in (h.all("a") or [Element("a", {}, None)])[:1]], [
            (cells[0] if cells else None, [c.places() for c in cells[1:]]) for cells in rows]

    def read(page: Page, url: str) -> dict:
        has_table, anchors, rows = page.once("table", lambda: layout(page))
        return {
            "page_date": headed_date(_stated(page)), "other_region": False, "notice": None, "has_table": has_table, "links": _links(anchors, url),
            "rows": [{"label": "" if label is None else label.text(),
                      "cells": [[v for texts, at in c if (v := texts[at].strip()).isascii() and v.isdigit()] for c in cells]} for label, cells in rows]}

    out = _parsed(pages, read, _TABLE)
    problem = F.coalesce(date_problem(F.col("page_date"), F.col("selected_date")), _table_problem(FALLBACK_ROW_LABELS, FALLBACK_LINK))
    return out.withColumn("problem", problem).drop("has_table", "other_region", "notice")


def page_fallback_table(tables: DataFrame) -> DataFrame:
    return _station_rows(tables.where("problem is null"), FALLBACK_ROW_LABELS, FALLBACK_LINK)


def station_violations(draws: DataFrame, keys: list[str], profile: Profile = STATION) -> DataFrame:
    """(keys, violation) for every group of a station's draw that breaks the layout: count, digits or width.

    ``draws`` has one array per group (see ``group_columns``).
    """
    problems = F.array(*[F.concat(F.lit(f"{n}_"), group_problem(F.col(n), c, w)) for n, c, w in profile.groups])
    return draws.select(*keys, F.explode(F.array_compact(problems)).alias("violation"))


def page_outlines(pages: DataFrame) -> DataFrame:
    """Title, first heading, number of links and the hosts they name, of any page."""

    def read(page: Page, url: str) -> dict:
        title, heading = page.find(lambda e: e.tag == "title"), page.find(lambda e: e.tag == "h1")
        links = [urljoin(url, a.attributes["href"]) for a in page.all("a") if "href" in a.attributes]
        hosts = {m[1].lower() for m in (re.match(r"https?://([^/?#]+)", link) for link in links) if m}
        return {"title": title.text() if title else None, "heading": heading.text() if heading else None, "links": len(links), "hosts": sorted(hosts)}

    return _parsed(pages, read, {"title": "string", "heading": "string", "links": "long", "hosts": "array<string>"})


def group_columns(values: DataFrame, keys: list[str], profile: Profile = STATION) -> DataFrame:
    """Long station values to one array per group; a page bounds its own arrays."""
    return values.groupBy(*keys).agg(
        *[
            F.transform(
                F.array_sort(
                    F.collect_list(F.when(F.col("prize_group") == n, F.struct("prize_order", "value")))
                ),
                lambda p: p["value"],
            ).alias(n)
            for n in profile.group_names
        ]
    )


