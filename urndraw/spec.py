"""Draw profiles: which prize groups a draw has, and which columns identify a draw besides its date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (prize group, number of prizes, digits per prize) in serving order.
DAILY_GROUPS = (
    ("special", 1, 5),
    ("prize1", 1, 5),
    ("prize2", 2, 5),
    ("prize3", 6, 5),
    ("prize4", 4, 4),
    ("prize5", 6, 4),
    ("prize6", 3, 3),
    ("prize7", 4, 2),
)
# The same for draws held per station.
STATION_GROUPS = (
    ("prize8", 1, 2),
    ("prize7", 1, 3),
    ("prize6", 3, 4),
    ("prize5", 1, 4),
    ("prize4", 7, 5),
    ("prize3", 2, 5),
    ("prize2", 1, 5),
    ("prize1", 1, 5),
    ("special", 1, 6),
)

# Stations that draw on each ISO weekday (1 = Monday).
SOUTH_WEEKDAYS = {
    1: ("CM", "DT", "HCM"),
    2: ("BL", "BTR", "VT"),
    3: ("CT", "DN", "ST"),
    4: ("AG", "BTH", "TN"),
    5: ("BD", "TV", "VL"),
    6: ("BP", "HCM", "HG", "LA"),
    7: ("DL", "KG", "TG"),
}
CENTRAL_WEEKDAYS = {
    1: ("PY", "TTH"),
    2: ("DLK", "QNA"),
    3: ("DNA", "KH"),
    4: ("BDI", "QB", "QT"),
    5: ("GL", "NT"),
    6: ("DNA", "DNO", "QNG"),
    7: ("KH", "KT", "TTH"),
}
# Station that joined its weekday later than the others, as (weekday, code, first date).
CENTRAL_LATE_STARTS = ((7, "TTH", "2022-01-02"),)
# Documented dates on which only some stations drew.
CENTRAL_OVERRIDES = (
    ("2021-07-27", "QNA"),
    ("2021-08-03", "QNA"),
    ("2021-08-06", "GL"),
    ("2021-08-18", "KH"),
    ("2021-08-21", "DNO"),
    ("2021-08-21", "QNG"),
    ("2021-09-04", "DNA"),
    ("2021-09-04", "DNO"),
)

# Local minute of day from which a region's own draw counts as complete.
DRAW_CUTOFFS = {"south": 16 * 60 + 35, "central": 17 * 60 + 35, "north": 18 * 60 + 35}

STATUSES = ("success", "no_draw", "missing", "failed")
CLOSED_STATUSES = ("success", "no_draw")
OPEN_STATUSES = ("missing", "failed")

ROLLING_WINDOWS = (7, 30, 90)
MODEL_KINDS = ("frequency", "gap", "balanced")
MODEL_WINDOWS = (30, 90, 180, 365)
TOP_K = 10
EVALUATION_LIMIT = 90
BOOTSTRAP_SAMPLES = 2000
RECENT_DRAWS = 455
SAMPLE_LIMIT = 25
PAGE_SIZE = 25
PAGE_SIZE_MAX = 100


@dataclass(frozen=True)
class Profile:
    """A draw is one row of ``keys``; its prizes are described by ``groups``."""

    name: str
    grain: tuple[str, ...]
    groups: tuple[tuple[str, int, int], ...]

    @property
    def keys(self) -> list[str]:
        return [*self.grain, "draw_date"]

    @property
    def named(self) -> bool:
        """Whether its draws belong to stations, which have a name, an order and a page."""
        return "station_code" in self.grain

    @property
    def per_lake(self) -> Profile:
        """The same draws where several lakes are handled side by side: a draw also has its lake."""
        return Profile(self.name, ("lake", *self.grain), self.groups)

    @property
    def prize_count(self) -> int:
        return sum(count for _, count, _ in self.groups)

    @property
    def group_names(self) -> list[str]:
        return [name for name, _, _ in self.groups]

    def width_of(self, group: Column) -> Column:
        return self._lookup(group, {name: width for name, _, width in self.groups})

    def count_of(self, group: Column) -> Column:
        return self._lookup(group, {name: count for name, count, _ in self.groups})

    def order_of(self, group: Column) -> Column:
        return self._lookup(group, {name: at for at, (name, _, _) in enumerate(self.groups)})

    @staticmethod
    def _lookup(group: Column, values: dict[str, int]) -> Column:
        out = F.lit(None).cast("long")
        for name, value in values.items():
            out = F.when(group == name, F.lit(value).cast("long")).otherwise(out)
        return out

    def wide_columns(self) -> list[tuple[str, str, int]]:
        """(column, group, order) of the wide one-row-per-draw layout."""
        return [
            (name if count == 1 else f"{name}_{order}", name, order)
            for name, count, _ in self.groups
            for order in range(1, count + 1)
        ]


DAILY = Profile("daily", (), DAILY_GROUPS)
STATION = Profile("station", ("station_code",), STATION_GROUPS)


def prize_spec(spark: SparkSession, *profiles: Profile) -> DataFrame:
    """The layout as a table: one row per profile and prize group (17 rows for both profiles)."""
    rows = [
        (p.name, name, at, count, width)
        for p in profiles
        for at, (name, count, width) in enumerate(p.groups)
    ]
    return spark.createDataFrame(
        rows, "profile string, prize_group string, group_order long, prize_count long, prize_width long"
    )


def numbers_column() -> Column:
    """The 100 two-digit numbers as one array literal."""
    return F.transform(F.sequence(F.lit(0), F.lit(99)), lambda n: F.lpad(n.cast("string"), 2, "0"))


def published_calendar(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The published weekday calendar and its dated overrides, both effective-dated tables."""
    late = {(weekday, code): start for weekday, code, start in CENTRAL_LATE_STARTS}
    rows = [
        (region, weekday, code, late.get((weekday, code), "1900-01-01") if region == "central" else "1900-01-01", "9999-12-31")
        for region, days in (("south", SOUTH_WEEKDAYS), ("central", CENTRAL_WEEKDAYS))
        for weekday, codes in days.items()
        for code in codes
    ]
    calendar = spark.createDataFrame(
        rows, "region string, weekday int, station_code string, valid_from string, valid_to string"
    ).select(
        "region", "weekday", "station_code",
        F.to_date("valid_from").alias("valid_from"), F.to_date("valid_to").alias("valid_to"),
    )
    overrides = spark.createDataFrame(
        [("central", day, code) for day, code in CENTRAL_OVERRIDES],
        "region string, draw_date string, station_code string",
    ).withColumn("draw_date", F.to_date("draw_date"))
    return calendar, overrides
