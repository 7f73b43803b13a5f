"""History audit: every rule yields offending rows as text; findings count them and keep samples.

Inputs are raw published tables whose columns may hold anything: dates, numbers and orders are
text and are cast with ``try_cast``, so a damaged row becomes a finding and never a failed job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urndraw.functions.ranking import first_k_per
from urndraw.functions.text import is_digits, tail_2d, zero_pad
from urndraw.operators.calendars import set_mismatch
from urndraw.operators.census import count_numbers, different, repeated_numbers
from urndraw.operators.state import release_integrity
from urndraw.spec import SAMPLE_LIMIT, STATUSES, Profile

STATION_CODE = "^[A-Z0-9]{2,8}$"  # fixed value

REQUIRED = {
    "dim-date": {"date", "draw_status"},
    "fact": {"draw_date", "prize_group", "prize_order", "prize_width", "full_number", "formatted_number", "loto_2d",
             "tens_digit", "ones_digit", "run_id"},
    "loto": {"draw_date", "number_2d", "frequency", "appeared", "run_id"},
    "dim-station": {"station_code", "first_draw_date", "latest_draw_date"},
}


class Published:
    """What an audit looks at: named tables, each built when a rule first asks for it.

    Tables: dates, fact, loto, stations, expected, manifest, store (object tables) and required
    (the keys that must be referenced). ``keep`` writes what several rules share and reads it back; without one it is
    computed for each of them.
    """

    def __init__(self, profile: Profile, run_id: str, start: str, end: str, tables: dict[str, Callable[[], DataFrame]],
                 keep: Callable[[DataFrame], DataFrame] | None = None):
        self.profile, self.run_id, self.start, self.end = profile, run_id, start, end
        self._tables = {name: cache(build) for name, build in tables.items()}
        self._shared: dict[str, DataFrame] = {}
        self._keep = keep or (lambda df: df)

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._shared:
            self._shared[name] = self._keep(build())
        return self._shared[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        return self._tables[name]()

    def between(self, day: Column) -> Column:
        return day.between(F.lit(self.start).cast("date"), F.lit(self.end).cast("date"))


def missing_columns(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Pre-check: columns a table lacks. Such a table cannot be audited."""
    return {name: sorted(REQUIRED[name] - set(df.columns)) for name, df in tables.items() if REQUIRED[name] - set(df.columns)}


def _day(name: str) -> Column:
    return F.expr(f"try_cast({name} as date)")


def _whole(df: DataFrame, name: str) -> Column:
    """The value as a whole number, NULL when it is none; only odd spellings take the slow way."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    number = F.expr(f"try_cast({name} as double)")
    exact = F.when(number == F.floor(number), F.expr(f"try_cast({name} as decimal(38,0))").cast("long"))
    return F.coalesce(F.expr(f"try_cast({name} as bigint)"), exact) if isinstance(kind, T.StringType) else exact


def _text(*names: str) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(n).cast("string"), F.lit("<null>")) for n in names])


def _bad(rows: DataFrame, text: Column) -> DataFrame:
    return rows.select(text.alias("txt"))


def _fact(p: Published) -> DataFrame:
    return p.fact.withColumn("_day", _day("draw_date"))


def _loto(p: Published) -> DataFrame:
    return p.loto.withColumn("_day", _day("draw_date"))


def _loto_in(p: Published) -> DataFrame:
    return _loto(p).where(p.between(F.col("_day")))


def _grain(p: Published) -> list[str]:
    return ["_day", *p.profile.grain]


def _cells(p: Published) -> DataFrame:
    """The prize fact as counts per place and number, in and out of the audited range: what all grouped rules read."""
    keys = [*_grain(p), "prize_group", "prize_order", "loto_2d"]
    return p.shared("cells", lambda: _fact(p).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))


def _cells_in(p: Published) -> DataFrame:
    return _cells(p).where(p.between(F.col("_day")))


def _numbers(p: Published) -> DataFrame:
    """The dense fact counted by draw: what all its grouped rules read."""
    return p.shared("numbers", lambda: count_numbers(_loto_in(p), _grain(p), _whole(p.loto, "frequency")))


def _times(rows: DataFrame, count: str, text: Column) -> DataFrame:
    """An offence for each of the rows that a count stands for."""
    return rows.select(F.explode(F.array_repeat(text, F.col(count).cast("int"))).alias("txt"))


def status_by_date(p: Published) -> DataFrame:
    return p.shared("status", lambda: _status_by_date(p))


def _status_by_date(p: Published) -> DataFrame:
    """One row per date of the audited range: its valid status, else missing."""
    days = p.dates.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(p.start).cast("date"), F.lit(p.end).cast("date"))).alias("_day")
    )
    last = (
        p.dates.withColumn("_day", _day("date")).where(p.between(F.col("_day")))
        .groupBy("_day").agg(F.max_by(F.struct("draw_status"), "seq").alias("_s"))
        .select("_day", F.col("_s.draw_status").alias("raw_status"), F.lit(True).alias("present"))
    )
    known = F.col("raw_status").isin(*STATUSES)
    return days.join(last, "_day", "left").withColumn(
        "status", F.when(known, F.col("raw_status")).otherwise(F.lit("missing"))
    )


def _dates_invalid(p):
    return _bad(p.dates.where(_day("date").isNull()), _text("date"))


def _dates_duplicate(p):
    rows = p.dates.withColumn("_day", _day("date")).where(p.between(F.col("_day")))
    return _bad(rows.groupBy("_day").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), _text("_day"))


def _offences(rows: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """All row rules of one table in one scan: (code, txt) for every rule a row breaks."""
    broken = [
        F.when(is_bad, F.struct(F.lit(code).alias("code"), text.alias("txt"))) for code, (is_bad, text) in rules.items()
    ]
    return rows.select(F.inline(F.array_compact(F.array(*broken))))


def _calendar(p: Published, codes: list[str]) -> DataFrame:
    """Status and alignment rules: one row per date of the range, with the presence of facts if needed."""
    rows = status_by_date(p)
    aligned = {"success-date-missing-draw-facts", "success-date-missing-loto-facts", "no-draw-has-facts", "incomplete-date-has-facts"}
    if aligned & set(codes):
        for name, table in (("has_fact", _cells_in(p)), ("has_loto", _numbers(p))):
            rows = rows.join(table.select("_day").distinct().withColumn(name, F.lit(True)), "_day", "left")
    day, status, raw = _text("_day"), F.col("status"), F.col("raw_status")
    has_fact, has_loto = (F.coalesce(F.col(n), F.lit(False)) if aligned & set(codes) else F.lit(False) for n in ("has_fact", "has_loto"))
    rules = {
        "dim-date-calendar-gap": (F.col("present").isNull(), day),
        "draw-status-invalid": (raw.isNotNull() & ~raw.isin(*STATUSES), day),
        "draw-status-missing": (status == "missing", day),
        "draw-status-failed": (status == "failed", day),
        "success-date-missing-draw-facts": ((status == "success") & ~has_fact, day),
        "success-date-missing-loto-facts": ((status == "success") & ~has_loto, day),
        "no-draw-has-facts": ((status == "no_draw") & (has_fact | has_loto), day),
        "incomplete-date-has-facts": (status.isin("missing", "failed") & (has_fact | has_loto), day),
    }
    return _offences(rows, {code: rules[code] for code in codes})


def _fact_duplicate(p):
    keys = [*_grain(p), "prize_group", "prize_order"]
    repeated = _cells_in(p).groupBy(*keys).agg(F.sum("_n").alias("_n")).where("_n > 1")
    return _times(repeated, "_n", _text(*keys))


def _fact_count(p):
    sizes = _cells_in(p).groupBy(*_grain(p)).agg(F.sum("_n").alias("_n")).where(F.col("_n") != p.profile.prize_count)
    return _bad(sizes, F.concat(_text(*_grain(p)), F.lit("="), F.col("_n").cast("string")))


def _fact_layout(p):
    rows = _cells_in(p).withColumn("_order", _whole(p.fact, "prize_order"))
    count = p.profile.count_of(F.col("prize_group"))
    usable = F.col("prize_group").isNotNull() & F.col("_order").isNotNull()
    known = F.coalesce(F.col("_order").between(F.lit(1), count), F.lit(False))
    places = rows.groupBy(*_grain(p), "prize_group", "_order").agg(F.first(usable).alias("_use"), F.first(known).alias("_ok"))
    sets = places.groupBy(*_grain(p)).agg(
        F.count(F.when(F.col("_use") & F.col("_ok"), 1)).alias("_in"), F.count(F.when(F.col("_use") & ~F.col("_ok"), 1)).alias("_out")
    )
    return _bad(sets.where((F.col("_in") != p.profile.prize_count) | (F.col("_out") > 0)), _text(*_grain(p)))


def _sound_prize(p: Published) -> Column:
    width = p.profile.width_of(F.col("prize_group"))
    full, order = _whole(p.fact, "full_number"), _whole(p.fact, "prize_order")
    expected = zero_pad(full, width)
    loto = F.col("loto_2d")
    return (
        width.isNotNull() & order.isNotNull() & (_whole(p.fact, "prize_width") == width) & (full >= 0)
        & (full < F.pow(F.lit(10), width).cast("long"))
        & is_digits(F.col("formatted_number")) & (F.col("formatted_number") == expected)
        & is_digits(loto, 2) & (loto == tail_2d(expected))
        & (_whole(p.fact, "tens_digit") == F.expr("try_cast(substr(loto_2d, 1, 1) as bigint)"))
        & (_whole(p.fact, "ones_digit") == F.expr("try_cast(substr(loto_2d, 2, 1) as bigint)"))
    )


def _not(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _fact_rows(p: Published, codes: list[str]) -> DataFrame:
    inside, raw = p.between(F.col("_day")), ["draw_date", *p.profile.grain, "prize_group", "prize_order"]
    rules = {
        "fact-run-id-mismatch": (~F.col("run_id").eqNullSafe(F.lit(p.run_id)), _text(*raw, "run_id")),
        "fact-draw-date-invalid": (F.col("_day").isNull(), _text(*raw)),
        "fact-prize-integrity-invalid": (inside & _not(_sound_prize(p)), _text(*_grain(p), "prize_group", "prize_order")),
    }
    return _offences(_fact(p), {code: rules[code] for code in codes})


def _loto_rows(p: Published, codes: list[str]) -> DataFrame:
    inside, raw = p.between(F.col("_day")), ["draw_date", *p.profile.grain, "number_2d"]
    frequency, key = _whole(p.loto, "frequency"), _text(*_grain(p), "number_2d")
    appeared = F.expr("try_cast(appeared as boolean)") == F.coalesce(frequency > 0, F.lit(False))
    rules = {
        "loto-run-id-mismatch": (~F.col("run_id").eqNullSafe(F.lit(p.run_id)), _text(*raw, "run_id")),
        "loto-draw-date-invalid": (F.col("_day").isNull(), _text(*raw)),
        "loto-number-invalid": (inside & _not(is_digits(F.col("number_2d"), 2)), key),
        "loto-frequency-invalid": (inside & _not(frequency >= 0), key),
        "loto-appeared-invalid": (inside & _not(appeared), key),
    }
    return _offences(_loto(p), {code: rules[code] for code in codes})


def _loto_draws(p: Published, codes: list[str]) -> DataFrame:
    """Row count, frequency sum and coverage of each draw."""
    good = is_digits(F.col("number"), 2)
    draws = _numbers(p).groupBy(*_grain(p)).agg(
        F.sum("rows").alias("_rows"), F.sum("value").alias("_sum"),
        F.sum(different() + F.when(good, 1).otherwise(0)).alias("_in"), F.count(F.when(~good, 1)).alias("_out"),
    )

    def shown(name):
        return F.concat(_text(*_grain(p)), F.lit("="), F.coalesce(F.col(name).cast("string"), F.lit("<null>")))

    rules = {
        "loto-row-count-invalid": (F.col("_rows") != 100, shown("_rows")),
        "loto-frequency-sum-invalid": (~F.col("_sum").eqNullSafe(F.lit(p.profile.prize_count).cast("long")), shown("_sum")),
        "loto-number-coverage-invalid": ((F.col("_in") != 100) | (F.col("_out") > 0), _text(*_grain(p))),
    }
    return _offences(draws, {code: rules[code] for code in codes})


def _loto_duplicate(p):
    keys = [*_grain(p), "number_2d"]
    return _times(repeated_numbers(_numbers(p), _grain(p)), "rows", _text(*keys))


def _loto_mismatch(p):
    keys = [*_grain(p), "number_2d"]
    again = _cells_in(p).groupBy(*_grain(p), F.col("loto_2d").alias("number_2d")).agg(F.sum("_n").alias("_expected"))
    rows = _loto_in(p).select(*keys, _whole(p.loto, "frequency").alias("_f")).join(again, keys, "left")
    return _bad(rows.where(~F.col("_f").eqNullSafe(F.coalesce("_expected", F.lit(0)))), _text(*keys))


def _station_sets(p):
    success = status_by_date(p).where("status = 'success'").select("_day")
    expected = p.expected.select(F.col("draw_date").alias("_day"), "station_code").join(success, "_day", "left_semi")
    wrong = [
        set_mismatch(
            rows.select("_day", "station_code").distinct().join(success, "_day", "left_semi"), expected, ["_day", "station_code"]
        )
        for rows in (_cells_in(p), _numbers(p))
    ]
    return _bad(wrong[0].unionByName(wrong[1]).select("_day").distinct(), _text("_day"))


def _station_code(p):
    return _bad(p.stations.where(~F.coalesce(F.col("station_code").rlike(STATION_CODE), F.lit(False))), _text("station_code"))


def _station_duplicate(p):
    return _bad(
        p.stations.where("station_code is not null").groupBy("station_code").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        _text("station_code"),
    )


def _station_range(p):
    first, last = _day("first_draw_date"), _day("latest_draw_date")
    return _bad(p.stations.where(first.isNull() | last.isNull() | (first > last)), _text("station_code"))


def _station_codes(p):
    wrong = set_mismatch(
        _cells(p).where("station_code is not null").select("station_code"),
        p.stations.where("station_code is not null").select("station_code"), ["station_code"],
    )
    # 'unexpected' is in the facts only, so missing in the dimension
    side = F.when(F.col("problem") == "unexpected", "missing ").otherwise("extra ")
    return _bad(wrong, F.concat(side, "station_code"))


def _station_dates(p):
    actual = _cells(p).where("_day is not null").groupBy("station_code").agg(F.min("_day").alias("_a"), F.max("_day").alias("_b"))
    rows = p.stations.select("station_code", _day("first_draw_date").alias("_f"), _day("latest_draw_date").alias("_l"))
    joined = rows.join(actual, "station_code").where("_f is not null and _l is not null")
    return _bad(joined.where("_f <> _a or _l <> _b"), _text("station_code", "_a", "_b"))


def _checked(p: Published) -> DataFrame:
    return p.shared("checked", lambda: release_integrity(p.manifest, p.store))


_OBJECT_ISSUES = {
    "gold-reference-duplicate": "duplicate_reference", "gold-object-missing": "missing",
    "gold-object-size-mismatch": "size", "gold-object-checksum-mismatch": "sha256",
}


def _objects(p: Published, codes: list[str]) -> DataFrame:
    return _offences(_checked(p), {code: (F.col("issue") == _OBJECT_ISSUES[code], _text("key")) for code in codes})


def _reference_missing(p):
    return _bad(p.required.join(p.manifest.select("key").distinct(), "key", "left_anti"), _text("key"))


def _publication(p):
    prefix = f"gold/releases/run-id={p.run_id}/"
    outside = p.manifest.where(~F.col("key").startswith(prefix)).select(F.concat(F.lit("outside "), "key").alias("txt"))
    broken = _checked(p).where("issue in ('missing', 'size', 'sha256')").select(F.concat_ws(" ", "issue", "key").alias("txt"))
    repeated = _checked(p).where("issue = 'duplicate_reference'").limit(1).select(F.lit("duplicate object keys").alias("txt"))
    return outside.unionByName(broken).unionByName(repeated)



def _one(rule: Callable[[Published], DataFrame]) -> Callable[[Published, list[str]], DataFrame]:
    return lambda p, codes: rule(p).select(F.lit(codes[0]).alias("code"), "txt")


# rules that share a scan, a grouping or a join stand together
FAMILIES: tuple[tuple[tuple[str, ...], Callable[[Published, list[str]], DataFrame]], ...] = (
    (("lake-publication-invalid",), _one(_publication)),
    (tuple(_OBJECT_ISSUES), _objects),
    (("gold-reference-missing",), _one(_reference_missing)),
    (("dim-date-values-invalid",), _one(_dates_invalid)),
    (("dim-date-business-key-duplicate",), _one(_dates_duplicate)),
    (("dim-date-calendar-gap", "draw-status-invalid", "draw-status-missing", "draw-status-failed",
      "success-date-missing-draw-facts", "success-date-missing-loto-facts", "no-draw-has-facts",
      "incomplete-date-has-facts"), _calendar),
    (("fact-run-id-mismatch", "fact-draw-date-invalid", "fact-prize-integrity-invalid"), _fact_rows),
    (("fact-business-key-duplicate",), _one(_fact_duplicate)),
    (("fact-row-count-invalid",), _one(_fact_count)),
    (("fact-prize-layout-invalid",), _one(_fact_layout)),
    (("loto-run-id-mismatch", "loto-draw-date-invalid", "loto-number-invalid", "loto-frequency-invalid",
      "loto-appeared-invalid"), _loto_rows),
    (("loto-business-key-duplicate",), _one(_loto_duplicate)),
    (("loto-row-count-invalid", "loto-frequency-sum-invalid", "loto-number-coverage-invalid"), _loto_draws),
    (("loto-frequency-fact-mismatch",), _one(_loto_mismatch)),
    (("station-set-mismatch",), _one(_station_sets)),
    (("dim-station-code-invalid",), _one(_station_code)),
    (("dim-station-business-key-duplicate",), _one(_station_duplicate)),
    (("dim-station-range-invalid",), _one(_station_range)),
    (("dim-station-code-set-mismatch",), _one(_station_codes)),
    (("dim-station-range-mismatch",), _one(_station_dates)),
)
RULES = tuple(code for codes, _ in FAMILIES for code in codes)
# rules that are one finding however many members differ
SINGLE = frozenset({"dim-station-code-set-mismatch"})


def findings(published: Published, codes: list[str], staging: str | None = None) -> DataFrame:
    """One row per rule: count of offending rows and the first samples as text.

    Samples are ranked per rule with the limit applied in every task first, so a rule with many
    offenders is counted, not collected. Counting and sampling both read the offences; with a
    ``staging`` path they are written there once instead of being computed twice.
    """
    if unknown := set(codes) - set(RULES):
        raise ValueError(f"unknown audit rules: {sorted(unknown)}")
    parts = [rule(published, own) for family, rule in FAMILIES if (own := [c for c in family if c in codes])]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    if staging is not None:
        rows.write.parquet(staging)
        rows = rows.sparkSession.read.schema("code string, txt string").parquet(staging)
    counts = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    samples = first_k_per(rows, ["code"], [F.asc("txt")], SAMPLE_LIMIT).groupBy("code").agg(
        F.array_join(F.array_sort(F.collect_list("txt")), "; ").alias("samples")
    )
    spark = rows.sparkSession
    every = spark.createDataFrame([(code,) for code in codes], "code string")
    n = F.coalesce("n", F.lit(0).cast("long"))
    return every.join(counts, "code", "left").join(samples, "code", "left").select(
        "code", F.lit("critical").alias("severity"), (n == 0).alias("passed"),
        F.when(F.col("code").isin(*SINGLE), F.least(n, F.lit(1).cast("long"))).otherwise(n).alias("finding_count"),
        "samples",
    )
