"""Repair a damaged primary source from an independent second one, or reject the whole date.

Both sides have one row per (draw_date, station_code) with one array column per prize group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urndraw.functions.once import with_once
from urndraw.functions.text import is_digits, is_placeholder, normal_name
from urndraw.operators.parse import group_problem
from urndraw.spec import STATION

GROUPS = STATION.group_names
MINIMUM_DAYWIDE = 4  # fixed value: stations a date needs for the day-wide rule


def _single(values: Column) -> Column:
    return F.size(values) == 1


def _one_of_width(values: Column, width: int) -> Column:
    return _single(values) & is_digits(values[0], width)


def classify(primary: DataFrame) -> DataFrame:
    """ok / truncated_special / recoverable / not_recoverable per station, and whether the date goes on.

    A date is looked up in the second source when its first faulty station is repairable.
    """
    problems = {n: group_problem(F.col(n), c, w) for n, c, w in STATION.groups}
    faulty = F.array_compact(F.array(*[F.when(p.isNotNull(), F.lit(n)) for n, p in problems.items()]))
    any_placeholder = F.exists(F.flatten(F.array(*[F.col(n) for n in GROUPS])), is_placeholder)
    exchanged = _one_of_width(F.col("prize8"), 3) & _one_of_width(F.col("prize7"), 2)
    kind = (
        F.when(F.size("_faulty") == 0, "ok")
        .when((F.col("_faulty") == F.array(F.lit("special"))) & _one_of_width(F.col("special"), 5), "truncated_special")
        .when(any_placeholder | exchanged, "recoverable")
        .otherwise("not_recoverable")
    )
    rows = with_once(with_once(primary, {"_faulty": faulty}), {"kind": kind}).drop("_faulty")
    first = rows.where("kind <> 'ok'").groupBy("draw_date").agg(F.min_by("kind", "station_order").alias("_first"))
    return rows.join(first, "draw_date", "left").withColumn(
        "needs_fallback", F.coalesce(F.col("_first").isin("truncated_special", "recoverable"), F.lit(False))
    ).drop("_first")


def match_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Pair stations per date by code, the rest by name; every station may be used once.

    Returns all stations of both sides: ``how`` is code or name, NULL when there is no single partner. A code that a side
    has twice on a date names nobody there, and neither does such a name.
    """
    def side(df: DataFrame, left: bool) -> DataFrame:
        return df.select("draw_date", F.col("station_code").alias("code"), F.col("station_name").alias("name"), F.lit(left).alias("_left"))

    left, code = F.col("_left"), F.col("code")
    stated = code.isNotNull() & F.col("draw_date").isNotNull()

    def single(window: W, *tests: Column) -> Column:
        """One row on either side, of those that pass."""
        passed = [F.count_if(F.lit(True) & t).over(window) == 1 for t in tests]
        return passed[0] & passed[1]

    rows = side(primary, True).unionAll(side(fallback, False))
    rows = rows.withColumn("_coded", stated & single(W.partitionBy("draw_date", "code"), left, ~left))
    # a name that occurs more than once on a side names nobody, so the pairs stay one to one
    rows = rows.withColumn("_name", F.when(F.col("_coded"), code).otherwise(normal_name(F.col("name")))).drop("name")
    by_name = W.partitionBy("draw_date", "_coded", "_name")
    named = ~F.col("_coded") & F.col("_name").isNotNull() & F.col("draw_date").isNotNull() & single(by_name, left, ~left)
    rows = rows.withColumns({"_named": named, "_other": F.max(F.when(~left, code)).over(by_name)})
    # a code that goes by name once is not alone in its other rows
    gone = stated & F.bool_or("_named").over(W.partitionBy("draw_date", "code", "_left"))
    rows = rows.withColumn("_alone", ~F.col("_coded") & ~gone)

    def pair(holds: Column, a: Column, b: Column, how: str | None) -> Column:
        return F.when(holds, F.struct(
            a.alias("station_code"), b.alias("fallback_code"), F.lit(how).cast("string").alias("how")))

    nobody = F.lit(None).cast("string")
    return rows.select("draw_date", F.inline(F.array_compact(F.array(
        pair(F.col("_coded") & left, code, code, "code"), pair(F.col("_named") & left, code, F.col("_other"), "name"),
        pair(F.col("_alone") & left, code, nobody, None), pair(F.col("_alone") & ~left, nobody, code, None)))))


def is_transposed(p8: Column, p7: Column, f8: Column, f7: Column) -> Column:
    return _single(p8) & _single(p7) & _single(f8) & _single(f7) & (p8 == f7) & (p7 == f8)


def is_truncated(primary: Column, fallback: Column) -> Column:
    return _one_of_width(primary, 5) & _one_of_width(fallback, 6) & F.endswith(fallback[0], primary[0])


def equals_but_placeholders(primary: Column, fallback: Column) -> Column:
    same = F.forall(F.zip_with(primary, fallback, lambda p, f: (p == f) | is_placeholder(p)), lambda ok: ok)
    return (F.size(primary) == F.size(fallback)) & F.exists(primary, is_placeholder) & same


def reconcile(
    primary: DataFrame, fallback: DataFrame, matches: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """One row per primary station: a rule per group, repaired arrays, and the verdict on its date.

    What is accepted comes from the second source or equals it, so a group of it that breaks the layout rejects the date: the
    final arrays are valid draws. ``keep`` writes what is read more than once and reads it back; without one it is computed again.
    """
    matches = keep(matches)
    f = fallback.select("draw_date", F.col("station_code").alias("fallback_code"), *[F.col(n).alias(f"f_{n}") for n in GROUPS])
    pairs = matches.where("how is not null").select("draw_date", "station_code", "fallback_code")
    rows = primary.join(pairs, ["draw_date", "station_code"], "left").join(f, ["draw_date", "fallback_code"], "left")
    exchanged = is_transposed(F.col("prize8"), F.col("prize7"), F.col("f_prize8"), F.col("f_prize7"))
    rows = with_once(rows, {"transposed": F.coalesce(exchanged, F.lit(False))})

    shapes = {name: (count, width) for name, count, width in STATION.groups}

    def rule(name: str, daywide: bool = False) -> Column:
        p, q = F.col(name), F.col(f"f_{name}")
        out = F.when(q.isNull() | group_problem(q, *shapes[name]).isNotNull(), "reject").when(p.eqNullSafe(q), "equal")
        if name in ("prize8", "prize7"):
            out = out.when(F.col("transposed"), "transposed")
        if name == "special":
            out = out.when(is_truncated(p, q), "truncated")
        if daywide:
            return out.otherwise("daywide")
        return out.when(equals_but_placeholders(p, q), "placeholder").otherwise("reject")

    special, other = F.col("special"), F.col("f_special")
    shape = _one_of_width(special, 5) & _one_of_width(other, 6)
    suffix = shape & F.endswith(other[0], special[0])
    # the rule of the special prize waits for its day: both that it may have
    rows = keep(with_once(rows, {
        **{f"rule_{n}": rule(n) for n in GROUPS}, "_special_daywide": rule("special", True),
        "_shape": F.coalesce(shape, F.lit(False)), "_suffix": F.coalesce(suffix, F.lit(False))}))
    bad = F.col("fallback_code").isNull()
    for n in GROUPS:
        if n != "special":
            bad = bad | (F.col(f"rule_{n}") == "reject")
    unmatched = matches.where("how is null").select("draw_date").distinct().withColumn("_unmatched", F.lit(True))
    # the day-wide facts are one row per calendar day
    days = rows.groupBy("draw_date").agg(
        F.count(F.lit(1)).alias("_stations"), F.count_if("_shape").alias("_shapes"), F.count_if("_suffix").alias("_suffixes"),
        F.bool_or(bad | (F.col("rule_special") == "reject")).alias("_bad"),
        F.bool_or(bad | (F.col("_special_daywide") == "reject")).alias("_bad_daywide"),
    ).join(unmatched, "draw_date", "left")
    daywide = (
        (F.col("_stations") >= MINIMUM_DAYWIDE) & (F.col("_shapes") == F.col("_stations"))
        & (F.col("_suffixes") >= F.col("_stations") - 1)
    )
    rejected = F.when(daywide, F.col("_bad_daywide")).otherwise(F.col("_bad"))
    verdict = F.when(F.col("_unmatched"), "station_sets_differ").when(rejected, "values_differ").otherwise("accepted")
    days = keep(days.select("draw_date", daywide.alias("daywide"), verdict.alias("verdict")))
    rows = rows.join(days, "draw_date").withColumn(
        "rule_special", F.when(F.col("daywide"), F.col("_special_daywide")).otherwise(F.col("rule_special"))
    ).drop("_special_daywide", "_shape", "_suffix")
    fixed = {
        n: F.when(F.col("verdict") != "accepted", F.lit(None)).when(F.col(f"rule_{n}") == "equal", F.col(n)).otherwise(F.col(f"f_{n}"))
        for n in GROUPS
    }
    return rows.withColumns({f"final_{n}": c for n, c in fixed.items()})


def rules_long(reconciled: DataFrame) -> DataFrame:
    """(date, station, group, rule) for every group of every paired station."""
    entries = F.array(*[F.struct(F.lit(n).alias("prize_group"), F.col(f"rule_{n}").alias("rule")) for n in GROUPS])
    return reconciled.where("fallback_code is not null").select("draw_date", "station_code", "verdict", F.inline(entries))
