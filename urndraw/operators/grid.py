"""The dense draw x 100 numbers fact with recurrence gaps and rolling sums.

Prize rows are counted per (draw, number) before anything else, so a draw leaves the first shuffle
as at most 100 rows however many prizes it has. The windows run per (station, number) over those
rows; a station has at most one draw per calendar day, which bounds a window to some hundred
rows per year. Rolling sums are differences of one running sum, so a row costs the same for
7 draws and for 365.

The dense fact itself is worked out by station: its draws, one row per calendar day at most, are a matrix of draws by
100 numbers, and a draw stays one row, with arrays of 100 values, until the rows are spread out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urndraw.functions.once import fan_out
from urndraw.spec import ROLLING_WINDOWS, Profile, numbers_column


def draw_counts(rows: DataFrame, profile: Profile, number: str = "number_2d") -> DataFrame:
    """How often each number came up in each draw.

    The name is a grouping key, not an aggregate: a maximum of strings would make Spark sort the
    prize rows before the shuffle, a plain count is hashed. A draw under two names gives one row
    per name; ``fold_draws`` adds them up.
    """
    names = ["station_name"] if profile.named else []
    return rows.groupBy(*profile.keys, *names, F.col(number).alias("number_2d")).agg(F.count(F.lit(1)).alias("frequency"))


def fold_draws(counts: DataFrame, profile: Profile) -> DataFrame:
    """One row per draw with its counts as a map of at most 100 entries.

    Folded rows lie together by station, which serves every later window by (station, number) and group by (station,
    date): the rows spread out to 100 per draw never cross the network. Without stations they lie by date.
    """
    names = [F.max("station_name").alias("station_name")] if profile.named else []
    entries = F.col("_entries")
    numbers = F.array_distinct(F.transform(entries, lambda e: e["number_2d"]))

    def total(n: Column) -> Column:
        own = F.filter(entries, lambda e: e["number_2d"] == n)
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, e: acc + e["frequency"])

    merged = F.transform(numbers, lambda n: F.struct(n.alias("number_2d"), total(n).alias("frequency")))
    folded = fan_out(counts, *(profile.grain or profile.keys)).groupBy(*profile.keys).agg(
        F.collect_list(F.struct("number_2d", "frequency")).alias("_entries"), *names
    )
    once = F.size(numbers) == F.size(entries)
    return folded.withColumn("counts", F.map_from_entries(F.when(once, entries).otherwise(merged))).drop("_entries")


def spread_draws(folded: DataFrame) -> DataFrame:
    """Every draw with all 100 numbers, 0 where a number did not come up."""
    kept = [c for c in folded.columns if c != "counts"]
    return folded.select(*kept, "counts", F.explode(numbers_column()).alias("number_2d")).select(
        *kept, "number_2d", F.coalesce(F.try_element_at("counts", F.col("number_2d")), F.lit(0)).alias("frequency")
    )


def dense_grid(counts: DataFrame, profile: Profile) -> DataFrame:
    """Draws x 100 numbers, without a cross join and without a join back to the counts."""
    return spread_draws(fold_draws(counts, profile))


def newest_draws(folded: DataFrame, profile: Profile, last: int | None = None) -> DataFrame:
    """Folded draws with ``draw_index`` 1 for the newest of each station, optionally the last N only.

    A station has at most one draw per calendar day; the daily profile has one row per day in all.
    """
    w = W.partitionBy(*profile.grain) if profile.grain else W
    index = F.row_number().over(w.orderBy(F.desc("draw_date"))).cast("long")
    out = folded.withColumn("draw_index", index)
    return out if last is None else out.where(F.col("draw_index") <= last)


def draw_positions(counts: DataFrame, profile: Profile) -> DataFrame:
    """Ordinal of each draw, one row per draw."""
    draws = counts.select(*profile.keys).distinct()
    w = W.partitionBy(*profile.grain).orderBy("draw_date")
    return draws.withColumn("draw_position", F.row_number().over(w).cast("long"))


#: What is known of a station before its first draw here: for each number seen, how far back the first draw finds it and the day it
#: came up, and what came up in the last draws, by their distance to the first draw.
STATE = "last array<struct<n:int,gap:bigint,day:int>>, tail array<struct<back:int,n:int,f:bigint>>"
_ARRAYS = ("frequency", "draws_since_previous", "calendar_days_since_previous", *[f"rolling_{n}_frequency" for n in ROLLING_WINDOWS])
_REACH = max(ROLLING_WINDOWS)
_NEVER, _NO_DAY = np.iinfo(np.int64).min // 2, np.iinfo(np.int32).min


def number_index(number: Column) -> Column:
    """0 to 99 for the 100 numbers, else NULL."""
    return F.when(number.rlike("^[0-9]{2}$"), F.expr("try_cast(number_2d as int)"))


def drawn_numbers(counts: DataFrame, profile: Profile) -> DataFrame:
    """One row per draw with what came up in it; rows lie together by station. A draw under two names may have a number twice."""
    names = [F.max("station_name").alias("station_name")] if profile.named else []
    entry = F.struct(number_index(F.col("number_2d")).alias("n"), F.col("frequency").cast("long").alias("f"))
    return fan_out(counts, *(profile.grain or profile.keys)).groupBy(*profile.keys).agg(F.collect_list(entry).alias("drawn"), *names)


def _entries(lists: pa.ChunkedArray) -> tuple[np.ndarray, pa.StructArray]:
    """Which row each entry of a list column is of, and the entries."""
    lists = lists.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.value_parent_indices().to_numpy(), lists.flatten()


def _field(entries: pa.StructArray, name: str, missing: int) -> np.ndarray:
    return entries.field(name).fill_null(missing).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)


class _Series:
    """One station's draws in the order of their days, and the state before them, if there is one."""

    def __init__(self, rows: pa.Table) -> None:
        first, known, before = np.full(100, _NEVER), np.full(100, _NO_DAY, np.int64), np.zeros((_REACH, 100), np.int64)
        if "last" in rows.column_names:
            state = rows.filter(rows["last"].is_valid())
            rows = rows.filter(rows["last"].is_null())
            if state.num_rows:
                last, tail = _entries(state["last"])[1], _entries(state["tail"])[1]
                n = _field(last, "n", 0)
                first[n], known[n] = -_field(last, "gap", 0), _field(last, "day", _NO_DAY)
                back = _field(tail, "back", 0)
                near = back <= _REACH
                before[_REACH - back[near], _field(tail, "n", 0)[near]] = _field(tail, "f", 0)[near]
        day = rows["day"].fill_null(_NO_DAY).to_numpy().astype(np.int64)
        order = np.argsort(day, kind="stable")  # a draw without a date comes first
        self.rows, self.day, self.before = rows.take(pa.array(order)), day[order], before
        size = len(order)
        draw, entries = _entries(self.rows["drawn"])
        n = _field(entries, "n", -1)
        self.frequency = np.zeros((size, 100), np.int64)
        np.add.at(self.frequency, (draw[n >= 0], n[n >= 0]), _field(entries, "f", 0)[n >= 0])
        came = np.where(self.frequency > 0, np.arange(size)[:, None], _NEVER)
        #: The place of each number's last appearance up to a draw; the first row is before all draws.
        self.seen = np.maximum.accumulate(np.vstack([first[None, :], came]), axis=0)
        self.known = known

    def days(self, seen: np.ndarray) -> np.ndarray:
        """The days of these appearances."""
        if not len(self.day):
            return np.broadcast_to(self.known, seen.shape)
        return np.where(seen >= 0, self.day[np.maximum(seen, 0)], self.known)

    def dense(self) -> list[pa.ListArray]:
        size, seen = len(self.day), self.seen[:-1]
        total = np.vstack([np.zeros((1, 100), np.int64), np.cumsum(np.vstack([self.before, self.frequency]), axis=0)])
        rolling = [total[_REACH + 1:] - total[_REACH + 1 - n:_REACH + 1 - n + size] for n in ROLLING_WINDOWS]
        days = self.days(seen)
        undated = (seen == _NEVER) | (days == _NO_DAY) | (self.day == _NO_DAY)[:, None]
        values = [
            pa.array(self.frequency.ravel()), pa.array((np.arange(size)[:, None] - seen).ravel(), mask=(seen == _NEVER).ravel()),
            pa.array((self.day[:, None] - days).ravel(), mask=undated.ravel()), *[pa.array(r.ravel()) for r in rolling]]
        return [_lists(v, np.arange(1, size + 1) * 100) for v in values]

    def states(self) -> tuple[np.ndarray, list[pa.ListArray]]:
        """The last draw of each month, and the state after it."""
        month = np.where(self.day == _NO_DAY, 0, self.day).astype("datetime64[D]").astype("datetime64[M]")
        ends = np.flatnonzero(np.append(month[1:] != month[:-1], True)) if len(month) else np.zeros(0, np.int64)
        ends = ends[self.day[ends] != _NO_DAY]
        seen = self.seen[ends + 1]
        days = self.days(seen)
        row, n = np.nonzero(seen != _NEVER)
        undated = days[row, n] == _NO_DAY
        last = pa.StructArray.from_arrays(
            [pa.array(n, pa.int32()), pa.array(ends[row] + 1 - seen[row, n]), pa.array(days[row, n], pa.int32(), mask=undated)], ["n", "gap", "day"])
        every = np.vstack([self.before, self.frequency])
        place, number = np.nonzero(every)
        # the draws that the longest window of the next draw reaches back to
        low, high = np.searchsorted(place, ends + 2), np.searchsorted(place, ends + _REACH + 1)
        at = np.concatenate([np.arange(a, b) for a, b in zip(low, high)]) if len(ends) else np.zeros(0, np.int64)
        back = np.repeat(ends + _REACH + 1, high - low) - place[at]
        tail = pa.StructArray.from_arrays(
            [pa.array(back, pa.int32()), pa.array(number[at], pa.int32()), pa.array(every[place[at], number[at]])], ["back", "n", "f"])
        return ends, [_lists(last, np.searchsorted(row, np.arange(1, len(ends) + 1))), _lists(tail, np.cumsum(high - low))]


def _by_station(drawn: DataFrame, state: DataFrame | None, profile: Profile, work: Callable[[pa.Table], pa.Table], kept: list[str], more: str) -> DataFrame:
    """A station's draws and its state, if given, worked out as one matrix; a task holds one station at a time."""
    rows = drawn.withColumn("day", F.unix_date("draw_date"))
    if state is not None:
        rows = rows.unionByName(state.select(*profile.grain, "last", "tail"), allowMissingColumns=True)
        rows = fan_out(rows, *profile.grain) if profile.grain else rows
    types = ", ".join(f"{c} {drawn.schema[c].dataType.simpleString()}" for c in kept)
    return rows.groupBy(*profile.grain).applyInArrow(work, f"{types}, {more}")


def dense_draws(drawn: DataFrame, profile: Profile, state: DataFrame | None = None) -> DataFrame:
    """Draws with the values of the dense fact as arrays of 100; ``state`` (``STATE`` by station) stands before the first draws."""
    kept = [c for c in drawn.columns if c != "drawn"]

    def work(rows: pa.Table) -> pa.Table:
        series = _Series(rows)
        return pa.table([*[series.rows[c] for c in kept], *series.dense()], names=[*kept, *_ARRAYS])

    return _by_station(drawn, state, profile, work, kept, ", ".join(f"{c} array<bigint>" for c in _ARRAYS))


def month_states(drawn: DataFrame, profile: Profile, state: DataFrame | None = None) -> DataFrame:
    """The state after the last draw of each month (``STATE``), one row per station and month."""
    kept = [*profile.keys]

    def work(rows: pa.Table) -> pa.Table:
        series = _Series(rows)
        ends, states = series.states()
        held = series.rows.take(pa.array(ends, pa.int64()))
        return pa.table([*[held[c] for c in kept], *states], names=[*kept, "last", "tail"])

    return _by_station(drawn, state, profile, work, kept, STATE)


def spread_dense(draws: DataFrame, profile: Profile, also: tuple[str, ...] = ()) -> DataFrame:
    """The rows of the dense fact, 100 for each draw of its layout by draw."""
    n, values = F.col("_n"), {c: F.get(c, F.col("_n")) for c in _ARRAYS[1:]}
    numbers = F.array(*[F.lit(f"{i:02d}") for i in range(100)])
    spread = draws.select(*[c for c in draws.columns if c != "frequency"], F.posexplode("frequency").alias("_n", "frequency"))
    return spread.select(
        "draw_date",
        *profile.grain, *(["station_name"] if profile.named else []),
        F.get(numbers, n).alias("number_2d"),
        "frequency",
        (F.col("frequency") > 0).alias("appeared"),
        *[values[c].alias(c) for c in _ARRAYS[1:3]],
        F.when(values["draws_since_previous"].isNull(), "never_seen").otherwise("seen_before").alias("previous_appearance_status"),
        *[values[c].alias(c) for c in _ARRAYS[3:]],
        "run_id",
        *also,
    )


def loto_daily(counts: DataFrame, profile: Profile, run_id: str, by_draw: bool = False) -> DataFrame:
    """The dense fact with all recurrence columns: one shuffle of the counts serves all of them.

    ``by_draw`` leaves it one row per draw, with arrays of its 100 values, a layout that costs a fraction of the rows to store.
    """
    draws = dense_draws(drawn_numbers(counts, profile), profile).withColumn("run_id", F.lit(run_id))
    return draws if by_draw else spread_dense(draws, profile)


def waiting_times(loto: DataFrame) -> DataFrame:
    """Distribution of the number of draws between two appearances."""
    return (
        loto.where("appeared and draws_since_previous is not null")
        .groupBy("draws_since_previous")
        .agg(F.count(F.lit(1)).alias("appearances"))
    )
