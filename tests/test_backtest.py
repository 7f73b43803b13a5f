"""Walk-forward backtest against a plain loop, and the seeded bootstrap against its definition."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from urndraw.operators import grid, rank
from urndraw.spec import STATION

START = datetime.date(2026, 1, 1)


def synthetic(days=60, per_draw=18, special=lambda i: (i * 13) % 100):
    return [[special(i), *[(i * 7 + j * j * 3 + j) % 100 for j in range(1, per_draw)]] for i in range(days)]


def observations(spark, draws, station="S1"):
    rows = [(station, START + datetime.timedelta(days=i), f"{n:02d}", station) for i, numbers in enumerate(draws) for n in numbers]
    return spark.createDataFrame(rows, "station_code string, draw_date date, number_2d string, station_name string")


def picks(training, kind, top_k):
    counts = [sum(d.count(n) for d in training) for n in range(100)]
    gaps = [next((g for g, d in enumerate(reversed(training)) if n in d), len(training)) for n in range(100)]
    top_f, top_g = max(*counts, 1), max(*gaps, 1)
    score = {
        "frequency": lambda n: counts[n] / top_f, "gap": lambda n: gaps[n] / top_g,
        "balanced": lambda n: counts[n] / top_f * 0.6 + gaps[n] / top_g * 0.4,
    }[kind]
    return sorted(range(100), key=lambda n: (-score(n), -counts[n], n))[:top_k]


def loop(draws, kind, window, limit, top_k=10):
    eligible = [i for i in range(len(draws)) if i >= window][-limit:]
    out = {}
    for i in eligible:
        chosen = set(picks(draws[i - window:i], kind, top_k))
        out[START + datetime.timedelta(days=i)] = (sum(n in chosen for n in draws[i]), len(draws[i]))
    return out


@pytest.mark.parametrize("limit", [20, None])
def test_walk_forward_equals_a_loop(spark, limit):
    draws = synthetic()
    counts = grid.draw_counts(observations(spark, draws), STATION)
    rows = rank.walk_forward(counts, STATION, (5, 30), limit=limit).collect()
    got = {}
    for r in rows:
        got.setdefault((r.kind, r.window), {})[r.evaluation_date] = (r.covered_results, r.total_results)
        day = (r.evaluation_date - START).days
        assert r.training_from == START + datetime.timedelta(days=day - r.window)
        assert r.training_to == START + datetime.timedelta(days=day - 1)
    for kind in ("frequency", "gap", "balanced"):
        for window in (5, 30):
            assert got[kind, window] == loop(draws, kind, window, limit or 1000), (kind, window)


def test_range_and_top_k(spark):
    draws = synthetic()
    counts = grid.draw_counts(observations(spark, draws), STATION)
    series = rank.walk_forward(counts, STATION, (30,), kinds=("gap",), top_k=5, start="2026-02-05", end="2026-02-14")
    summary = rank.backtest_summary(series, STATION, 5).first()
    assert (summary.evaluation_count, summary.baseline) == (10, 0.05)
    assert str(summary.evaluation_from) == "2026-02-05" and str(summary.evaluation_to) == "2026-02-14"


def test_no_look_ahead(spark):
    draws = [[0] * 18 for _ in range(40)]
    draws[30] = [99] * 18
    counts = grid.draw_counts(observations(spark, draws), STATION)
    rows = {r.evaluation_date: r.covered_results for r in rank.walk_forward(counts, STATION, (30,), kinds=("frequency",)).collect()}
    assert rows[START + datetime.timedelta(days=30)] == 0


def test_invalid_configuration(spark):
    counts = grid.draw_counts(observations(spark, synthetic(5)), STATION)
    for wrong in ({"top_k": 0}, {"top_k": 101}, {"windows": (0,)}, {"limit": 0}):
        with pytest.raises(ValueError):
            rank.walk_forward(counts, STATION, **{"windows": (3,), **wrong})


def generator(seed):
    state = seed
    mask = 0xFFFFFFFF
    while True:
        state = (state + 0x6D2B79F5) & mask
        v = ((state ^ (state >> 15)) * (state | 1)) & mask
        v ^= (v + (((v ^ (v >> 7)) * (v | 61)) & mask)) & mask
        yield ((v ^ (v >> 14)) & mask) / 4294967296


def test_any_draw_of_the_generator_can_be_computed_alone():
    for seed in (1, 0x6D2B79F5, 0xFFFFFFFF):
        source = generator(seed)
        whole = [next(source) for _ in range(500)]
        assert np.array_equal(rank.random_units(seed, 0, 500), whole)
        assert np.array_equal(rank.random_units(seed, 123, 50), whole[123:173])


def test_interval_equals_the_sequential_bootstrap(spark):
    tops, bottoms, seed, samples = [1, 0, 3, 2, 5, 0, 1], [18, 18, 17, 18, 20, 18, 18], 12345, 400
    source, estimates = generator(seed), []
    for _ in range(samples):
        a = b = 0.0
        for _ in tops:
            i = int(next(source) * len(tops))
            a, b = a + tops[i], b + bottoms[i]
        estimates.append(a / b)
    estimates.sort()

    def percentile(p):
        at = p * (samples - 1)
        low = int(at)
        return estimates[low] * (1 - (at - low)) + estimates[low + 1] * (at - low)

    row = spark.range(1).select(
        rank.bootstrap_interval(F.array(*map(F.lit, tops)), F.array(*map(F.lit, bottoms)), F.lit(seed).cast("long"), samples).alias("ci")
    ).first()
    # the order of the interpolation's operations differs, so the last bit may
    assert (row.ci.lower, row.ci.upper) == pytest.approx((percentile(0.025), percentile(0.975)), rel=1e-14)


def _marked(spark, draws):
    keys = ["station_code", "kind", "window"]
    counts = grid.draw_counts(observations(spark, draws), STATION)
    series = rank.walk_forward(counts, STATION, (10,), kinds=("balanced", "gap"), limit=30)
    return rank.with_fingerprint(rank.pack_series(series, keys), keys, {"top_k": 10})


def test_comparison_mirrors_when_sides_swap(spark):
    marked = _marked(spark, synthetic())
    a, b = marked.where("kind = 'balanced'"), marked.where("kind = 'gap'")
    one, two = rank.compare_models(a, b, STATION, 300).first(), rank.compare_models(b, a, STATION, 300).first()
    assert one.mean_coverage_delta == -two.mean_coverage_delta
    assert (one.lower, one.upper) == pytest.approx((-two.upper, -two.lower))
    assert (one.left_wins, one.right_wins, one.ties) == (two.right_wins, two.left_wins, two.ties)


def test_different_dates_are_not_compared(spark):
    marked = _marked(spark, synthetic())
    shorter = marked.where("kind = 'gap'").withColumn("points", F.slice("points", 2, 100))
    row = rank.compare_models(marked.where("kind = 'balanced'"), shorter, STATION, 50).first()
    assert row.comparable is False and row.mean_coverage_delta is None and row.lower is None


def test_a_station_of_one_side_is_reported(spark):
    marked = _marked(spark, synthetic())
    row = rank.compare_models(marked.where("kind = 'balanced'"), marked.where("kind = 'none'"), STATION, 50).first()
    assert row.comparable is False and row.evaluation_count is None and row.lower is None


def test_fingerprint_ignores_row_order_and_sees_changes(spark):
    first = {r.kind: r.fingerprint for r in _marked(spark, synthetic()).collect()}
    assert first == {r.kind: r.fingerprint for r in _marked(spark, synthetic()).collect()}
    changed = synthetic()
    changed[-1] = [99] * 18
    assert first["balanced"] != {r.kind: r.fingerprint for r in _marked(spark, changed).collect()}["balanced"]


def test_dense_rows_never_cross_the_network(spark):
    """Station profile: folded rows lie by station, and nothing is exchanged by number after that."""
    from urndraw.binding import observations
    from urndraw.operators import grid
    from urndraw.spec import STATION

    counts = grid.draw_counts(observations(spark, "/root/testdata/sf0.001"), STATION)
    for df in (grid.loto_daily(counts, STATION, "r1"), rank.walk_forward(counts, STATION, (30, 90))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "number_2d" in line]
        assert len(wide) <= 1, wide  # the counting of the prizes, before anything is spread out


def test_no_draw_is_spread_out_for_the_backtest(spark):
    counts = grid.draw_counts(observations(spark, synthetic()), STATION)
    plan = rank.walk_forward(counts, STATION, (5,), limit=None)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "Generate" not in plan
