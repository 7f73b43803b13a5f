"""Registered queries against DuckDB at the smallest scale. URNDRAW_ALL=1 runs every query."""

from __future__ import annotations

import os

import pytest

from check_queries import compare, connect
from urndraw.plans.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
CHOSEN = """
freq_by_draw total_frequency frequency_map loto_daily loto_daily_no_station draw_results canonical_draws legacy_long dim_date
special_by_weekday bi_star_join station_set_mismatch pending_dates status_fact_alignment column_stats heatmap_10x10 head_tail_table
station_metadata migration_summary rolling_frequency last_appearing_delta_special current_gap momentum dup_rows_all hot_cold
layout_equality quality_report quality_report_no_station history_audit audit_samples release_integrity release_findings release_status release_prechecks walk_forward model_grid
bootstrap_ci compare_models parse_outcome page_station_table page_outlines_given_pages match_fallback reconcile upsert_silver publish_gate
manifest_match draw_records draw_contract shard_contract release_contract compact_payload explorer_page health_flags incident_fsm
incident_stream stream_ingest stream_dedupe late_recompute src_release_read src_wide_json sink_gold sink_shards scalar_functions
""".split()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("URNDRAW_ALL") else CHOSEN)
def test_query_equals_sql(spark, duck, name):
    problem, _ = compare(spark, duck, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert "rolling_90_frequency" in entry.entry(spark).columns
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
