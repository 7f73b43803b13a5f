"""Damaged rows of the audits are doubled in place."""

from __future__ import annotations

import datetime

from urndraw.plans import q_quality


def test_doubled_audit_rows_take_no_second_grid(spark, tmp_path):
    days = [datetime.datetime(1996, 1, 1) + datetime.timedelta(days=i) for i in range(120)]
    spark.createDataFrame([(i, 1, d) for i, d in enumerate(days)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i, i % 7 + 1) for i in range(120)], "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    rows = q_quality.audit_loto(spark, str(tmp_path))
    # day 103 of the year has no rows; what stands twice does so by the day and the number
    k = [day * 100 + n for day in range(1, 121) if day != 103 for n in range(100)]
    assert rows.count() == len(k) + sum(1 for x in k if x % 347 == 0)
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
