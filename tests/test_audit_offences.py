"""An audit of one rule works its offences out once."""

from __future__ import annotations

import datetime

from urndraw.plans import q_quality
from urndraw.plans.registry import QUERIES


def test_counts_and_samples_read_stored_offences(spark, tmp_path):
    days = [datetime.datetime(1996, 1, 1) + datetime.timedelta(days=i) for i in range(40)]
    spark.createDataFrame([(i, 1, d) for i, d in enumerate(days)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i, i % 7 + 1) for i in range(40)], "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    found = QUERIES["audit_loto_business_key_duplicate"](spark, str(tmp_path))
    twice = [k for k in (day * 100 + n for day in range(1, 41) for n in range(100)) if k % 347 == 0 and k % 301 and k % 311]
    # rows named A1 may stand more than once on a day, too
    named = [k // 100 for k in (day * 100 + n for day in range(1, 41) for n in range(100)) if k % 311 == 0 and k % 301 for _ in range(1 + (k % 347 == 0))]
    assert found.first()["finding_count"] == 2 * len(twice) + sum(named.count(d) for d in set(named) if named.count(d) > 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "o_custkey" not in plan and "l_partkey" not in plan


def test_no_rule_is_without_stored_offences(monkeypatch):
    seen = []
    monkeypatch.setattr(q_quality, "published", lambda *_: None)
    monkeypatch.setattr(q_quality, "fresh_dir", lambda _, label: label)
    monkeypatch.setattr(q_quality.audit, "findings", lambda p, codes, staging=None: seen.append(staging))
    for code in q_quality.audit.RULES:
        QUERIES["audit_" + code.replace("-", "_")](None, "")
    assert seen == ["offences"] * len(q_quality.audit.RULES)
