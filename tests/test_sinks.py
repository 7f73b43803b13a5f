"""What is written in several formats is computed once; text formats are compressed."""

from __future__ import annotations

import datetime
from pathlib import Path

from pyspark.sql import functions as F

from urndraw.sources import tables


def files(path, end):
    return [f for f in Path(path).rglob("part-*") if f.name.endswith(end)]


def test_a_release_in_two_formats_is_computed_once(spark, tmp_path):
    rows = spark.range(50).select("id", F.uuid().alias("drawn"), F.lit(datetime.date(2026, 1, 2)).alias("day"))
    base = tables.write_release({"fact": rows}, f"file://{tmp_path}", "r1", ("csv", "parquet"))
    one = {tuple(r) for r in spark.read.parquet(f"{base}/fact.parquet").collect()}
    assert one == {tuple(r) for r in spark.read.schema(rows.schema).option("header", True).csv(f"{base}/fact.csv").collect()} and len(one) == 50
    assert files(f"{base}/fact.csv"[7:], ".csv.gz") and not files(f"{base}/fact.csv"[7:], ".csv")


def test_three_formats_are_computed_once(spark, tmp_path):
    rows = spark.range(50).select("id", F.uuid().alias("drawn"))
    tables.write_three_formats(rows, f"file://{tmp_path}/t")
    read = spark.read.schema(rows.schema)
    found = [{tuple(r) for r in df.collect()} for df in (
        read.parquet(f"{tmp_path}/t/parquet"), read.option("header", True).csv(f"{tmp_path}/t/csv"), read.json(f"{tmp_path}/t/json"))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 50
    assert files(f"{tmp_path}/t/json", ".json.gz") and files(f"{tmp_path}/t/csv", ".csv.gz")


def test_wide_json_is_compressed(spark, tmp_path):
    tables.write_wide_json(spark.range(3), f"{tmp_path}/wide")
    assert files(f"{tmp_path}/wide", ".json.gz") and spark.read.json(f"{tmp_path}/wide").count() == 3
