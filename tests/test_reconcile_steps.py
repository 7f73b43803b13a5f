from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.operators import reconcile
from urndraw.spec import STATION


def sources(spark):
    values = [f"array_repeat(repeat('1', {width}), {count}) as {name}" for name, count, width in STATION.groups]
    rows = spark.createDataFrame([("2020-01-01", f"S{i}", f"Station {i}", i) for i in range(4)], "d string, station_code string, station_name string, station_order long")
    rows = rows.selectExpr("date(d) as draw_date", "station_code", "station_name", "station_order", *values)
    return rows, rows.drop("station_order")


def test_each_source_is_read_once_for_the_matches(spark):
    opened = spark.sparkContext.accumulator(0)

    def read(batches):
        for rows in batches:
            opened.add(len(rows))
            yield rows

    rows = spark.createDataFrame([("2020-01-01", f"S{i}", f"Station {i}") for i in range(4)], "draw_date string, station_code string, station_name string")
    counted = rows.mapInPandas(read, rows.schema)
    assert {r.how for r in reconcile.match_fallback(counted, rows).collect()} == {"code"}
    assert opened.value == 4


def test_kept_steps_give_the_same_rows(spark, tmp_path):
    primary, fallback = sources(spark)
    primary = primary.withColumn("special", F.when(F.col("station_code") == "S1", F.array(F.lit("11111"))).otherwise(F.col("special")))
    matches = reconcile.match_fallback(primary, fallback)
    kept = []

    def keep(df):
        path = f"file://{tmp_path}/{len(kept)}"
        df.write.parquet(path)
        kept.append(path)
        return spark.read.schema(df.schema).parquet(path)

    shown = ["station_code", "daywide", "rule_special", "verdict", "final_special"]
    got = reconcile.reconcile(primary, fallback, matches, keep).select(shown).orderBy("station_code").collect()
    assert got == reconcile.reconcile(primary, fallback, matches).select(shown).orderBy("station_code").collect()
    assert [r.rule_special for r in got] == ["equal", "truncated", "equal", "equal"] and {r.verdict for r in got} == {"accepted"}
    assert len(kept) == 3
