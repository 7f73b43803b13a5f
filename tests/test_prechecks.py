from __future__ import annotations

import json

from pyspark.sql import functions as F

from urndraw.operators import prechecks
from urndraw.plans import q_release
from urndraw.operators.audit import REQUIRED
from urndraw.sources.footers import FOOTER, footers

SOUND = {"schema_version": 2, "run_id": "r1", "target_date": "2026-07-16", "published_at": "2026-07-16T20:00:00", "more": [1]}


def write(spark, path, columns):
    spark.createDataFrame([tuple(str(i) for _ in columns) for i in range(2000)], ", ".join(f"{c} string" for c in columns)).coalesce(1).write.parquet(str(path))
    return next(path.glob("part-*.parquet"))


def test_damaged_files_are_rows(spark, tmp_path):
    sound = write(spark, tmp_path / "fact.parquet", ["a", "b"])
    data = sound.read_bytes()
    footer = int.from_bytes(data[-8:-4], "little") + 8
    (tmp_path / "part-cut").write_bytes(data[:-20])
    (tmp_path / "part-text").write_text("no table")
    (tmp_path / "part-pages").write_bytes(data[:4] + bytes(len(data) - 4 - footer) + data[-footer:])
    (tmp_path / "part-empty").write_bytes(b"")
    got = {r.path.rsplit("/")[-1]: r for r in footers(spark, f"file://{tmp_path}").collect()}
    assert set(got) == {sound.name, "part-cut", "part-text", "part-pages"}
    assert got[sound.name].columns == ["a", "b"] and got[sound.name].row_count == 2000 and got[sound.name].error is None
    assert all(got[n].error and got[n].columns is None and got[n].row_count is None for n in ("part-cut", "part-text"))
    assert got["part-pages"].error is None  # its footer is whole
    deep = {r.path.rsplit("/")[-1]: r.error for r in footers(spark, f"file://{tmp_path}", deep=True).collect()}
    assert deep["part-pages"] and deep[sound.name] is None


def test_manifest_states(spark):
    texts = {
        "sound": json.dumps(SOUND), "cut": json.dumps(SOUND)[:40], "null": None, "blank": " ", "list": "[1]", "word": "soon",
        "lacks": json.dumps(SOUND | {"run_id": None}), "type": json.dumps(SOUND | {"schema_version": "two"}), "day": json.dumps(SOUND | {"target_date": "soon"})}
    rows = [*texts.items(), ("twice", json.dumps(SOUND)), ("twice", json.dumps(SOUND)), ("unknown", "x")]
    lakes = spark.createDataFrame([(n,) for n in [*texts, "twice", "absent", "absent"]], "lake string")
    got = {r.lake: (r.state, r.detail, r.run_id) for r in prechecks.read_manifests(lakes, spark.createDataFrame(rows, "lake string, text string")).collect()}
    assert got.pop("sound") == (None, None, "r1") and got.pop("absent") == ("missing", None, None)
    assert got.pop("lacks") == ("invalid", "lacks run_id", None) and got.pop("twice") == ("invalid", "several", None)
    assert len(got) == 7 and all(state == "invalid" and detail and run is None for state, detail, run in got.values())


def test_findings_of_a_release(spark, tmp_path):
    for lake in ("a", "b"):
        base = tmp_path / f"lake={lake}" / "gold" / "releases" / "run-id=r1"
        for name, place in prechecks.TABLES.items():
            lost = {"fact": ["full_number", "run_id"], "loto": ["appeared"]}.get(name, []) if lake == "a" else []
            write(spark, base / f"{place}.parquet", [*sorted(REQUIRED[name] - set(lost)), "extra"])
    next((tmp_path / "lake=a/gold/releases/run-id=r1/dim-date.parquet").glob("part-*")).write_bytes(b"PAR1")
    write(spark, tmp_path / "lake=b/gold/releases/run-id=r0/fact-draw-result.parquet", ["old"])  # not the published run
    files = prechecks.placed(footers(spark, f"file://{tmp_path}"))
    lakes = spark.createDataFrame([("a",), ("b",)], "lake string")
    manifests = spark.createDataFrame([(n, json.dumps(SOUND)) for n in "ab"], "lake string, text string")
    got = sorted((r.lake, r.code, r.subject, r.detail if r.code.endswith("missing") else bool(r.detail)) for r in prechecks.findings(lakes, manifests, files).collect())
    assert got == [
        ("a", "fact-columns-missing", "fact-draw-result", "full_number, run_id"), ("a", "gold-parquet-invalid", "dim-date", True),
        ("a", "loto-columns-missing", "fact-loto-daily", "appeared")]
    unusable = prechecks.findings(lakes, manifests.where("lake = 'b'"), files).collect()
    assert [(r.lake, r.code) for r in unusable] == [("a", "latest-manifest-missing")]
    none = prechecks.placed(spark.createDataFrame([], FOOTER))
    assert prechecks.findings(lakes, manifests, none).count() == 0 and prechecks.findings(lakes.limit(0), manifests, none).count() == 0
    assert {r.code for r in prechecks.findings(lakes, manifests.withColumn("text", F.lit("{")), files).collect()} == {"latest-manifest-invalid"}


def test_each_footer_is_read_once(spark, tmp_path):
    opened = spark.sparkContext.accumulator(0)

    def read(batches):
        for rows in batches:
            opened.add(len(rows))
            yield rows

    files = spark.createDataFrame([("a", "r1", table, ["x"]) for table in prechecks.TABLES.values()], "lake string, run_id string, table string, columns array<string>")
    files = files.withColumn("error", F.lit(None).cast("string"))
    files = files.mapInPandas(read, files.schema)
    lakes = spark.createDataFrame([("a",)], "lake string")
    text = '{"schema_version": 2, "run_id": "r1", "target_date": "2026-07-16", "published_at": "2026-07-16T20:00:00"}'
    manifests = spark.createDataFrame([("a", text)], "lake string, text string")
    places = iter(range(9))

    def keep(df):
        path = f"file://{tmp_path}/{next(places)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    found = prechecks.findings(lakes, manifests, files, keep).collect()
    assert {r.code for r in found} == {f"{name}-columns-missing" for name in prechecks.TABLES}
    assert opened.value == len(prechecks.TABLES)


def test_a_lake_of_many_batches_is_one_file_in_each_table(spark, tmp_path):
    tmp = f"{tmp_path}/sf"
    orders = [(key, customer) for customer in (0, 25, 130) for key in range(customer, customer + 20)] + [(999, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp}/orders.parquet")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "3")
    try:
        q_release._write_lakes(spark, tmp, f"file://{tmp_path}/out")
    finally:
        spark.conf.set(batch, before)
    files = footers(spark, f"file://{tmp_path}/out/gold").collect()
    assert len(files) == 3 * len(prechecks.TABLES)
    assert sum(f.row_count or 0 for f in files) == 20 * (len(files) - 1)
    assert [f.path.rsplit("/", 2)[1] for f in files if f.error] == [list(prechecks.TABLES.values())[6 % 4]]
    assert len(list((tmp_path / "out" / "latest").iterdir())) == 3
