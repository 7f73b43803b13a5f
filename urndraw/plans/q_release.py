"""Publication health over lakes of twenty customers each, whose orders are the published objects, damaged by key modulus."""

from __future__ import annotations

from pyspark.sql import functions as F

from urndraw.binding import table
from urndraw.functions.once import fan_out
from urndraw.operators import audit, prechecks, releases
from urndraw.plans.registry import cte, query
from urndraw.sources.footers import footers
from urndraw.sources.tables import created, qualified
from urndraw.workdir import fresh_dir, keeping

CUSTOMERS_PER_LAKE = 20
RULE = "public, max-age=300, stale-while-revalidate=60"

cte("rlake", f"""
SELECT n, 'L' || CAST(n AS VARCHAR) AS lake, CASE WHEN n % 5 = 4 THEN 1 ELSE 2 END AS version, 'run-' || CAST(n AS VARCHAR) AS run,
  last_day AS target, CASE WHEN n % 5 = 4 THEN 'gold/latest/' ELSE 'gold/releases/run-id=run-' || CAST(n AS VARCHAR) || '/' END AS prefix,
  n % 17 <> 16 AS pointed, n % 23 <> 22 AS ran
FROM (SELECT o_custkey // {CUSTOMERS_PER_LAKE} AS n, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1)""")
cte("robj", f"""
SELECT l.*, o_orderkey AS k, CASE WHEN o_orderkey % 223 = 0 THEN 'elsewhere/' ELSE prefix END || 'part-' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS key,
  CAST(o_custkey * 1000 + o_orderkey % 1000 AS BIGINT) AS size, sha256(CAST(o_orderkey AS VARCHAR)) AS sha,
  CASE WHEN o_orderkey % 3 <> 0 THEN '{RULE}' END AS cache
FROM orders JOIN rlake l ON l.n = o_custkey // {CUSTOMERS_PER_LAKE}""")
cte("rref", """
SELECT * FROM robj WHERE pointed AND n % 19 <> 18 AND k % 199 <> 0
UNION ALL SELECT * FROM robj WHERE pointed AND n % 19 <> 18 AND k % 199 <> 0 AND k % 211 = 0""")
cte("rfind", """
SELECT lake, 'pointer_missing' AS issue, NULL AS key FROM rlake WHERE NOT pointed
UNION ALL SELECT lake, 'pointer_region', NULL FROM rlake WHERE pointed AND n % 13 = 12
UNION ALL SELECT lake, 'pointer_version', NULL FROM rlake WHERE pointed AND n % 11 = 10
UNION ALL SELECT lake, 'no_objects', NULL FROM rlake WHERE pointed AND lake NOT IN (SELECT lake FROM rref)
UNION ALL SELECT lake, 'release_prefix', NULL FROM rlake WHERE pointed AND version = 2 AND n % 7 = 6
UNION ALL SELECT lake, 'legacy_prefix', NULL FROM rlake WHERE pointed AND version = 1 AND n % 10 = 9
UNION ALL SELECT lake, 'run_missing', NULL FROM rlake WHERE pointed AND NOT ran
UNION ALL SELECT lake, 'run_id', NULL FROM rlake WHERE pointed AND ran AND n % 29 = 28
UNION ALL SELECT lake, 'run_region', NULL FROM rlake WHERE pointed AND ran AND n % 31 = 30
UNION ALL SELECT lake, 'run_target_date', NULL FROM rlake WHERE pointed AND ran AND n % 37 = 36
UNION ALL SELECT lake, 'run_status', NULL FROM rlake WHERE pointed AND ran AND n % 9 = 8
UNION ALL SELECT lake, 'run_quality', NULL FROM rlake WHERE pointed AND ran AND n % 8 = 7
UNION ALL SELECT lake, 'snapshot_missing', NULL FROM rlake WHERE pointed AND n % 6 = 5
UNION ALL SELECT lake, 'snapshot_differs', NULL FROM rlake WHERE pointed AND n % 6 <> 5 AND (n % 14 = 13 OR lake IN (SELECT lake FROM rref WHERE k % 157 = 0))
UNION ALL SELECT lake, 'outside_release', key FROM rref WHERE k % 223 = 0
UNION ALL SELECT lake, 'missing', key FROM rref WHERE k % 197 = 0
UNION ALL SELECT lake, 'size', key FROM rref WHERE k % 197 <> 0 AND k % 193 = 0
UNION ALL SELECT lake, 'sha256_missing', key FROM rref WHERE k % 197 <> 0 AND k % 191 = 0
UNION ALL SELECT lake, 'sha256', key FROM rref WHERE k % 197 <> 0 AND k % 191 <> 0 AND k % 181 = 0
UNION ALL SELECT lake, 'content_type', key FROM rref WHERE k % 197 <> 0 AND k % 179 = 0
UNION ALL SELECT lake, 'cache_control', key FROM rref WHERE k % 197 <> 0 AND cache IS NOT NULL AND k % 173 = 0
UNION ALL SELECT DISTINCT lake, 'duplicate_reference', key FROM rref WHERE k % 211 = 0
UNION ALL SELECT lake, 'absent_from_latest', key FROM robj WHERE pointed AND ran AND (n % 19 = 18 OR k % 199 = 0) AND k % 167 <> 0 AND k % 223 <> 0
UNION ALL SELECT DISTINCT lake, 'unexpected_in_latest', key FROM rref WHERE ran AND (k % 167 = 0 OR k % 223 = 0)
UNION ALL SELECT DISTINCT lake, 'reference_differs', key FROM rref WHERE ran AND k % 167 <> 0 AND k % 223 <> 0 AND (k % 163 = 0 OR k % 211 = 0)""")


def described_lakes(spark, sf):
    """What lakes of the given orders would have published, with damage of every kind."""
    n, k = F.col("n"), F.col("k")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.expr(f"o_custkey div {CUSTOMERS_PER_LAKE}").alias("n"), "o_custkey", F.to_date("o_orderdate").alias("day"))
    lakes = orders.groupBy("n").agg(F.max("day").alias("target_date")).select(
        "*", F.concat(F.lit("L"), n.cast("string")).alias("lake"), F.concat(F.lit("run-"), n.cast("string")).alias("run"),
        F.when(n % 5 == 4, 1).otherwise(2).alias("schema_version"))
    place = F.when(n % 5 == 4, releases.LEGACY).otherwise(F.concat(F.lit(releases.RELEASES + "run-"), n.cast("string"), F.lit("/")))
    at = F.to_timestamp_ntz(F.concat(F.col("target_date").cast("string"), F.lit(" 20:00:00")))
    pointers = lakes.where(n % 17 != 16).select(
        "lake", F.when(n % 13 == 12, "other").otherwise(F.col("lake")).alias("region"), "schema_version",
        F.when(n % 11 == 10, "stale").otherwise(F.col("run")).alias("dataset_version"), F.col("run").alias("run_id"), "target_date", at.alias("published_at"),
        F.when(n % 5 == 4, F.when(n % 10 == 9, releases.LEGACY)).when(n % 7 != 6, place).alias("release_prefix"), "n")
    objects = orders.select(
        "n", "k", F.concat(F.lit("L"), n.cast("string")).alias("lake"),
        F.concat(F.when(k % 223 == 0, "elsewhere/").otherwise(place), F.lit("part-"), k.cast("string"), F.lit(".parquet")).alias("key"),
        (F.col("o_custkey") * 1000 + k % 1000).alias("size"), F.sha2(k.cast("string").cast("binary"), 256).alias("sha256"),
        F.lit("application/vnd.apache.parquet").alias("content_type"), F.when(k % 3 != 0, RULE).alias("cache_control"))
    named = objects.where((k % 199 != 0) & (n % 19 != 18) & (n % 17 != 16)).withColumn("position", k * 2)
    named = named.unionByName(named.where(k % 211 == 0).withColumn("position", k * 2 + 1))
    runs = lakes.where(n % 23 != 22).select(
        "lake", F.col("run").alias("run_key"), F.when(n % 29 == 28, "other").otherwise(F.col("run")).alias("run_id"),
        F.when(n % 31 == 30, "other").otherwise(F.col("lake")).alias("region"),
        F.when(n % 37 == 36, F.date_sub("target_date", 1)).otherwise(F.col("target_date")).alias("target_date"),
        F.when(n % 9 == 8, "failed").otherwise("success").alias("status"), (n % 8 != 7).alias("quality_passed"), (n % 30 + 1).alias("covered_dates"))
    run_references = objects.where(k % 167 != 0).select(
        "lake", F.concat(F.lit("run-"), n.cast("string")).alias("run_key"), "key", F.when(k % 163 == 0, F.col("size") + 7).otherwise(F.col("size")).alias("size"),
        "sha256", "content_type", "cache_control")
    copied = pointers.where(n % 6 != 5).withColumn("snapshot_key", releases.snapshot_key())
    snapshots = copied.withColumn("published_at", F.when(n % 14 == 13, F.col("published_at") + F.expr("interval 1 second")).otherwise(F.col("published_at")))
    snapshot_references = named.join(copied.select("lake", "snapshot_key"), "lake").withColumn(
        "sha256", F.when(k % 157 == 0, F.lit("0" * 64)).otherwise(F.col("sha256")))
    store = objects.where(k % 197 != 0).select(
        "lake", "key", (F.col("size") + F.when(k % 193 == 0, 1).otherwise(0)).alias("size"),
        F.when(k % 191 == 0, "").when(k % 181 == 0, F.sha2(F.lit("x").cast("binary"), 256)).otherwise(F.col("sha256")).alias("sha256"),
        F.when(k % 179 == 0, "text/plain").otherwise(F.col("content_type")).alias("content_type"),
        F.when(k % 173 == 0, "no-cache").otherwise(F.lit(RULE)).alias("cache_control"))
    return releases.Lakes(lakes, pointers.drop("n"), named.drop("n", "k"), runs, run_references, snapshots.drop("n"),
                          snapshot_references.drop("n", "k"), store)


def _kept(spark):
    return keeping(spark, "release")


@query("release_findings", "SELECT lake, issue, key FROM rfind")
def _(spark, sf):
    return releases.inspect(described_lakes(spark, sf), _kept(spark))[1]


@query("release_status", """
SELECT l.lake, f.n IS NULL AS healthy, CASE WHEN pointed THEN run END AS run_id, CASE WHEN pointed THEN target END AS target_date,
  CASE WHEN pointed THEN CAST(target AS TIMESTAMP) + INTERVAL 20 HOUR END AS published_at,
  CASE WHEN pointed AND ran THEN CASE WHEN l.n % 9 = 8 THEN 'failed' ELSE 'success' END END AS run_status,
  CASE WHEN pointed AND ran THEN l.n % 8 <> 7 END AS quality_passed, CASE WHEN pointed AND ran THEN l.n % 30 + 1 ELSE 0 END AS covered_date_count,
  coalesce(r.objects, 0) AS object_count, coalesce(r.sound, 0) AS verified_object_count, CAST(coalesce(r.bytes, 0) AS BIGINT) AS total_size_bytes,
  CASE WHEN pointed THEN l.lake NOT IN (SELECT lake FROM rfind WHERE issue IN ('snapshot_missing', 'snapshot_differs')) END AS snapshot_matches_latest,
  coalesce(f.n, 0) AS finding_count
FROM rlake l LEFT JOIN (SELECT lake, count(*) AS n FROM rfind GROUP BY 1) f ON f.lake = l.lake
LEFT JOIN (SELECT lake, count(*) AS objects,
    count(*) FILTER (k % 197 <> 0 AND k % 193 <> 0 AND k % 191 <> 0 AND k % 181 <> 0 AND k % 179 <> 0 AND (cache IS NULL OR k % 173 <> 0)) AS sound,
    sum(CASE WHEN k % 197 = 0 THEN 0 ELSE size + CASE WHEN k % 193 = 0 THEN 1 ELSE 0 END END) AS bytes FROM rref GROUP BY 1) r ON r.lake = l.lake""")
def _(spark, sf):
    return releases.inspect(described_lakes(spark, sf), _kept(spark))[0]


#: One lake in so many lacks columns of this table.
LACKING = {"dim-date": 5, "fact": 6, "loto": 8, "dim-station": 9}


def _tables_of(root):
    """Writes the tables of each lake, whose rows come one lake after another: a file for each, closed when the next lake begins."""
    import pyarrow as pa
    from pyarrow import parquet

    def kind(n, at, name):
        if n % 7 == 6 and n % 4 == at:
            return None
        columns = sorted(audit.REQUIRED[name])
        return columns[2:] if n % LACKING[name] == LACKING[name] - 1 else columns

    def write(batches):
        lake, files, count = None, [], 0

        def close():
            for data, writer, _, _ in files:
                if writer is not None:
                    writer.close()
                data.close()

        for batch in batches:
            lakes = batch.column("lake").to_numpy(zero_copy_only=False)
            starts = [0, *[i for i in range(1, len(lakes)) if lakes[i] != lakes[i - 1]], len(lakes)]
            for first, end in zip(starts, starts[1:]):
                if first == end:
                    continue
                if lakes[first] != lake:
                    close()
                    lake, files, n = lakes[first], [], batch.column("n")[first].as_py()
                    for at, (name, place) in enumerate(prechecks.TABLES.items()):
                        columns = kind(n, at, name)
                        data = created(f"{root}/{place}/part-{lake}.{'txt' if columns is None else 'parquet'}")
                        schema = None if columns is None else pa.schema([(c, pa.string()) for c in [*columns, "extra"]])
                        files.append((data, schema and parquet.ParquetWriter(data, schema), schema, place))
                    count += len(files)
                k = batch.column("k").slice(first, end - first)
                for data, writer, schema, place in files:
                    if writer is None:
                        data.write("".join(f"{x}\n" for x in k.to_pylist()).encode())
                    else:
                        writer.write_table(pa.table([k] * (len(schema) - 1) + [pa.array([place] * len(k))], schema=schema))
        close()
        yield pa.RecordBatch.from_pydict({"files": [count]})

    return write


def _pointers_of(root):
    def write(batches):
        import pyarrow as pa

        count = 0
        for batch in batches:
            for lake, text in zip(batch.column("lake").to_pylist(), batch.column("value").to_pylist()):
                with created(f"{root}/part-{lake}.txt") as data:
                    data.write(f"{text}\n".encode())
                count += 1
        yield pa.RecordBatch.from_pydict({"files": [count]})

    return write


def _write_lakes(spark, sf, root):
    """A release per lake with the orders of its customers in every table below ``gold``, and its manifest below ``latest``; some damaged.

    The tasks write the files as they meet the lakes: there are several for each lake, too many to be renamed one by one at the end. A
    file is named by its lake, as a folder for each file would take most of the time to list.
    """
    n = F.col("n")
    orders = table(spark, sf, "orders").select(F.expr(f"o_custkey div {CUSTOMERS_PER_LAKE}").alias("n"), F.col("o_orderkey").cast("string").alias("k")).withColumn(
        "lake", F.concat(F.lit("L"), n.cast("string")))
    place = qualified(spark, root)
    named = orders.where("lake is not null")
    fan_out(named, "lake").sortWithinPartitions("lake").mapInArrow(_tables_of(f"{place}/gold"), "files long").agg(F.sum("files")).first()
    text = F.to_json(F.struct(
        F.lit(2).alias("schema_version"), F.when(n % 11 != 10, "r1").alias("run_id"), F.lit("2026-07-16").alias("target_date"),
        F.when(n % 10 == 9, "soon").otherwise("2026-07-16T20:00:00").alias("published_at")))
    pointers = fan_out(named.select("lake", "n").distinct().where(n % 17 != 16), "lake")
    pointers = pointers.select("lake", F.when(n % 13 == 12, F.substring(text, 1, 30)).otherwise(text).alias("value"))
    pointers.mapInArrow(_pointers_of(f"{place}/latest"), "files long").agg(F.sum("files")).first()
    return orders.select("lake")


NAMED = "/part-([^/]+)[.][a-z]+$"
_USABLE = "n % 17 <> 16 AND n % 13 <> 12 AND n % 11 <> 10 AND n % 10 <> 9"


def _prechecks_sql():
    lakes = f"(SELECT DISTINCT o_custkey // {CUSTOMERS_PER_LAKE} AS n FROM orders)"
    parts = [
        "SELECT n, 'latest-manifest-missing' AS code, 'manifests/latest' AS subject, NULL AS lacking FROM lakes WHERE n % 17 = 16",
        f"SELECT n, 'latest-manifest-invalid', 'manifests/latest', NULL FROM lakes WHERE n % 17 <> 16 AND NOT ({_USABLE})"]
    for at, (name, place) in enumerate(prechecks.TABLES.items()):
        lacking = ", ".join(sorted(audit.REQUIRED[name])[:2])
        parts += [
            f"SELECT n, 'gold-parquet-invalid', '{place}', NULL FROM lakes WHERE {_USABLE} AND n % 7 = 6 AND n % 4 = {at}",
            f"SELECT n, '{name}-columns-missing', '{place}', '{lacking}' FROM lakes WHERE {_USABLE} AND (n % 7 <> 6 OR n % 4 <> {at}) AND n % {LACKING[name]} = {LACKING[name] - 1}"]
    rows = f"(WITH lakes AS {lakes} " + " UNION ALL ".join(parts) + ")"
    return f"SELECT 'L' || CAST(n AS VARCHAR) AS lake, code, subject, lacking FROM {rows}"


@query("release_prechecks", _prechecks_sql())
def _(spark, sf):
    root = fresh_dir(spark, "prechecks")
    lakes = _write_lakes(spark, sf, root)
    named = F.regexp_extract("_metadata.file_path", NAMED, 1)
    manifests = spark.read.option("wholetext", True).text(f"{root}/latest").select(named.alias("lake"), F.col("value").alias("text"))
    files = footers(spark, f"{root}/gold").withColumns({
        "lake": F.regexp_extract("path", NAMED, 1), "run_id": F.lit("r1"), "table": F.regexp_extract("path", "/([^/]+)/part-[^/]+$", 1)})
    return prechecks.findings(lakes, manifests, files, _kept(spark)).select(
        "lake", "code", "subject", F.when(F.col("code").endswith("-columns-missing"), F.col("detail")).alias("lacking"))
