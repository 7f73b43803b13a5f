"""Stored tables: month-partitioned facts, releases with a manifest, CSV/JSON exports."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from urndraw.spec import Profile

GOLD_FORMATS = ("parquet", "csv")
ROWS_PER_FILE = 5_000_000
CHUNK = 8 << 20
#: Months whose files a task has open at a time; of a task that has more, the rest is sorted.
OPEN_MONTHS = 24
#: Of text formats, which are several times the size of their Parquet files; every reader of Spark knows it by the files' names.
COMPRESSION = "gzip"


def by_month(df: DataFrame) -> DataFrame:
    months = df.withColumns({"year": F.year("draw_date"), "month": F.month("draw_date")})
    # Spark splits large months and merges small ones while writing
    return months.hint("rebalance", "year", "month")


def write_silver(df: DataFrame, path: str) -> None:
    """Replace exactly the months present in ``df``."""
    (
        by_month(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month").parquet(path)
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("year", "month")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Union with the row of the highest sequence winning per key.

    An aggregate, not a window: duplicates of one key collapse before the shuffle.
    """
    both = old.unionByName(new)
    values = [c for c in both.columns if c not in keys]
    winner = F.max_by(F.struct(*values), F.struct(*seq))
    return both.groupBy(*keys).agg(winner.alias("_row")).select(*keys, "_row.*")


def months_of(rows: DataFrame, date: str = "draw_date") -> list[tuple[int, int]]:
    """The (year, month) pairs of ``rows``, in order; no more of them than months the data span."""
    found = rows.where(F.col(date).isNotNull()).select(F.year(date).alias("y"), F.month(date).alias("m")).distinct().collect()
    return sorted((r["y"], r["m"]) for r in found)


def in_months(months: list[tuple[int, int]]) -> Column:
    """Rows of these partitions, as literals that prune the scan before it starts."""
    years: dict[int, list[int]] = {}
    for year, month in months:
        years.setdefault(year, []).append(month)
    return reduce(lambda found, y: found | ((F.col("year") == y) & F.col("month").isin(years[y])), sorted(years), F.lit(False))


def stored_months(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The months that have a partition at ``path``, from the names of its folders."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    names = [(f.getPath().getParent().getName(), f.getPath().getName()) for f in found]
    return sorted((int(y.removeprefix("year=")), int(m.removeprefix("month="))) for y, m in names)


def read_months(spark: SparkSession, path: str, schema: StructType, months: list[tuple[int, int]], placed: bool = False) -> DataFrame:
    """The stored rows of these months, without their partition columns unless ``placed``."""
    fields = [f for f in schema.fields if f.name not in ("year", "month")]
    whole = StructType([*fields, StructField("year", IntegerType()), StructField("month", IntegerType())])
    return spark.read.schema(whole).parquet(path).where(in_months(months)).select(*[f.name for f in whole.fields if placed or f in fields])


def replace_months(spark: SparkSession, rows: DataFrame, path: str, staging: str) -> None:
    """Put ``rows`` in the place of the months they have, by way of a staging folder: what is read from ``path`` may be part of them."""
    by_month(rows).write.mode("overwrite").partitionBy("year", "month").parquet(staging)
    schema = StructType([*rows.schema.fields, StructField("year", IntegerType()), StructField("month", IntegerType())])
    (
        spark.read.schema(schema).parquet(staging).hint("rebalance", "year", "month")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    )


def put_months(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Put ``rows``, which name their ``year`` and ``month``, in the place of the months they have.

    They are written once, into a folder of the job beside the months; when all tasks have ended it takes their place, so what is
    read from ``path`` may be part of them. A task holds a file open for each of its months instead of sorting its rows by month.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_MONTHS)
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    finally:
        spark.conf.set(name, before)


def upsert_silver(spark: SparkSession, path: str, new: DataFrame, keys: list[str], seq: list[str], staging: str) -> None:
    """Merge ``new`` into the stored months it touches; the files of all other months are neither read nor changed.

    The merge goes to a staging folder first, overwriting what an earlier merge left there, and replaces the months from
    it, so a lost job can be repeated: the same batch gives the same rows. An empty batch changes nothing.
    """
    months = months_of(new)
    if months:
        replace_months(spark, upsert(read_months(spark, path, new.schema, months), new, keys, seq), path, staging)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``, asked of the file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


RUN_IDS = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def release_path(root: str, run_id: str) -> str:
    if not RUN_IDS.fullmatch(run_id):
        raise ValueError(f"run ids are letters, digits, dots, dashes and underscores and start with a letter or digit, not {run_id!r}")
    return f"{root}/gold/releases/run-id={run_id}"


def write_release(
    tables: dict[str, DataFrame], root: str, run_id: str, formats: tuple[str, ...] = ("parquet",), replace: bool = False
) -> str:
    """One immutable folder per run; writing the same run again is an error, unless ``replace`` says that no pointer names it.

    A table is computed once, for its first format; another one is written from the stored rows. CSV is compressed.
    """
    unknown = set(formats) - set(GOLD_FORMATS)
    if not formats or unknown:
        raise ValueError(f"unsupported release formats: {sorted(unknown)}")
    base = release_path(root, run_id)
    for name, df in tables.items():
        stored = "parquet" in formats and formats != ("parquet",)
        # Parquet first: it keeps the types, so the rows that are read back are the rows of the table
        for fmt in sorted(formats, key=lambda f: f != "parquet"):
            if stored and fmt != "parquet":
                df = df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}.parquet")
            writer = df.write.mode("overwrite" if replace else "errorifexists").option("maxRecordsPerFile", ROWS_PER_FILE)
            if fmt == "csv":
                writer.option("header", True).option("dateFormat", "yyyy-MM-dd").option("compression", COMPRESSION).csv(f"{base}/{name}.csv")
            else:
                writer.parquet(f"{base}/{name}.parquet")
    return base


def opened(path: str):
    """The bytes of a file by its scheme: local ones, and those of stores that Arrow knows."""
    from pyarrow import fs

    if path.startswith("file:"):
        return open(unquote(urlsplit(path).path), "rb")
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def created(path: str):
    """A new file to write bytes into, in the place of one of that name; its folders are made."""
    from pyarrow import fs

    if path.startswith("file:"):
        place = unquote(urlsplit(path).path)
        os.makedirs(os.path.dirname(place), exist_ok=True)
        return open(place, "wb")
    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(place)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system, as Spark's readers name files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = []
        for path in rows["path"]:
            digest = hashlib.sha256()
            with opened(path) as data:
                while chunk := data.read(CHUNK):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield rows.assign(sha256=found)


def stored_objects(spark: SparkSession, base: str) -> DataFrame:
    """Key, size and checksum of every data file below a folder, hashed on the executors.

    Files are listed without their content and read in chunks of ``CHUNK`` bytes, so a file of any length takes the same memory. Tasks
    get files by their lengths; one without a byte is no object.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(base)
    hashed = files.select("path", F.col("length").alias("size")).mapInPandas(_digests, "path string, size long, sha256 string")
    return hashed.select(F.regexp_extract("path", r"/(gold/releases/.*)$", 1).alias("key"), "size", "sha256")


def write_manifest(spark: SparkSession, root: str, run_id: str, target_date: str, published_at: str, replace: bool = False) -> None:
    """The objects of a release, then the pointer to it, in that order."""
    base = release_path(root, run_id)
    stored_objects(spark, base).write.mode("overwrite" if replace else "errorifexists").json(f"{root}/manifests/runs/run-id={run_id}")
    spark.createDataFrame(
        [(run_id, target_date, published_at)], "run_id string, target_date string, published_at string"
    ).coalesce(1).write.mode("append").json(f"{root}/manifests/latest")


def latest_pointer(spark: SparkSession, root: str) -> DataFrame:
    """The newest published pointer: later target date first, then later publication."""
    rows = spark.read.schema("run_id string, target_date string, published_at string").json(f"{root}/manifests/latest")
    return rows.orderBy(F.desc("target_date"), F.desc("published_at")).limit(1)


def read_release(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Resolve the pointer, verify size and checksum of every referenced file, read the named tables."""
    pointer = latest_pointer(spark, root).first()
    if pointer is None:
        raise FileNotFoundError("no release has been published")
    base = release_path(root, pointer["run_id"])
    manifest = spark.read.schema("key string, size long, sha256 string").json(
        f"{root}/manifests/runs/run-id={pointer['run_id']}"
    )
    from urndraw.operators.state import release_integrity

    bad = release_integrity(manifest, stored_objects(spark, base)).where("issue is not null").limit(5).collect()
    if bad:
        raise ValueError(f"release {pointer['run_id']} is damaged: {[(r['key'], r['issue']) for r in bad]}")
    return {name: spark.read.parquet(f"{base}/{name}.parquet") for name in names}


def write_three_formats(df: DataFrame, path: str) -> None:
    """The rows as Parquet, and from there, so that they are computed once, as compressed CSV and JSON."""
    df.write.parquet(f"{path}/parquet")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet")
    rows.write.option("header", True).option("compression", COMPRESSION).csv(f"{path}/csv")
    write_wide_json(rows, f"{path}/json")


def write_wide_json(df: DataFrame, path: str) -> None:
    df.write.option("compression", COMPRESSION).json(path)


def _wide_schema(profile: Profile) -> str:
    return "date date, " + ", ".join(f"{name} long" for name, _, _ in profile.wide_columns()) + ", result_count long"


def read_wide_json(spark: SparkSession, path: str, profile: Profile, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(_wide_schema(profile)).option("multiLine", multi_line).json(path)


def read_wide_csv(spark: SparkSession, path: str, profile: Profile) -> DataFrame:
    return spark.read.schema(_wide_schema(profile)).option("header", True).csv(path)


SHARD = """station_code string, year int, draw_date date, part long, station_name string, result_count long, status string,
  special_prize string, special_tail string, numbers array<string>, prizes map<string, array<string>>"""


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Stored records; station_code and year are folders, so filters on them decide which are opened."""
    return spark.read.schema(SHARD).json(path)


def write_shards(records: DataFrame, path: str) -> None:
    """Serving records as JSON, one folder per station and year."""
    shards = records.withColumn("year", F.year("draw_date"))
    shards.hint("rebalance", "station_code", "year").write.mode("errorifexists").partitionBy("station_code", "year").json(path)
