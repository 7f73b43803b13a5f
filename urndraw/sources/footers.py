"""What Parquet files say of themselves, read file by file on the executors; a file that can not be read is a row, not a failed job."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urndraw.sources.tables import opened

FOOTER = "path string, size long, row_count long, columns array<string>, error string"


def _read(deep: bool):
    from pyarrow import parquet

    def one(path: str) -> tuple[int | None, list[str] | None, str | None]:
        try:
            with opened(path) as data:
                file = parquet.ParquetFile(data)
                if deep:
                    for batch in file.iter_batches():
                        batch.validate()
                return file.metadata.num_rows, file.schema_arrow.names, None
        except Exception as bad:  # damaged files raise many kinds; each becomes the file's finding
            return None, None, " ".join(f"{type(bad).__name__}: {bad}".split())[:240]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [one(path) for path in rows["path"]]
            values = pd.DataFrame(found, columns=["row_count", "columns", "error"], index=rows.index)
            values["row_count"] = values["row_count"].astype("Int64")
            yield pd.concat([rows, values], axis=1)

    return read


def footers(spark: SparkSession, base: str, deep: bool = False) -> DataFrame:
    """(path, size, row_count, columns, error) of every data file below ``base``.

    Only footers are read; ``deep`` decodes the pages too, batch by batch. Files without a byte hold no table and are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(base)
    return files.select("path", F.col("length").alias("size")).mapInPandas(_read(deep), FOOTER)
