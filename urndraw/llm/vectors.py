"""Reading vector tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str | None = None) -> DataFrame:
    """(vec_id, label, vector array<double>, usable): one row per id.

    Rows that repeat an id count as one vector, the smallest by (label, vector); rows without an id are left out.
    A vector is usable if it has components and all of them are finite.
    """
    label = F.col(label_column).cast("string") if label_column else F.lit(None).cast("string")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), label.alias("label"),
                        F.col(vector_column).cast("array<double>").alias("vector")).where("vec_id is not null")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("v")).select("vec_id", "v.label", "v.vector")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return one.withColumn("usable", F.coalesce((F.size("vector") > 0) & finite, F.lit(False)))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of vectors of one length as rows."""
    values = pa.concat_arrays([chunk.flatten() for chunk in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return values.to_numpy(zero_copy_only=False).reshape(len(column), -1 if len(column) else 0)
