"""Tables of vectors on their way into blocked products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from melodex.llm.common import ship

ship(__name__)


def vector_flags(df: DataFrame, vector: str) -> DataFrame:
    """Add ``__usable``: the vector is not null or zero, and all its components are finite numbers."""
    big = F.lit(float("inf"))
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    some = F.exists(F.col(vector), lambda x: x != 0)
    return df.withColumn("__usable", F.coalesce(fine & some, F.lit(False)))


def usable_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, vector) in double precision of the rows with an id and a usable vector of the commonest length."""
    flagged = vector_flags(df.select(F.col(id_column).alias("id"), F.col(vector).alias("vector")), "vector")
    fine = flagged.filter(F.col("__usable") & F.col("id").isNotNull())
    length = fine.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if length is None:
        return fine.select("id", F.col("vector").cast("array<double>"))
    return fine.filter(F.size("vector") == length["length"]).select("id", F.col("vector").cast("array<double>"))


def exploded(column: pa.Array) -> np.ndarray:
    """Matrix of a list column whose lists have one length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def pack(matrix: np.ndarray) -> pa.Array:
    """List column of a matrix' rows."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))
