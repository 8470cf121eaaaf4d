"""Small helpers of the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# the white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions along with the tasks, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def root_of(rows: Column) -> Column:
    """Square root of a row count, at least 1: as many buckets as rows in a bucket."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(rows))).cast("long")


def total_before(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], value: Column, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group before this one.

    ``bucket`` must rise with ``order``. Rows are summed inside their bucket, and buckets inside their
    group, so with as many buckets as rows in a bucket no task sees more than the root of a group.
    """
    df = df.withColumn("__value", value)
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    across = across.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*group, bucket)
        .agg(F.sum("__value").alias("__total"))
        .withColumn("__offset", F.coalesce(F.sum("__total").over(across), F.lit(0)))
        .drop("__total")
    )
    return (
        df.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
        .join(offsets, [*group, bucket])
        .withColumn(out, F.col("__inside") + F.col("__offset"))
        .drop("__inside", "__offset", "__value")
    )


def digest(*columns: Column | str) -> list[Column]:
    """Two long columns that together are a 128-bit hash."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def hash_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About ``rows`` rows (all, if there are no more), chosen by the hash of their key; the same on every run.

    A sorted limit would send that many rows of every partition to one place; this sends only what is kept.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.xxhash64(F.lit("sample"), *key) < int((rows / total - 0.5) * 2**64))


def as_list(values: pa.Array) -> pa.Array:
    """A column of one row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def narrow(numbers: np.ndarray, below: int) -> bytes:
    """Numbers from 0 to below ``below`` as 16 bits where that is enough, else as 32."""
    return numbers.astype("<u2" if below <= 1 << 16 else "<u4").tobytes()


def widen(numbers: bytes, below: int) -> np.ndarray:
    return np.frombuffer(numbers, "<u2" if below <= 1 << 16 else "<u4")


def with_entries(blocks: DataFrame, entries: str, table: DataFrame, *values: str) -> DataFrame:
    """The blocks, each with ``found``: a list of (place, values) of its entries that ``table`` (entry, values) has,
    in the order of their places.

    A block holds many rows and lists their distinct entries once, so the join has one row per block and entry,
    however often the block's rows use it, and an entry found everywhere has one row per block.
    """
    places = blocks.select("block", F.posexplode(entries).alias("place", "entry"))
    known = table.withColumnRenamed("entry", "__entry")
    found = (
        places.join(known, F.col("entry") == F.col("__entry"))
        .groupBy(F.col("block").alias("__block"))
        .agg(F.sort_array(F.collect_list(F.struct("place", *values))).alias("found"))  # entries of one block
    )
    return blocks.join(found, F.col("block") == F.col("__block"), "left").drop("__block", entries)
