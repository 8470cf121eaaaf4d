"""Exploratory profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.functions.text import tag_list


# two to this power registers in a sketch of distinct values
SKETCH_BITS = 12


def _per_column(df: DataFrame, aggregates: dict[str, Sequence[Column]], fields: Sequence[str]) -> DataFrame:
    """All aggregates of all columns in one pass, then one row per column."""
    rows = [
        F.struct(F.lit(name).alias("column"), *[a.alias(f) for a, f in zip(values, fields, strict=True)])
        for name, values in aggregates.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def value_counts(df: DataFrame, column: str | Column, name: str = "value", min_count: int = 1) -> DataFrame:
    counts = df.select(F.col(column).alias(name) if isinstance(column, str) else column.alias(name))
    counts = counts.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    if min_count > 1:
        counts = counts.filter(F.col("n") >= min_count)
    return counts.orderBy(F.desc("n"), name)


def tag_tokens(df: DataFrame, column: str = "tags") -> DataFrame:
    """One row per tag of a comma-separated list."""
    return df.select(F.explode(tag_list(F.col(column))).alias("tag"))


def tag_counts(df: DataFrame, column: str = "tags", min_count: int = 1) -> DataFrame:
    return value_counts(tag_tokens(df, column), "tag", "tag", min_count)


def numeric_ranges(df: DataFrame) -> DataFrame:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return _per_column(
        df,
        {c: (F.min(c).cast("double"), F.max(c).cast("double")) for c in numeric},
        ("min", "max"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column; their sum over the columns is the total."""
    return _per_column(df, {c: (F.count_if(F.col(c).isNull()),) for c in df.columns}, ("nulls",))


def null_ratios(df: DataFrame, top: int = 2) -> DataFrame:
    """The columns with most nulls, in percent."""
    ratios = _per_column(
        df,
        {c: (F.avg(F.col(c).isNull().cast("int")) * 100,) for c in df.columns},
        ("null_percent",),
    )
    return ratios.orderBy(F.desc("null_percent"), "column").limit(top)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier key; two nulls count as equal."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, one row each.

    Exact counts spread over one (column, value) grouping; sketches need a single pass.
    """
    if approximate:
        return _per_column(df, {c: (F.approx_count_distinct(c),) for c in columns}, ("n_distinct",))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .distinct()
        .groupBy("column")
        .agg(F.count("value").alias("n_distinct"))
    )


def distinct_sketches(df: DataFrame, columns: Sequence[str], parts: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """One row per part of a table with a sketch of each column's distinct values, to be stored. Sketches of parts
    added later are rows added later."""
    return df.groupBy(*parts).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(c) for c in columns])


def merged_distinct_counts(sketches: DataFrame, columns: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """Estimated distinct values of the whole table per column, from its parts' sketches alone, and the error
    (three standard errors of merged sketches, one at least) that the estimate should keep to."""
    merged = {c: F.hll_union_agg(c) for c in columns}
    estimates = {c: F.coalesce(F.hll_sketch_estimate(s), F.lit(0).cast("long")) for c, s in merged.items()}
    error = 3 * 1.04 / 2 ** (bits / 2)
    return _per_column(
        sketches, {c: (e, F.greatest(e * F.lit(error), F.lit(1.0))) for c, e in estimates.items()}, ("estimate", "error")
    )


def shape_report(df: DataFrame) -> DataFrame:
    """One row per column: its position and type, and the table's row and column counts."""
    fields = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.count("*").alias("n_rows")).select(
        F.inline(F.array(*fields)), "n_rows", F.lit(len(fields)).cast("long").alias("n_columns")
    )


def matrix_stats(interactions: DataFrame) -> DataFrame:
    """Size and density of the track by user matrix."""
    sizes = distinct_counts(interactions, ["track_id", "user_id"])
    return (
        sizes.groupBy()
        .pivot("column", ["track_id", "user_id"])
        .agg(F.first("n_distinct"))
        .select(
            F.col("track_id").alias("n_tracks"),
            F.col("user_id").alias("n_users"),
            interactions.agg(F.count("*")).scalar().alias("nnz"),
        )
        .select(
            "*",
            (1 - F.col("nnz") / (F.col("n_tracks").cast("double") * F.col("n_users"))).alias("sparsity"),
            F.try_divide("nnz", "n_users").alias("mean_per_user"),
            F.try_divide("nnz", "n_tracks").alias("mean_per_track"),
        )
    )
