"""Ranks inside groups, safe for groups that hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from melodex.functions.scoring import rank_key
from melodex.session import materialise


def grouped_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "rank", size: str | None = None
) -> DataFrame:
    """Zero-based position of each row in its group, and optionally the group's size.

    ``order`` holds ascending sort expressions that make a total order within a group. A plain window
    would sort a whole group in one task. Here the rows are first divided into ranges of group and position, which
    are stored; each range ranks its own rows, and a group that runs over several ranges adds the rows of the
    ranges before. So a task's share depends on the number of ranges (shuffle partitions) and not on any group.
    """
    keys = list(keys)
    positioned = df.withColumn("_position", F.struct(*order)).repartitionByRange(*keys, "_position")
    ranged = materialise(positioned.withColumn("_range", F.spark_partition_id()), "ranges")

    in_group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = in_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("_group_rows", F.sum("_rows").over(in_group))
        .filter(F.col("_rows") < F.col("_group_rows"))
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_of"), "_offset", "_group_rows")
    )
    here = F.col("_range") == F.col("_of")
    for key in keys:
        here &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    # a border between ranges cuts one group at most: no more than two rows per range
    within = Window.partitionBy(*keys, "_range")
    placed = ranged.withColumn("_number", F.row_number().over(within.orderBy("_position")) - 1)
    if size is not None:
        placed = placed.withColumn("_here", F.count("*").over(within))
    placed = placed.join(F.broadcast(spans), here, "left").withColumn(
        rank, F.col("_number") + F.coalesce("_offset", F.lit(0))
    )
    if size is not None:
        placed = placed.withColumn(size, F.coalesce("_group_rows", "_here"))
    return placed.select(*df.columns, rank, *([size] if size is not None else []))


def top_k(
    scored: DataFrame,
    k: int,
    keys: Sequence[str] = ("seed",),
    item: str = "item",
    score: str = "score",
    exact: bool = False,
) -> DataFrame:
    """The k best items per key with ranks 1..k: score descending, then item id; null and NaN scores last.

    Scores that come from sums of products tie if they agree to nine decimals; ``exact`` ranks on the value.
    Spark limits each key to k rows per partition before the shuffle.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(None)) if exact else rank_key(F.col(score).cast("double"))
    best = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(value), item)
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def dictionary(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Dense codes 0..n-1 of the distinct values in ascending order."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return grouped_row_number(values, [], [F.col(column)], code)
