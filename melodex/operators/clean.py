"""Catalogue cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from melodex.functions.text import MISSING_TAGS
from melodex.sources.schemas import PREVIEW_URL, SOURCE_ID

# The columns cleaning drops, and those that are put in lower case.
DROPPED_COLUMNS = ("genre", SOURCE_ID)
LOWERED_COLUMNS = ("name", "artist", "tags")
NON_CONTENT_COLUMNS = ("name", PREVIEW_URL)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key in the given order.

    The filter on ``row_number`` becomes a group limit of one ahead of the shuffle, so a key with very
    many rows sends one row per input partition.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def fill_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults)


def lower_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in columns})


def clean_catalogue(
    raw: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = ("track_id",),
    drop: Sequence[str] = DROPPED_COLUMNS,
) -> DataFrame:
    """First row per key, without the dropped columns, missing tags filled, text in lower case.

    ``order`` says which duplicate comes first: a distributed table has no row order of its own.
    """
    return (
        raw.transform(first_per_key, keys, order)
        .drop(*drop)
        .transform(fill_missing, {"tags": MISSING_TAGS})
        .transform(lower_columns, LOWERED_COLUMNS)
    )


def content_columns(tracks: DataFrame, drop: Sequence[str] = NON_CONTENT_COLUMNS) -> DataFrame:
    """What the encoder sees; the track id stays as the key."""
    return tracks.drop(*drop)


def duplicate_stats(raw: DataFrame, keys: Sequence[str] = ("track_id",)) -> DataFrame:
    """What ``cleaning_stats`` says of a cleaning that drops repeated keys alone, from one pass over the keys. Rows are
    counted per key, so an executor lost on the way does not make any count twice."""
    per_key = raw.groupBy(*keys).agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    counts = per_key.agg(rows.alias("raw_rows"), F.count("*").alias("cleaned_rows"))
    return _with_drop_rate(counts)


def cleaning_stats(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: raw_rows, cleaned_rows, rows_dropped, drop_rate."""
    counts = raw.agg(F.count("*").alias("raw_rows")).withColumn(
        "cleaned_rows", cleaned.agg(F.count("*")).scalar()
    )
    return _with_drop_rate(counts)


def _with_drop_rate(counts: DataFrame) -> DataFrame:
    dropped = F.col("raw_rows") - F.col("cleaned_rows")
    rate = F.coalesce(F.try_divide(dropped, "raw_rows"), F.lit(0.0))
    return counts.withColumns({"rows_dropped": dropped, "drop_rate": rate})
