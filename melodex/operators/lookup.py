"""Finding seed tracks by exact name and artist, and choosing their recommender."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, NOT_FOUND, AMBIGUOUS, NO_HISTORY = "ok", "not_found", "ambiguous", "no_history"


NAME_AND_ARTIST = ("name", "artist")


def _named(tracks: DataFrame, keys: Sequence[str] = NAME_AND_ARTIST) -> DataFrame:
    """One row per name and artist, however many tracks share them."""
    return tracks.groupBy(*keys).agg(F.min("track_id").alias("track_id"), F.count("*").alias("n_matches"))


def resolve_seeds(seeds: DataFrame, tracks: DataFrame, keys: Sequence[str] = NAME_AND_ARTIST) -> DataFrame:
    """Add ``track_id`` (the first match) and ``n_matches`` to seeds named by ``keys``: with ``("name",)``, by name alone."""
    lowered = seeds.withColumns({c: F.lower(c) for c in keys})
    return lowered.join(_named(tracks, keys), list(keys), "left").withColumn(
        "n_matches", F.coalesce("n_matches", F.lit(0))
    )


def content_status() -> Column:
    """Content ranking takes the first of several matches."""
    return F.when(F.col("n_matches") == 0, NOT_FOUND).otherwise(OK)


def collab_status(has_history: Column) -> Column:
    """Rankings by track id need exactly one match, and that it has history."""
    return (
        F.when(F.col("n_matches") == 0, NOT_FOUND)
        .when(F.col("n_matches") > 1, AMBIGUOUS)
        .when(~has_history, NO_HISTORY)
        .otherwise(OK)
    )


def with_history_flag(seeds: DataFrame, history_tracks: DataFrame) -> DataFrame:
    """Whether each seed's ``track_id`` occurs in the log."""
    flagged = history_tracks.select("track_id").distinct().withColumn("_listed", F.lit(True))
    # seeds that nothing matches stay out of the join: their null keys would meet in one task
    found = seeds.filter(F.col("track_id").isNotNull()).join(flagged, "track_id", "left")
    unmatched = seeds.filter(F.col("track_id").isNull())
    return (
        found.unionByName(unmatched, allowMissingColumns=True)
        .withColumn("has_history", F.coalesce("_listed", F.lit(False)))
        .drop("_listed")
    )


def route(
    seeds: DataFrame, tracks: DataFrame, history_tracks: DataFrame, keys: Sequence[str] = NAME_AND_ARTIST
) -> DataFrame:
    """Hybrid where a track of those ``keys`` has history, else content; null where nothing matches.

    The seed keeps the match its recommender will use: the one with history for hybrid.
    """
    everywhere = resolve_seeds(seeds, tracks, keys)
    with_history = tracks.join(history_tracks.select("track_id").distinct(), "track_id", "left_semi")
    listed = _named(with_history, keys).select(
        *keys, F.col("track_id").alias("_listed_id"), F.col("n_matches").alias("_listed_matches")
    )
    routed = everywhere.join(listed, list(keys), "left")
    has_history = F.col("_listed_id").isNotNull()
    return (
        routed.withColumn(
            "model",
            F.when(has_history, "hybrid").when(F.col("n_matches") > 0, "content_based"),
        )
        .withColumn(
            "status",
            F.when(F.col("n_matches") == 0, NOT_FOUND)
            .when(F.col("_listed_matches") > 1, AMBIGUOUS)
            .otherwise(OK),
        )
        .withColumn("track_id", F.coalesce("_listed_id", "track_id"))
        .drop("_listed_id", "_listed_matches")
    )
