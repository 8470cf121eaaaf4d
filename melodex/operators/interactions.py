"""The listening log as a weighted track x user relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from melodex.operators.ranking import dictionary


def with_double_playcount(history: DataFrame) -> DataFrame:
    return history.withColumn("playcount", F.col("playcount").cast("double"))


def build_interactions(history: DataFrame) -> DataFrame:
    """Total playcount per (track, user). Rows without a track or user are left out."""
    return (
        with_double_playcount(history)
        .filter(F.col("track_id").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("track_id", "user_id")
        .agg(F.sum("playcount").alias("playcount"))
    )


def null_key_rows(history: DataFrame) -> DataFrame:
    """How many rows ``build_interactions`` leaves out."""
    missing = F.col("track_id").isNull() | F.col("user_id").isNull()
    return history.agg(F.count_if(missing).alias("null_key_rows"))


def history_tracks(history: DataFrame) -> DataFrame:
    return history.select("track_id").filter(F.col("track_id").isNotNull()).distinct()


def tracks_with_history(tracks: DataFrame, history: DataFrame) -> DataFrame:
    return tracks.join(history_tracks(history), "track_id", "left_semi")


def tracks_without_history(tracks: DataFrame, history: DataFrame) -> DataFrame:
    return tracks.join(history_tracks(history), "track_id", "left_anti")


def coded_interactions(interactions: DataFrame) -> DataFrame:
    """Matrix triples (track_idx, user_idx, playcount); each index is the dense code of its id."""
    tracks = dictionary(interactions, "track_id", "track_idx")
    users = dictionary(interactions, "user_id", "user_idx")
    return interactions.join(tracks, "track_id").join(users, "user_id").select("track_idx", "user_idx", "playcount")


def decode_tracks(coded: DataFrame, tracks: DataFrame) -> DataFrame:
    """Back from codes to ids."""
    return coded.join(tracks.select("track_idx", "track_id"), "track_idx")


def items_per_user(interactions: DataFrame) -> DataFrame:
    """Each user's set of tracks as rows, not as one array per user, so no user needs to fit in a row."""
    return interactions.select("user_id", "track_id").distinct()
