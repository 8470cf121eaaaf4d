"""Column names and types of the two raw inputs and of the persisted tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the raw catalogue and log files.
PREVIEW_URL = "spotify_preview_url"
SOURCE_ID = "spotify_id"

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("track_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField(PREVIEW_URL, T.StringType()),
        T.StructField(SOURCE_ID, T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("danceability", T.DoubleType()),
        T.StructField("energy", T.DoubleType()),
        T.StructField("key", T.IntegerType()),
        T.StructField("loudness", T.DoubleType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("speechiness", T.DoubleType()),
        T.StructField("acousticness", T.DoubleType()),
        T.StructField("instrumentalness", T.DoubleType()),
        T.StructField("liveness", T.DoubleType()),
        T.StructField("valence", T.DoubleType()),
        T.StructField("tempo", T.DoubleType()),
        T.StructField("time_signature", T.IntegerType()),
    ]
)

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("track_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("playcount", T.DoubleType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("latency", T.DoubleType()),
        T.StructField("n_recs", T.LongType()),
    ]
)

# Tables an artifact folder holds; the encoder tables carry the prefix.
ENCODER_PREFIX = "encoder_"
ARTIFACTS = (
    "tracks",
    "features",
    "tracks_with_history",
    "interactions",
    "encoder_frequency",
    "encoder_categories",
    "encoder_vocabulary",
    "encoder_standard",
    "encoder_minmax",
)
