"""The offline pipeline: raw inputs to the tables that serving and evaluation read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from melodex.operators.clean import clean_catalogue, content_columns
from melodex.operators.features import EncoderSpec, fit_encoder, transform
from melodex.operators.interactions import build_interactions, tracks_with_history
from melodex.sources.files import encoder_tables, load_artifacts, save_artifacts
from melodex.sources.schemas import ENCODER_PREFIX


def build_artifacts(
    spark: SparkSession,
    raw_tracks: DataFrame,
    raw_history: DataFrame,
    folder: str,
    order: Sequence[str | Column],
    spec: EncoderSpec = EncoderSpec(),
) -> dict[str, DataFrame]:
    """Write every artifact and open it again. Each stage reads what the one before wrote, so nothing is
    computed twice and a lost executor only repeats its own stage."""
    save_artifacts({"tracks": clean_catalogue(raw_tracks, order)}, folder)
    tracks = load_artifacts(spark, folder, ["tracks"])["tracks"]

    content = content_columns(tracks)
    fitted = fit_encoder(content, spec)
    save_artifacts({ENCODER_PREFIX + name: table for name, table in fitted.items()}, folder)
    encoder = encoder_tables(load_artifacts(spark, folder, [ENCODER_PREFIX + name for name in fitted]))
    save_artifacts({"features": transform(content, encoder, spec, all_known=True)}, folder)

    # clustered by track within a file, so that a lookup of few tracks skips row groups
    interactions = build_interactions(raw_history).sortWithinPartitions("track_id")
    save_artifacts({"interactions": interactions}, folder)
    stored = load_artifacts(spark, folder, ["interactions"])["interactions"]
    save_artifacts({"tracks_with_history": tracks_with_history(tracks, stored)}, folder)
    return load_artifacts(spark, folder)


def serving_subset(features: DataFrame, interactions: DataFrame) -> DataFrame:
    """Features of the tracks with history; the encoder fitted on the whole catalogue stays as it is."""
    return features.join(interactions.select(F.col("track_id")).distinct(), "track_id", "left_semi")
