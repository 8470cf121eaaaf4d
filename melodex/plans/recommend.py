"""Recommendation plans: whole tables of seeds at once, and the single-seed calls built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from melodex.functions.scoring import check_k, check_weight, diversity_weight
from melodex.operators.interactions import tracks_with_history
from melodex.operators.lookup import (
    AMBIGUOUS,
    NAME_AND_ARTIST,
    NO_HISTORY,
    NOT_FOUND,
    OK,
    collab_status,
    content_status,
    resolve_seeds,
    route,
    with_history_flag,
)
from melodex.operators.pruned import pruned_top_k
from melodex.operators.similarity import (
    as_items,
    as_seeds,
    collab_top_k,
    hybrid_top_k,
)
from melodex.sources.schemas import PREVIEW_URL

# Default list lengths of the recommenders and of the lists that are evaluated.
CONTENT_K, COLLAB_K, EVALUATED_K = 10, 5, 100
NARROW_COLUMNS = ("name", "artist", PREVIEW_URL)


# ---- ranked id lists for a table of seed track ids -----------------------------------------------


def _seed_features(features: DataFrame, seeds: DataFrame) -> DataFrame:
    return as_seeds(features.join(seeds.select("track_id").distinct(), "track_id", "left_semi"))


def content_lists(features: DataFrame, seeds: DataFrame, k: int = EVALUATED_K) -> DataFrame:
    """(seed, item, score, rank) by content for every seed ``track_id``."""
    return pruned_top_k(as_items(features), _seed_features(features, seeds), check_k(k))


def collab_lists(
    interactions: DataFrame, seeds: DataFrame, k: int = EVALUATED_K, fill_zero: bool = True
) -> DataFrame:
    """(seed, item, score, rank) by shared listeners for every seed ``track_id`` in the log."""
    return collab_top_k(interactions, seeds, check_k(k), fill_zero)


def hybrid_lists(
    features: DataFrame,
    interactions: DataFrame,
    seeds: DataFrame,
    k: int = EVALUATED_K,
    weight_content: float = 0.5,
) -> DataFrame:
    """(seed, item, score, rank) by the weighted blend, over the tracks that have features and history."""
    check_k(k, "number_of_recommendations")
    check_weight(weight_content)
    common = tracks_with_history(features, interactions)
    inside = interactions.join(features.select("track_id"), "track_id", "left_semi")
    listed = seeds.select("track_id").distinct()
    return hybrid_top_k(as_items(common), _seed_features(common, listed), inside, k, weight_content)


# ---- named seeds ---------------------------------------------------------------------------------
#
# Seeds have a seed_id and the columns of ``keys``: name and artist, or with ("name",) the name alone.


def attach_catalogue(lists: DataFrame, tracks: DataFrame, project: str = "all") -> DataFrame:
    """Catalogue columns of the recommended tracks. Lists are cut to k before; tracks missing from the
    catalogue drop out. ``project='narrow'`` keeps name, artist and preview address only."""
    columns = NARROW_COLUMNS if project == "narrow" else [c for c in tracks.columns if c != "track_id"]
    catalogue = tracks.select(F.col("track_id").alias("item"), *columns)
    return lists.join(catalogue, "item")


def _named_lists(resolved: DataFrame, lists: DataFrame, keys: Sequence[str] = ("seed",)) -> DataFrame:
    """Lists per seed_id; seeds without a list keep one row that says why. Those stay out of the join: they have no
    track, and all null keys would meet in one task."""
    asked = resolved.withColumnRenamed("track_id", "seed").select("seed_id", "status", *keys)
    usable = F.col("status") == OK
    rest = asked.filter(~usable).withColumn("seed", F.lit(None).cast(asked.schema["seed"].dataType))
    return (
        asked.filter(usable)
        .join(lists, list(keys), "left")
        .unionByName(rest, allowMissingColumns=True)
        .select("seed_id", "status", *[c for c in keys if c != "seed"], "seed", "item", "score", "rank")
    )


def content_recommendations(
    seeds: DataFrame,
    tracks: DataFrame,
    features: DataFrame,
    k: int = CONTENT_K,
    keys: Sequence[str] = NAME_AND_ARTIST,
) -> DataFrame:
    """Content lists for seeds (seed_id and ``keys``). Status: ok or not_found."""
    check_k(k)
    resolved = resolve_seeds(seeds, tracks, keys).withColumn("status", content_status())
    return _named_lists(resolved, content_lists(features, resolved.filter(F.col("status") == OK), k))


def collab_recommendations(
    seeds: DataFrame,
    tracks: DataFrame,
    interactions: DataFrame,
    k: int = COLLAB_K,
    fill_zero: bool = True,
    keys: Sequence[str] = NAME_AND_ARTIST,
) -> DataFrame:
    """Collaborative lists for seeds (seed_id and ``keys``). Status: ok, not_found, ambiguous or no_history."""
    check_k(k)
    resolved = with_history_flag(resolve_seeds(seeds, tracks, keys), interactions)
    resolved = resolved.withColumn("status", collab_status(F.col("has_history")))
    ok = resolved.filter(F.col("status") == OK)
    return _named_lists(resolved, collab_lists(interactions, ok, k, fill_zero))


def hybrid_recommendations(
    seeds: DataFrame,
    tracks: DataFrame,
    features: DataFrame,
    interactions: DataFrame,
    k: int = CONTENT_K,
    weight_content: float | None = None,
    diversity: int | None = None,
    keys: Sequence[str] = NAME_AND_ARTIST,
) -> DataFrame:
    """Hybrid lists for seeds (seed_id and ``keys``), which are looked up among the tracks with history."""
    weight = _weight(weight_content, diversity)
    check_k(k, "number_of_recommendations")
    listed = tracks_with_history(tracks, interactions)
    resolved = resolve_seeds(seeds, listed, keys).withColumn("status", collab_status(F.lit(True)))
    ok = resolved.filter(F.col("status") == OK)
    return _named_lists(resolved, hybrid_lists(features, interactions, ok, k, weight))


def routed_recommendations(
    seeds: DataFrame,
    tracks: DataFrame,
    features: DataFrame,
    interactions: DataFrame,
    k: int = CONTENT_K,
    weight_content: float | None = None,
    diversity: int | None = None,
    keys: Sequence[str] = NAME_AND_ARTIST,
) -> DataFrame:
    """Hybrid lists for seeds with history, content lists for the others; ``model`` says which."""
    weight = _weight(weight_content, diversity)
    check_k(k)
    routed = route(seeds, tracks, interactions, keys)
    by_hybrid = routed.filter((F.col("model") == "hybrid") & (F.col("status") == OK))
    by_content = routed.filter((F.col("model") == "content_based") & (F.col("status") == OK))
    lists = (
        hybrid_lists(features, interactions, by_hybrid, k, weight)
        .withColumn("model", F.lit("hybrid"))
        .unionByName(content_lists(features, by_content, k).withColumn("model", F.lit("content_based")))
    )
    return _named_lists(routed, lists, ("seed", "model"))


def adhoc_recommendations(features: DataFrame, adhoc_features: DataFrame, k: int = CONTENT_K) -> DataFrame:
    """Content lists for encoded songs that are not in the catalogue."""
    return pruned_top_k(as_items(features), as_seeds(adhoc_features), check_k(k))


def _weight(weight_content: float | None, diversity: int | None) -> float:
    if diversity is not None:
        if weight_content is not None:
            raise ValueError("give weight_content or diversity, not both")
        return diversity_weight(diversity)
    return check_weight(0.5 if weight_content is None else weight_content)


# ---- one seed ------------------------------------------------------------------------------------


# An artist of None looks the song up by its name alone.


def _keys(artist: str | None) -> Sequence[str]:
    return ("name",) if artist is None else NAME_AND_ARTIST


def _one_seed(tracks: DataFrame, name: str, artist: str | None) -> DataFrame:
    given = {"name": name, "artist": artist}
    seed = tracks.sparkSession.range(1).withColumnRenamed("id", "seed_id")
    return seed.withColumns({key: F.lit(given[key]) for key in _keys(artist)})


def _resolved_id(resolved: DataFrame, name: str, artist: str | None, message: str):
    row = resolved.first()
    if row.status == NOT_FOUND:
        by = "" if artist is None else f" by '{artist.lower()}'"
        raise ValueError(f"Song '{name.lower()}'{by} not found in database")
    if row.status == AMBIGUOUS:
        song = repr(name.lower()) + ("" if artist is None else f" / {artist.lower()!r}")
        raise ValueError(f"Multiple songs match {song}: {row.n_matches} track ids. {message}")
    if row.status == NO_HISTORY:
        raise ValueError(f"Track ID '{row.track_id}' not found in collaborative filtering data")
    return row.track_id


_DEDUPLICATE = "Ask by track id, or clean the catalogue first."


def _listed(lists: DataFrame, tracks: DataFrame, project: str) -> DataFrame:
    return attach_catalogue(lists, tracks, project).orderBy("rank")


def _only(tracks: DataFrame, track_id) -> DataFrame:
    return tracks.filter(F.col("track_id") == F.lit(track_id)).select("track_id")


def recommend_content(
    name: str, artist: str | None, tracks: DataFrame, features: DataFrame, k: int = CONTENT_K, project: str = "all"
) -> DataFrame:
    check_k(k)
    found = resolve_seeds(_one_seed(tracks, name, artist), tracks, _keys(artist))
    resolved = found.withColumn("status", content_status())
    track_id = _resolved_id(resolved, name, artist, _DEDUPLICATE)
    return _listed(content_lists(features, _only(tracks, track_id), k), tracks, project)


def recommend_collab(
    name: str, artist: str | None, tracks: DataFrame, interactions: DataFrame, k: int = COLLAB_K, project: str = "all"
) -> DataFrame:
    check_k(k)
    found = resolve_seeds(_one_seed(tracks, name, artist), tracks, _keys(artist))
    resolved = with_history_flag(found, interactions)
    resolved = resolved.withColumn("status", collab_status(F.col("has_history")))
    track_id = _resolved_id(resolved, name, artist, _DEDUPLICATE)
    return _listed(collab_lists(interactions, _only(tracks, track_id), k), tracks, project)


def recommend_hybrid(
    name: str,
    artist: str | None,
    tracks: DataFrame,
    features: DataFrame,
    interactions: DataFrame,
    k: int = CONTENT_K,
    weight_content: float | None = None,
    diversity: int | None = None,
    project: str = "all",
) -> DataFrame:
    """``tracks`` may be the whole catalogue: only tracks with history are looked up."""
    weight = _weight(weight_content, diversity)
    check_k(k, "number_of_recommendations")
    listed = tracks_with_history(tracks, interactions)
    found = resolve_seeds(_one_seed(tracks, name, artist), listed, _keys(artist))
    resolved = found.withColumn("status", collab_status(F.lit(True)))
    track_id = _resolved_id(resolved, name, artist, _DEDUPLICATE)
    lists = hybrid_lists(features, interactions, _only(tracks, track_id), k, weight)
    return _listed(lists, listed, project)


def recommend(
    name: str,
    artist: str | None,
    tracks: DataFrame,
    features: DataFrame,
    interactions: DataFrame,
    k: int = CONTENT_K,
    diversity: int = 5,
    project: str = "all",
) -> DataFrame:
    """Hybrid where the song has history, else content."""
    seed = route(_one_seed(tracks, name, artist), tracks, interactions, _keys(artist)).first()
    if seed.model == "hybrid":
        return recommend_hybrid(
            name, artist, tracks, features, interactions, k, diversity=diversity, project=project
        )
    return recommend_content(name, artist, tracks, features, k, project)
