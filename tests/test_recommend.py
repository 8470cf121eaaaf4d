"""Single-seed calls and batch lists on toy catalogues."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import listening
from melodex.functions.scoring import diversity_weight
from melodex.operators import pruned, similarity
from melodex.plans import recommend as r


SEED = ("Salt Road", "Marsh")


def _ask(model, case, name, artist, k):
    tracks, features, log = case
    if model == "content":
        return r.recommend_content(name, artist, tracks, features, k)
    if model == "collab":
        return r.recommend_collab(name, artist, tracks, log, k)
    return r.recommend_hybrid(name, artist, tracks, features, log, k)


MODELS = ("content", "collab", "hybrid")


@pytest.mark.parametrize("model", MODELS)
def test_lists_leave_the_seed_out_and_are_as_long_as_asked(harbour, model):
    for k in (1, 3, 8):
        found = _ask(model, harbour, *SEED, k).collect()
        assert [row["rank"] for row in found] == list(range(1, min(k, 3) + 1))
        assert 17 not in [row["item"] for row in found]


@pytest.mark.parametrize("model", MODELS)
def test_what_a_caller_must_see(harbour, model):
    limit = "number_of_recommendations must be positive" if model == "hybrid" else "k must be a positive integer"
    for k in (0, -1):
        with pytest.raises(ValueError, match=limit):
            _ask(model, harbour, *SEED, k)
    with pytest.raises(ValueError, match="not found in database"):
        _ask(model, harbour, "salt road", "tide", 2)  # the name of one song, the artist of another


def test_order_by_shared_listeners_and_by_direction(harbour):
    tracks, features, log = harbour
    collab = r.recommend_collab("night ferry", "tide", tracks, log, 3).collect()
    assert [row["item"] for row in collab] == [11, 17, 23]
    assert collab[0].score == pytest.approx(8 / math.sqrt(17 * 13)) and collab[2].score == 0
    content = r.recommend_content("night ferry", "tide", tracks, features, 3).collect()
    assert [row["item"] for row in content] == [11, 17, 23]
    blended = r.recommend_hybrid("night ferry", "tide", tracks, features, log, 2, 0.4, project="narrow")
    assert [row.name for row in blended.collect()] == ["harbour lights", "salt road"]
    assert {"name", "artist", "spotify_preview_url"} <= set(blended.columns)


def test_seed_that_nobody_plays(spark, harbour):
    tracks, features, log = harbour
    quiet = log.filter("track_id != 23")
    with pytest.raises(ValueError, match="not found in collaborative filtering data"):
        r.recommend_collab("low water", "marsh", tracks, quiet)
    seeds = spark.createDataFrame([(5, "low water", "marsh"), (6, *SEED)], "seed_id long, name string, artist string")
    routed = r.routed_recommendations(seeds, tracks, features, quiet, 3, diversity=4).collect()
    assert {(row.seed_id, row.model) for row in routed} == {(5, "content_based"), (6, "hybrid")}
    # the blend ranks what has history, direction alone ranks all
    assert sorted(row["item"] for row in routed if row.seed_id == 6) == [11, 14]
    assert sorted(row["item"] for row in routed if row.seed_id == 5) == [11, 14, 17]
    assert r.recommend("low water", "marsh", tracks, features, quiet, 1).count() == 1


def test_plays_of_zero_score_zero(spark, harbour):
    tracks, features, log = harbour
    silent = log.withColumn("playcount", F.col("playcount") * 0)
    rows = r.recommend_hybrid(*SEED, tracks, features, silent, 3, 0.0).collect()
    assert len(rows) == 3 and all(row.score == 0 for row in rows)


def test_two_tracks_of_one_title(spark, harbour):
    tracks, features, log = harbour
    tracks = tracks.union(spark.createDataFrame([(31, "salt road", "marsh", "p31")], tracks.schema))
    features = features.union(spark.createDataFrame([(31, [0.5, 0.5], ["marsh"])], features.schema))
    log = log.union(listening(spark, [("di", 31, 1)]))
    for model in ("collab", "hybrid"):
        with pytest.raises(ValueError, match="Multiple songs match"):
            _ask(model, (tracks, features, log), *SEED, 2)
    chosen = _ask("content", (tracks, features, log), *SEED, 2).collect()
    assert {row.seed for row in chosen} == {17}  # the smaller id
    asked = [(1, *SEED), (2, "LOW water", "MARSH"), (3, "low tide", "marsh")]
    seeds = spark.createDataFrame(asked, "seed_id long, name string, artist string")
    status = {row.seed_id: row.status for row in r.collab_recommendations(seeds, tracks, log, 2).collect()}
    assert status == {1: "ambiguous", 2: "ok", 3: "not_found"}


def test_recommended_tracks_missing_from_the_catalogue_drop_out(harbour):
    tracks, _, log = harbour
    found = r.recommend_collab(*SEED, tracks.filter("track_id != 14"), log, 3).collect()
    assert sorted(row["item"] for row in found) == [11, 23]


def test_vectors_must_be_finite(spark, harbour):
    tracks, features, log = harbour
    broken = features.withColumn("dense", F.when(F.col("track_id") == 14, F.array(F.lit(None), F.lit(1.0))).otherwise(F.col("dense")))
    with pytest.raises(Exception, match="finite"):
        r.recommend_hybrid(*SEED, tracks, broken, log, 2).collect()


def test_diversity():
    assert [round(diversity_weight(d), 1) for d in (1, 5, 9)] == [0.9, 0.5, 0.1]
    with pytest.raises(ValueError):
        diversity_weight(10)


def _random_case(spark, n_items=60, n_users=25, seed=7):
    rng = np.random.default_rng(seed)
    dense = rng.normal(size=(n_items, 4)).round(3)
    artists = rng.integers(0, 5, n_items)
    plays = (rng.random((n_items, n_users)) < 0.2) * rng.integers(1, 9, (n_items, n_users))
    plays[3] = 0  # no history
    plays[:, 0] = rng.integers(1, 9, n_items)  # one user who plays everything
    plays[3, 0] = 0
    features = spark.createDataFrame(
        [(i, dense[i].tolist(), [f"={artists[i]}"] if artists[i] else [None]) for i in range(n_items)],
        "track_id long, dense array<double>, cats array<string>",
    )
    log = spark.createDataFrame(
        [(i, u, float(plays[i, u])) for i in range(n_items) for u in range(n_users) if plays[i, u]],
        "track_id long, user_id long, playcount double",
    )
    onehot = np.zeros((n_items, 5))
    onehot[np.arange(n_items), artists] = artists > 0
    wide = np.hstack([dense, onehot])
    return features, log, _cosine(wide), _cosine(plays.astype(float))


def _cosine(matrix):
    norms = np.linalg.norm(matrix, axis=1)
    safe = np.where(norms > 0, norms, np.inf)
    return matrix @ matrix.T / safe[:, None] / safe[None, :]


def _expected(scores, k, universe):
    out = {}
    for s in universe:
        order = sorted((i for i in universe if i != s), key=lambda i: (-np.floor(scores[s, i] * 1e9 + 0.5), i))
        out[s] = order[:k]
    return out


def _lists(df):
    out = {}
    for row in sorted(df.collect(), key=lambda row: (row.seed, row["rank"])):
        out.setdefault(row.seed, []).append(row["item"])
    return out


def test_content_lists_against_numpy(spark):
    features, _, cosine, _ = _random_case(spark)
    found = similarity.content_top_k(similarity.as_items(features), similarity.as_seeds(features), 7, tile_rows=16)
    assert _lists(found) == _expected(cosine, 7, range(60))


def _clustered(spark, clusters=12, members=25):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(clusters, 8))
    dense = np.repeat(centres, members, axis=0) + rng.normal(size=(clusters * members, 8)) * 0.05
    dense[3] = dense[4]  # copies, and a vector without direction
    dense[9] = 0
    artists = [[f"={i // members}"] if i % 3 else [None] for i in range(len(dense))]
    features = spark.createDataFrame(
        [(i, dense[i].tolist(), artists[i]) for i in range(len(dense))], "track_id long, dense array<double>, cats array<string>"
    )
    onehot = np.array([[float(a == [f"={c}"]) for c in range(clusters)] for a in artists])
    return features, _cosine(np.hstack([dense, onehot]))


@pytest.mark.parametrize("pivots", [1, 7, 40])
def test_pruned_lists_against_numpy(spark, pivots):
    features, cosine = _clustered(spark)
    found = pruned.search(similarity.as_items(features), similarity.as_seeds(features), 9, pivots, tile_rows=16)
    assert _lists(found.lists) == _expected(cosine, 9, range(300))
    features, _, cosine, _ = _random_case(spark)
    found = pruned.search(similarity.as_items(features), similarity.as_seeds(features), 70, pivots, tile_rows=16)
    assert _lists(found.lists) == _expected(cosine, 70, range(60))  # lists as long as the table


def test_blocks_of_other_clusters_are_not_visited(spark):
    features, _ = _clustered(spark)
    visits = pruned.search(similarity.as_items(features), similarity.as_seeds(features), 9, 40).visits.collect()
    assert len(visits) == 300 and {row.blocks for row in visits} == {40}
    zero = [row.visited for row in visits if row.seed == 9]
    assert zero == [40]  # all scores of a vector without direction tie
    assert sum(row.visited for row in visits) < 0.4 * 300 * 40


def test_few_seeds_are_scored_without_blocks(spark):
    features, cosine = _clustered(spark)
    few = similarity.as_seeds(features.filter("track_id < 3"))
    found = _lists(pruned.pruned_top_k(similarity.as_items(features), few, 5))
    assert found == {s: items for s, items in _expected(cosine, 5, range(300)).items() if s < 3}


@pytest.mark.parametrize("heavy_items", [5, 30, 10_000])
def test_collab_scores_do_not_depend_on_the_heavy_limit(spark, heavy_items):
    _, log, _, cosine = _random_case(spark)
    scores = similarity.collab_scores(log, log.select("track_id"), heavy_items).collect()
    assert len(scores) == np.count_nonzero(cosine)
    for row in scores:
        assert row.score == pytest.approx(cosine[row.seed, row["item"]], abs=1e-12)


@pytest.mark.parametrize("heavy_items", [5, 10_000])
def test_collab_scores_of_some_seeds(spark, heavy_items):
    _, log, _, cosine = _random_case(spark)
    seeds = spark.createDataFrame([(7,), (50,)], "track_id long")
    scores = similarity.collab_scores(log, seeds, heavy_items).collect()
    assert {row.seed for row in scores} == {7, 50}
    assert len(scores) == np.count_nonzero(cosine[[7, 50]])
    for row in scores:
        assert row.score == pytest.approx(cosine[row.seed, row["item"]], abs=1e-12)


def test_collab_fill_completes_short_lists(spark):
    _, log, _, cosine = _random_case(spark)
    universe = [i for i in range(60) if i != 3]
    assert _lists(similarity.collab_top_k(log, log.select("track_id"), 55)) == _expected(cosine, 55, universe)
    lonely = listening(spark, [(f"only {i}", i, i) for i in range(1, 9)])
    found = _lists(similarity.collab_top_k(lonely, lonely.select("track_id"), 3))
    assert found == {s: [i for i in range(1, 9) if i != s][:3] for s in range(1, 9)}


@pytest.mark.parametrize("weight", [0.0, 0.3, 1.0])
def test_hybrid_lists_against_numpy(spark, weight):
    features, log, content, collab = _random_case(spark)
    universe = [i for i in range(60) if i != 3]
    index = np.ix_(universe, universe)

    def normal(scores):
        inside = scores[index]
        low, high = inside.min(axis=1, keepdims=True), inside.max(axis=1, keepdims=True)
        return (inside - low) / (high - low + 1e-8)

    blended = np.full(content.shape, np.nan)
    blended[index] = weight * normal(content) + (1 - weight) * normal(collab)
    found = r.hybrid_lists(features, log, features.select("track_id"), 9, weight)
    assert _lists(found) == _expected(blended, 9, universe)


def test_string_ids(spark):
    features, log, cosine, _ = _random_case(spark)
    named = F.concat(F.lit("TR"), F.lpad(F.col("track_id").cast("string"), 4, "0"))
    found = r.hybrid_lists(
        features.withColumn("track_id", named), log.withColumn("track_id", named), log.select(named.alias("track_id")), 4
    )
    plain = r.hybrid_lists(features, log, log.select("track_id"), 4)
    assert _lists(found) == {f"TR{s:04d}": [f"TR{i:04d}" for i in items] for s, items in _lists(plain).items()}


def test_seeds_given_by_name_alone(spark, harbour):
    tracks, features, log = harbour
    by_name = r.recommend_content("Night Ferry", None, tracks, features, 3).collect()
    assert [row["item"] for row in by_name] == [11, 17, 23]
    assert r.recommend_collab("night ferry", None, tracks, log, 1).first()["item"] == 11
    assert r.recommend("night ferry", None, tracks, features, log, 2).count() == 2
    with pytest.raises(ValueError, match="Song 'low tide' not found in database"):
        r.recommend_content("low tide", None, tracks, features)
    # one title by two artists: the name alone is ambiguous, the name and artist are not
    twice = tracks.union(spark.createDataFrame([(31, "salt road", "tide", "p31")], tracks.schema))
    log = log.union(listening(spark, [("di", 31, 1)]))
    with pytest.raises(ValueError, match="Multiple songs match 'salt road': 2 track ids"):
        r.recommend_collab("salt road", None, twice, log)
    assert r.recommend_collab(*SEED, twice, log, 2).count() == 2
    seeds = spark.createDataFrame([(1, "Salt ROAD"), (2, "low water"), (3, "none such"), (4, None)], "seed_id long, name string")
    found = r.collab_recommendations(seeds, twice, log, 2, keys=("name",))
    assert {row.seed_id: row.status for row in found.collect()} == {1: "ambiguous", 2: "ok", 3: "not_found", 4: "not_found"}
    routed = r.routed_recommendations(seeds, tracks, features, log.filter("track_id != 31"), 2, keys=("name",)).collect()
    assert {(row.seed_id, row.status, row.model) for row in routed} == {
        (1, "ok", "hybrid"), (2, "ok", "hybrid"), (3, "not_found", None), (4, "not_found", None)
    }


def test_seeds_without_a_list_keep_one_row_and_stay_out_of_the_join(spark, harbour):
    tracks, features, log = harbour
    asked = [(i, f"unknown {i}", "nobody") for i in range(40)] + [(99, *SEED)]
    seeds = spark.createDataFrame(asked, "seed_id long, name string, artist string")
    for found in (r.content_recommendations(seeds, tracks, features, 2), r.collab_recommendations(seeds, tracks, log, 2)):
        rows = found.collect()
        assert len(rows) == 42 and sum(row.status == "not_found" and row.seed is None for row in rows) == 40
        assert [row["rank"] for row in rows if row.seed_id == 99] in ([1, 2], [2, 1])
