"""One query per operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from melodex.functions.scoring import DIVERSITY_STEPS, diversity_weight_column
from melodex.functions.text import ASCII_WORD_PATTERN, MISSING_TAGS, title_case, words
from melodex.functions.vectors import cosine, dot, l2_norm
from melodex.operators import clean, features, interactions, lookup, metrics, profile, pruned, ranking, search, similarity, split
from melodex.plans import evaluate, pipeline, recommend
from melodex.session import materialise, new_folder
from melodex.sources import files
from melodex.sources.schemas import ARTIFACTS, PREVIEW_URL
from melodex.streaming import monitor
from melodex.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# of the tables stored hashed by track
BUCKETS = 16


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _lists(df: DataFrame) -> DataFrame:
    return _rounded(df, "score").select("seed", "item", "score", "rank")


def _content(spark: SparkSession, folder: str) -> DataFrame:
    """What the encoder sees, written once: fitting reads it several times."""
    return materialise(clean.content_columns(t.tracks(spark, folder)), "content")


def _features(spark: SparkSession, folder: str) -> DataFrame:
    """Features as an artifact: the catalogue, the encoder and the features are each written once."""
    return materialise(features.fit_transform(_content(spark, folder)), "features")


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions as an artifact."""
    return materialise(t.interactions(spark, folder), "interactions")


def _radio_log(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions of the radio log, in which many tracks have no plays."""
    return materialise(t.radio_interactions(spark, folder), "radio")


def _named_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """A seed per part: its name in capitals, and an artist that exists for about half of them."""
    return t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("seed_id"),
        F.upper("p_name").alias("name"),
        F.concat(F.lit("Brand#"), F.col("p_size").cast("string")).alias("artist"),
    )


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# ---- sources and sinks ---------------------------------------------------------------------------


@query
def a1_csv_catalogue(spark, folder):
    raw = t.raw_catalogue(spark, folder)
    path = new_folder(spark, "catalogue-csv")
    files.write_table(raw, path, "csv")
    return files.read_catalogue(spark, path, schema=raw.schema)


@query
def a2_csv_history(spark, folder):
    raw = t.history(spark, folder)
    path = new_folder(spark, "history-csv")
    files.write_table(raw, path, "csv")
    return files.read_history(spark, path, schema=raw.schema)


@query
def a3_pruned_scan(spark, folder):
    return files.read_table(spark, f"{folder}/part.parquet", columns=["p_partkey", "p_name", "p_brand"])


@query
def a4_write_cleaned(spark, folder):
    path = new_folder(spark, "cleaned")
    files.write_table(t.tracks(spark, folder), path, partition_by=["time_signature"])
    return files.read_table(spark, path)


@query
def a4_write_cleaned_json(spark, folder):
    cleaned = t.tracks(spark, folder)
    path = new_folder(spark, "cleaned-json")
    files.write_table(cleaned, path, "json")
    return files.read_table(spark, path, cleaned.schema, "json")


@query
def a4_write_cleaned_orc(spark, folder):
    path = new_folder(spark, "cleaned-orc")
    files.write_table(t.tracks(spark, folder), path, "orc")
    return files.read_table(spark, path, file_format="orc")


def _artifacts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return pipeline.build_artifacts(
        spark, t.first_listings(spark, folder), t.history(spark, folder), new_folder(spark, "artifacts"), t.LISTING_ORDER,
        features.EncoderSpec(passthrough=("mode",)),
    )


@query
def a5_feature_matrix(spark, folder):
    stored = _artifacts(spark, folder)["features"]
    return stored.select("track_id", F.posexplode("dense").alias("position", "value")).select(
        "track_id", "position", F.round("value", 6).alias("value")
    )


@query
def a6_stored_interactions(spark, folder):
    return _artifacts(spark, folder)["interactions"].select("track_id", "user_id", "playcount")


@query
def a7_stored_encoder(spark, folder):
    encoder = files.encoder_tables(_artifacts(spark, folder))
    return _dense_rows(
        features.transform(
            clean.content_columns(t.tracks(spark, folder)), encoder, features.EncoderSpec(passthrough=("mode",))
        )
    )


@query
def a8_load_artifacts(spark, folder):
    loaded = _artifacts(spark, folder)
    sizes = [loaded[name].groupBy(F.lit(name).alias("artifact")).agg(F.count("*").alias("n_rows")) for name in ARTIFACTS]
    out = sizes[0]
    for size in sizes[1:]:
        out = out.unionByName(size)
    return out


@query
def a9_report(spark, folder):
    report = _collab_report(spark, folder)
    path = new_folder(spark, "report")
    files.write_report(report, path)
    return _rounded(files.read_table(spark, f"{path}/metrics", report.schema, "json"), *metrics.METRICS)


@query
def a9_report_run(spark, folder):
    """What the stored report says about the data it was made from."""
    evaluation = _evaluation(spark, folder)
    path = new_folder(spark, "report")
    files.write_report(evaluation.metrics, path, evaluation.run)
    run = files.read_table(spark, f"{path}/run", evaluation.run.schema, "json")
    return run.withColumn("k_values", F.array_join(F.col("k_values").cast("array<string>"), ","))


# ---- cleaning ------------------------------------------------------------------------------------


@query
def b1_dedup_first(spark, folder):
    return clean.first_per_key(t.listings(spark, folder), ["track_id"], t.LISTING_ORDER).select(
        "track_id", *[c for c in t.LISTING_ORDER if c != "l_shipdate"]
    )


@query
def b1_dedup_three_keys(spark, folder):
    """Duplicates by source id, year and duration, as the exploration did."""
    kept = clean.first_per_key(
        t.listings(spark, folder), ["spotify_id", "year", "duration_ms"], [*t.LISTING_ORDER, "track_id"]
    )
    return kept.select("spotify_id", "year", "duration_ms", "track_id", "l_orderkey", "l_linenumber")


@query
def b2_drop_columns(spark, folder):
    return t.raw_catalogue(spark, folder).drop(*clean.DROPPED_COLUMNS).select(
        "track_id", "name", "artist", "tags", "year", "duration_ms"
    )


@query
def b3_fill_missing(spark, folder):
    return clean.fill_missing(t.raw_catalogue(spark, folder).select("track_id", "tags"), {"tags": "no_tags"})


@query
def b4_lower_columns(spark, folder):
    raw = t.raw_catalogue(spark, folder).select("track_id", "name", "artist", "tags")
    return clean.lower_columns(raw, clean.LOWERED_COLUMNS)


@query
def b5_clean_data(spark, folder):
    return t.tracks(spark, folder)


@query
def b6_content_columns(spark, folder):
    return clean.content_columns(t.tracks(spark, folder))


@query
def b7_cast_playcount(spark, folder):
    whole = t.history(spark, folder).withColumn("playcount", F.col("playcount").cast("int"))
    return interactions.with_double_playcount(whole)


@query
def b8_seed_lookup(spark, folder):
    resolved = lookup.resolve_seeds(_named_seeds(spark, folder), t.tracks(spark, folder))
    flagged = lookup.with_history_flag(resolved, t.radio_interactions(spark, folder))
    return flagged.select(
        "seed_id",
        "track_id",
        "n_matches",
        lookup.content_status().alias("content_status"),
        lookup.collab_status(F.col("has_history")).alias("collab_status"),
    )


@query
def b8_seed_lookup_by_name(spark, folder):
    """Seeds given by name alone; recordings of about half of the parts are asked for as live ones, which there are none of."""
    part = t.table(spark, folder, "part")
    asked = F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.concat("p_name", F.lit(" (live)")))
    seeds = part.select(F.col("p_partkey").alias("seed_id"), asked.alias("name"))
    resolved = lookup.resolve_seeds(seeds, t.tracks(spark, folder), ["name"])
    flagged = lookup.with_history_flag(resolved, t.radio_interactions(spark, folder))
    return flagged.select(
        "seed_id",
        "track_id",
        "n_matches",
        lookup.content_status().alias("content_status"),
        lookup.collab_status(F.col("has_history")).alias("collab_status"),
    )


@query
def b9_known_names(spark, folder):
    seeds = clean.lower_columns(_named_seeds(spark, folder), ["name", "artist"])
    return seeds.join(t.tracks(spark, folder), ["name", "artist"], "left_semi").select("seed_id", "name", "artist")


@query
def b10_route(spark, folder):
    routed = lookup.route(
        _named_seeds(spark, folder), t.tracks(spark, folder), t.radio_interactions(spark, folder)
    )
    return routed.select("seed_id", "track_id", "model", "status")


@query
def b11_filter_artist(spark, folder):
    return t.tracks(spark, folder).filter(F.col("artist") == "brand#7").select("track_id", "name", "artist")


# ---- joins ---------------------------------------------------------------------------------------


@query
def c1_tracks_with_history(spark, folder):
    kept = interactions.tracks_with_history(t.tracks(spark, folder), t.radio_history(spark, folder))
    return kept.select("track_id", "name", "artist", "tags", "year")


@query
def c1_bucketed(spark, folder):
    """The same from a catalogue and a log that are stored hashed by track, joined without a shuffle."""
    catalogue = files.store_bucketed(t.tracks(spark, folder), new_folder(spark, "catalogue"), "track_id", BUCKETS)
    # one row per track: no track holds more of them than another
    listed = interactions.history_tracks(t.radio_history(spark, folder))
    heard = files.store_bucketed(listed, new_folder(spark, "heard"), "track_id", BUCKETS)
    kept = interactions.tracks_with_history(catalogue, heard)
    return kept.select("track_id", "name", "artist", "tags", "year")


@query
def c2_attach_catalogue(spark, folder):
    log = _log(spark, folder)
    lists = recommend.collab_lists(log, log.select("track_id"), 5)
    return _rounded(recommend.attach_catalogue(lists, t.tracks(spark, folder), "narrow"), "score").select(
        "seed", "item", "score", "rank", "name", "artist", PREVIEW_URL
    )


@query
def c3_aligned_scores(spark, folder):
    """Content and collaborative scores of the pairs that are in both rankings."""
    encoded, log = _features(spark, folder), _log(spark, folder)
    by_content = recommend.content_lists(encoded, encoded.select("track_id"), 20)
    by_collab = recommend.collab_lists(log, log.select("track_id"), 20)
    both = by_content.select("seed", "item", F.col("score").alias("content_score")).join(
        by_collab.select("seed", "item", F.col("score").alias("collab_score")), ["seed", "item"]
    )
    return _rounded(both, "content_score", "collab_score")


@query
def c4_dictionary_join(spark, folder):
    log = _log(spark, folder)
    coded = interactions.coded_interactions(log).select("track_idx", "playcount")
    decoded = interactions.decode_tracks(coded, ranking.dictionary(log, "track_id", "track_idx"))
    return decoded.groupBy("track_id").agg(F.sum("playcount").alias("playcount"), F.count("*").alias("n_users"))


@query
def c5_sampled_users(spark, folder):
    log = _log(spark, folder)
    return split.rows_of_users(log, split.sample_users(log, 100)).select("track_id", "user_id", "playcount")


@query
def c6_shared_listeners(spark, folder):
    """Products of the profiles of all tracks sharing a listener, summed up per seed."""
    log = _log(spark, folder)
    products = similarity.collab_products(log, log.select("track_id"))
    return products.groupBy("seed").agg(
        F.count("*").alias("n_items"), F.sum("dot").alias("total"), F.max("dot").alias("largest")
    )


@query
def c7_content_ranges(spark, folder):
    """Every seed against every item, reduced to the range of its scores."""
    encoded = _features(spark, folder)
    return _rounded(
        similarity.content_ranges(similarity.as_items(encoded), similarity.as_seeds(encoded)), "low", "high"
    )


@query
def c8_tracks_without_history(spark, folder):
    kept = interactions.tracks_without_history(t.tracks(spark, folder), t.radio_history(spark, folder))
    return kept.select("track_id", "name", "artist", "tags", "year")


# ---- aggregates ----------------------------------------------------------------------------------


@query
def d1_interactions(spark, folder):
    return t.interactions(spark, folder)


@query
def d2_matrix(spark, folder):
    return interactions.coded_interactions(t.interactions(spark, folder))


@query
def d3_distinct_counts(spark, folder):
    return profile.distinct_counts(t.raw_catalogue(spark, folder), ["track_id", "name", "artist", "year", "tags"])


@query
def d3_merged_sketches(spark, folder):
    """Exact counts, and whether those merged from the sketches of the years' listings keep to their error."""
    columns = ["track_id", "name", "artist", "year", "tags"]
    parts = t.listings(spark, folder).withColumn("shipped", F.year("l_shipdate"))
    sketches = materialise(profile.distinct_sketches(parts, columns, ["shipped"]), "sketches")
    estimates = profile.merged_distinct_counts(sketches, columns)
    exact = profile.distinct_counts(t.raw_catalogue(spark, folder), columns)
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.col("error")
    return exact.join(estimates, "column").select("column", "n_distinct", near.alias("within_error"))


@query
def d3_distinct_tracks(spark, folder):
    return interactions.history_tracks(t.history(spark, folder))


@query
def d4_dictionary_encode(spark, folder):
    return ranking.dictionary(t.raw_catalogue(spark, folder), "name")


@query
def d5_items_per_user(spark, folder):
    return interactions.items_per_user(t.interactions(spark, folder))


@query
def d6_collab_ranges(spark, folder):
    log = _log(spark, folder)
    scores = similarity.collab_scores(log, log.select("track_id"))
    n_items = log.agg(F.count_distinct("track_id")).scalar()
    return _rounded(similarity.collab_ranges(scores, n_items), "low", "high")


@query
def d7_mean_metrics(spark, folder):
    return _rounded(_collab_report(spark, folder), *metrics.METRICS)


@query
def d8_tag_counts(spark, folder):
    return profile.tag_counts(t.raw_catalogue(spark, folder))


@query
def d9_tag_counts_min(spark, folder):
    return profile.tag_counts(t.raw_catalogue(spark, folder), min_count=1000)


@query
def d10_numeric_ranges(spark, folder):
    return profile.numeric_ranges(t.raw_catalogue(spark, folder))


@query
def d11_null_counts(spark, folder):
    return profile.null_counts(t.raw_catalogue(spark, folder))


@query
def d12_null_ratio_top2(spark, folder):
    return _rounded(profile.null_ratios(t.raw_catalogue(spark, folder)), "null_percent")


@query
def d13_duplicate_count(spark, folder):
    return profile.duplicate_count(t.raw_catalogue(spark, folder), ["spotify_id", "year", "tags"])


@query
def d14_shape(spark, folder):
    return profile.shape_report(t.raw_catalogue(spark, folder)).select("position", "column", "n_rows", "n_columns")


@query
def d15_clean_stats(spark, folder):
    return _rounded(clean.cleaning_stats(t.raw_catalogue(spark, folder), t.tracks(spark, folder)), "drop_rate")


@query
def d15_duplicate_stats(spark, folder):
    return _rounded(clean.duplicate_stats(t.raw_catalogue(spark, folder)), "drop_rate")


@query
def d16_matrix_stats(spark, folder):
    return _rounded(
        profile.matrix_stats(t.interactions(spark, folder)), "sparsity", "mean_per_user", "mean_per_track"
    )


@query
def d17_feature_stats(spark, folder):
    return _rounded(features.feature_stats(_features(spark, folder)), "sparsity")


# ---- windows -------------------------------------------------------------------------------------


@query
def e1_rank_in_user(spark, folder):
    return split.ranked_interactions(t.interactions(spark, folder)).select("track_id", "user_id", "rank")


@query
def e2_group_size(spark, folder):
    return split.ranked_interactions(t.interactions(spark, folder)).select("track_id", "user_id", "group_size")


@query
def e3_split_train(spark, folder):
    return split.train_test(t.interactions(spark, folder))[0].select("track_id", "user_id", "playcount")


@query
def e3_split_test(spark, folder):
    return split.train_test(t.interactions(spark, folder))[1].select("track_id", "user_id", "playcount")


@query
def e4_topk_per_user(spark, folder):
    """The five tracks each user plays most."""
    best = ranking.top_k(t.interactions(spark, folder), 5, ["user_id"], "track_id", "playcount", exact=True)
    return best.select("user_id", "track_id", "rank")


@query
def e5_hits(spark, folder):
    log = _log(spark, folder)
    _, test = evaluate.held_out(log)
    seeds = metrics.seed_per_user(test)
    lists = recommend.collab_lists(log, seeds.select(F.col("seed").alias("track_id")), 100)
    return metrics.hits(seeds, test, lists, 100).select("user_id", "item", "rank", "hit_no")


# ---- sorts, limits, sets -------------------------------------------------------------------------


@query
def f1_sorted_tracks(spark, folder):
    return interactions.tracks_with_history(
        t.tracks(spark, folder), t.history(spark, folder)
    ).orderBy("track_id").select("track_id", "name", "artist")


@query
def f2_one_seed(spark, folder):
    """The single-seed call, for the song that leads the catalogue."""
    cleaned = materialise(t.tracks(spark, folder), "tracks")
    song = cleaned.orderBy("track_id").first()
    encoded = materialise(features.fit_transform(clean.content_columns(cleaned)), "features")
    found = recommend.recommend_content(song.name.upper(), song.artist, cleaned, encoded, 10, "narrow")
    return _rounded(found, "score")


@query
def f3_sorted_interactions(spark, folder):
    return t.interactions(spark, folder).orderBy("user_id", F.desc("playcount"), "track_id")


@query
def f4_head(spark, folder):
    return t.tracks(spark, folder).orderBy("track_id").limit(5).select("track_id", "name", "artist")


@query
def f5_hit_sets(spark, folder):
    log = _log(spark, folder)
    _, test = evaluate.held_out(log)
    seeds = metrics.seed_per_user(test)
    lists = recommend.collab_lists(log, seeds.select(F.col("seed").alias("track_id")), 20)
    return metrics.hits(seeds, test, lists, 20).groupBy("user_id").agg(F.count("*").alias("n_hits"))


@query
def f6_split_check(spark, folder):
    log = _log(spark, folder)
    return split.partition_check(log, *split.train_test(log))


@query
def f7_union_models(spark, folder):
    report = _evaluation(spark, folder).metrics
    return _rounded(report, *metrics.METRICS)


@query
def f8_hash_sample(spark, folder):
    return split.sample_users(t.interactions(spark, folder), 50)


# ---- features ------------------------------------------------------------------------------------


def _dense_rows(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "track_id", F.posexplode("dense").alias("position", "value"), F.concat_ws("|", "cats").alias("cats")
    ).select("track_id", "position", F.round("value", 6).alias("value"), "cats")


@query
def g1_frequency(spark, folder):
    fitted = features.fit_frequency(t.tracks(spark, folder), ["year"])
    return _rounded(fitted, "frequency")


@query
def g2_onehot_categories(spark, folder):
    return features.fit_categories(t.tracks(spark, folder), ["artist", "time_signature", "key"])


@query
def g3_tfidf_vocabulary(spark, folder):
    documents = t.documents(spark, folder)
    return _rounded(features.fit_vocabulary(documents, "text", 85, ASCII_WORD_PATTERN), "idf")


@query
def g3_tfidf_weights(spark, folder):
    documents = t.documents(spark, folder)
    known = features.fit_vocabulary(documents, "text", 85, ASCII_WORD_PATTERN)
    return _rounded(features.tfidf_weights(documents, known, "doc_id", "text", ASCII_WORD_PATTERN), "weight")


@query
def g3_tfidf_weights_fitted(spark, folder):
    """The same for a vocabulary that was fitted and stored before."""
    documents = t.documents(spark, folder)
    known = materialise(features.fit_vocabulary(documents, "text", 85, ASCII_WORD_PATTERN), "vocabulary")
    return _rounded(features.tfidf_weights(documents, known, "doc_id", "text", ASCII_WORD_PATTERN), "weight")


@query
def g4_standard_scale(spark, folder):
    cleaned = t.tracks(spark, folder)
    columns = features.EncoderSpec().standard
    scaled = features.standard_scale(cleaned, features.fit_standard(cleaned, columns), columns)
    return _rounded(scaled.select("track_id", *columns), *columns)


@query
def g5_minmax_scale(spark, folder):
    cleaned = t.tracks(spark, folder)
    columns = features.EncoderSpec().minmax
    scaled = features.minmax_scale(cleaned, features.fit_minmax(cleaned, columns), columns)
    return _rounded(scaled.select("track_id", *columns), *columns)


@query
def g6_passthrough(spark, folder):
    content = clean.content_columns(t.tracks(spark, folder))
    rest = features.EncoderSpec().rest(content)
    return content.select("track_id", *[F.col(c).cast("double").alias(c) for c in rest])


@query
def g7_fit_scales(spark, folder):
    encoder = features.fit_encoder(clean.content_columns(t.tracks(spark, folder)))
    return _rounded(
        encoder["standard"].select("column", F.col("mean").alias("first"), F.col("std").alias("second")).unionByName(
            encoder["minmax"].select("column", F.col("low").alias("first"), F.col("high").alias("second"))
        ),
        "first",
        "second",
    )


@query
def g8_transform(spark, folder):
    return _dense_rows(_features(spark, folder))


@query
def g8_transform_raw_year(spark, folder):
    return _dense_rows(features.fit_transform(_content(spark, folder), features.EncoderSpec(year_encoding="raw")))


def _holed_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of a catalogue that lacks numbers, which are imputed."""
    content = clean.content_columns(t.tracks(spark, folder)).withColumns(
        {
            "tempo": F.when(F.col("tags") == MISSING_TAGS, float("nan")).otherwise(F.col("tempo")),
            "energy": F.when(F.col("time_signature") > 1, F.col("energy")),
            "mode": F.when(F.col("key") > 0, F.col("mode")),
        }
    )
    holed = materialise(content, "holed")
    return materialise(features.fit_transform(holed, features.EncoderSpec(missing="impute")), "holed-features")


@query
def g8_transform_missing(spark, folder):
    return _dense_rows(_holed_features(spark, folder))


@query
def g9_transform_subset(spark, folder):
    """Only tracks played on the radio, encoded as the whole catalogue was."""
    content = _content(spark, folder)
    encoder = features.fit_encoder(content)
    subset = interactions.tracks_with_history(content, t.radio_history(spark, folder))
    return _dense_rows(features.transform(subset, encoder))


@query
def g10_feature_names(spark, folder):
    content = clean.content_columns(t.tracks(spark, folder))
    return features.feature_names(content, features.fit_encoder(content))


@query
def g11_tag_tokens(spark, folder):
    return profile.tag_tokens(t.tracks(spark, folder).select("tags")).groupBy("tag").agg(F.count("*").alias("n"))


# ---- similarity and recommendation ---------------------------------------------------------------


def _embedding_features(spark: SparkSession, folder: str) -> DataFrame:
    return t.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("track_id"),
        F.col("embedding").cast("array<double>").alias("dense"),
        F.array().cast("array<string>").alias("cats"),
    )


@query
def h1_embedding_cosine(spark, folder):
    vectors = _embedding_features(spark, folder)
    return _lists(
        pruned.pruned_top_k(similarity.as_items(vectors), similarity.as_seeds(vectors), 10)
    )


@query
def h1_pruned_search(spark, folder):
    """The same lists by blocks of like items, without the blocks that cannot hold a nearer one."""
    return _lists(_pruned(spark, folder).lists)


@query
def h1_visited_blocks(spark, folder):
    """How many pairs of a vector and a block the search visited, of all."""
    return _pruned(spark, folder).visits.agg(
        F.count("*").alias("seeds"), F.sum("visited").alias("visited"), F.sum("blocks").alias("pairs")
    )


def _pruned(spark, folder):
    vectors = materialise(_embedding_features(spark, folder), "vectors")
    return pruned.search(similarity.as_items(vectors), similarity.as_seeds(vectors), 10, pivots=64)


@query
def h1_label_centre_cosine(spark, folder):
    """Cosine of every embedding to the mean embedding of its label, by column expressions."""
    vectors = t.table(spark, folder, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    )
    centres = (
        vectors.select("label", F.posexplode("v").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg("x").alias("x"))
        .groupBy("label")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("centre"))
    )
    joined = vectors.join(centres, "label")
    return joined.select(
        "vec_id",
        F.round(cosine(F.col("v"), F.col("centre")), 6).alias("score"),
        F.round(dot(F.col("v"), F.col("centre")), 6).alias("dot"),
        F.round(l2_norm(F.col("v")), 6).alias("norm"),
    )


@query
def h2_content(spark, folder):
    encoded = _features(spark, folder)
    return _lists(recommend.content_lists(encoded, encoded.select("track_id"), 10))


@query
def h2_content_named(spark, folder):
    found = recommend.content_recommendations(
        _named_seeds(spark, folder), t.tracks(spark, folder), _features(spark, folder), 5
    )
    return _rounded(found, "score")


@query
def h2_content_by_name(spark, folder):
    """Seeds given by name alone."""
    seeds = _named_seeds(spark, folder).drop("artist")
    found = recommend.content_recommendations(
        seeds, t.tracks(spark, folder), _features(spark, folder), 5, keys=("name",)
    )
    return _rounded(found, "score")


@query
def h3_collab_scores(spark, folder):
    """All collaborative scores, summed up per seed."""
    log = _log(spark, folder)
    scores = similarity.collab_scores(log, log.select("track_id"))
    return scores.groupBy("seed").agg(
        F.count("*").alias("n_items"),
        F.sum(F.floor(F.col("score") * 1e6 + 0.5)).alias("total_millionths"),
        F.round(F.max(F.when(F.col("item") != F.col("seed"), F.col("score"))), 6).alias("closest"),
    )


@query
def h4_collab(spark, folder):
    log = _log(spark, folder)
    return _lists(recommend.collab_lists(log, log.select("track_id"), 10))


@query
def h4_collab_filled(spark, folder):
    """A sparse log, so that lists are completed with tracks of score 0."""
    log = _radio_log(spark, folder)
    return _lists(recommend.collab_lists(log, log.select("track_id"), 100))


@query
def h4_collab_named(spark, folder):
    found = recommend.collab_recommendations(
        _named_seeds(spark, folder), t.tracks(spark, folder), _radio_log(spark, folder), 5
    )
    return _rounded(found, "score")


@query
def h4_collab_by_name(spark, folder):
    """Seeds given by name alone."""
    seeds = _named_seeds(spark, folder).drop("artist")
    found = recommend.collab_recommendations(
        seeds, t.tracks(spark, folder), _radio_log(spark, folder), 5, keys=("name",)
    )
    return _rounded(found, "score")


@query
def h5_normalised(spark, folder):
    """Min-max normalised collaborative scores, summed up per seed."""
    log = _log(spark, folder)
    seeds = log.select("track_id")
    n_items = log.agg(F.count_distinct("track_id")).scalar()
    ranges = similarity.collab_ranges(similarity.collab_scores(log, seeds), n_items)
    return similarity.collab_scores(log, seeds, ranges=ranges).groupBy("seed").agg(
        F.sum(F.floor(F.col("score") * 1e6 + 0.5)).alias("total_millionths"), F.round(F.max("score"), 6).alias("largest")
    )


@query
def h7_hybrid(spark, folder):
    encoded, log = _features(spark, folder), _log(spark, folder)
    return _lists(recommend.hybrid_lists(encoded, log, encoded.select("track_id"), 10, 0.5))


@query
def h7_hybrid_towards_content(spark, folder):
    """A weight that favours content."""
    encoded, log = _features(spark, folder), _log(spark, folder)
    return _lists(recommend.hybrid_lists(encoded, log, encoded.select("track_id"), 10, 0.75))


@query
def h7_hybrid_missing(spark, folder):
    """Numbers that the catalogue lacks are imputed, so that no score is NaN."""
    encoded, log = _holed_features(spark, folder), _log(spark, folder)
    return _lists(recommend.hybrid_lists(encoded, log, encoded.select("track_id"), 10, 0.5))


@query
def h7_hybrid_named(spark, folder):
    found = recommend.hybrid_recommendations(
        _named_seeds(spark, folder),
        t.tracks(spark, folder),
        _features(spark, folder),
        _log(spark, folder),
        5,
        diversity=5,
    )
    return _rounded(found, "score")


@query
def h8_weights(spark, folder):
    """Weights of a table of requests: every track asked for at the setting that its size gives."""
    asked = t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("track_id"), (F.col("p_size") % len(DIVERSITY_STEPS) + 1).alias("diversity")
    )
    return asked.select(
        "track_id",
        "diversity",
        F.round(diversity_weight_column(F.col("diversity")), 6).alias("weight_content"),
        (10 - F.col("diversity")).alias("personalised"),
    )


@query
def h9_routed(spark, folder):
    found = recommend.routed_recommendations(
        _named_seeds(spark, folder),
        t.tracks(spark, folder),
        _features(spark, folder),
        _radio_log(spark, folder),
        5,
        diversity=5,
    )
    return _rounded(found, "score")


@query
def h10_content_lists(spark, folder):
    encoded = _features(spark, folder)
    return _lists(recommend.content_lists(encoded, encoded.select("track_id")))


@query
def h11_collab_lists(spark, folder):
    log = _log(spark, folder)
    return _lists(recommend.collab_lists(log, log.select("track_id")))


@query
def h12_hybrid_lists(spark, folder):
    encoded, log = _features(spark, folder), _log(spark, folder)
    return _lists(recommend.hybrid_lists(encoded, log, encoded.select("track_id")))


@query
def h13_adhoc(spark, folder):
    """Songs that are not in the catalogue: each track re-made by an unknown artist three years later."""
    content = _content(spark, folder)
    encoder = features.fit_encoder(content)
    adhoc = content.withColumns({"artist": F.concat("artist", F.lit(" tribute")), "year": F.col("year") + 3})
    found = recommend.adhoc_recommendations(
        materialise(features.transform(content, encoder, all_known=True), "features"),
        materialise(features.transform(adhoc, encoder).withColumn("track_id", -1 - F.col("track_id")), "adhoc"),
    )
    return _lists(found)


# ---- evaluation ----------------------------------------------------------------------------------


def _evaluation(spark: SparkSession, folder: str) -> evaluate.Evaluation:
    return evaluate.run_evaluation(_features(spark, folder), _log(spark, folder))


def _collab_user_metrics(spark: SparkSession, folder: str) -> DataFrame:
    log = _log(spark, folder)
    _, test = evaluate.held_out(log)
    seeds = metrics.seed_per_user(test)
    lists = recommend.collab_lists(log, seeds.select(F.col("seed").alias("track_id")))
    return metrics.user_metrics(seeds, test, lists)


def _collab_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.mean_metrics(_collab_user_metrics(spark, folder), "collaborative")


def _one_metric(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(_collab_user_metrics(spark, folder).select("user_id", "k", name), name)

    return run


for _query, _metric in zip(("i1_precision", "i2_recall", "i3_ndcg", "i4_ap"), metrics.METRICS, strict=True):
    QUERIES[_query] = _one_metric(_metric)


@query
def i5_content(spark, folder):
    _, test = evaluate.held_out(t.interactions(spark, folder))
    seeds = metrics.seed_per_user(test)
    lists = recommend.content_lists(_features(spark, folder), seeds.select(F.col("seed").alias("track_id")))
    return _rounded(metrics.evaluate("content_based", lists, test, seeds), *metrics.METRICS)


@query
def i5_collab(spark, folder):
    return _rounded(_collab_report(spark, folder), *metrics.METRICS)


@query
def i5_hybrid(spark, folder):
    log = _log(spark, folder)
    _, test = evaluate.held_out(log)
    seeds = metrics.seed_per_user(test)
    lists = recommend.hybrid_lists(_features(spark, folder), log, seeds.select(F.col("seed").alias("track_id")))
    return _rounded(metrics.evaluate("hybrid", lists, test, seeds), *metrics.METRICS)


@query
def i6_seed_per_user(spark, folder):
    return metrics.seed_per_user(evaluate.held_out(t.interactions(spark, folder))[1])


@query
def i6_top_played_seed(spark, folder):
    return metrics.seed_per_user(evaluate.held_out(t.interactions(spark, folder))[1], "top_playcount")


@query
def i7_coded_rows(spark, folder):
    log = _log(spark, folder)
    coded = interactions.coded_interactions(log)
    return interactions.decode_tracks(coded, ranking.dictionary(log, "track_id", "track_idx"))


@query
def i8_run(spark, folder):
    return evaluate.describe_run(_log(spark, folder)).drop("k_values")


@query
def i8_sampled_on_train(spark, folder):
    """Fifty users, ranked without the plays that were held out."""
    found = evaluate.run_evaluation(_features(spark, folder), _log(spark, folder), sample=50, fit_on="train")
    return _rounded(found.metrics, *metrics.METRICS)


@query
def i9_flat_metrics(spark, folder):
    return _rounded(metrics.flat_metrics(_collab_report(spark, folder), "eval_"), "value")


# ---- search --------------------------------------------------------------------------------------


@query
def j1_song_index(spark, folder):
    return search.song_index(t.tracks(spark, folder))


@query
def j2_fuzzy_matches(spark, folder):
    found = search.search(t.searches(spark, folder), t.tracks(spark, folder))
    return _rounded(found, "ratio").select("query", "key", "ratio", "rank", "name", "artist", "display")


@query
def j2_fuzzy_levenshtein(spark, folder):
    names = t.tracks(spark, folder).select(F.col("name").alias("key"))
    return search.edit_matches(t.searches(spark, folder), names)


# ---- request metrics -----------------------------------------------------------------------------


@query
def k1_request_rate(spark, folder):
    return _ntz(_rounded(monitor.request_rate(t.requests(spark, folder)), "per_second"), "window_start", "window_end")


@query
def k2_latency_quantiles(spark, folder):
    found = monitor.latency_quantiles(t.requests(spark, folder))
    return _ntz(_rounded(found, "p50", "p95", "p99"), "window_start", "window_end")


@query
def k2_merged_sketches(spark, folder):
    """Exact quantiles, and whether those of the models' stored sketches, merged, keep to twice their error."""
    requests = t.requests(spark, folder)
    sketches = materialise(monitor.latency_sketches(requests, ["model_type"]), "latency-sketches")
    estimates = monitor.sketched_quantiles(sketches).select("window_start", "p50", "p95", "p99")
    timed = requests.filter((F.col("status") == monitor.SUCCESS) & F.col("latency").isNotNull())
    windowed = timed.select(F.window("ts", monitor.RANGE, monitor.STEP)["start"].alias("window_start"), "latency")
    error, n = 2 * monitor.sketch_error(), F.count("*").cast("double")
    values, kept = [], F.lit(True)
    for q in monitor.QUANTILES:
        name = f"p{round(q * 100)}"
        values.append(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY latency)").alias(name))
        kept &= F.count_if(F.col("latency") < F.col(name)) / n <= q + error
        kept &= F.count_if(F.col("latency") <= F.col(name)) / n >= q - error
    found = windowed.join(estimates, "window_start").groupBy("window_start")
    exact = found.agg(F.count("*").alias("n_requests"), *values, kept.alias("within_error"))
    return _ntz(_rounded(exact, "p50", "p95", "p99"), "window_start")


@query
def k3_in_flight(spark, folder):
    return _ntz(monitor.in_flight(t.requests(spark, folder)), "step_end")


@query
def k3_in_flight_stream(spark, folder):
    path = new_folder(spark, "flight")
    monitor.write_flight(t.request_stream(spark, folder), path, new_folder(spark, "progress")).awaitTermination()
    return _ntz(monitor.stored_in_flight(spark, path), "step_end")


@query
def k4_served(spark, folder):
    return _ntz(monitor.recommendations_served(t.requests(spark, folder)), "window_start", "window_end")


@query
def k5_error_ratio(spark, folder):
    return _ntz(_rounded(monitor.error_ratio(t.requests(spark, folder)), "error_ratio"), "window_start", "window_end")


def _streamed(spark: SparkSession, folder: str, metric: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a metric over the request stream to its end and read what it wrote."""
    out = metric(monitor.with_lateness(t.request_stream(spark, folder)))
    path = new_folder(spark, "windows")
    monitor.write_windows(out, path, new_folder(spark, "progress")).awaitTermination()
    closed = spark.read.schema(out.schema).parquet(path)
    return closed.unionByName(monitor.open_windows(t.requests(spark, folder), metric, closed))


@query
def k1_request_rate_stream(spark, folder):
    found = _streamed(spark, folder, monitor.request_rate)
    return _ntz(_rounded(found, "per_second"), "window_start", "window_end")


@query
def k2_latency_quantiles_stream(spark, folder):
    found = _streamed(spark, folder, monitor.latency_quantiles)
    return _ntz(_rounded(found, "p50", "p95", "p99"), "window_start", "window_end")


@query
def k4_served_stream(spark, folder):
    return _ntz(_streamed(spark, folder, monitor.recommendations_served), "window_start", "window_end")


@query
def k5_error_ratio_stream(spark, folder):
    found = _streamed(spark, folder, monitor.error_ratio)
    return _ntz(_rounded(found, "error_ratio"), "window_start", "window_end")


# ---- scalar functions ----------------------------------------------------------------------------


@query
def s1_title_case(spark, folder):
    return t.documents(spark, folder).select("doc_id", F.md5(title_case(F.col("text"))).alias("title_md5"))


@query
def s2_words(spark, folder):
    documents = t.documents(spark, folder)
    return documents.select("doc_id", F.size(words(F.col("text"), ASCII_WORD_PATTERN)).cast("long").alias("n_words"))
