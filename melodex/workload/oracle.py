"""Oracle SQL (DuckDB) of the queries in ``queries.py``; one entry per query unless SQL cannot say it."""

from __future__ import annotations

from melodex.workload import sql as s

# the tracks of either log, under the name that the named seeds look them up by
WHOLE_HISTORY = "heard AS (SELECT DISTINCT track_id FROM inter)"
RADIO_HISTORY = "heard AS (SELECT DISTINCT CAST(floor(value) AS BIGINT) AS track_id FROM events WHERE value IS NOT NULL)"

NAMED = """named AS (
  SELECT p_partkey AS seed_id, lower(p_name) AS name, 'brand#' || p_size AS artist FROM part),
by_name AS (SELECT name, artist, min(track_id) AS track_id, count(*) AS n_matches FROM tracks GROUP BY 1, 2),
listed AS (
  SELECT name, artist, min(track_id) AS listed_id, count(*) AS listed_matches FROM tracks
  WHERE track_id IN (SELECT track_id FROM heard) GROUP BY 1, 2),
resolved AS (
  SELECT seed_id, name, artist, by_name.track_id, coalesce(n_matches, 0) AS n_matches,
         track_id IN (SELECT track_id FROM heard) AS has_history, listed_id, listed_matches
  FROM named LEFT JOIN by_name USING (name, artist) LEFT JOIN listed USING (name, artist))"""

LISTS = "SELECT seed, item, round(score, 6) AS score, rank FROM lists"

RAW_COLUMNS = (
    "track_id, name, artist, spotify_preview_url, spotify_id, tags, genre, year, duration_ms, danceability, energy, key, "
    "loudness, mode, speechiness, acousticness, instrumentalness, liveness, valence, tempo, time_signature"
)
NUMERIC = (
    "track_id year duration_ms danceability energy key loudness mode speechiness acousticness instrumentalness liveness "
    "valence tempo time_signature"
).split()

DENSE = """SELECT track_id, generate_subscripts(dense, 1)::INT - 1 AS position, round(unnest(dense), 6) AS value,
       '=' || artist || '|=' || time_signature || '|=' || key AS cats FROM feat"""

REPORT = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(ndcg, 6) AS ndcg, round(ap, 6) AS ap"
COLLAB_REPORT = (s.SPLIT, s.collab("inter", "seeds"), s.filled("inter", "seeds"), s.top("filled", 100), s.evaluation())

CONTENT_REPORT = (s.FEATURES, s.SPLIT, "seed_feat AS (SELECT * FROM feat WHERE track_id IN (SELECT track_id FROM seeds))",
                  s.content("seed_feat"), s.top("content", 100), s.evaluation())
HYBRID_REPORT = (s.FEATURES, s.SPLIT, s.hybrid(0.5, "inter", "seeds"), s.top("hybrid", 100), s.evaluation())



def _windows(select: str, where: str = "true", group: str = "") -> str:
    keys = f"{group}, " if group else ""
    return s.query(
        s.REQUESTS,
        select=f"""SELECT window_start, window_start + INTERVAL 5 minutes AS window_end, {keys}{select}
FROM windowed WHERE {where} GROUP BY window_start{', ' + group if group else ''}""",
    )


def _quantiles() -> str:
    bounds = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
    counts = ", ".join(f"count(*) FILTER (latency <= {b}::DOUBLE) AS le_{i}" for i, b in enumerate(bounds))

    def value(q: float) -> str:
        cases = []
        for i, bound in enumerate(bounds):
            low, below = (bounds[i - 1], f"le_{i - 1}") if i else (0.0, "0")
            cases.append(
                f"WHEN le_{i} >= {q}::DOUBLE * n_requests THEN {low}::DOUBLE + {bound - low}::DOUBLE * "
                f"({q}::DOUBLE * n_requests - {below}) / nullif(le_{i} - {below}, 0)"
            )
        return f"round(CASE {' '.join(cases)} ELSE {bounds[-1]}::DOUBLE END, 6) AS p{round(q * 100)}"

    return s.query(
        s.REQUESTS,
        f"buckets AS (SELECT window_start, count(*) AS n_requests, {counts} FROM windowed WHERE status = 'success' AND latency IS NOT NULL GROUP BY 1)",
        select=f"""SELECT window_start, window_start + INTERVAL 5 minutes AS window_end, n_requests,
       {value(0.5)}, {value(0.95)}, {value(0.99)} FROM buckets""",
    )


def _flat() -> str:
    parts = [
        f"SELECT 'eval_collaborative_{m}_at_k' || k AS metric, round({m}, 6) AS value FROM report"
        for m in ("precision", "recall", "ndcg", "ap")
    ]
    return s.query(*COLLAB_REPORT, select=" UNION ALL ".join(parts))


def _per_user(metric: str) -> str:
    return s.query(*COLLAB_REPORT, select=f"SELECT user_id, k::INT AS k, round({metric}, 6) AS {metric} FROM per_user")


def _scaled(columns: tuple[str, ...], form: str) -> str:
    values = ", ".join(f"round({form.format(c=c)}, 6) AS {c}" for c in columns)
    return s.query(s.TRACKS, select=f"SELECT track_id, {values} FROM tracks")


def _cells(row: str, names: list[str]) -> str:
    """One row per column from a one-row aggregate."""
    return " UNION ALL ".join(row.format(c=c) for c in names)


_ARTIFACT_COUNTS = s.query(
    s.FEATURES,
    s.INTERACTIONS,
    select=" UNION ALL ".join(
        f"SELECT '{name}' AS artifact, ({count})::BIGINT AS n_rows"
        for name, count in {
            "tracks": "SELECT count(*) FROM tracks",
            "features": "SELECT count(*) FROM feat",
            "tracks_with_history": "SELECT count(*) FROM tracks WHERE track_id IN (SELECT track_id FROM inter)",
            "interactions": "SELECT count(*) FROM inter",
            "encoder_frequency": "SELECT count(DISTINCT year) FROM tracks",
            "encoder_categories": "SELECT count(DISTINCT artist) + count(DISTINCT time_signature) + count(DISTINCT key) FROM tracks",
            "encoder_vocabulary": "SELECT count(*) FROM vocab",
            "encoder_standard": "SELECT 3",
            "encoder_minmax": "SELECT 7",
        }.items()
    ),
)

_CLEANED = s.query(s.TRACKS, select=f"SELECT {s.TRACK_COLUMNS} FROM tracks")


def _report_union(split: str, log: str) -> str:
    return s.query(
        s.FEATURES,
        split,
        s.hybrid(0.5, log, "seeds"),
        s.filled(log, "seeds"),
        "seed_feat AS (SELECT * FROM feat WHERE track_id IN (SELECT track_id FROM seeds))",
        s.content("seed_feat").replace("content AS", "all_content AS"),
        s.top("all_content", 100, "lists_a"),
        s.top("filled", 100, "lists_b"),
        s.top("hybrid", 100, "lists_c"),
        s.evaluation("lists_a", suffix="_a"),
        s.evaluation("lists_b", suffix="_b"),
        s.evaluation("lists_c", suffix="_c"),
        select=" UNION ALL ".join(
            f"SELECT '{model}' AS model, k::INT AS k, {REPORT} FROM report_{x}"
            for model, x in (("content_based", "a"), ("collaborative", "b"), ("hybrid", "c"))
        ),
    )


_REPORT_UNION = _report_union(s.SPLIT, "inter")

RUN = """SELECT (SELECT count(DISTINCT user_id) FROM inter) AS n_users_total, (SELECT count(DISTINCT track_id) FROM inter) AS n_items,
       count(*) FILTER (NOT is_test) AS n_train_interactions, count(*) FILTER (is_test) AS n_test_interactions,
       (SELECT count(*) FROM user_seeds) AS sampled_users"""

_NAMES = s.query(
    s.FEATURES,
    "names AS (" + " UNION ALL ".join(
        [
            "SELECT 0 AS block, 0 AS code, 'frequency_encode__year' AS feature",
            "SELECT DISTINCT 1, dense_rank() OVER (ORDER BY artist), 'ohe__artist_' || artist FROM tracks",
            "SELECT DISTINCT 2, dense_rank() OVER (ORDER BY time_signature), 'ohe__time_signature_' || time_signature FROM tracks",
            "SELECT DISTINCT 3, dense_rank() OVER (ORDER BY key), 'ohe__key_' || key FROM tracks",
            "SELECT 4, idx, 'tfidf__' || term FROM vocab",
        ]
        + [f"SELECT 5, {i}, 'standard_scale__{c}'" for i, c in enumerate(s.STANDARD)]
        + [f"SELECT 6, {i}, 'min_max_scale__{c}'" for i, c in enumerate(s.MINMAX)]
        + ["SELECT 7, 0, 'remainder__mode'"]
    ) + ")",
    select="SELECT row_number() OVER (ORDER BY block, code) - 1 AS position, feature FROM names",
)

ORACLE: dict[str, str] = {
    # sources and sinks
    "a1_csv_catalogue": s.query(s.LISTINGS, select=f"SELECT {RAW_COLUMNS} FROM listings"),
    "a2_csv_history": """SELECT l_partkey AS track_id, o_custkey AS user_id, l_quantity AS playcount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "a3_pruned_scan": "SELECT p_partkey, p_name, p_brand FROM part",
    "a4_write_cleaned": _CLEANED,
    "a4_write_cleaned_json": _CLEANED,
    "a4_write_cleaned_orc": _CLEANED,
    "a5_feature_matrix": s.query(
        s.FEATURES,
        select="SELECT track_id, generate_subscripts(dense, 1)::INT - 1 AS position, round(unnest(dense), 6) AS value FROM feat",
    ),
    "a6_stored_interactions": s.query(s.INTERACTIONS, select="SELECT * FROM inter"),
    "a7_stored_encoder": s.query(s.FEATURES, select=DENSE),
    "a8_load_artifacts": _ARTIFACT_COUNTS,
    "a9_report": s.query(*COLLAB_REPORT, select=f"SELECT 'collaborative' AS model, k::INT AS k, {REPORT} FROM report"),
    "a9_report_run": s.query(s.SPLIT, select=f"{RUN}, '5,10,20' AS k_values FROM marked"),
    # cleaning
    "b1_dedup_first": s.query(
        s.LISTINGS,
        select=f"""SELECT track_id, {s.ORDER.replace(', l_shipdate', '')} FROM listings
QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY {s.ORDER}) = 1""",
    ),
    "b1_dedup_three_keys": s.query(
        s.LISTINGS,
        select=f"""SELECT spotify_id, year, duration_ms, track_id, l_orderkey, l_linenumber FROM listings
QUALIFY row_number() OVER (PARTITION BY spotify_id, year, duration_ms ORDER BY {s.ORDER}, track_id) = 1""",
    ),
    "b2_drop_columns": s.query(s.LISTINGS, select="SELECT track_id, name, artist, tags, year, duration_ms FROM listings"),
    "b3_fill_missing": s.query(s.LISTINGS, select="SELECT track_id, coalesce(tags, 'no_tags') AS tags FROM listings"),
    "b4_lower_columns": s.query(
        s.LISTINGS,
        select="SELECT track_id, lower(name) AS name, lower(artist) AS artist, lower(tags) AS tags FROM listings",
    ),
    "b5_clean_data": _CLEANED,
    "b6_content_columns": s.query(
        s.TRACKS, select=f"SELECT {s.TRACK_COLUMNS.replace(' name,', '').replace(' spotify_preview_url,', '')} FROM tracks"
    ),
    "b7_cast_playcount": """SELECT l_partkey AS track_id, o_custkey AS user_id, CAST(CAST(l_quantity AS INT) AS DOUBLE) AS playcount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "b8_seed_lookup": s.query(
        s.TRACKS,
        RADIO_HISTORY,
        NAMED,
        select="""SELECT seed_id, track_id, n_matches,
       CASE WHEN n_matches = 0 THEN 'not_found' ELSE 'ok' END AS content_status,
       CASE WHEN n_matches = 0 THEN 'not_found' WHEN n_matches > 1 THEN 'ambiguous'
            WHEN NOT has_history THEN 'no_history' ELSE 'ok' END AS collab_status FROM resolved""",
    ),
    "b8_seed_lookup_by_name": s.query(
        s.TRACKS,
        RADIO_HISTORY,
        "asked AS (SELECT p_partkey AS seed_id, lower(CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_name || ' (live)' END) AS name FROM part)",
        "by_name AS (SELECT name, min(track_id) AS track_id, count(*) AS n_matches FROM tracks GROUP BY 1)",
        """resolved AS (
  SELECT seed_id, by_name.track_id, coalesce(n_matches, 0) AS n_matches, by_name.track_id IN (SELECT track_id FROM heard) AS has_history
  FROM asked LEFT JOIN by_name USING (name))""",
        select="""SELECT seed_id, track_id, n_matches,
       CASE WHEN n_matches = 0 THEN 'not_found' ELSE 'ok' END AS content_status,
       CASE WHEN n_matches = 0 THEN 'not_found' WHEN n_matches > 1 THEN 'ambiguous'
            WHEN NOT has_history THEN 'no_history' ELSE 'ok' END AS collab_status FROM resolved""",
    ),
    "b9_known_names": s.query(
        s.TRACKS, RADIO_HISTORY, NAMED, select="SELECT seed_id, name, artist FROM resolved WHERE n_matches > 0"
    ),
    "b10_route": s.query(
        s.TRACKS,
        RADIO_HISTORY,
        NAMED,
        select="""SELECT seed_id, coalesce(listed_id, track_id) AS track_id,
       CASE WHEN listed_id IS NOT NULL THEN 'hybrid' WHEN n_matches > 0 THEN 'content_based' END AS model,
       CASE WHEN n_matches = 0 THEN 'not_found' WHEN listed_matches > 1 THEN 'ambiguous' ELSE 'ok' END AS status
FROM resolved""",
    ),
    "b11_filter_artist": s.query(s.TRACKS, select="SELECT track_id, name, artist FROM tracks WHERE artist = 'brand#7'"),
    # joins
    "c1_tracks_with_history": s.query(
        s.TRACKS,
        RADIO_HISTORY,
        select="SELECT track_id, name, artist, tags, year FROM tracks WHERE track_id IN (SELECT track_id FROM heard)",
    ),
    "c2_attach_catalogue": s.query(
        s.TRACKS,
        s.INTERACTIONS,
        s.collab(),
        s.filled(),
        s.top("filled", 5),
        select="""SELECT seed, item, round(score, 6) AS score, rank, name, artist, spotify_preview_url
FROM lists JOIN tracks ON item = track_id""",
    ),
    "c3_aligned_scores": s.query(
        s.FEATURES,
        s.INTERACTIONS,
        s.content(),
        s.collab(),
        s.filled(),
        s.top("content", 20, "by_content"),
        s.top("filled", 20, "by_collab"),
        select="""SELECT seed, item, round(a.score, 6) AS content_score, round(b.score, 6) AS collab_score
FROM by_content a JOIN by_collab b USING (seed, item)""",
    ),
    "c4_dictionary_join": s.query(
        s.INTERACTIONS,
        select="SELECT track_id, sum(playcount) AS playcount, count(*) AS n_users FROM inter GROUP BY 1",
    ),
    "c5_sampled_users": s.query(
        s.INTERACTIONS,
        select="""SELECT * FROM inter WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM inter) ORDER BY md5(user_id || ':42'), user_id LIMIT 100)""",
    ),
    "c6_shared_listeners": s.query(
        s.INTERACTIONS,
        s.collab(),
        select="SELECT seed, count(*) AS n_items, sum(dot) AS total, max(dot) AS largest FROM dots GROUP BY 1",
    ),
    "c7_content_ranges": s.query(
        s.FEATURES,
        s.content(),
        select="SELECT seed, round(min(score), 6) AS low, round(max(score), 6) AS high FROM content GROUP BY 1",
    ),
    "c8_tracks_without_history": s.query(
        s.TRACKS,
        RADIO_HISTORY,
        select="SELECT track_id, name, artist, tags, year FROM tracks WHERE track_id NOT IN (SELECT track_id FROM heard)",
    ),
    # aggregates
    "d1_interactions": s.query(s.INTERACTIONS, select="SELECT * FROM inter"),
    "d2_matrix": s.query(
        s.INTERACTIONS,
        select="""SELECT dense_rank() OVER (ORDER BY track_id) - 1 AS track_idx, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx,
       playcount FROM inter""",
    ),
    "d3_distinct_counts": s.query(
        s.LISTINGS,
        select=_cells(
            'SELECT \'{c}\' AS "column", count(DISTINCT {c}) AS n_distinct FROM listings',
            ["track_id", "name", "artist", "year", "tags"],
        ),
    ),
    "d3_distinct_tracks": s.query(s.INTERACTIONS, select="SELECT DISTINCT track_id FROM inter"),
    "d4_dictionary_encode": s.query(
        s.LISTINGS, select="SELECT name, row_number() OVER (ORDER BY name) - 1 AS code FROM (SELECT DISTINCT name FROM listings)"
    ),
    "d5_items_per_user": s.query(s.INTERACTIONS, select="SELECT user_id, track_id FROM inter"),
    "d6_collab_ranges": s.query(
        s.INTERACTIONS,
        s.collab(),
        s.filled(),
        select="SELECT seed, round(min(score), 6) AS low, round(max(score), 6) AS high FROM filled GROUP BY 1",
    ),
    "d7_mean_metrics": s.query(*COLLAB_REPORT, select=f"SELECT 'collaborative' AS model, k::INT AS k, {REPORT} FROM report"),
    "d8_tag_counts": s.query(
        s.LISTINGS,
        select="SELECT trim(t) AS tag, count(*) AS n FROM (SELECT unnest(string_split(lower(tags), ',')) AS t FROM listings) GROUP BY 1",
    ),
    "d9_tag_counts_min": s.query(
        s.LISTINGS,
        select="""SELECT trim(t) AS tag, count(*) AS n FROM (SELECT unnest(string_split(lower(tags), ',')) AS t FROM listings)
GROUP BY 1 HAVING count(*) >= 1000""",
    ),
    "d10_numeric_ranges": s.query(
        s.LISTINGS,
        select=_cells('SELECT \'{c}\' AS "column", min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM listings', NUMERIC),
    ),
    "d11_null_counts": s.query(
        s.LISTINGS,
        select=_cells(
            'SELECT \'{c}\' AS "column", count(*) - count({c}) AS nulls FROM listings', RAW_COLUMNS.split(", ")
        ),
    ),
    "d12_null_ratio_top2": s.query(
        s.LISTINGS,
        select="SELECT * FROM ("
        + _cells(
            'SELECT \'{c}\' AS "column", round(avg(({c} IS NULL)::INT) * 100, 6) AS null_percent FROM listings',
            RAW_COLUMNS.split(", "),
        )
        + ') ORDER BY null_percent DESC, "column" LIMIT 2',
    ),
    "d13_duplicate_count": s.query(
        s.LISTINGS,
        select="SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM listings GROUP BY spotify_id, year, tags)",
    ),
    "d14_shape": s.query(
        s.LISTINGS,
        select=" UNION ALL ".join(
            f"SELECT {i}::INT AS position, '{c}' AS \"column\", count(*) AS n_rows, {len(RAW_COLUMNS.split(', '))}::BIGINT AS n_columns FROM listings"
            for i, c in enumerate(RAW_COLUMNS.split(", "))
        ),
    ),
    "d15_clean_stats": s.query(
        s.TRACKS,
        select="""SELECT raw_rows, cleaned_rows, raw_rows - cleaned_rows AS rows_dropped,
       round((raw_rows - cleaned_rows)::DOUBLE / raw_rows, 6) AS drop_rate
FROM (SELECT (SELECT count(*) FROM listings) AS raw_rows, (SELECT count(*) FROM tracks) AS cleaned_rows)""",
    ),
    "d16_matrix_stats": s.query(
        s.INTERACTIONS,
        select="""SELECT n_tracks, n_users, nnz, round(1 - nnz / (n_tracks::DOUBLE * n_users), 6) AS sparsity,
       round(nnz::DOUBLE / n_users, 6) AS mean_per_user, round(nnz::DOUBLE / n_tracks, 6) AS mean_per_track
FROM (SELECT count(DISTINCT track_id) AS n_tracks, count(DISTINCT user_id) AS n_users, count(*) AS nnz FROM inter)""",
    ),
    "d17_feature_stats": s.query(
        s.FEATURES,
        select="""SELECT n_samples, nnz, n_features, round(1 - nnz / (n_samples::DOUBLE * n_features), 6) AS sparsity FROM (
  SELECT count(*) AS n_samples, sum(len(list_filter(dense, lambda x: x <> 0)) + 3)::BIGINT AS nnz,
         max(len(dense)) + count(DISTINCT artist) + count(DISTINCT time_signature) + count(DISTINCT key) AS n_features
  FROM feat)""",
    ),
    # windows
    "e1_rank_in_user": s.query(s.SPLIT, select="SELECT track_id, user_id, rank FROM ranked"),
    "e2_group_size": s.query(s.SPLIT, select="SELECT track_id, user_id, group_size FROM ranked"),
    "e3_split_train": s.query(s.SPLIT, select="SELECT track_id, user_id, playcount FROM marked WHERE NOT is_test"),
    "e3_split_test": s.query(s.SPLIT, select="SELECT track_id, user_id, playcount FROM test"),
    "e4_topk_per_user": s.query(
        s.INTERACTIONS,
        select="""SELECT user_id, track_id, (row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC, track_id))::INT AS rank
FROM inter QUALIFY rank <= 5""",
    ),
    "e5_hits": s.query(*COLLAB_REPORT, select="SELECT user_id, item, rank, hit_no::INT AS hit_no FROM hits"),
    # sorts, limits, sets
    "f1_sorted_tracks": s.query(
        s.TRACKS,
        s.INTERACTIONS,
        select="""SELECT track_id, name, artist FROM tracks WHERE track_id IN (SELECT track_id FROM inter)
ORDER BY track_id""",
    ),
    "f2_one_seed": s.query(
        s.FEATURES,
        "song AS (SELECT name, artist FROM tracks ORDER BY track_id LIMIT 1)",
        "seed AS (SELECT min(track_id) AS track_id FROM tracks JOIN song USING (name, artist))",
        "seed_feat AS (SELECT * FROM feat WHERE track_id IN (SELECT track_id FROM seed))",
        s.content("seed_feat"),
        s.top("content", 10),
        select="""SELECT seed, item, round(score, 6) AS score, rank, name, artist, spotify_preview_url
FROM lists JOIN tracks ON item = track_id""",
    ),
    "f3_sorted_interactions": s.query(s.INTERACTIONS, select="SELECT * FROM inter ORDER BY user_id, playcount DESC, track_id"),
    "f4_head": s.query(s.TRACKS, select="SELECT track_id, name, artist FROM tracks ORDER BY track_id LIMIT 5"),
    "f5_hit_sets": s.query(
        *COLLAB_REPORT, select="SELECT user_id, count(*) AS n_hits FROM hits WHERE rank <= 20 GROUP BY 1"
    ),
    "f6_split_check": s.query(
        s.SPLIT,
        select="""SELECT count(*) AS n_whole, count(*) FILTER (NOT is_test) AS n_first, count(*) FILTER (is_test) AS n_second,
       0::BIGINT AS n_overlap, 0::BIGINT AS n_uncovered FROM marked""",
    ),
    "f7_union_models": _REPORT_UNION,
    "f8_hash_sample": s.query(
        s.INTERACTIONS,
        select="SELECT user_id FROM (SELECT DISTINCT user_id FROM inter) ORDER BY md5(user_id || ':42'), user_id LIMIT 50",
    ),
    # features
    "g1_frequency": s.query(
        s.TRACKS,
        select="""SELECT 'year' AS "column", '=' || year AS value, round(count(*)::DOUBLE / (SELECT count(*) FROM tracks), 6) AS frequency
FROM tracks GROUP BY year""",
    ),
    "g2_onehot_categories": s.query(
        s.TRACKS,
        select=_cells(
            'SELECT DISTINCT \'{c}\' AS "column", \'=\' || {c} AS value FROM tracks', ["artist", "time_signature", "key"]
        ),
    ),
    "g3_tfidf_vocabulary": s.query(
        s.vocabulary("documents", "doc_id", "text"),
        select="SELECT term, idx::INT AS idx, corpus_tf, df, round(idf, 6) AS idf FROM vocab",
    ),
    "g3_tfidf_weights": s.query(
        s.vocabulary("documents", "doc_id", "text"),
        "raw AS (SELECT doc_id, term, tf * idf AS raw FROM tf JOIN vocab USING (term))",
        select="SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw",
    ),
    "g3_tfidf_weights_fitted": s.query(
        s.vocabulary("documents", "doc_id", "text"),
        "raw AS (SELECT doc_id, term, tf * idf AS raw FROM tf JOIN vocab USING (term))",
        select="SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw",
    ),
    "g4_standard_scale": _scaled(s.STANDARD, "({c} - avg({c}::DOUBLE) OVER ()) / stddev_pop({c}::DOUBLE) OVER ()"),
    "g5_minmax_scale": _scaled(s.MINMAX, "({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"),
    "g6_passthrough": s.query(s.TRACKS, select="SELECT track_id, mode::DOUBLE AS mode FROM tracks"),
    "g7_fit_scales": s.query(
        s.TRACKS,
        select=_cells(
            'SELECT \'{c}\' AS "column", round(avg({c}::DOUBLE), 6) AS first, round(stddev_pop({c}::DOUBLE), 6) AS second FROM tracks',
            list(s.STANDARD),
        )
        + " UNION ALL "
        + _cells(
            'SELECT \'{c}\' AS "column", round(min({c}), 6) AS first, round(max({c}), 6) AS second FROM tracks', list(s.MINMAX)
        ),
    ),
    "g8_transform": s.query(s.FEATURES, select=DENSE),
    "g8_transform_raw_year": s.query(s.RAW_YEAR_FEATURES, select=DENSE),
    "g8_transform_missing": s.query(s.HOLED_FEATURES, select=DENSE),
    "g9_transform_subset": s.query(
        s.FEATURES,
        RADIO_HISTORY,
        select=f"SELECT * FROM ({DENSE}) WHERE track_id IN (SELECT track_id FROM heard)",
    ),
    "g10_feature_names": _NAMES,
    "g11_tag_tokens": s.query(
        s.TRACKS,
        select="SELECT trim(t) AS tag, count(*) AS n FROM (SELECT unnest(string_split(tags, ',')) AS t FROM tracks) GROUP BY 1",
    ),
    # similarity and recommendation
    "h1_embedding_cosine": s.query(
        """vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS seed, b.vec_id AS item, list_cosine_similarity(a.v, b.v) AS score FROM vectors a CROSS JOIN vectors b)""",
        s.top("pairs", 10),
        select=LISTS,
    ),
    "h1_label_centre_cosine": s.query(
        """vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
parts AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM vectors),
centres AS (SELECT label, list(x ORDER BY i) AS centre FROM (SELECT label, i, avg(x) AS x FROM parts GROUP BY 1, 2) GROUP BY 1)""",
        select="""SELECT vec_id, round(list_cosine_similarity(v, centre), 6) AS score, round(list_dot_product(v, centre), 6) AS dot,
       round(sqrt(list_dot_product(v, v)), 6) AS norm FROM vectors JOIN centres USING (label)""",
    ),
    "h2_content": s.query(s.FEATURES, s.content(), s.top("content", 10), select=LISTS),
    "h2_content_named": s.query(
        s.FEATURES,
        RADIO_HISTORY,
        NAMED,
        "seed_feat AS (SELECT * FROM feat WHERE track_id IN (SELECT track_id FROM resolved))",
        s.content("seed_feat"),
        s.top("content", 5),
        select="""SELECT seed_id, CASE WHEN n_matches = 0 THEN 'not_found' ELSE 'ok' END AS status, track_id AS seed, item,
       round(score, 6) AS score, rank FROM resolved LEFT JOIN lists ON seed = track_id""",
    ),
    "h3_collab_scores": s.query(
        s.INTERACTIONS,
        s.collab(),
        select="""SELECT seed, count(*) AS n_items, sum(floor(score * 1e6 + 0.5))::BIGINT AS total_millionths,
       round(max(CASE WHEN item <> seed THEN score END), 6) AS closest FROM collab GROUP BY 1""",
    ),
    "h4_collab": s.query(s.INTERACTIONS, s.collab(), s.filled(), s.top("filled", 10), select=LISTS),
    "h4_collab_filled": s.query(
        s.RADIO_INTERACTIONS, s.collab("radio"), s.filled("radio"), s.top("filled", 100), select=LISTS
    ),
    "h4_collab_named": s.query(
        s.TRACKS,
        RADIO_HISTORY,
        NAMED,
        s.RADIO_INTERACTIONS,
        s.collab("radio"),
        s.filled("radio"),
        s.top("filled", 5),
        """named_status AS (
  SELECT seed_id, track_id, CASE WHEN n_matches = 0 THEN 'not_found' WHEN n_matches > 1 THEN 'ambiguous'
         WHEN NOT has_history THEN 'no_history' ELSE 'ok' END AS status FROM resolved)""",
        select="""SELECT seed_id, status, CASE WHEN status = 'ok' THEN track_id END AS seed, item, round(score, 6) AS score, rank
FROM named_status LEFT JOIN lists ON seed = track_id AND status = 'ok'""",
    ),
    "h5_normalised": s.query(
        s.INTERACTIONS,
        s.collab(),
        s.filled(),
        "ranges AS (SELECT seed, min(score) AS low, max(score) AS high FROM filled GROUP BY 1)",
        "normal AS (SELECT seed, (score - low) / (high - low + 1e-8) AS x FROM collab JOIN ranges USING (seed))",
        select="""SELECT seed, sum(floor(x * 1e6 + 0.5))::BIGINT AS total_millionths, round(max(x), 6) AS largest
FROM normal GROUP BY 1""",
    ),
    "h7_hybrid": s.query(s.FEATURES, s.INTERACTIONS, s.hybrid(0.5), s.top("hybrid", 10), select=LISTS),
    "h7_hybrid_towards_content": s.query(
        s.FEATURES, s.INTERACTIONS, s.hybrid(0.75), s.top("hybrid", 10), select=LISTS
    ),
    "h7_hybrid_missing": s.query(
        s.HOLED_FEATURES, s.INTERACTIONS, s.hybrid(0.5), s.top("hybrid", 10), select=LISTS
    ),
    "h7_hybrid_named": s.query(
        s.FEATURES,
        s.INTERACTIONS,
        WHOLE_HISTORY,
        NAMED,
        s.hybrid(0.5),
        s.top("hybrid", 5),
        """named_status AS (
  SELECT seed_id, listed_id, CASE WHEN listed_id IS NULL THEN 'not_found' WHEN listed_matches > 1 THEN 'ambiguous' ELSE 'ok' END AS status
  FROM resolved)""",
        select="""SELECT seed_id, status, CASE WHEN status = 'ok' THEN listed_id END AS seed, item, round(score, 6) AS score, rank
FROM named_status LEFT JOIN lists ON seed = listed_id AND status = 'ok'""",
    ),
    "h8_weights": """SELECT p_partkey AS track_id, p_size % 9 + 1 AS diversity, round(1 - (p_size % 9 + 1) / 10e0, 6) AS weight_content,
       10 - (p_size % 9 + 1) AS personalised FROM part""",
    "h9_routed": s.query(
        s.FEATURES,
        RADIO_HISTORY,
        NAMED,
        s.RADIO_INTERACTIONS,
        s.hybrid(0.5, "radio"),
        s.top("hybrid", 5, "hybrid_lists"),
        s.content().replace("content AS", "all_content AS"),
        s.top("all_content", 5, "content_lists"),
        """routed AS (
  SELECT seed_id, coalesce(listed_id, track_id) AS track_id,
         CASE WHEN listed_id IS NOT NULL THEN 'hybrid' WHEN n_matches > 0 THEN 'content_based' END AS model,
         CASE WHEN n_matches = 0 THEN 'not_found' WHEN listed_matches > 1 THEN 'ambiguous' ELSE 'ok' END AS status FROM resolved)""",
        "lists AS (SELECT *, 'hybrid' AS model FROM hybrid_lists UNION ALL SELECT *, 'content_based' FROM content_lists)",
        select="""SELECT seed_id, status, routed.model, CASE WHEN status = 'ok' THEN track_id END AS seed, item,
       round(score, 6) AS score, rank
FROM routed LEFT JOIN lists ON seed = track_id AND status = 'ok' AND lists.model = routed.model""",
    ),
    "h10_content_lists": s.query(s.FEATURES, s.content(), s.top("content", 100), select=LISTS),
    "h11_collab_lists": s.query(s.INTERACTIONS, s.collab(), s.filled(), s.top("filled", 100), select=LISTS),
    "h12_hybrid_lists": s.query(s.FEATURES, s.INTERACTIONS, s.hybrid(0.5), s.top("hybrid", 100), select=LISTS),
    "h13_adhoc": s.query(
        s.FEATURES,
        """freqs AS (SELECT year, count(*)::DOUBLE / (SELECT count(*) FROM tracks) AS freq FROM tracks GROUP BY 1),
remade AS (
  SELECT -1 - track_id AS track_id, feat.time_signature, feat.key,
         list_concat([coalesce(freq, 0)], dense[2:]) AS dense
  FROM feat JOIN tracks USING (track_id) LEFT JOIN freqs ON freqs.year = tracks.year + 3),
content AS (
  SELECT a.track_id AS seed, b.track_id AS item,
         (list_dot_product(a.dense, b.dense) + (a.time_signature = b.time_signature)::INT + (a.key = b.key)::INT)
         / (sqrt(list_dot_product(a.dense, a.dense) + 2) * b.norm) AS score
  FROM remade a CROSS JOIN feat b)""",
        s.top("content", 10),
        select=LISTS,
    ),
    # evaluation
    "i1_precision": _per_user("precision"),
    "i2_recall": _per_user("recall"),
    "i3_ndcg": _per_user("ndcg"),
    "i4_ap": _per_user("ap"),
    "i5_content": s.query(*CONTENT_REPORT, select=f"SELECT 'content_based' AS model, k::INT AS k, {REPORT} FROM report"),
    "i5_collab": s.query(*COLLAB_REPORT, select=f"SELECT 'collaborative' AS model, k::INT AS k, {REPORT} FROM report"),
    "i5_hybrid": s.query(*HYBRID_REPORT, select=f"SELECT 'hybrid' AS model, k::INT AS k, {REPORT} FROM report"),
    "i6_seed_per_user": s.query(s.SPLIT, select="SELECT user_id, seed FROM user_seeds"),
    "i6_top_played_seed": s.query(
        s.SPLIT,
        select="""SELECT user_id, track_id AS seed FROM test
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC, track_id) = 1""",
    ),
    "i7_coded_rows": s.query(
        s.INTERACTIONS,
        select="""SELECT dense_rank() OVER (ORDER BY track_id) - 1 AS track_idx, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx,
       playcount, track_id FROM inter""",
    ),
    "i8_run": s.query(s.SPLIT, select=f"{RUN} FROM marked"),
    "i8_sampled_on_train": _report_union(s.split(50), "train"),
    "i9_flat_metrics": _flat(),
    # search
    "j1_song_index": s.query(
        s.TRACKS,
        select="""SELECT lower(display) AS key, name, artist, display FROM (SELECT *, name || ' — ' || artist AS display FROM tracks)
QUALIFY row_number() OVER (PARTITION BY lower(display) ORDER BY track_id) = 1""",
    ),
    "j2_fuzzy_matches": s.query(
        s.TRACKS,
        """keys AS (SELECT lower(display) AS key, name, artist, display FROM (SELECT *, name || ' — ' || artist AS display FROM tracks)
QUALIFY row_number() OVER (PARTITION BY lower(display) ORDER BY track_id) = 1)""",
        "asked AS (SELECT DISTINCT lower(trim(p_name)) AS query FROM part)",
        """compared AS (
  SELECT query, keys.*, list_distinct([substr('  ' || query || ' ', i, 3) FOR i IN range(1, length(query) + 2)]) AS q,
         list_distinct([substr('  ' || key || ' ', i, 3) FOR i IN range(1, length(key) + 2)]) AS k
  FROM asked CROSS JOIN keys)""",
        """rated AS (SELECT *, 2e0 * len(list_intersect(q, k)) / (len(q) + len(k)) AS ratio FROM compared)""",
        select="""SELECT query, key, round(ratio, 6) AS ratio, (row_number() OVER (PARTITION BY query ORDER BY ratio DESC, key DESC))::INT AS rank,
       name, artist, display FROM rated WHERE ratio >= 0.4 QUALIFY rank <= 10""",
    ),
    # request metrics
    "k1_request_rate": _windows(
        "count(*) AS n_requests, round(count(*) / 300e0, 6) AS per_second", group="model_type, status"
    ),
    "k2_latency_quantiles": _quantiles(),
    "k3_in_flight": s.query(
        s.REQUESTS,
        """marks AS (
  SELECT ts AS mark, 1 AS delta FROM requests
  UNION ALL SELECT make_timestamp(epoch_us(ts) + CAST(round(latency * 1000000) AS BIGINT)), -1 FROM requests),
steps AS (
  SELECT time_bucket(INTERVAL 30 seconds, mark, TIMESTAMP '2024-01-01') + INTERVAL 30 seconds AS step_end, sum(delta) AS delta
  FROM marks GROUP BY 1)""",
        select="SELECT step_end, (sum(delta) OVER (ORDER BY step_end))::BIGINT AS in_flight FROM steps",
    ),
    "k4_served": _windows("coalesce(sum(n_recs), 0)::BIGINT AS n_served", group="model_type"),
    "k5_error_ratio": _windows(
        """count(*) FILTER (status = 'error') AS n_errors, count(*) AS n_requests,
       round(count(*) FILTER (status = 'error') / count(*)::DOUBLE, 6) AS error_ratio""",
        group="model_type",
    ),
    "k1_request_rate_stream": _windows(
        "count(*) AS n_requests, round(count(*) / 300e0, 6) AS per_second", group="model_type, status"
    ),
    "k2_latency_quantiles_stream": _quantiles(),
    "k4_served_stream": _windows("coalesce(sum(n_recs), 0)::BIGINT AS n_served", group="model_type"),
    "k5_error_ratio_stream": _windows(
        """count(*) FILTER (status = 'error') AS n_errors, count(*) AS n_requests,
       round(count(*) FILTER (status = 'error') / count(*)::DOUBLE, 6) AS error_ratio""",
        group="model_type",
    ),
    # scalar functions
    "s1_title_case": """SELECT doc_id, md5(array_to_string(list_transform(
  regexp_extract_all(text, '\\p{L}+|\\P{L}+'), lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), '')) AS title_md5 FROM documents""",
    "s2_words": "SELECT doc_id, len(regexp_extract_all(lower(text), '\\w\\w+'))::BIGINT AS n_words FROM documents",
}
ORACLE["k3_in_flight_stream"] = ORACLE["k3_in_flight"]
ORACLE["c1_bucketed"] = ORACLE["c1_tracks_with_history"]
ORACLE["k2_merged_sketches"] = s.query(
    s.REQUESTS,
    """timed AS (
  SELECT window_start, latency, row_number() OVER (PARTITION BY window_start ORDER BY latency) AS place,
         count(*) OVER (PARTITION BY window_start) AS n FROM windowed WHERE status = 'success' AND latency IS NOT NULL)""",
    select="SELECT window_start, count(*) AS n_requests, true AS within_error, "
    + ", ".join(f"round(min(latency) FILTER (place >= {q}::DOUBLE * n), 6) AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99))
    + " FROM timed GROUP BY 1",
)
BY_NAME = """named AS (SELECT p_partkey AS seed_id, lower(p_name) AS name FROM part),
by_name AS (SELECT name, min(track_id) AS track_id, count(*) AS n_matches FROM tracks GROUP BY 1),
resolved AS (
  SELECT seed_id, by_name.track_id, coalesce(n_matches, 0) AS n_matches, by_name.track_id IN (SELECT track_id FROM heard) AS has_history
  FROM named LEFT JOIN by_name USING (name))"""
ORACLE["h2_content_by_name"] = ORACLE["h2_content_named"].replace(NAMED, BY_NAME)
ORACLE["h4_collab_by_name"] = ORACLE["h4_collab_named"].replace(NAMED, BY_NAME)
ORACLE["d15_duplicate_stats"] = ORACLE["d15_clean_stats"]
ORACLE["d3_merged_sketches"] = f"SELECT *, true AS within_error FROM ({ORACLE['d3_distinct_counts']})"
ORACLE["j2_fuzzy_levenshtein"] = s.query(
    s.TRACKS,
    "asked AS (SELECT DISTINCT lower(trim(p_name)) AS query FROM part)",
    "names AS (SELECT DISTINCT name AS key FROM tracks)",
    "measured AS (SELECT query, key, levenshtein(query, key)::INT AS distance FROM asked CROSS JOIN names)",
    select="""SELECT query, key, distance, (row_number() OVER (PARTITION BY query ORDER BY distance, key))::INT AS rank
FROM measured WHERE distance <= 2 QUALIFY rank <= 10""",
)
ORACLE["h1_pruned_search"] = ORACLE["h1_embedding_cosine"]
