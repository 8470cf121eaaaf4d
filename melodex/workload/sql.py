"""Building blocks of the oracle SQL: the tables of ``tables.py`` and the models, written for DuckDB."""

from __future__ import annotations

from melodex.workload.tables import LISTING_ORDER

ORDER = ", ".join(LISTING_ORDER)

TRACK_COLUMNS = (
    "track_id, name, artist, spotify_preview_url, tags, year, duration_ms, danceability, energy, key, loudness, "
    "mode, speechiness, acousticness, instrumentalness, liveness, valence, tempo, time_signature"
)

LISTINGS = f"""listings AS (
  SELECT l_partkey AS track_id, p_name AS name, p_brand AS artist,
         'u' || l_partkey AS spotify_preview_url, 's' || l_suppkey AS spotify_id,
         CASE WHEN l_returnflag <> 'R' THEN p_type || ', ' || p_name END AS tags, l_linestatus AS genre,
         p_size + 1970 AS year, CAST(floor(l_extendedprice) AS BIGINT) AS duration_ms, l_tax AS danceability,
         l_quantity / 50e0 AS energy, p_size % 12 AS key, l_discount AS loudness, l_linenumber % 2 AS mode,
         l_discount * l_tax AS speechiness, l_extendedprice / 100000e0 AS acousticness,
         p_size / 50e0 AS instrumentalness, p_retailprice / 2000e0 AS liveness,
         l_quantity * l_discount AS valence, l_quantity AS tempo, l_linenumber AS time_signature, {ORDER}
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

TRACKS = f"""{LISTINGS},
tracks AS (
  SELECT * EXCLUDE ({ORDER}, genre, spotify_id, tags, name, artist),
         lower(name) AS name, lower(artist) AS artist, lower(coalesce(tags, 'no_tags')) AS tags
  FROM listings QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY {ORDER}) = 1)"""


INTERACTIONS = """inter AS (
  SELECT l_partkey AS track_id, o_custkey AS user_id, sum(l_quantity) AS playcount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
RADIO_INTERACTIONS = """radio AS (
  SELECT CAST(floor(value) AS BIGINT) AS track_id, user_id,
         sum(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1)::DOUBLE AS playcount
  FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2)"""

STANDARD = ("duration_ms", "loudness", "tempo")
MINMAX = ("danceability", "energy", "speechiness", "acousticness", "instrumentalness", "liveness", "valence")


def vocabulary(source: str, key: str, text: str, prefix: str = "", size: int = 85) -> str:
    return f"""{prefix}tf AS (
  SELECT {key}, term, count(*) AS tf
  FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '\\w\\w+')) AS term FROM {source}) GROUP BY 1, 2),
{prefix}vocab AS (
  SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, corpus_tf, df,
         ln((1 + (SELECT count(*) FROM {source}))::DOUBLE / (1 + df)) + 1 AS idf
  FROM (SELECT term, sum(tf)::BIGINT AS corpus_tf, count(*) AS df FROM {prefix}tf GROUP BY 1
        ORDER BY corpus_tf DESC, term LIMIT {size}))"""


YEAR_FREQUENCY = "(count(*) OVER (PARTITION BY year))::DOUBLE / count(*) OVER ()"


def features(source: str = "tracks", year: str = YEAR_FREQUENCY) -> str:
    """Feature vectors of a catalogue; numbers that it lacks are imputed."""
    numbers = ", ".join(
        [f"coalesce(({c} - avg({c}::DOUBLE) OVER ()) / stddev_pop({c}::DOUBLE) OVER (), 0)" for c in STANDARD]
        + [f"coalesce(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 0.5e0)" for c in MINMAX]
        + ["coalesce(mode, 0)::DOUBLE"]
    )
    return f"""{vocabulary(source, "track_id", "tags")},
raw_weights AS (
  SELECT track_id, list(coalesce(tf, 0) * idf ORDER BY idx) AS w
  FROM {source} CROSS JOIN vocab LEFT JOIN tf USING (track_id, term) GROUP BY 1),
weights AS (
  SELECT track_id, w, sqrt(list_dot_product(w, w)) AS length FROM raw_weights),
scaled AS (
  SELECT track_id, artist, time_signature, key, [{year}] AS freq, [{numbers}] AS rest FROM {source}),
feat AS (
  SELECT *, sqrt(list_dot_product(dense, dense) + 3) AS norm FROM (
    SELECT track_id, artist, time_signature, key,
           list_concat(list_concat(freq, list_transform(w, lambda x: CASE WHEN length > 0 THEN x / length ELSE 0e0 END)), rest) AS dense
    FROM scaled JOIN weights USING (track_id)))"""


FEATURES = f"{TRACKS},\n{features()}"
RAW_YEAR_FEATURES = f"{TRACKS},\n{features(year='year::DOUBLE')}"
HOLED_FEATURES = f"""{TRACKS},
holed AS (
  SELECT * REPLACE (CASE WHEN tags <> 'no_tags' THEN tempo END AS tempo, CASE WHEN time_signature > 1 THEN energy END AS energy,
                    CASE WHEN key > 0 THEN mode END AS mode) FROM tracks),
{features("holed")}"""


def content(seeds: str = "feat", items: str = "feat") -> str:
    """All cosines between two feature tables."""
    return f"""content AS (
  SELECT a.track_id AS seed, b.track_id AS item,
         (list_dot_product(a.dense, b.dense) + (a.artist = b.artist)::INT + (a.time_signature = b.time_signature)::INT
          + (a.key = b.key)::INT) / (a.norm * b.norm) AS score
  FROM {seeds} a CROSS JOIN {items} b)"""


def collab(source: str = "inter", seeds: str | None = None) -> str:
    only = f"WHERE a.track_id IN (SELECT track_id FROM {seeds})" if seeds else ""
    return f"""norms AS (SELECT track_id, sqrt(sum(playcount * playcount)) AS norm FROM {source} GROUP BY 1),
dots AS (
  SELECT a.track_id AS seed, b.track_id AS item, sum(a.playcount * b.playcount) AS dot
  FROM {source} a JOIN {source} b USING (user_id) {only} GROUP BY 1, 2),
collab AS (
  SELECT seed, item, dot / (s.norm * i.norm) AS score
  FROM dots JOIN norms s ON s.track_id = seed JOIN norms i ON i.track_id = item)"""


def filled(source: str = "inter", seeds: str | None = None) -> str:
    """Collaborative scores of all pairs, 0 where no listener is shared."""
    only = f"WHERE track_id IN (SELECT track_id FROM {seeds})" if seeds else ""
    return f"""filled AS (
  SELECT s.track_id AS seed, i.track_id AS item, coalesce(score, 0) AS score
  FROM (SELECT DISTINCT track_id FROM {source} {only}) s CROSS JOIN (SELECT DISTINCT track_id FROM {source}) i
  LEFT JOIN collab ON collab.seed = s.track_id AND collab.item = i.track_id)"""


def top(scores: str, k: int, name: str = "lists") -> str:
    return f"""{name} AS (
  SELECT seed, item, score,
         (row_number() OVER (PARTITION BY seed ORDER BY floor(score * 1e9 + 0.5) DESC, item))::INT AS rank
  FROM {scores} WHERE seed <> item QUALIFY rank <= {k})"""


def hybrid(weight: float, source: str = "inter", seeds: str | None = None) -> str:
    """Needs FEATURES and the interactions ``source``; gives ``hybrid`` and, on the way, both score tables."""
    only = f"AND track_id IN (SELECT track_id FROM {seeds})" if seeds else ""
    return f"""common AS (SELECT * FROM feat WHERE track_id IN (SELECT track_id FROM {source})),
common_seeds AS (SELECT * FROM common WHERE true {only}),
{collab(source, seeds)},
{content("common_seeds", "common")},
paired AS (
  SELECT seed, item, content.score AS c, coalesce(collab.score, 0) AS f
  FROM content LEFT JOIN collab USING (seed, item)),
ranged AS (
  SELECT *, min(c) OVER s AS c_low, max(c) OVER s AS c_high, min(f) OVER s AS f_low, max(f) OVER s AS f_high
  FROM paired WINDOW s AS (PARTITION BY seed)),
hybrid AS (
  SELECT seed, item, {weight}::DOUBLE * ((c - c_low) / (c_high - c_low + 1e-8))
                     + {1 - weight}::DOUBLE * ((f - f_low) / (f_high - f_low + 1e-8)) AS score
  FROM ranged)"""


def split(sample: int | None = None) -> str:
    """The held-out rows of all users, or of a sample drawn by hash."""
    drawn = "(SELECT DISTINCT user_id FROM marked WHERE is_test)"
    chosen = f"AND user_id IN (SELECT user_id FROM {drawn} ORDER BY md5(user_id || ':42'), user_id LIMIT {sample})"
    return f"""{INTERACTIONS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY playcount DESC, track_id) - 1 AS rank,
         count(*) OVER (PARTITION BY user_id) AS group_size FROM inter),
marked AS (
  SELECT track_id, user_id, playcount, group_size >= 3 AND rank < greatest(2, group_size // 2) AS is_test FROM ranked),
train AS (SELECT track_id, user_id, playcount FROM marked WHERE NOT is_test),
test AS (SELECT track_id, user_id, playcount FROM marked WHERE is_test {chosen if sample else ""}),
user_seeds AS (SELECT user_id, min(track_id) AS seed FROM test GROUP BY 1),
seeds AS (SELECT DISTINCT seed AS track_id FROM user_seeds)"""


SPLIT = split()


def evaluation(lists: str = "lists", ks: tuple[int, ...] = (5, 10, 20), suffix: str = "") -> str:
    """Needs SPLIT and a ranked list table; gives hits, per_user and report."""
    values = ", ".join(f"({k})" for k in ks)
    return f"""hits{suffix} AS (
  SELECT user_id, item, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS hit_no
  FROM test JOIN user_seeds USING (user_id) JOIN {lists} ON {lists}.seed = user_seeds.seed AND {lists}.item = test.track_id),
ks{suffix} AS (SELECT * FROM (VALUES {values}) v(k)),
sizes{suffix} AS (SELECT user_id, count(*) AS n_relevant FROM test GROUP BY 1),
ideal{suffix} AS (
  SELECT i AS n, sum(1 / log2(i + 1)) OVER (ORDER BY i) AS gain FROM range(1, {max(ks) + 1}) r(i)),
per_user{suffix} AS (
  SELECT sizes{suffix}.user_id, k, count(item)::DOUBLE / k AS precision, count(item)::DOUBLE / any_value(n_relevant) AS recall,
         coalesce(sum(1 / log2(rank + 1)), 0) / any_value(gain) AS ndcg,
         coalesce(sum(hit_no::DOUBLE / rank), 0) / least(any_value(n_relevant), k) AS ap
  FROM sizes{suffix} CROSS JOIN ks{suffix} JOIN ideal{suffix} ON n = least(n_relevant, k)
  LEFT JOIN hits{suffix} ON hits{suffix}.user_id = sizes{suffix}.user_id AND rank <= k
  GROUP BY sizes{suffix}.user_id, k),
report{suffix} AS (
  SELECT k, avg(precision) AS precision, avg(recall) AS recall, avg(ndcg) AS ndcg, avg(ap) AS ap
  FROM per_user{suffix} GROUP BY k)"""


REQUESTS = """requests AS (
  SELECT ts, CASE WHEN user_id % 2 = 0 THEN 'hybrid' ELSE 'content_based' END AS model_type,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, value / 1000e0 AS latency,
         CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS n_recs
  FROM events),
windowed AS (
  SELECT *, time_bucket(INTERVAL 30 seconds, ts, TIMESTAMP '2024-01-01') - to_seconds(30 * unnest(range(0, 10))) AS window_start
  FROM requests)"""


def query(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
