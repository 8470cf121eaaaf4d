"""Cleaning, interactions, ranks, split, metrics, features and search."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from melodex.functions.text import strip, title_case
from melodex.functions.vectors import cosine
from melodex.operators import clean, features, interactions, metrics, profile, ranking, search, similarity, split
from melodex.plans import evaluate
from melodex.session import new_folder
from melodex.sources import files
from melodex.sources.schemas import CATALOGUE_SCHEMA


def test_clean_keeps_the_first_listing(spark):
    raw = spark.createDataFrame(
        [
            (2, 1, "B Song", "Y", "Rock, POP", "s1", "g"),
            (1, 1, "A Song", "X", None, "s2", "g"),
            (3, 2, "Null", "NA", "null", "s3", None),
        ],
        "ord int, track_id long, name string, artist string, tags string, spotify_id string, genre string",
    )
    rows = {r.track_id: r for r in clean.clean_catalogue(raw, ["ord"]).collect()}
    assert (rows[1].name, rows[1].tags) == ("a song", "no_tags")
    assert (rows[2].name, rows[2].artist, rows[2].tags) == ("null", "na", "null")
    assert set(rows[1].asDict()) == {"ord", "track_id", "name", "artist", "tags"}
    stats = clean.cleaning_stats(raw, clean.clean_catalogue(raw, ["ord"])).first()
    assert (stats.raw_rows, stats.cleaned_rows, stats.rows_dropped) == (3, 2, 1)
    assert stats.drop_rate == pytest.approx(1 / 3)


def test_csv_round_trip_and_na_values(spark):
    path = new_folder(spark, "csv")
    row = {f.name: None for f in CATALOGUE_SCHEMA.fields}
    rows = [
        tuple({**row, "track_id": "t1", "name": 'say "hi", twice', "tags": "NA", "year": 2001}.values()),
        tuple({**row, "track_id": "t2", "name": "null", "tempo": 1.5}.values()),
    ]
    files.write_table(spark.createDataFrame(rows, CATALOGUE_SCHEMA), path, "csv")
    read = {r.track_id: r for r in files.read_catalogue(spark, path).collect()}
    assert (read["t1"].name, read["t1"].tags, read["t2"].name) == ('say "hi", twice', "NA", "null")
    mapped = {r.track_id: r for r in files.read_catalogue(spark, path, na_values=["NA", "null"]).collect()}
    assert mapped["t1"].tags is None and mapped["t2"].name is None
    with pytest.raises(ValueError, match="schema"):
        files.read_table(spark, path, file_format="csv")


def test_missing_artifacts_are_listed_together(spark):
    folder = new_folder(spark, "artifacts")
    spark.range(1).write.parquet(f"{folder}/tracks")
    with pytest.raises(FileNotFoundError, match="8 artifacts are not in"):
        files.load_artifacts(spark, folder)


def test_interactions_sum_and_skip_null_keys(spark):
    log = spark.createDataFrame(
        [("t", "u", 1), ("t", "u", 2), (None, "u", 5), ("t", None, 5), ("v", "u", 0)],
        "track_id string, user_id string, playcount int",
    )
    rows = {(r.track_id, r.user_id): r.playcount for r in interactions.build_interactions(log).collect()}
    assert rows == {("t", "u"): 3.0, ("v", "u"): 0.0}
    assert interactions.null_key_rows(log).first().null_key_rows == 2
    identity = spark.createDataFrame([(i, i, 1.0) for i in range(10)], "track_id long, user_id long, playcount double")
    stats = profile.matrix_stats(identity).first()
    assert (stats.nnz, stats.sparsity, stats.mean_per_user, stats.mean_per_track) == (10, 0.9, 1.0, 1.0)


@pytest.fixture(params=["one range", "many ranges"])
def ranges(spark, request):
    """Small inputs make one range, unless Spark is kept from merging partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param == "one range")
    yield
    spark.conf.set(name, before)


def test_rank_of_a_group_that_holds_most_rows(spark, ranges):
    random.seed(1)
    rows = [("hot", i, random.randrange(5)) for i in range(900)]
    rows += [(f"u{i % 40}", i, random.randrange(5)) for i in range(300)]
    rows += [(None, i, random.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(rows, "user_id string, track_id long, playcount int").repartition(7)
    ranked = ranking.grouped_row_number(
        df, ["user_id"], [-F.col("playcount"), F.col("track_id")], "rank", "n"
    )
    assert ranked.columns == [*df.columns, "rank", "n"]
    ranked = ranked.collect()
    expected = {}
    for user in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == user), key=lambda r: (-r[2], r[1]))
        expected |= {(user, r[1]): (i, len(own)) for i, r in enumerate(own)}
    assert {(r.user_id, r.track_id): (r["rank"], r.n) for r in ranked} == expected


def test_dictionary_codes_are_dense_and_sorted(spark, ranges):
    values = [f"v{i * 37 % 500:03d}" for i in range(500)] * 2
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "name string")
    codes = {r.name: r.code for r in ranking.dictionary(df, "name").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(set(values)))}


# listener -> plays per track; ties fall to the track id
PLAYS = {
    "one": {"x": 9},
    "two": {"x": 1, "y": 1},
    "three": {"x": 4, "y": 7, "z": 4},
    "five": {"v": 2, "w": 2, "x": 2, "y": 8, "z": 1},
}


def _plays(spark, of=PLAYS):
    rows = [(user, n, track) for user, tracks in of.items() for track, n in tracks.items()]
    return spark.createDataFrame(rows, "user_id string, playcount int, track_id string")


def test_split_holds_out_the_most_played_half(spark):
    df = _plays(spark)
    train, test = split.train_test(df)
    held = sorted((row.user_id, row.track_id) for row in test.collect())
    assert held == [("five", "v"), ("five", "y"), ("three", "x"), ("three", "y")]
    check = split.partition_check(df, train, test).first()
    assert (check.n_whole, check.n_first, check.n_second, check.n_overlap, check.n_uncovered) == (11, 7, 4, 0, 0)
    # a row in both parts must show, and so must one in neither; both are wrongly covered
    check = split.partition_check(df, train.filter("user_id != 'one'").union(test.limit(1).select(*train.columns)), test)
    assert (check.first().n_overlap, check.first().n_uncovered) == (1, 2)


def test_split_without_test_users(spark):
    with pytest.raises(ValueError, match="No test users"):
        split.train_test(_plays(spark, {"one": PLAYS["one"], "two": PLAYS["two"]}))


def _metrics(spark, relevant, lists, ks):
    relevant = spark.createDataFrame(relevant, "user_id int, track_id string")
    lists = spark.createDataFrame(lists, "seed string, item string, rank int")
    seeds = metrics.seed_per_user(relevant)
    return {(r.user_id, r.k): r for r in metrics.user_metrics(seeds, relevant, lists, ks).collect()}


def test_metrics_by_hand(spark):
    relevant = [(4, "p"), (4, "q"), (4, "r")]
    lists = [("p", "u", 1), ("p", "r", 2), ("p", "v", 3), ("p", "q", 4)]
    row = _metrics(spark, relevant, lists, [4])[(4, 4)]  # hits at ranks 2 and 4
    assert (row.precision, row.recall) == (0.5, pytest.approx(2 / 3))
    assert row.ap == pytest.approx((1 / 2 + 2 / 4) / 3)
    gain = 1 / math.log2(3) + 1 / math.log2(5)
    assert row.ndcg == pytest.approx(gain / (1 + 1 / math.log2(3) + 1 / 2))


def test_metrics_of_repeated_items_empty_lists_and_k_zero(spark):
    lists = [("a", "b", 1), ("a", "b", 2), ("a", "x", 3)]
    rows = _metrics(spark, [(0, "a"), (0, "b"), (1, "z")], lists, [0, 3])
    twice = rows[(0, 3)]
    assert twice.precision == pytest.approx(1 / 3) and twice.recall == 0.5
    assert twice.ndcg == pytest.approx(1.0) and twice.ap == pytest.approx(1.0)
    assert (rows[(1, 3)].precision, rows[(1, 3)].recall, rows[(1, 3)].ndcg, rows[(1, 3)].ap) == (0, 0, 0, 0)
    assert rows[(0, 0)].precision == 0 and rows[(0, 0)].ndcg == 0 and rows[(0, 0)].ap == 0


def test_metrics_against_a_plain_loop(spark):
    random.seed(3)
    items = [f"t{i:02d}" for i in range(30)]
    relevant = {u: set(random.sample(items, random.randint(1, 12))) for u in range(20)}
    lists = {s: random.sample([i for i in items if i != s], 15) for s in items if s != "t00"}
    found = _metrics(
        spark,
        [(u, t) for u, ts in relevant.items() for t in ts],
        [(s, i, n) for s, own in lists.items() for n, i in enumerate(own, 1)],
        [1, 5, 10],
    )
    for (user, k), row in found.items():
        wanted = relevant[user]
        top = lists.get(min(wanted), [])[:k]
        ranks = [n for n, item in enumerate(top, 1) if item in wanted]
        ideal = sum(1 / math.log2(n + 1) for n in range(1, min(len(wanted), k) + 1))
        assert row.precision == pytest.approx(len(ranks) / k)
        assert row.recall == pytest.approx(len(ranks) / len(wanted))
        assert row.ndcg == pytest.approx(sum(1 / math.log2(n + 1) for n in ranks) / ideal)
        assert row.ap == pytest.approx(sum(h / n for h, n in enumerate(ranks, 1)) / min(len(wanted), k))


def test_flat_metrics(spark):
    report = spark.createDataFrame(
        [("content_based", 5, 0.1, 0.2, 0.3, 0.4)], "model string, k int, precision double, recall double, ndcg double, ap double"
    )
    flat = {r.metric: r.value for r in metrics.flat_metrics(report, "eval_").collect()}
    assert flat == {f"eval_content_based_{m}_at_k5": v for m, v in zip(metrics.METRICS, (0.1, 0.2, 0.3, 0.4))}


SPEC = features.EncoderSpec(onehot=("artist",), standard=("tempo",), minmax=("energy", "same"), passthrough=("mode",))


def _songs(spark, rows):
    return spark.createDataFrame(
        rows, "track_id long, artist string, year int, tags string, tempo double, energy double, same double, mode int"
    )


def test_encoder_by_hand(spark):
    songs = _songs(
        spark,
        [
            (1, "x", 2000, "rock pop", 1.0, 0.0, 7.0, 1),
            (2, "y", 2000, "rock rock", 2.0, 5.0, 7.0, 0),
            (3, "x", 1999, "no_tags", 3.0, 10.0, 7.0, 1),
            (4, None, 1998, "a b", 2.0, 5.0, 7.0, 0),
        ],
    )
    encoder = features.fit_encoder(songs, SPEC)
    rows = {r.track_id: r for r in features.transform(songs, encoder, SPEC, all_known=True).collect()}
    # vocabulary: no_tags, pop, rock; one-letter words are not words
    idf = {"no_tags": math.log(5 / 2) + 1, "pop": math.log(5 / 2) + 1, "rock": math.log(5 / 3) + 1}
    length = math.hypot(idf["pop"], idf["rock"])
    deviation = math.sqrt(0.5)
    assert rows[1].dense == pytest.approx([0.5, 0, idf["pop"] / length, idf["rock"] / length, -1 / deviation, 0, 0, 1])
    assert rows[2].dense == pytest.approx([0.5, 0, 0, 1, 0, 0.5, 0, 0])
    assert rows[3].dense == pytest.approx([0.25, 1, 0, 0, 1 / deviation, 1, 0, 1])
    assert rows[4].dense == pytest.approx([0.25, 0, 0, 0, 0, 0.5, 0, 0])
    unseen = features.transform(_songs(spark, [(9, "new", 1950, "rock", 2.0, 20.0, 9.0, 1)]), encoder, SPEC).first()
    assert unseen.cats == [None]
    assert unseen.dense == pytest.approx([0, 0, 0, 1, 0, 2, 2, 1])
    known = features.transform(songs, encoder, SPEC).collect()
    assert {r.track_id: (r.dense, r.cats) for r in known} == {t: (r.dense, r.cats) for t, r in rows.items()}
    raw = features.EncoderSpec(**{**SPEC.__dict__, "year_encoding": "raw"})
    assert features.transform(songs, encoder, raw, all_known=True).filter("track_id = 1").first().dense[0] == 2000


def test_missing_numbers_are_imputed_when_asked(spark):
    nan, infinite = float("nan"), float("inf")
    songs = _songs(
        spark,
        [
            (1, "x", 2000, "aa", 1.0, 2.0, 7.0, 1),
            (2, "x", 2000, "aa", 5.0, 6.0, 7.0, 3),
            (3, "x", 2000, "aa", nan, None, nan, None),
            (4, "x", 2000, "aa", None, -infinite, infinite, 2),
        ],
    )
    spec = features.EncoderSpec(**{**SPEC.__dict__, "missing": "impute"})
    rows = {r.track_id: r.dense[-4:] for r in features.fit_transform(songs, spec).collect()}
    # tempo about its mean, energy in the middle, a constant column at its constant, the rest 0
    assert rows == {1: [-1, 0, 0, 1], 2: [1, 1, 0, 3], 3: [0, 0.5, 0, 0], 4: [0, 0.5, 0, 2]}
    kept = {r.track_id: r.dense[-4:] for r in features.fit_transform(songs, SPEC).collect()}
    assert kept[3][1] is None and math.isnan(kept[3][0])
    with pytest.raises(ValueError):
        features.fit_transform(songs, features.EncoderSpec(**{**SPEC.__dict__, "missing": "drop"}))


def test_vocabulary_is_limited_by_corpus_frequency(spark):
    docs = spark.createDataFrame([(1, "aa aa aa bb"), (2, "bb cc"), (3, "bb cc dd")], "doc_id long, text string")
    kept = features.fit_vocabulary(docs, "text", 3).collect()
    assert {r.term: (r.corpus_tf, r.df) for r in kept} == {"aa": (3, 1), "bb": (3, 3), "cc": (2, 2)}


def test_row_and_relational_tfidf_agree(spark):
    docs = spark.createDataFrame([(1, "aa aa bb"), (2, "béa cc"), (3, "zz")], "doc_id long, text string")
    vocabulary = features.fit_vocabulary(docs, "text", 4)
    long = {(r.doc_id, r.term): r.weight for r in features.tfidf_weights(docs, vocabulary, "doc_id", "text").collect()}
    with_terms = features._with_terms(docs, vocabulary)
    for row in with_terms.select("doc_id", "_terms", features.tfidf_vector(F.col("_terms"), F.col("text")).alias("v")).collect():
        for term, weight in zip(row._terms, row.v):
            assert weight == pytest.approx(long.get((row.doc_id, term.term), 0.0))


def test_feature_stats(spark):
    identity = spark.createDataFrame(
        [(i, [1.0 if i == j else 0.0 for j in range(5)], []) for i in range(5)],
        "track_id long, dense array<double>, cats array<string>",
    )
    stats = features.feature_stats(identity).first()
    assert (stats.nnz, stats.n_samples, stats.n_features, stats.sparsity) == (5, 5, 5, 0.8)


def test_cosine_expression(spark):
    row = spark.sql("SELECT array(1D, 2D) AS a, array(2D, 4D) AS b, array(0D, 0D) AS z").select(
        cosine(F.col("a"), F.col("b")).alias("same"), cosine(F.col("a"), F.col("z")).alias("zero")
    ).first()
    assert row.same == pytest.approx(1.0) and row.zero == 0.0


def _grams(text):
    padded = f"  {text} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


@pytest.mark.parametrize("cutoff", [0.2, 0.4, 0.7])
def test_fuzzy_matches_equal_a_plain_loop(spark, cutoff):
    random.seed(5)
    parts = ["or", "lan", "ti", "ke", "vel", "mu", "sa"]
    names = sorted({" ".join("".join(random.choices(parts, k=2)) for _ in range(random.randint(1, 3))) for _ in range(300)})
    index = spark.createDataFrame([(n,) for n in names], "key string")
    asked = [names[3], names[9][1:], f"  {names[20].upper()}\t", "", "   ", "qqqq", "x", "tike " * 30]
    queries = spark.createDataFrame([(q,) for q in asked], "query string")
    found = {}
    for row in search.fuzzy_matches(queries, index, 10, cutoff).orderBy("query", "rank").collect():
        found.setdefault(row.query, []).append((row.key, row.ratio))
    for query in {q.strip().lower() for q in asked}:
        own, rated = _grams(query), []
        for key in names:
            ratio = 2.0 * len(own & _grams(key)) / (len(own) + len(_grams(key)))
            if query and ratio >= cutoff:
                rated.append((ratio, key))
        assert found.get(query, []) == [(key, ratio) for ratio, key in sorted(rated, reverse=True)[:10]]


def test_top_k_ranks_large_and_close_values(spark):
    rows = [("a", 1, 1e10), ("a", 2, 9e10), ("a", 3, 5e10), ("a", 4, float("nan")), ("b", 1, 0.5), ("b", 2, 0.5 + 1e-13)]
    df = spark.createDataFrame(rows, "seed string, item long, score double")
    order = lambda found, key: [r["item"] for r in found.orderBy("rank").collect() if r.seed == key]
    assert order(ranking.top_k(df, 4), "a") == [2, 3, 1, 4]
    assert order(ranking.top_k(df, 4), "b") == [1, 2]  # equal to nine decimals
    assert order(ranking.top_k(df, 4, exact=True), "b") == [2, 1]


def test_song_index_keeps_the_first(spark):
    tracks = spark.createDataFrame(
        [(2, "Song", "X"), (1, "song", "x"), (3, "Other", "Y")], "track_id long, name string, artist string"
    )
    rows = {r.key: r.display for r in search.song_index(tracks).collect()}
    assert rows == {"song — x": "song — x", "other — y": "Other — Y"}


def test_text_functions_equal_python(spark):
    texts = ["don't stop", "ab-cd EF", "3rd straße", " \t x \n", "élan vital", "ßa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", title_case(F.col("t")).alias("title"), strip(F.col("t")).alias("stripped")).collect():
        assert row.title == row.t.title()
        assert row.stripped == row.t.strip()


def test_evaluation_run(spark):
    random.seed(11)
    plays = [(i, u, float(random.randint(1, 5))) for u in range(12) for i in random.sample(range(20), 8)]
    log = spark.createDataFrame(plays, "track_id long, user_id long, playcount double")
    encoded = spark.createDataFrame(
        [(i, [random.random() for _ in range(3)], []) for i in range(20)], "track_id long, dense array<double>, cats array<string>"
    )
    run = evaluate.run_evaluation(encoded, log, sample=5, ks=[2, 5], depth=10)
    rows = run.metrics.collect()
    assert len(rows) == 6
    assert all(0 <= row[m] <= 1 for row in rows for m in metrics.METRICS)
    facts = run.run.first()
    assert (facts.n_users_total, facts.sampled_users, facts.n_test_interactions) == (12, 5, 20)
    trained = evaluate.run_evaluation(encoded, log, ks=[2], depth=10, fit_on="train", exclude_seed_from_relevant=True)
    assert trained.metrics.count() == 3
    with pytest.raises(ValueError, match="fit_on"):
        evaluate.run_evaluation(encoded, log, fit_on="test")


def test_collab_ranges_count_missing_pairs_as_zero(spark):
    scores = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.5), (2, 1, 0.5), (2, 2, 1.0)], "seed long, item long, score double")
    assert {(r.low, r.high) for r in similarity.collab_ranges(scores, F.lit(2)).collect()} == {(0.5, 1.0)}
    assert {(r.low, r.high) for r in similarity.collab_ranges(scores, F.lit(3)).collect()} == {(0.0, 1.0)}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edit_matches_equal_all_pairs(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choices("abé", k=draw.randint(0, 9))) for _ in range(150)] + ["a", "ab", "x" * 300, "x" * 299 + "y"]
    queries = spark.createDataFrame([(t,) for t in [*texts, " ", None]], "query string")
    keys = spark.createDataFrame([(t,) for t in [*texts, None, "a"]], "key string")
    plain = {(a, b, _edits(a, b)) for a in set(texts) if a for b in set(texts) if abs(len(a) - len(b)) <= 2}
    for distance in (0, 1, 2):
        got = {(r.query, r.key, r.distance) for r in search.edit_matches(queries, keys, distance, 1000).collect()}
        assert got == {pair for pair in plain if pair[2] <= distance}


def test_edit_candidates_are_few(spark):
    draw = random.Random(6)
    texts = ["".join(draw.choices("abcdefgh", k=20)) for _ in range(400)]
    pairs = spark.createDataFrame([(t,) for t in texts], "query string")
    assert search.edit_candidates(pairs, pairs.toDF("key"), 2).count() < 400 * 400 / 50


def test_merged_sketches_of_appended_parts(spark):
    parts = spark.range(6000).selectExpr("id % 3 AS part", "id % 2000 AS a", "CAST(NULL AS string) AS b")
    first = profile.distinct_sketches(parts.filter("part < 2"), ["a", "b"], ["part"])
    added = profile.distinct_sketches(parts.filter("part = 2"), ["a", "b"], ["part"])
    rows = {r.column: r for r in profile.merged_distinct_counts(first.unionByName(added), ["a", "b"]).collect()}
    assert abs(rows["a"].estimate - 2000) <= rows["a"].error < 200
    assert (rows["b"].estimate, rows["b"].error) == (0, 1.0)
    assert {r.estimate for r in profile.merged_distinct_counts(first.limit(0), ["a", "b"]).collect()} == {0}


def test_duplicate_stats(spark):
    raw = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "track_id int, name string")
    assert tuple(clean.duplicate_stats(raw).first()) == (5, 3, 2, 0.4)
    assert tuple(clean.duplicate_stats(raw.limit(0)).first()) == (0, 0, 0, 0.0)


def test_tables_stored_in_buckets_meet_without_a_shuffle(spark):
    left = spark.range(200).select((F.col("id") % 50).alias("track_id"), F.col("id").alias("plays"))
    right = spark.range(20, 70).select(F.col("id").alias("track_id"), F.lit("x").alias("name"))
    plays, tracks = (files.store_bucketed(df, new_folder(spark, "bucketed"), "track_id", 4) for df in (left, right))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to send
    try:
        summed = plays.groupBy("track_id").agg(F.sum("plays").alias("plays")).join(tracks, "track_id")
        plan = summed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        unstored = left.join(right, "track_id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in unstored
        rows = {row.track_id: row.plays for row in summed.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows == {i: sum(range(i, 200, 50)) for i in range(20, 50)}
