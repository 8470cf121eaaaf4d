"""What must not grow with the pairs: copies, shuffled rows, repeated work."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import listening
from melodex.operators import similarity
from melodex.plans import evaluate
from melodex.plans import recommend as r
from melodex.workload import tables


def _rows(rng, n, key, categories):
    dense = rng.normal(size=(n, 5))
    dense[1] = dense[2]  # ties go to the smaller id
    dense[4] = 0
    cats = [[f"a{i}", None if i % 3 == 0 else f"b{i % 4}"] for i in rng.integers(0, categories, n)]
    return pa.table({key: np.arange(n), "dense": dense.tolist(), "cats": cats})


def _scores(items, seeds):
    def cosine(s, i):
        a, b = np.array(seeds["dense"][s].as_py()), np.array(items["dense"][i].as_py())
        known = [sum(c is not None for c in side["cats"][row].as_py()) for side, row in ((seeds, s), (items, i))]
        same = sum(x is not None and x == y for x, y in zip(seeds["cats"][s].as_py(), items["cats"][i].as_py()))
        norm = np.sqrt((a @ a + known[0]) * (b @ b + known[1]))
        return (a @ b + same) / norm if norm else 0.0

    return np.array([[cosine(s, i) for i in range(len(items))] for s in range(len(seeds))])


def test_tiles_in_single_precision_give_exact_lists(monkeypatch):
    monkeypatch.setattr(similarity, "CHUNK_ITEMS", 16)
    monkeypatch.setattr(similarity, "EXACT_PAIRS", 10)
    rng = np.random.default_rng(3)
    for categories in (3, 90):  # widened, and compared
        monkeypatch.setattr(similarity, "NARROW_CATEGORIES", 20)
        items, seeds = _rows(rng, 70, "item", categories), _rows(rng, 30, "seed", categories)
        expected = _scores(items, seeds)
        tile = similarity.Tile(items, seeds)
        for k in (4, 100):
            for part in tile.parts():
                rows, columns, scores = tile.best(part, k)
                for s in range(part.start, part.stop):
                    order = sorted((i for i in range(70) if i != s), key=lambda i: (-np.floor(expected[s, i] * 1e9 + 0.5), i))
                    assert columns[rows == s - part.start].tolist() == order[:k]
                np.testing.assert_allclose(scores, expected[rows + part.start, columns], atol=1e-12)
                low, high = tile.ranges(part)
                np.testing.assert_allclose([low, high], [expected[part].min(axis=1), expected[part].max(axis=1)], atol=1e-12)


def test_larger_tables_are_copied_less_often(spark):
    """A row is copied once per block of the other side: for a million tracks ten times, not 147 times."""
    rows = spark.range(1_200_000).withColumnRenamed("id", "item")
    blocks = similarity._Blocks(rows, rows, similarity.TILE_ROWS, similarity.TILE_ROWS)
    assert spark.range(1).select(blocks.items.alias("n")).first().n <= 16


def test_no_pair_is_shuffled(spark):
    log = listening(spark, [(u, i, i + u + 1) for u in range(4) for i in range(6)])
    seeds = log.select("track_id")
    for df in (similarity.collab_products(log, seeds), similarity.collab_top_k(log, seeds, 2, fill_zero=False)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert shuffles and not [line for line in shuffles if "(seed#" in line and ", item#" in line]


def test_lists_leave_a_block_of_seeds_final(spark, harbour, monkeypatch):
    """No list per block of items is shuffled, however few items pass at a time."""
    log = listening(spark, [(u, i, (u * i) % 5 + 1) for u in range(6) for i in range(u, 30, u + 1)])
    features = harbour[1]
    sides = similarity.as_items(features), similarity.as_seeds(features)
    found = []
    for rows, plays in ((1 << 17, 1 << 23), (2, 3)):
        monkeypatch.setattr(similarity, "TILE_ROWS", rows)
        monkeypatch.setattr(similarity, "PASSING_PLAYS", plays)
        lists = [
            similarity.collab_top_k(log, log.select("track_id"), 9),
            similarity.content_top_k(*sides, 3, tile_rows=1 << 17),
            r.hybrid_lists(features, harbour[2], features.select("track_id"), 3),
        ]
        found.append([sorted((x.seed, x.rank, x["item"], round(x.score, 9)) for x in df.collect()) for df in lists])
        if rows > 2:
            assert not [df for df in lists if "Window" in df._jdf.queryExecution().executedPlan().toString()]
    assert found[0] == found[1]


def test_no_row_is_copied_per_block_of_seeds(spark, harbour, monkeypatch):
    """Items are stored once and read by every task, in any number of blocks, ranges and packed rows."""
    log = listening(spark, [(u, i, (u * i) % 5 + 1) for u in range(6) for i in range(u, 30, u + 1)])
    features, seeds = harbour[1], log.select("track_id")
    sides = similarity.as_items(features), similarity.as_seeds(features)
    found = []
    for few in (False, True):
        if few:
            for name in ("SLICE_ROWS", "PACKED_ROWS", "RANGE_ROWS", "PASSING_PLAYS", "TILE_ROWS"):
                monkeypatch.setattr(similarity, name, 2)
            monkeypatch.setattr(similarity, "TILE_PLAYS", 20)
        scores = similarity.collab_scores(log, seeds)
        tables = [
            similarity.collab_top_k(log, seeds, 9),
            similarity.content_top_k(*sides, 3, tile_rows=2),
            similarity.content_ranges(*sides, tile_rows=1),
            similarity.collab_ranges(scores, F.lit(30)),
            scores,
            r.hybrid_lists(features, harbour[2], features.select("track_id"), 3),
        ]
        for df in tables:
            assert "explode(" not in df._jdf.queryExecution().optimizedPlan().toString()
        found.append([sorted(tuple(round(x, 9) for x in row) for row in df.collect()) for df in tables])
    assert found[0] == found[1]


def test_rows_of_one_item_are_packed_together(monkeypatch):
    monkeypatch.setattr(similarity, "PACKED_ROWS", 2)
    batches = [pa.RecordBatch.from_pydict({"item": ids}) for ids in ([None, None, None, 1], [1, 1, 1], [], [2, 3, 3, 3, 4])]
    found = [table["item"].to_pylist() for table in similarity._whole_items(iter(batches))]
    assert found == [[None, None, None], [1, 1, 1, 1], [2, 3, 3, 3], [4]]


def test_collab_scores_normalised_by_ranges(spark):
    log = listening(spark, [(0, 1, 3), (0, 2, 4), (1, 2, 5), (1, 3, 1)])
    seeds = log.select("track_id")
    plain = {(x.seed, x["item"]): x.score for x in similarity.collab_scores(log, seeds).collect()}
    ranges = spark.createDataFrame([(1, 0.0, 0.5), (2, 0.25, 1.0), (3, 0.0, 1.0)], "seed long, low double, high double")
    ends = {1: (0.0, 0.5), 2: (0.25, 1.0), 3: (0.0, 1.0)}
    found = similarity.collab_scores(log, seeds, ranges=ranges).collect()
    assert len(found) == len(plain)
    for x in found:
        low, high = ends[x.seed]
        assert abs(x.score - (plain[x.seed, x["item"]] - low) / (high - low + 1e-8)) < 1e-9


def test_item_with_more_plays_than_a_batch(spark):
    many = spark.range(25_000).selectExpr("1L as track_id", "id as user_id", "1.0D as playcount")
    log = many.union(many.filter("user_id < 40").selectExpr("2L", "user_id", "2.0D"))
    found = {(x.seed, x["item"]): x.dot for x in similarity.collab_products(log, log.select("track_id")).collect()}
    assert found == {(1, 1): 25_000.0, (1, 2): 80.0, (2, 1): 80.0, (2, 2): 160.0}


def test_blend_stores_no_pairs(spark, harbour, monkeypatch):
    tracks, features, log = harbour
    stored = []
    monkeypatch.setattr(r, "materialise", lambda df, label, **o: stored.append(label) or df, raising=False)
    assert r.hybrid_lists(features, log, features.select("track_id"), 2).count() == 8
    assert not stored


def test_run_is_described_without_lists(spark, harbour):
    log = harbour[2].unionByName(listening(spark, [("eve", i, i) for i in (11, 14, 17, 23)]))
    row = evaluate.describe_run(log, ks=(5,)).first()
    assert (row.n_users_total, row.n_items, row.n_test_interactions, row.sampled_users) == (5, 4, 2, 1)
    assert row == evaluate.run_evaluation(harbour[1], log, ks=(5,)).run.first()


def test_first_listing_is_found_before_the_join(spark, tmp_path):
    listing = "l_partkey long, l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    rows = [(p, o, 1, 7, float(o), 10.5, 0.1, 0.2, "N", "O", None) for p in (1, 2, 9) for o in (5, 3, 4)]
    spark.createDataFrame(rows + [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "R", "O", None)], listing).write.parquet(f"{tmp_path}/lineitem.parquet")
    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(p, f"Name {p}", "B", "t", 3, 9.0) for p in (1, 2, 4)], part).write.parquet(f"{tmp_path}/part.parquet")
    assert tables.first_listings(spark, str(tmp_path)).count() == 2
    kept = tables.tracks(spark, str(tmp_path)).select("track_id", "tempo").collect()
    assert sorted(kept) == [(1, 3.0), (2, 3.0)]


def _grouped(rng, n, key):
    """Rows of 16 pairs of categories, some of them unknown, and a few zero vectors."""
    dense = rng.normal(size=(n, 3)) * rng.choice([0.1, 0.3, 0.6], n)[:, None]
    dense[:2] = 0
    cats = [[f"a{i % 4}", None if i == 13 else f"b{i // 4}"] for i in rng.integers(0, 16, n)]
    cats[0] = [None, None]
    return pa.table({key: np.arange(n), "dense": dense.tolist(), "cats": cats, "place": np.arange(n)})


def test_items_that_cannot_be_listed_are_not_scored(monkeypatch):
    """Categories and lengths rule blocks of items out; the lists are those of all pairs."""
    monkeypatch.setattr(similarity, "BLOCK_ITEMS", 8)
    monkeypatch.setattr(similarity, "NEAR_ITEMS", 32)
    monkeypatch.setattr(similarity, "BOUND_ROWS", 4)
    monkeypatch.setattr(similarity, "SLICE_ROWS", 16)
    scored, near = [], similarity.Tile.near
    monkeypatch.setattr(similarity.Tile, "near", lambda tile, *a: scored.append((out := near(tile, *a))[1].size) or out)
    rng = np.random.default_rng(5)
    items, seeds = _grouped(rng, 2000, "item"), similarity._in_order(_grouped(rng, 160, "seed").drop("place"))
    expected, ids = _scores(items, seeds), seeds["seed"].to_numpy()
    tile = similarity.Tile(items, seeds)
    for part in tile.parts():
        limits = tile.bounds(part)
        for row in range(part.start, part.stop):
            most = np.maximum.reduceat(expected[row][tile.order], tile.starts[:-1])
            assert (limits[(row - part.start) // 4] >= most).all()
    lists = similarity.Lists(tile.seed_ids, 5)
    lists.floors = similarity._reached(items.rename_columns(["seed", "dense", "cats", "place"]), seeds, 5)
    lists.meet(items["place"].to_numpy(), tile.item_ids)
    scored.clear()
    for part in tile.parts():
        lists.put(part, *tile.best(part, 5, lists=lists))
    rows, places, _ = lists.of(slice(0, 160))
    for s in range(160):
        order = sorted((i for i in range(2000) if i != ids[s]), key=lambda i: (-np.floor(expected[s, i] * 1e9 + 0.5), i))
        assert places[rows == s].tolist() == order[:5]
    assert sum(scored) < 2000 * 160 / 2


def test_blocks_of_like_seeds_give_the_lists_of_all(spark, monkeypatch):
    """Seeds are cut by their categories; rows of one id that differ in them still share a list."""
    rng = np.random.default_rng(7)
    rows = _grouped(rng, 60, "track_id").drop("place").to_pylist()
    rows += [{**rows[5], "cats": ["a0", "b0"]}, {**rows[7], "track_id": None}]
    features = spark.createDataFrame([(x["track_id"], x["dense"], x["cats"]) for x in rows], "track_id long, dense array<double>, cats array<string>")
    found = []
    for slice_rows in (256, 8):
        monkeypatch.setattr(similarity, "SLICE_ROWS", slice_rows)
        for seeds in (features.filter("track_id != 5"), features):
            lists = similarity.content_top_k(similarity.as_items(features.filter("track_id != 5")), similarity.as_seeds(seeds), 4)
            found.append(sorted(((x.seed if x.seed is not None else -1), x.rank, x["item"], round(x.score, 9)) for x in lists.collect() if x["item"] is not None))
    assert found[0] == found[2] and found[1] == found[3]


def test_items_that_cannot_widen_a_range_are_not_scored(monkeypatch):
    """Centres and radii, and least and greatest values, bound the lowest cosines of a block."""
    monkeypatch.setattr(similarity, "BLOCK_ITEMS", 8)
    monkeypatch.setattr(similarity, "NEAR_ITEMS", 32)
    scored, near = [], similarity.Tile.near
    monkeypatch.setattr(similarity.Tile, "near", lambda tile, *a: scored.append((out := near(tile, *a))[1].size) or out)
    rng = np.random.default_rng(9)
    items, seeds = _grouped(rng, 2000, "item"), _grouped(rng, 48, "seed").drop("place")
    expected, tile = _scores(items, seeds), similarity.FarTile(items, seeds)
    low = np.full(48, np.inf)
    for start in range(0, 48, 16):
        part = slice(start, start + 16)
        limits = -tile.bounds(part)
        blocks = np.minimum.reduceat(expected[part][:, tile.order], tile.starts[:-1], axis=1)
        assert (limits <= blocks).all()
        tile.lowest(part, low[part])
    np.testing.assert_allclose(low, expected.min(axis=1), atol=1e-12)
    assert sum(scored) < 2000 * 48 / 2


def test_a_stored_row_holds_few_plays():
    """Items that many users play are not packed by the hundred."""
    plays = pa.RecordBatch.from_pydict(
        {"item": np.arange(400) // 3, "users": [list(range(2000))] * 400, "plays": [[1.0] * 2000] * 400, "place": np.arange(400)}
    )
    tables = list(similarity._whole_items(iter([plays.slice(0, 200), plays.slice(200)])))
    assert max(sum(map(len, table["users"].to_pylist())) for table in tables) < 80_000
    assert [x for table in tables for x in table["place"].to_pylist()] == list(range(400))
    ids = [set(table["item"].to_pylist()) for table in tables]
    assert not [1 for a, b in zip(ids, ids[1:]) if a & b]


def test_a_task_lets_go_of_what_has_passed():
    """Only one part of the passing items is held, and a block's plays once."""
    tables = iter([pa.table({"place": [i], "n": [1]}) for i in range(3)])
    passing = similarity._some(tables, lambda table: 1.0)
    import sys

    first = next(passing)
    assert sys.getrefcount(first) == 2 and not [x for x in passing.gi_frame.f_locals.values() if x is first]
    plays = similarity._Plays(pa.table({"seed": [1, 2], "users": [[5], [5, 6]], "plays": [[1.0], [2.0, 3.0]]}), "seed", True)
    users, place, _, bounds = plays.by_code
    assert plays.users is None and plays.codes is None
    assert [users[i].as_py() for i in place] == [5, 5, 6] and bounds.tolist() == [0, 1, 3]
