"""Operators on vectors against brute force, and on vectors that take no part."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from melodex.llm.ann import fit_tree, leaf_of, nearest_neighbours, visiting_order
from melodex.llm.embed_dedup import embedding_groups

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, matrix, first=0):
    rows = [(first + i, [float(x) for x in row]) for i, row in enumerate(np.asarray(matrix, np.float32))]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]),
        (1, [2.0, 0.0]),
        (2, None),
        (3, []),
        (4, [0.0, 0.0]),
        (5, [nan, 1.0]),
        (6, [inf, 1.0]),
        (7, [None, 1.0]),
        (8, [1.0, 0.0, 0.0]),
        (9, [0.0, 1.0]),
        (100, [0.0, 1.0]),
        (100, [0.0, 1.0]),
        (None, [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "node", "unit", "weight", "component", "leaf", "vector", "label"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def clusters(seed=4):
    """Tight and loose groups, exact copies, chains at the threshold, and vectors of their own."""
    draw = np.random.default_rng(seed)
    parts = [draw.standard_normal((600, 16))]
    for size, spread in ((300, 0.05), (120, 0.25), (40, 0.1), (2, 0.05), (2, 0.2)):
        centre = draw.standard_normal(16)
        parts.append(centre / np.linalg.norm(centre) + spread * draw.standard_normal((size, 16)) / 4)
    parts.append(np.repeat(draw.standard_normal((1, 16)), 50, axis=0))
    angles = np.arange(12) * 0.4  # neighbours of the chain link, others don't
    chain = np.zeros((12, 16))
    chain[:, 0], chain[:, 1] = np.cos(angles), np.sin(angles)
    parts.append(chain)
    matrix = np.concatenate(parts).astype(np.float32)
    return matrix[draw.permutation(len(matrix))]


def plain_groups(matrix, threshold):
    units = matrix.astype(float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    linked = units @ units.T >= threshold
    np.fill_diagonal(linked, False)
    group = np.arange(len(units))
    while True:
        least = np.array([min(group[i], *group[linked[i]]) if linked[i].any() else group[i] for i in range(len(units))])
        if (least == group).all():
            return linked.sum(1), group
        group = least


def test_groups_equal_brute_force(spark):
    matrix = clusters()
    rows = embedding_groups(table(spark, matrix)).collect()
    links, groups = plain_groups(matrix, 0.9)
    assert len(rows) == len(matrix)
    wrong = [r for r in rows if (r.n_links, r.component_id) != (links[r.vec_id], groups[r.vec_id])]
    assert len(wrong) <= 0.02 * len(matrix)
    assert sum(r.n_links for r in rows) >= 0.99 * links.sum()
    assert all(r.n_links <= links[r.vec_id] and r.kept == (r.vec_id == r.component_id) for r in rows)


def test_groups_of_awkward_vectors(spark):
    rows = embedding_groups(awkward(spark)).collect()
    assert len(rows) == 13
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in rows if r.vec_id is not None)
    assert found == [
        (0, 1, 0),
        (1, 1, 0),
        *((i, 0, i) for i in range(2, 9)),
        (9, 2, 9),
        (100, 2, 9),
        (100, 2, 9),
    ]
    nameless = [r for r in rows if r.vec_id is None]
    assert [(r.n_links, r.component_id, r.kept) for r in nameless] == [(0, None, False)]
    assert embedding_groups(awkward(spark).limit(0)).collect() == []


def test_search_reaches_its_recall(spark):
    matrix = clusters(9)
    rows = table(spark, matrix)
    got = nearest_neighbours(rows, rows.filter("vec_id % 10 = 0"), k=10, training_vectors=500).collect()
    points, hits, total = matrix.astype(float), 0, 0
    for query in range(0, len(points), 10):
        distances = np.sqrt(((points - points[query]) ** 2).sum(1))
        distances[query] = np.inf
        found = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        assert all(abs(r.score - distances[r.vec_id]) < 1e-12 for r in found)
        limit = np.sort(distances)[9]
        hits, total = hits + sum(r.score <= limit + 1e-12 for r in found), total + 10
    assert hits / total >= 0.9


def test_search_of_awkward_vectors(spark):
    df = awkward(spark)
    rows = nearest_neighbours(df, df.filter("vec_id % 100 = 0"), k=10).collect()
    zero = [(r["rank"], r.vec_id, r.score) for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 0]
    assert [z[1] for z in zero] == [1, 9, 100, 100] and zero[0][2] == 1.0
    assert {r.vec_id for r in rows if r.query_id == 100} == {0, 1, 9}
    nothing = df.limit(0)
    assert nearest_neighbours(nothing, nothing).collect() == []


def test_tree_search_visits_every_leaf_once():
    points = clusters(1).astype(float)
    tree = fit_tree(points, 32)
    order = visiting_order(points[5], tree, len(tree.children))
    assert sorted(order) == sorted(tree.leaves())
    assert set(leaf_of(points, tree)) <= set(tree.leaves())
    assert visiting_order(points[5], tree, 3) == order[:3]
