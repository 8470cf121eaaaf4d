"""Searches among leaves of few rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from melodex.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def test_lists_are_full_where_leaves_are_small(spark, monkeypatch):
    draw = np.random.default_rng(2)
    tight = np.repeat(10 * draw.standard_normal((5, 8)), 100, axis=0) + 0.01 * draw.standard_normal((500, 8))
    matrix = np.concatenate([tight, 100 * draw.standard_normal((40, 8))])
    rows = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], SCHEMA)
    monkeypatch.setattr(ann, "leaf_visits", lambda *args: 1)  # as where the calibration meets copies only
    queries = rows.filter(F.col("vec_id") % 20 == 0)
    found = Counter(r.query_id for r in ann.nearest_neighbours(rows, queries, k=10).collect())
    assert found == {i: 10 for i in range(0, 540, 20)}
    short = ann.nearest_neighbours(rows.limit(4), rows.filter("vec_id = 1"), k=10).collect()
    assert {r.vec_id for r in short} == {0, 2, 3}
