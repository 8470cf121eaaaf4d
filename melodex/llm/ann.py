"""Approximate nearest neighbours: a tree of k-means cells, searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from melodex.llm.common import hash_sample, ship
from melodex.llm.vectors import exploded, usable_vectors
from melodex.session import materialise

ship(__name__)

TRAINING_VECTORS = 8_192  # vectors the tree is fitted on, chosen by hash
BRANCHES = 8
LEAF_VECTORS = 64  # training vectors of a cell that is not divided further
CALIBRATION_QUERIES = 64  # queries whose true neighbours are computed to choose the leaf visits
RECALL = 0.96  # to be reached on them
ROWS_PER_BLOCK = 4_096  # rows of a leaf, and queries, that are compared in one task at a time
QUERIES_PER_BLOCK = 1_024


class Tree(NamedTuple):
    """Nodes in breadth-first order; a leaf has no children."""

    centres: np.ndarray  # nodes x dimensions
    children: list[list[int]]

    def leaves(self) -> list[int]:
        return [node for node, below in enumerate(self.children) if not below]


def _kmeans(points: np.ndarray, count: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    """Index of the cell of each point; cells may be empty."""
    centres = points[random.choice(len(points), count, replace=False)]
    cells = np.zeros(len(points), int)
    for _ in range(rounds):
        cells = _squares(points, centres).argmin(1)
        for c in range(count):
            if (cells == c).any():
                centres[c] = points[cells == c].mean(0)
    return cells


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, up to rounding."""
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)


def fit_tree(points: np.ndarray, leaf_vectors: int = LEAF_VECTORS) -> Tree:
    random = np.random.default_rng(5)
    centres, children, members = [points.mean(0)], [[]], [np.arange(len(points))]
    node = 0
    while node < len(members):
        inside = members[node]
        if len(inside) > leaf_vectors:
            cells = _kmeans(points[inside], BRANCHES, 8, random)
            found = [inside[cells == c] for c in range(BRANCHES) if (cells == c).any()]
            if len(found) > 1:  # equal points can't be divided
                for part in found:
                    children[node].append(len(members))
                    centres.append(points[part].mean(0))
                    children.append([])
                    members.append(part)
        node += 1
    return Tree(np.array(centres), children)


def leaf_of(points: np.ndarray, tree: Tree) -> np.ndarray:
    """Leaf of each point: from the root down to the nearest child."""
    at = np.zeros(len(points), int)
    for node, below in enumerate(tree.children):  # breadth first: a node comes before its children
        inside = np.nonzero(at == node)[0] if below else ()
        if len(inside):
            at[inside] = np.array(below)[_squares(points[inside], tree.centres[below]).argmin(1)]
    return at


def visiting_order(
    query: np.ndarray, tree: Tree, visits: int, sizes: dict[int, int] | None = None, wanted: int = 0
) -> list[int]:
    """The first leaves of a best-bin-first search: always the nearest node seen so far is opened next.

    With the rows of each leaf (``sizes``) it goes on until the leaves hold as many rows as wanted.
    """
    queue, leaves, held = [(0.0, 0)], [], 0
    while queue and (len(leaves) < visits or held < wanted):
        node = heapq.heappop(queue)[1]
        below = tree.children[node]
        if not below:
            leaves.append(node)
            held += sizes.get(node, 0) if sizes else 0
            continue
        gaps = ((tree.centres[below] - query) ** 2).sum(1)
        for gap, child in zip(gaps.tolist(), below):
            heapq.heappush(queue, (gap, child))
    return leaves


def nearest_in_block(
    query_ids: np.ndarray, queries: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its k nearest rows with another id: (query index, row index, exact distance).

    Products give the distances up to rounding; all rows that may be among the k nearest are measured again
    from the differences of the vectors.
    """
    squares = _squares(queries, rows)
    squares[query_ids[:, None] == row_ids[None, :]] = np.inf
    if rows.shape[0] > k:
        limits = np.partition(squares, k - 1, axis=1)[:, k - 1 : k]
    else:
        limits = np.full((len(queries), 1), np.inf)
    scale = (queries * queries).sum(1)[:, None] + (rows * rows).sum(1).max(initial=0.0)
    query_at, row_at = np.nonzero((squares <= limits + 1e-12 * scale) & np.isfinite(squares))
    distances = np.empty(len(query_at))
    for start in range(0, len(query_at), 65_536):
        part = slice(start, start + 65_536)
        distances[part] = np.sqrt(((queries[query_at[part]] - rows[row_at[part]]) ** 2).sum(1))
    order = np.lexsort((row_ids[row_at], distances, query_at))
    query_at, row_at, distances = query_at[order], row_at[order], distances[order]
    starts = np.searchsorted(query_at, query_at)
    kept = np.arange(len(query_at)) - starts < k
    return query_at[kept], row_at[kept], distances[kept]


def _result(query_ids, row_ids, distances, *more) -> pa.RecordBatch:
    names = ["query_id", "vec_id", "score", "leaf"]
    columns = [pa.array(query_ids, pa.int64()), pa.array(row_ids, pa.int64()), pa.array(distances, pa.float64())]
    columns += [pa.array(x, pa.int32()) for x in more]
    return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])


def _assign_batches(sent):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(*sent.value)
        for batch in batches:
            leaves = leaf_of(exploded(batch.column(1)), tree) if batch.num_rows else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.int32())], names=["id", "vector", "leaf"]
            )

    return assign


def _truth_batches(sent, k: int):
    """The k nearest rows of each calibration query inside a batch."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                block = batch.slice(start, ROWS_PER_BLOCK)
                row_ids = block.column(0).to_numpy()
                q, r, d = nearest_in_block(ids, queries, row_ids, exploded(block.column(1)), k)
                yield _result(ids[q], row_ids[r], d, block.column(2).to_numpy()[r])

    return search


def _visit_batches(sent, visits: int, sizes: dict[int, int], k: int):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(*sent.value)
        for batch in batches:
            queries = exploded(batch.column(1)) if batch.num_rows else []
            own = batch.column(2).to_pylist()  # rows that are no candidates
            orders = [visiting_order(query, tree, visits, sizes, k + n) for query, n in zip(queries, own)]
            at = np.repeat(np.arange(len(orders)), [len(o) for o in orders]) if orders else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)),
                    pa.array([leaf for order in orders for leaf in order], pa.int32()),
                ],
                names=["id", "vector", "leaf"],
            )

    return visit


def _search_blocks(k: int):
    def search(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        query_ids, row_ids = queries["id"].to_numpy(), rows["id"].to_numpy()
        query_vectors = exploded(queries["vector"].combine_chunks())
        row_vectors = exploded(rows["vector"].combine_chunks())
        found = []
        for q in range(0, len(query_ids), 256):
            for r in range(0, len(row_ids), ROWS_PER_BLOCK):
                qs, rs = slice(q, q + 256), slice(r, r + ROWS_PER_BLOCK)
                a, b, d = nearest_in_block(query_ids[qs], query_vectors[qs], row_ids[rs], row_vectors[rs], k)
                found.append(_result(query_ids[qs][a], row_ids[rs][b], d))
        return pa.Table.from_batches(found, schema)

    return search


def _k_nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def leaf_visits(leaves: DataFrame, queries: DataFrame, tree: Tree, sent, k: int, recall: float) -> int:
    """The fewest leaf visits that find the wished share of the true neighbours of some queries.

    The true neighbours come from comparing a bounded number of queries, chosen by hash, with all rows.
    """
    chosen = hash_sample(queries, CALIBRATION_QUERIES, "id").collect()
    if not chosen:
        return 1
    ids, vectors = np.array([row["id"] for row in chosen]), np.array([row["vector"] for row in chosen], float)
    truth = leaves.mapInArrow(
        _truth_batches(leaves.sparkSession.sparkContext.broadcast((ids, vectors)), k),
        "query_id long, vec_id long, score double, leaf int",
    )
    wanted: dict[int, list[int]] = {}
    for row in _k_nearest(truth, k).select("query_id", "leaf").collect():
        wanted.setdefault(row["query_id"], []).append(row["leaf"])
    orders = {int(i): visiting_order(v, tree, len(tree.children)) for i, v in zip(ids, vectors)}
    places = np.sort([orders[query].index(leaf) for query, found in wanted.items() for leaf in found])
    if not len(places):
        return 1
    # widened until so many of the true neighbours lie in the leaves visited
    return int(places[min(len(places), math.ceil(recall * len(places))) - 1]) + 1


def nearest_neighbours(
    rows: DataFrame,
    queries: DataFrame,
    *,
    k: int = 10,
    id_column: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
    training_vectors: int = TRAINING_VECTORS,
) -> DataFrame:
    """The ``k`` nearest rows found for each query: query_id, rank (from 1), vec_id, score (Euclidean distance).

    A tree of k-means cells is fitted on about ``training_vectors`` rows, chosen by hash; every row goes
    into the leaf reached by always taking the nearest child. A query visits leaves in the order of a
    best-bin-first search, as many as a calibration on some queries needs for ``recall``, and on until they hold
    ``k`` candidates, if there are so many. Rows of a leaf are dealt
    into blocks of bounded size, and each block is compared with blocks of queries, so a leaf that holds a
    third of all rows is many tasks. Distances are exact and ties go to the smaller id. A row whose id is the
    query's own is no candidate. Vectors that are null, empty, zero, hold null or non-finite components, or have another
    length than most take no part; neither do rows without an id. Equal rows are each found.
    """
    spark = rows.sparkSession
    given = usable_vectors(rows, id_column, vector)
    given = materialise(given, "ann-rows")
    asked = usable_vectors(queries, id_column, vector)
    sample = hash_sample(given, training_vectors, "id").orderBy("id").select("vector").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(np.array([row["vector"] for row in sample], float))
    sent = spark.sparkContext.broadcast(tuple(tree))
    pair = "id long, vector array<double>, leaf int"
    leaves = materialise(given.mapInArrow(_assign_batches(sent), pair), "ann-leaves")
    visits = leaf_visits(leaves, asked, tree, sent, k, recall)

    # one row per leaf: at most as many as training vectors
    sizes = {row["leaf"]: row["count"] for row in leaves.groupBy("leaf").count().collect()}
    same = leaves.join(asked.select("id").distinct(), "id", "left_semi").groupBy(F.col("id").alias("__id"))
    same = materialise(same.agg(F.count("*").alias("own")), "ann-own")
    asked = asked.select("id", "vector").join(same, F.col("id") == F.col("__id"), "left")
    asked = asked.select("id", "vector", F.coalesce("own", F.lit(0).cast("long")).alias("own"))
    visited = materialise(asked.mapInArrow(_visit_batches(sent, visits, sizes, k), pair), "ann-visits")
    rows_in = _blocks(leaves, ROWS_PER_BLOCK, "row_blocks")
    queries_in = _blocks(visited, QUERIES_PER_BLOCK, "query_blocks")
    counts = rows_in.join(queries_in, "leaf")  # one row per leaf: at most as many as training vectors
    counts = F.broadcast(materialise(counts, "ann-blocks"))
    hashed = F.xxhash64("id")
    query_side = (
        visited.join(counts, "leaf")
        .withColumn("query_block", F.pmod(hashed, "query_blocks"))
        .withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)))
    )
    row_side = (
        leaves.join(counts, "leaf")
        .withColumn("row_block", F.pmod(hashed, "row_blocks"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)))
    )
    block = ["leaf", "row_block", "query_block"]
    found = (
        query_side.select("id", "vector", *block)
        .groupBy(*block)
        .cogroup(row_side.select("id", "vector", *block).groupBy(*block))
        .applyInArrow(_search_blocks(k), "query_id long, vec_id long, score double")
    )
    return _k_nearest(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _blocks(df: DataFrame, size: int, out: str) -> DataFrame:
    return df.groupBy("leaf").agg(F.ceil(F.count("*") / size).cast("long").alias(out))
