"""Near duplicates among vectors: a neighbour graph refined by NN-descent, and exact counts inside its groups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from melodex.llm.common import digest, hash_sample, ship
from melodex.llm.components import connected_components
from melodex.llm.vectors import exploded, pack, usable_vectors
from melodex.session import discard, materialise

ship(__name__)

NEIGHBOURS = 8  # length of a neighbour list at the start
MOST_NEIGHBOURS = 16  # of a saturated list; what goes beyond is found by comparing whole groups
FIRST_SHARE = 0.99  # chance that two vectors at the threshold share a cell of one of the random cuttings at least
CELL = 48  # vectors wished for in a cell of a cutting
CELL_BLOCK = 512  # a larger cell is dealt into blocks of about this size
REVERSE_BLOCK = 24  # vectors that list a vector, taken at a time in its local join
NODES_PER_TASK = 64  # local joins done in one call
ROUNDS = 12  # at most; they end when few entries are new
SETTLED = 0.002  # share of new entries of which there are few
GROUP_BLOCK = 512  # vectors of a group compared with each other at a time
AUDITED = 1_024  # vectors compared with all others, chosen by hash
RECALL = 0.995  # mean share of an audited vector's links that must lie inside its group
ATTEMPTS = 8
# cosines in single precision this near to the threshold are computed again
MARGIN = 1e-5


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            vectors = exploded(batch.column(1))
            largest = np.abs(vectors).max(1, keepdims=True)  # so that no square overflows or vanishes
            vectors = vectors / largest
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pack(vectors / np.linalg.norm(vectors, axis=1, keepdims=True)), batch.column(1)],
                names=["id", "unit", "vector"],
            )


def cuttings(bits: int, threshold: float) -> int:
    """How many cuttings of so many bits two vectors at the threshold need to share a cell with ``FIRST_SHARE``."""
    alike = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return 1 if alike >= FIRST_SHARE else math.ceil(math.log(1 - FIRST_SHARE) / math.log(1 - alike))


def _cell_batches(bits: int, tables: int, seed: int):
    """Adds the cell of each random cutting: the signs of the products with ``bits`` random directions."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = exploded(batch.column(1))
                directions = np.random.default_rng(seed).standard_normal((units.shape[1], tables * bits))
                signs = (units @ directions > 0).reshape(len(units), tables, bits)
                keys = signs @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pack(units.astype(np.float32)), pack(keys)], names=["node", "unit", "cells"]
                )

    return cells


def _block_neighbours(kept: int):
    """The nearest vectors of the same block for each vector of it."""

    def neighbours(block: pa.Table) -> pa.Table:
        nodes = block["node"].to_numpy()
        units = exploded(block["unit"].combine_chunks()).astype(np.float32)
        sources, targets, cosines = [], [], []
        count = min(kept, len(nodes) - 1)
        for start in range(0, len(nodes) if count > 0 else 0, 1024):
            part = units[start : start + 1024] @ units.T
            part[np.arange(len(part)), start + np.arange(len(part))] = -2
            best = np.argpartition(-part, count - 1, axis=1)[:, :count]
            sources.append(np.repeat(nodes[start : start + 1024], count))
            targets.append(nodes[best].ravel())
            cosines.append(np.take_along_axis(part, best, 1).ravel())
        return _edges(sources, targets, cosines)

    return neighbours


def _edges(sources: list, targets: list, cosines: list) -> pa.Table:
    def joined(parts: list, kind: type) -> pa.Array:
        return pa.array(np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind))

    return pa.table(
        {"src": joined(sources, np.int64), "dst": joined(targets, np.int64), "cosine": joined(cosines, np.float32)}
    )


def _local_joins(block: pa.Table) -> pa.Table:
    """Compare the vectors around each node with each other, if one of the two came there newly, and return
    the pairs that are better than the worst entry of a list."""
    block = block.sort_by([("node", "ascending"), ("part", "ascending")])
    node, part = block["node"].to_numpy(), block["part"].to_numpy()
    member, fresh, bar = block["member"].to_numpy(), block["fresh"].to_numpy(zero_copy_only=False), block["bar"].to_numpy()
    units = exploded(block["unit"].combine_chunks()).astype(np.float32)
    starts = np.nonzero(np.r_[True, (node[1:] != node[:-1]) | (part[1:] != part[:-1])])[0]
    sources, targets, cosines = [], [], []
    for start, stop in zip(starts, np.r_[starts[1:], len(node)]):
        around = slice(start, stop)
        if stop - start < 2 or not fresh[around].any():
            continue
        products = units[around] @ units[around].T
        names = member[around]
        useful = (fresh[around][:, None] | fresh[around][None, :]) & (names[:, None] != names[None, :])
        a, b = np.nonzero(useful & (products > bar[around][:, None]))
        sources.append(names[a])
        targets.append(names[b])
        cosines.append(products[a, b])
    edges = _edges(sources, targets, cosines)
    return edges.group_by(["src", "dst"]).aggregate([("cosine", "max")]).rename_columns(["src", "dst", "cosine"])


class NeighbourGraph:
    """Neighbour lists (src, dst, cosine, fresh, room): the nearest vectors found so far for every vector."""

    def __init__(self, units: DataFrame, threshold: float, seed: int):
        self.threshold = threshold
        bits = max(1, math.ceil(math.log2(max(2, units.count() / CELL))))
        placed = units.select("node", "unit").mapInArrow(
            _cell_batches(bits, cuttings(bits, threshold), seed), "node long, unit array<float>, cells array<long>"
        )
        self.placed = materialise(placed, "descent-cells")
        self.units = self.placed.select("node", "unit")
        celled = self.placed.select("node", "unit", F.posexplode("cells").alias("table", "cell"))
        crowded = celled.groupBy("table", "cell").count().filter(F.col("count") > CELL_BLOCK)
        crowded = materialise(crowded, "descent-crowded").select(
            F.col("table").alias("__table"), F.col("cell").alias("__cell"), "count"
        )
        blocks = F.coalesce(F.ceil(F.col("count") / CELL_BLOCK), F.lit(1))
        dealt = celled.join(
            crowded, (F.col("table") == F.col("__table")) & (F.col("cell") == F.col("__cell")), "left"
        ).withColumn("block", F.pmod(F.xxhash64("node", "table"), blocks))
        found = dealt.groupBy("table", "cell", "block").applyInArrow(
            _block_neighbours(NEIGHBOURS), "src long, dst long, cosine float"
        )
        found = found.select("src", "dst", "cosine", F.lit(True).alias("fresh"), F.lit(NEIGHBOURS).alias("room"))
        self.lists = materialise(self._best(found), "descent-lists")

    def _best(self, found: DataFrame) -> DataFrame:
        """The best entries of each list. A list all of whose places are links gets twice the places."""
        once = found.groupBy("src", "dst").agg(
            F.max("cosine").alias("cosine"), F.min("fresh").alias("fresh"), F.max("room").alias("room")
        )
        own = Window.partitionBy("src")
        links = F.sum((F.col("cosine") >= self.threshold).cast("int")).over(own)
        room = F.max("room").over(own)
        wider = F.when(links >= room, F.least(room * 2, F.lit(MOST_NEIGHBOURS))).otherwise(room)
        ranked = once.withColumns(
            {"room": wider, "rank": F.row_number().over(own.orderBy(F.desc("cosine"), "dst"))}
        )
        return ranked.filter(F.col("rank") <= F.col("room")).drop("rank")

    def refine(self) -> int:
        """One round: a vector's neighbours, and those it is a neighbour of, are compared with each other.

        A vector in many lists is handled in parts of bounded size, each with its own neighbours, so that a
        hub's work is spread. Returns how many list entries are new.
        """
        lists = self.lists
        bars = lists.groupBy("src").agg(
            F.when(F.count("*") >= F.max("room"), F.min("cosine")).otherwise(-2.0).cast("float").alias("bar")
        )
        listed = lists.groupBy("dst").agg(F.ceil(F.count("*") / REVERSE_BLOCK).alias("parts"))
        listed = listed.withColumnRenamed("dst", "node")
        parts = F.coalesce("parts", F.lit(1))
        listed = materialise(listed, "descent-parts")
        forward = (
            lists.select(F.col("src").alias("node"), F.col("dst").alias("member"), "fresh")
            .join(listed, "node", "left")
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        )
        backward = (
            lists.select(F.col("dst").alias("node"), F.col("src").alias("member"), "fresh")
            .join(listed, "node")
            .withColumn("part", F.pmod(F.xxhash64("member"), "parts"))
        )
        columns = ["node", "part", "member", "fresh"]
        around = forward.select(*columns).union(backward.select(*columns))
        around = around.groupBy("node", "part", "member").agg(F.max("fresh").alias("fresh"))
        known = self.units.join(bars, F.col("node") == F.col("src"), "left").select(
            F.col("node").alias("member"), "unit", F.coalesce("bar", F.lit(-2.0).cast("float")).alias("bar")
        )
        known = materialise(known, "descent-known")
        calls = around.select(F.ceil(F.count_distinct("node", "part") / NODES_PER_TASK)).first()[0] or 1
        better = (
            around.join(known, "member")
            .withColumn("call", F.pmod(F.xxhash64("node", "part"), F.lit(calls)))
            .groupBy("call")
            .applyInArrow(_local_joins, "src long, dst long, cosine float")
        )
        new = better.select("src", "dst", "cosine", F.lit(True).alias("fresh"), F.lit(NEIGHBOURS).alias("room"))
        merged = self._best(lists.withColumn("fresh", F.lit(False)).union(new))
        merged = materialise(merged, "descent-lists")
        for done in (lists, known, listed):
            discard(done)
        self.lists = merged
        return merged.filter("fresh").count()

    def links(self, units: DataFrame) -> DataFrame:
        """Pairs (a, b) at or above the threshold; near it the cosine is computed in double precision."""
        pairs = self.lists.select(
            F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "cosine"
        ).filter(F.col("cosine") >= self.threshold - MARGIN)
        sure = pairs.filter(F.col("cosine") >= self.threshold + MARGIN).select("a", "b")
        close = pairs.filter(F.col("cosine") < self.threshold + MARGIN).select("a", "b").distinct()
        left = units.select(F.col("node").alias("a"), F.col("unit").alias("unit_a"))
        right = units.select(F.col("node").alias("b"), F.col("unit").alias("unit_b"))
        close = close.join(left, "a").join(right, "b").filter(_dot("unit_a", "unit_b") >= self.threshold)
        return sure.union(close.select("a", "b")).distinct()

    def saturated(self) -> DataFrame:
        """The nodes whose lists are full of links, so that links may have had no place."""
        near = self.lists.filter(F.col("cosine") >= self.threshold - MARGIN)
        return near.groupBy(F.col("src").alias("node")).count().filter(F.col("count") >= MOST_NEIGHBOURS).select("node")

    def drop(self) -> None:
        for done in (self.lists, self.placed):
            discard(done)


def _dot(a: str, b: str):
    products = F.zip_with(F.col(a), F.col(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _audit_batches(sent, threshold: float):
    """Links of each audited vector inside and outside its group, and one pair for each group outside."""

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, groups, units = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            other, group = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for start in range(0, len(other), 4096):
                vectors = exploded(batch.column(2).slice(start, 4096))
                a, b = np.nonzero(units @ vectors.T >= threshold)
                b = b + start
                apart = nodes[a] != other[b]
                a, b = a[apart], b[apart]
                outside = groups[a] != group[b]
                pairs = {(int(nodes[x]), int(group[y])): int(other[y]) for x, y in zip(a[outside], b[outside])}
                seen = np.unique(a)
                within = np.bincount(a[~outside], minlength=len(nodes))[seen]
                beyond = np.bincount(a[outside], minlength=len(nodes))[seen]
                none = [0] * len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in pairs] + nodes[seen].tolist(), pa.int64()),
                        pa.array([*pairs.values(), *[None] * len(seen)], pa.int64()),
                        pa.array(none + within.tolist(), pa.int64()),
                        pa.array(none + beyond.tolist(), pa.int64()),
                    ],
                    names=["a", "b", "inside", "outside"],
                )

    return audit


def audit_links(grouped: DataFrame, threshold: float, seed: int = 0) -> tuple[float, DataFrame]:
    """Share of the links of some vectors that lie inside their groups, and the links found that don't.

    The vectors, a bounded number chosen by hash, are compared with all others. The share is taken per vector
    that has links, and is the mean of those: a dense group weighs by its vectors, not by its links.
    """
    spark = grouped.sparkSession
    rows = hash_sample(grouped, AUDITED, F.lit(seed), "node").collect()
    sample = (
        np.array([r["node"] for r in rows]),
        np.array([r["component"] for r in rows]),
        np.array([r["unit"] for r in rows], float),
    )
    seen = grouped.select("node", "component", "unit").mapInArrow(
        _audit_batches(spark.sparkContext.broadcast(sample), threshold),
        "a long, b long, inside long, outside long",
    )
    seen = materialise(seen, "descent-audit")
    shares = seen.filter("b is null").groupBy("a").agg((F.sum("inside") / F.sum(F.col("inside") + F.col("outside"))).alias("share"))
    recall = shares.agg(F.avg("share")).first()[0]
    missed = seen.filter("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return (1.0 if recall is None else recall), missed


def _near_groups(threshold: float):
    """Pairs of groups, of two blocks of them, whose centres and radii allow a link."""

    def pairs(block: pa.Table) -> pa.Table:
        low, high = block["low"][0].as_py(), block["high"][0].as_py()
        side, names, radius = (block[c].to_numpy() for c in ("block", "component", "radius"))
        centres = exploded(block["centre"].combine_chunks())
        left, right = np.nonzero(side == low)[0], np.nonzero(side == high)[0]
        gaps = np.arccos(np.clip(centres[left] @ centres[right].T, -1, 1))
        near = gaps <= radius[left][:, None] + radius[right][None, :] + math.acos(threshold) + 1e-6
        x, y = np.nonzero(near)
        x, y = names[left[x]], names[right[y]]
        once = x < y if low == high else x != y
        return pa.table({"x": pa.array(x[once], pa.int64()), "y": pa.array(y[once], pa.int64())})

    return pairs


def _one_link(threshold: float):
    def link(key, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = np.zeros(0, int), np.zeros(0, int)
        if left.num_rows and right.num_rows:
            products = exploded(left["unit"].combine_chunks()) @ exploded(right["other_unit"].combine_chunks()).T
            a, b = np.nonzero(products >= threshold)
            a, b = left["node"].to_numpy()[a[:1]], right["other_node"].to_numpy()[b[:1]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def links_across_groups(full: DataFrame, threshold: float, dimensions: int) -> DataFrame:
    """Links (a, b) that join the groups of nodes whose lists are full: one for each two blocks with a link.

    A link missing for want of a place has a full list at both ends, so only such nodes (node, component,
    unit) are compared, exactly, for all pairs of groups whose centres and radii allow a link.
    """
    sums = full.groupBy("component").agg(
        F.count("*").alias("members"), F.array(*[F.sum(F.get("unit", F.lit(i))) for i in range(dimensions)]).alias("sum")
    )
    length = F.sqrt(_dot("sum", "sum"))
    sums = sums.withColumn("centre", F.transform("sum", lambda x: F.when(length > 0, x / length).otherwise(0.0)))
    sums = materialise(sums.select("component", "members", "centre"), "across-sums")
    radius = F.acos(F.least(F.greatest(F.min(_dot("unit", "centre")), F.lit(-1.0)), F.lit(1.0)))
    radii = full.join(sums, "component").groupBy("component").agg(radius.alias("radius"))
    groups = materialise(sums.join(radii, "component"), "across-groups")
    blocks = max(1, math.ceil(groups.count() / GROUP_BLOCK))
    own = F.pmod(F.xxhash64("component"), F.lit(blocks))
    tiles = groups.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = tiles.withColumn("low", F.least("block", F.col("other").cast("long"))).withColumn(
        "high", F.greatest("block", F.col("other").cast("long"))
    )
    near = tiles.select("low", "high", "block", "component", "radius", "centre").groupBy("low", "high")
    near = materialise(near.applyInArrow(_near_groups(threshold), "x long, y long"), "across-near")
    chunks = groups.select("component", F.ceil(F.col("members") / GROUP_BLOCK).alias("chunks"))
    for side in ("x", "y"):
        counted = chunks.select(F.col("component").alias(side), F.col("chunks").alias(f"chunks_{side}"))
        near = near.join(counted, side)
    key = ["x", "y", "chunk_x", "chunk_y"]

    def members(mine: str, others: str) -> DataFrame:
        named = full.select(F.col("component").alias(mine), "node", "unit")
        dealt = near.join(named, mine).withColumn(f"chunk_{mine}", F.pmod(F.xxhash64("node"), f"chunks_{mine}"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"chunks_{others}") - 1))
        return dealt.withColumn(f"chunk_{others}", every).select(*key, "node", "unit")

    left, right = members("x", "y"), members("y", "x")
    named = [f"other_{name}" for name in right.columns]  # names of its own: both sides come from the same tables
    left, right = left.groupBy(*key), right.toDF(*named).groupBy(*named[: len(key)])
    return left.cogroup(right).applyInArrow(_one_link(threshold), "a long, b long")


def _block_links(threshold: float):
    def count(block: pa.Table) -> pa.Table:
        nodes, weights, chunk = (block[c].to_numpy() for c in ("node", "weight", "chunk"))
        low, high = block["low"][0].as_py(), block["high"][0].as_py()
        units = exploded(block["unit"].combine_chunks())
        left = np.nonzero(chunk == low)[0]
        right = np.nonzero(chunk == high)[0]
        linked = units[left] @ units[right].T >= threshold
        if low == high:
            np.fill_diagonal(linked, False)
            return pa.table({"node": nodes[left], "links": linked @ weights[right]})
        return pa.table(
            {
                "node": np.concatenate([nodes[left], nodes[right]]),
                "links": np.concatenate([linked @ weights[right], weights[left] @ linked]),
            }
        )

    return count


def links_inside_groups(grouped: DataFrame, threshold: float, dimensions: int) -> DataFrame:
    """(node, links): how many vectors of its group each vector links with, copies of others counted.

    If all vectors of a group lie so near to their mean that any two must link, counting them is enough. The
    other groups are compared block by block, and a block gives counts, not pairs.
    """
    sizes = grouped.groupBy("component").agg(
        F.count("*").alias("members"),
        F.sum("weight").alias("total"),
        F.array(*[F.sum(F.get("unit", F.lit(i))) for i in range(dimensions)]).alias("sum"),
    )
    sizes = materialise(sizes.filter("members > 1"), "groups-sizes")
    sized = grouped.join(sizes, "component")
    length = F.sqrt(_dot("sum", "sum"))
    spread = sized.groupBy("component").agg(F.min(_dot("unit", "sum") / length).alias("least"))
    # twice the widest angle to the mean bounds the angle of any two
    tight = 2 * F.acos(F.least(F.col("least"), F.lit(1.0))) <= math.acos(threshold) - 1e-6
    kinds = materialise(
        spread.withColumn("tight", F.coalesce(tight, F.lit(False)))
        .join(sizes, "component")
        .select("component", "tight", "members", "total"),
        "groups-kinds",
    )
    known = grouped.join(kinds, "component")
    easy = known.filter("tight").select("node", (F.col("total") - F.col("weight")).alias("links"))
    chunks = F.ceil(F.col("members") / GROUP_BLOCK)
    chunked = known.filter("not tight").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
    paired = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).select(
        "component",
        F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"),
        "chunk",
        "node",
        "weight",
        "unit",
    )
    hard = (
        paired.groupBy("component", "low", "high")
        .applyInArrow(_block_links(threshold), "node long, links long")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    return easy.union(hard)


def embedding_groups(
    rows: DataFrame,
    *,
    threshold: float = 0.9,
    id_column: str = "vec_id",
    vector: str = "embedding",
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per vector: id, ``n_links`` (other vectors at a cosine of ``threshold`` or more), ``component_id``
    (the smallest id reachable by links) and ``kept`` (whether that is its own).

    Equal vectors are one node with a weight. Random cuttings of the space give every node a first list of
    neighbours; rounds of NN-descent compare the neighbours of each node with each other and keep the best;
    lists full of links grow. Links join nodes to groups, and nodes whose lists stayed full are compared across groups.
    An audit compares a bounded sample of nodes with all vectors; the links it finds are added, and if too few
    of a node's links lay inside its group, the search starts again with other cuttings, and fails after ``ATTEMPTS``. Inside a group all links are counted, however long the lists are.

    Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
    link with nothing. Rows without an id are returned with no links and no component. Rows that share an id
    and a vector count as two vectors. Cosines are computed in double precision.
    """
    given = usable_vectors(rows, id_column, vector)
    units = given.mapInArrow(_unit_batches, "id long, unit array<double>, vector array<double>")
    units = units.select("id", "unit", F.array(*digest("vector")).alias("print"))
    units = materialise(units, "groups-units")
    nodes = units.groupBy("print").agg(
        F.min("id").alias("node"), F.count("*").alias("weight"), F.first("unit").alias("unit")
    )
    nodes = materialise(nodes, "groups-nodes")

    dimensions = nodes.select(F.size("unit")).head()
    components, links = None, None
    count = nodes.count()
    if count > 1:
        for attempt in range(ATTEMPTS):
            graph = NeighbourGraph(nodes, threshold, seed=attempt)
            for _ in range(rounds):
                if graph.refine() <= SETTLED * count * NEIGHBOURS:
                    break
            found = materialise(graph.links(nodes), "groups-links")
            full = materialise(graph.saturated(), "groups-full")
            graph.drop()
            links = found if links is None else links.union(found)
            components = materialise(connected_components(links), "groups-components")
            if not full.isEmpty():
                crowded = materialise(_grouped(nodes, components).join(full, "node"), "groups-crowded")
                across = materialise(links_across_groups(crowded, threshold, dimensions[0]), "groups-across")
                links = links.union(across)
                components = materialise(connected_components(links), "groups-components")
            recall, missed = audit_links(_grouped(nodes, components), threshold, attempt)
            if not missed.isEmpty():
                links = links.union(missed)
                components = materialise(connected_components(links), "groups-components")
            if recall >= RECALL:
                break
        else:
            raise RuntimeError(f"groups hold {recall:.4f} of the audited links after {ATTEMPTS} attempts")
    if components is None:
        components = nodes.select("node", F.col("node").alias("component")).limit(0)

    linked = _grouped(nodes, components).join(components.select("node"), "node", "left_semi")
    linked = materialise(linked, "groups-linked")
    inside = links_inside_groups(linked, threshold, dimensions[0] if dimensions else 1)
    described = materialise(
        _grouped(nodes, components)
        .join(inside, "node", "left")
        .select(
            F.col("print").alias("__print"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            "component",
        ),
        "groups-described",
    )
    counted = units.join(described, F.col("print") == F.col("__print")).select("id", "n_links", "component")
    flagged = rows.select(F.col(id_column).alias("id")).groupBy("id").count()
    used = units.groupBy("id").agg(F.count("*").alias("used"))
    # rows that took no part: those of the table less those used
    alone = flagged.join(used, "id", "left").withColumn("left", F.col("count") - F.coalesce("used", F.lit(0)))
    alone = alone.filter("left > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("left"))))
    everything = counted.union(alone.select("id", F.lit(0).cast("long"), F.col("id")))
    return everything.select(
        F.col("id").alias(id_column),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def _grouped(nodes: DataFrame, components: DataFrame) -> DataFrame:
    return nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
