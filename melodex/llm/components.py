"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from melodex.session import discard, materialise

MOST_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node each node of ``links`` (a, b) can reach: one row (node, component) per node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest
    neighbour, then its smaller neighbours to the smallest of them. Each step is a grouped minimum and a join
    whose hot side Spark can split, and each round is stored, so a lost executor costs one round at most.
    Links to itself and repeated links are allowed; a null end drops the link.
    """
    stars = _ordered(links.select("a", "b"))
    stars = materialise(stars, "stars")
    before = None
    for _ in range(MOST_ROUNDS):
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        following = materialise(_small_star(_large_star(stars)), "stars")
        discard(stars)
        stars = following
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = stars.select(F.col("small").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("big").alias("node"), F.col("small").alias("component")).union(roots)


def _ordered(links: DataFrame) -> DataFrame:
    """Links as (big, small), each once, without loops."""
    return (
        links.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"), "a", "b")
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select("big", "small")
        .distinct()
    )


def _stored(least: DataFrame) -> DataFrame:
    """Stored ahead of the join with it, so that Spark can split the rows of a node with very many neighbours."""
    return materialise(least, "star-least")


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.select(F.col("big").alias("u"), F.col("small").alias("v")).union(
        stars.select(F.col("small").alias("u"), F.col("big").alias("v"))
    )
    least = _stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    # big is the larger neighbour of small
    moved = stars.select(F.col("small").alias("u"), F.col("big").alias("v")).join(least, "u")
    return _ordered(moved.select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(stars: DataFrame) -> DataFrame:
    least = _stored(stars.groupBy(F.col("big").alias("u")).agg(F.min("small").alias("m")))
    moved = stars.select(F.col("big").alias("u"), F.col("small").alias("v")).join(least, "u")
    return _ordered(
        moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    )
