"""Precision, recall, NDCG and average precision of ranked lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The cut-offs of the report and the metrics in its order.
K_VALUES = (5, 10, 20)
METRICS = ("precision", "recall", "ndcg", "ap")


def seed_per_user(relevant: DataFrame, by: str = "track_id") -> DataFrame:
    """(user_id, seed): the smallest relevant track, or the one played most (``by='top_playcount'``)."""
    users = relevant.groupBy("user_id")
    if by == "track_id":
        return users.agg(F.min("track_id").alias("seed"))
    if by == "top_playcount":
        best = F.min(F.struct(-F.col("playcount"), F.col("track_id").alias("track_id")))
        return users.agg(best["track_id"].alias("seed"))
    raise ValueError(f"unknown seed rule {by!r}")


def hits(user_seeds: DataFrame, relevant: DataFrame, lists: DataFrame, depth: int) -> DataFrame:
    """(user_id, item, rank, hit_no, is_first) of the recommended items that are relevant.

    Relevant rows look their own item up in the seed's list, so a user adds as many rows as there are
    relevant items, and a list is not copied to each of its users. An item may occur more than once in a
    list; ``is_first`` marks its best rank.
    """
    listed = lists.filter(F.col("rank") <= depth).select("seed", "item", "rank")
    repeats = Window.partitionBy("seed", "item")
    listed = listed.withColumn("is_first", F.col("rank") == F.min("rank").over(repeats))
    found = (
        relevant.select("user_id", F.col("track_id").alias("item"))
        .distinct()
        .join(user_seeds, "user_id")
        .join(listed, ["seed", "item"])
    )
    # at most ``depth`` rows per user
    in_list = Window.partitionBy("user_id").orderBy("rank")
    return found.select("user_id", "item", "rank", F.row_number().over(in_list).alias("hit_no"), "is_first")


def _ideal_gain(n_relevant: Column, k: int) -> Column:
    gains, total = [0.0], 0.0
    for rank in range(1, k + 1):
        total += 1.0 / log2(rank + 1)
        gains.append(total)
    return F.element_at(
        F.array(*[F.lit(g) for g in gains]), (F.least(n_relevant, F.lit(k)) + 1).cast("int")
    )


def user_metrics(
    user_seeds: DataFrame, relevant: DataFrame, lists: DataFrame, ks: Sequence[int] = K_VALUES
) -> DataFrame:
    """(user_id, k, precision, recall, ndcg, ap) of every user with relevant items.

    Users whose seed has no list, or whose list holds nothing relevant, score 0.
    """
    found = hits(user_seeds, relevant, lists, max(ks, default=0))
    aggregates = []
    for k in ks:
        within = F.col("rank") <= k
        aggregates += [
            F.count_if(within & F.col("is_first")).alias(f"hits_{k}"),
            F.sum(F.when(within, 1.0 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"gain_{k}"),
            F.sum(F.when(within, F.col("hit_no") / F.col("rank")).otherwise(0.0)).alias(f"precisions_{k}"),
        ]
    per_user = found.groupBy("user_id").agg(*aggregates)
    relevant_counts = (
        relevant.select("user_id", "track_id").distinct().groupBy("user_id").agg(F.count("*").alias("n_relevant"))
    )
    joined = relevant_counts.join(per_user, "user_id", "left").na.fill(0)
    rows = []
    for k in ks:
        size = F.lit(float(k)) if k else F.lit(None).cast("double")
        reachable = F.least(F.col("n_relevant"), F.lit(k)).cast("double")
        values = {
            "precision": F.col(f"hits_{k}") / size,
            "recall": F.col(f"hits_{k}") / F.col("n_relevant").cast("double"),
            "ndcg": F.try_divide(f"gain_{k}", _ideal_gain(F.col("n_relevant"), k)),
            "ap": F.try_divide(F.col(f"precisions_{k}"), reachable),
        }
        rows.append(
            F.struct(F.lit(k).alias("k"), *[F.coalesce(v, F.lit(0.0)).alias(m) for m, v in values.items()])
        )
    return joined.select("user_id", F.inline(F.array(*rows)))


def mean_metrics(per_user: DataFrame, model: str) -> DataFrame:
    """(model, k, precision, recall, ndcg, ap) over all users."""
    return (
        per_user.groupBy("k")
        .agg(*[F.avg(m).alias(m) for m in METRICS])
        .select(F.lit(model).alias("model"), "k", *METRICS)
    )


def evaluate(
    model: str,
    lists: DataFrame,
    relevant: DataFrame,
    user_seeds: DataFrame | None = None,
    ks: Sequence[int] = K_VALUES,
    exclude_seed_from_relevant: bool = False,
) -> DataFrame:
    """Mean metrics of one model's lists (seed, item, rank). By default the seed counts as relevant though it
    is never recommended."""
    seeds = seed_per_user(relevant) if user_seeds is None else user_seeds
    if exclude_seed_from_relevant:
        relevant = relevant.join(seeds.withColumnRenamed("seed", "track_id"), ["user_id", "track_id"], "left_anti")
    return mean_metrics(user_metrics(seeds, relevant, lists, ks), model)


def combined(reports: Mapping[str, DataFrame]) -> DataFrame:
    """Reports of several models below each other, under the mapping's names."""
    return reduce(
        DataFrame.unionByName, [report.withColumn("model", F.lit(name)) for name, report in reports.items()]
    )


def flat_metrics(report: DataFrame, prefix: str = "") -> DataFrame:
    """(metric, value) with names such as ``content_based_precision_at_k5``."""
    long = report.unpivot(["model", "k"], list(METRICS), "metric", "value")
    name = F.concat(
        F.lit(prefix), "model", F.lit("_"), "metric", F.lit("_at_k"), F.col("k").cast("string")
    )
    return long.select(name.alias("metric"), "value")
