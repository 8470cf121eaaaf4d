"""Offline evaluation of the three recommenders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from melodex.operators.metrics import K_VALUES, combined, evaluate, seed_per_user
from melodex.operators.split import check_testable, rows_of_users, sample_users, top_half_holdout
from melodex.plans.recommend import EVALUATED_K, collab_lists, content_lists, hybrid_lists
from melodex.session import materialise


@dataclass(frozen=True)
class Evaluation:
    """``metrics`` has one row per model and k, ``run`` one row about the data."""

    metrics: DataFrame
    run: DataFrame


def held_out(interactions: DataFrame, sample: int | None = None, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, test), the test rows of ``sample`` users if a number is given. Plays of zero do not count.

    The split is written once: seeds, relevant items and counts all read it.
    """
    played = interactions.filter("playcount > 0")
    if check:
        check_testable(played)
    marked = materialise(top_half_holdout(played), "split")
    train, test = marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
    if sample is not None:
        test = rows_of_users(test, sample_users(test, sample))
    return train, test


def _described(
    interactions: DataFrame, train: DataFrame, test: DataFrame, user_seeds: DataFrame, ks: Sequence[int]
) -> DataFrame:
    return interactions.agg(
        F.count_distinct("user_id").alias("n_users_total"), F.count_distinct("track_id").alias("n_items")
    ).select(
        "*",
        train.agg(F.count("*")).scalar().alias("n_train_interactions"),
        test.agg(F.count("*")).scalar().alias("n_test_interactions"),
        user_seeds.agg(F.count("*")).scalar().alias("sampled_users"),
        F.array(*[F.lit(k) for k in ks]).alias("k_values"),
    )


def describe_run(
    interactions: DataFrame, sample: int | None = None, ks: Sequence[int] = K_VALUES, seed_rule: str = "track_id"
) -> DataFrame:
    """The row that ``run_evaluation`` gives about the data, without ranking anything."""
    train, test = held_out(interactions, sample)
    return _described(interactions, train, test, seed_per_user(test, seed_rule), ks)


def run_evaluation(
    features: DataFrame,
    interactions: DataFrame,
    sample: int | None = None,
    ks: Sequence[int] = K_VALUES,
    depth: int = EVALUATED_K,
    weight_content: float = 0.5,
    fit_on: str = "all",
    seed_rule: str = "track_id",
    exclude_seed_from_relevant: bool = False,
) -> Evaluation:
    """Evaluate all three models; every distinct seed is ranked once, whatever the number of its users.

    ``fit_on='all'`` ranks with all interactions, held-out ones included; ``'train'`` leaves them out.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', got {fit_on!r}")
    train, test = held_out(interactions, sample)
    known = train if fit_on == "train" else interactions
    user_seeds = seed_per_user(test, seed_rule)
    seeds = user_seeds.select(F.col("seed").alias("track_id")).distinct()
    lists = {
        "content_based": content_lists(features, seeds, depth),
        "collaborative": collab_lists(known, seeds, depth),
        "hybrid": hybrid_lists(features, known, seeds, depth, weight_content),
    }
    metrics = combined(
        {
            name: evaluate(name, ranked, test, user_seeds, ks, exclude_seed_from_relevant)
            for name, ranked in lists.items()
        }
    )
    run = _described(interactions, train, test, user_seeds, ks)
    return Evaluation(metrics, run)
