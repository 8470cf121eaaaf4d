"""Column expressions shared by the rankers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores that agree to nine decimals rank as equal and fall back to the item id, so that the order of
# a floating point sum cannot change a ranking.
RANK_SCALE = 1e9

# The guard in min-max normalisation and the steps of the diversity setting.
MINMAX_EPSILON = 1e-8
DIVERSITY_STEPS = range(1, 10)


# beyond this a double has no nine decimals left, and ranks as it is
RANK_LIMIT = 4e6


def rank_key(score: Column) -> Column:
    rounded = F.floor(score * F.lit(RANK_SCALE) + F.lit(0.5)).cast("double") / F.lit(RANK_SCALE)
    return F.when(F.abs(score) < RANK_LIMIT, rounded).otherwise(F.nanvl(score, F.lit(None)))


def check_k(k: int, label: str = "k") -> int:
    if k <= 0:
        if label == "k":
            raise ValueError(f"k must be a positive integer, got {k}")
        raise ValueError(f"{label} must be positive, got {k}")
    return int(k)


def check_weight(weight: float) -> float:
    if not 0.0 <= weight <= 1.0:
        raise ValueError(f"weight_content must lie in [0, 1], got {weight}")
    return float(weight)


def diversity_weight(diversity: int) -> float:
    """Weight of the content score at a diversity setting of 1 to 9."""
    if diversity not in DIVERSITY_STEPS:
        raise ValueError(f"diversity must be 1 to 9, got {diversity}")
    return 1 - diversity / 10


def diversity_weight_column(diversity: Column) -> Column:
    return F.lit(1.0) - diversity / F.lit(10.0)
