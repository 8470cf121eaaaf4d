"""Dense vector arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    A column used inside a lambda would be computed again for every element the lambda visits.
    """
    return F.transform(F.array(value), body)[0]


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x * x))


def unit(a: Column) -> Column:
    """Scaled to length one; a zero vector stays zero."""

    def scaled(v: Column) -> Column:
        return let(l2_norm(v), lambda norm: F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v))

    return let(a, scaled)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; zero when either vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b)), F.lit(0.0))
