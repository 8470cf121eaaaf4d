"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from melodex.llm.common import WORD_PATTERN, root_of, total_before
from melodex.session import materialise

# quality weights are put into this many classes to draw the bucket borders; the order itself uses the weight
WEIGHT_CLASSES = 8
LEAST_WEIGHT = 1.0 / 1024


class Mix(NamedTuple):
    rows: DataFrame  # one row per document: id, size, source_size, target, taken, source, copies
    sources: DataFrame  # one row per source: size, target, whole epochs and the last key of the fraction


def sampling_key(id_column: str, weight: Column, seed: int) -> Column:
    """Exponential key of Efraimidis and Spirakis: the smallest keys are a weighted sample."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column)), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(uniform) / weight


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shares: Sequence[float] = (5.0, 2.0, 1.0),
    budget: float = 1.5,
    max_epochs: int = 2,
    seed: int = 17,
) -> Mix:
    """Decide how often each document is used, so that each source's words come near its target.

    Sources in code point order, null last, get ``shares`` in turn; together they share ``budget`` times all
    words. A target stops at ``max_epochs`` times its source; the excess goes to the others by share. A source
    is used whole as often as its target allows. What is left is filled by documents in ascending order of
    their exponential key, which is divided by the document's weight, until the budget is reached; the document
    that crosses it is used if at least half of it fits.

    ``weights`` (id, ``weight``): quality weights in (0, 1], one row per id; missing, null or out of range
    count as 1 or the nearest bound. Null and empty texts have size 0 and are never taken. Rows of one id share
    a key; they are taken one by one here, but all together by ``mixed_documents``, which knows keys only. A null
    source is a source. No rows in, no rows out.
    """
    slim = docs.select(
        F.col(id_column).alias("id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
    )
    slim = materialise(_weighted(slim, "id", weights), "mix-rows")
    sources = materialise(_targets(slim, shares, budget, max_epochs), "mix-sources")

    keyed = (
        slim.withColumn("key", sampling_key("id", F.col("weight"), seed))
        .join(sources.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("bucket", _bucket())
    )
    placed = total_before(keyed, ["code"], "bucket", ["key", "id", "size"], F.col("size"), "before")
    more = (F.col("rest") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("rest"))
    copies = F.when(F.col("size") > 0, F.col("epochs") + more.cast("int")).otherwise(0)
    rows = placed.withColumn("copies", copies).withColumn(
        "taken", F.col("size") * F.col("copies")
    )
    cuts = (
        rows.filter(more)
        .groupBy("code")
        .agg(F.max(F.struct("key", "id")).alias("cut"))
        .withColumnRenamed("code", "__code")
    )
    sources = sources.join(cuts, F.col("code") == F.col("__code"), "left").drop("__code")
    wanted = ["id", "size", "source_size", "target", "taken", "source", "copies"]
    return Mix(
        rows.select(*wanted).withColumnRenamed("id", id_column),
        sources.select("source", "source_size", "target", "epochs", "cut"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 17,
    **options,
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix uses it.

    A document is in the fraction when its key is not above the last key of its source, so the texts are
    matched with one small row per source instead of one row per document.
    """
    mix = mix_sources(docs, weights, id_column=id_column, text=text, source=source, seed=seed, **options)
    cuts = materialise(mix.sources, "mix-cuts").select(
        F.col("source").alias("__source"), F.col("epochs").alias("__epochs"), F.col("cut").alias("__cut")
    )
    columns = docs.columns
    key = F.struct(sampling_key(id_column, F.col("__weight"), seed).alias("key"), F.col(id_column).alias("id"))
    copies = F.col("__epochs") + F.coalesce(key <= F.col("__cut"), F.lit(False)).cast("int")
    return (
        _weighted(docs, id_column, weights, "__weight")
        .join(cuts, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("__copies", F.when(F.regexp_like(F.col(text), F.lit(WORD_PATTERN)), copies).otherwise(0))
        .filter("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*columns)
    )


def _weighted(df: DataFrame, id_column: str, weights: DataFrame | None, out: str = "weight") -> DataFrame:
    if weights is None:
        return df.withColumn(out, F.lit(1.0))
    bounded = F.least(F.greatest(F.col("weight").cast("double"), F.lit(LEAST_WEIGHT)), F.lit(1.0))
    # built as a hash table, so that the texts beside it need no sort
    side = weights.select(F.col("id").alias("__id"), bounded.alias("__bounded")).hint("shuffle_hash")
    return (
        df.join(side, F.col(id_column) == F.col("__id"), "left")
        .withColumn(out, F.coalesce("__bounded", F.lit(1.0)))
        .drop("__id", "__bounded")
    )


def _weight_class(weight: Column) -> Column:
    return F.least(F.greatest(F.round(weight * WEIGHT_CLASSES), F.lit(1)), F.lit(WEIGHT_CLASSES)).cast("int")


def _bucket() -> Column:
    """Bucket that rises with the key: the share of keys expected below it, times the bucket count."""
    below = sum(
        (F.col(f"class{c}") * (1 - F.exp(-F.col("key") * (c / WEIGHT_CLASSES))) for c in range(1, WEIGHT_CLASSES + 1)),
        F.lit(0.0),
    )
    buckets = root_of(F.col("rows"))
    return F.least(F.floor(below / F.col("rows") * buckets), buckets - 1)


def _targets(slim: DataFrame, shares: Sequence[float], budget: float, max_epochs: int) -> DataFrame:
    """One row per source; a window over them all, as their order is over them all."""
    classes = [
        F.sum((_weight_class(F.col("weight")) == c).cast("long")).alias(f"class{c}")
        for c in range(1, WEIGHT_CLASSES + 1)
    ]
    everything = Window.partitionBy(F.lit(0))
    share = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), (F.col("code") % len(shares) + 1).cast("int"))
    sources = (
        slim.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"), *classes)
        .withColumn("code", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("share", share)
        .withColumn("limit", F.col("source_size").cast("double") * max_epochs)
    )
    # sources that reach their limit first come first: those at their limit are then a run at the start
    first = everything.orderBy(F.col("limit") / F.col("share"), "code").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(
        F.sum("limit").over(first), F.lit(0.0)
    )
    others = F.sum("share").over(everything) - F.coalesce(F.sum("share").over(first), F.lit(0.0))
    sources = sources.withColumn("level", left / others)
    # the level of the first source that stays below its limit holds for all that do
    free = F.when(
        F.col("limit") > F.col("level") * F.col("share"), F.struct(F.col("limit") / F.col("share"), "code", "level")
    )
    sources = sources.withColumn("level", F.min(free).over(everything)["level"])
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("share"), F.col("limit")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        sources.withColumn("target", target)
        .withColumn("epochs", epochs.cast("int"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .drop("limit", "level", "share")
    )
