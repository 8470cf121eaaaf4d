"""Feature encoding of the catalogue.

Fitting gives small parameter tables; transforming turns every track into

* ``dense``  -- array<double>: frequencies, TF-IDF weights, standard and min-max scaled columns, the rest;
* ``cats``   -- array<string>: one entry per one-hot column, null where the value was not seen in fitting.

The one-hot columns are never widened: the dot product of two one-hot blocks is 1 where the categories are
equal and known, else 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.functions.text import WORD_PATTERN, words
from melodex.functions.vectors import let, unit
from melodex.operators.ranking import dictionary


# Which columns get which encoding, and the size of the tag vocabulary.
@dataclass(frozen=True)
class EncoderSpec:
    key: str = "track_id"
    frequency: Sequence[str] = ("year",)
    onehot: Sequence[str] = ("artist", "time_signature", "key")
    tfidf: str = "tags"
    max_features: int = 85
    standard: Sequence[str] = ("duration_ms", "loudness", "tempo")
    minmax: Sequence[str] = (
        "danceability",
        "energy",
        "speechiness",
        "acousticness",
        "instrumentalness",
        "liveness",
        "valence",
    )
    # numeric columns taken as they are; None: every numeric column not named above
    passthrough: Sequence[str] | None = None
    # "frequency" or "raw" (the year itself)
    year_encoding: str = "frequency"
    # null, NaN and infinite numbers: "keep" them (the rankers refuse such vectors) or "impute" the fitted mean
    # (standard), the middle of the fitted range (min-max), 0 (columns taken as they are)
    missing: str = "keep"
    word_pattern: str = WORD_PATTERN

    def rest(self, df: DataFrame) -> list[str]:
        if self.passthrough is not None:
            return list(self.passthrough)
        named = {self.key, self.tfidf, *self.frequency, *self.onehot, *self.standard, *self.minmax}
        return [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in named
        ]


def category(column: str) -> Column:
    """Text form of a category; a missing value is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def _column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), category(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def fit_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, frequency): share of the rows holding the value."""
    n = df.agg(F.count("*")).scalar()
    return (
        _column_values(df, columns)
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .select("column", "value", (F.col("n").cast("double") / n).alias("frequency"))
    )


def fit_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of every category seen."""
    return _column_values(df, columns).distinct()


def fit_vocabulary(df: DataFrame, text: str, max_features: int, pattern: str = WORD_PATTERN) -> DataFrame:
    """(term, idx, corpus_tf, df, idf) of the terms most frequent in the corpus; ties by term.

    A document gives every word once for the corpus and every term once for itself. Both are summed per term
    ahead of the shuffle, which carries no row per document.
    """

    def counted(terms: Column, tf: int, df: int) -> Column:
        return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(tf).alias("tf"), F.lit(df).alias("df")))

    uses = let(words(F.col(text), pattern), lambda w: F.concat(counted(w, 1, 0), counted(F.array_distinct(w), 0, 1)))
    best = (
        df.select(F.inline(uses))
        .groupBy("term")
        .agg(F.sum("tf").alias("corpus_tf"), F.sum("df").alias("df"))
        .orderBy(F.desc("corpus_tf"), "term")
        .limit(max_features)
    )
    # at most max_features rows, so one window over all of them
    idf = F.log((1 + df.agg(F.count("*")).scalar()).cast("double") / (1 + F.col("df"))) + 1
    return best.select(
        "term", (F.row_number().over(Window.orderBy("term")) - 1).alias("idx"), "corpus_tf", "df", idf.alias("idf")
    )


def tfidf_weights(
    df: DataFrame, vocabulary: DataFrame, key: str, text: str, pattern: str = WORD_PATTERN
) -> DataFrame:
    """(key, term, weight) with unit length per document, as rows: for long documents.

    Words outside the vocabulary leave before documents are grouped.
    """
    known = F.broadcast(vocabulary.select("term", "idf"))  # at most max_features rows
    terms = df.select(key, F.explode(words(F.col(text), pattern)).alias("term")).join(known, "term")
    raw = terms.groupBy(key, "term").agg((F.count("*") * F.max("idf")).alias("raw"))
    # at most max_features rows per document
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / norm).alias("weight"))


def finite(column: str) -> Column:
    """The number as a double; null where it is null, NaN or infinite."""
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)  # NaN compares as larger


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std) of the finite values, with the population deviation."""
    rows = [
        F.struct(F.lit(c).alias("column"), F.avg(finite(c)).alias("mean"), F.stddev_pop(finite(c)).alias("std"))
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, low, high) of the finite values."""
    rows = [
        F.struct(F.lit(c).alias("column"), F.min(finite(c)).alias("low"), F.max(finite(c)).alias("high"))
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def fit_encoder(df: DataFrame, spec: EncoderSpec = EncoderSpec()) -> dict[str, DataFrame]:
    """Parameter tables of the encoder. All are lazy; persist them to fit once."""
    return {
        "frequency": fit_frequency(df, spec.frequency),
        "categories": fit_categories(df, spec.onehot),
        "vocabulary": fit_vocabulary(df, spec.tfidf, spec.max_features, spec.word_pattern),
        "standard": fit_standard(df, spec.standard),
        "minmax": fit_minmax(df, spec.minmax),
    }


def _with_parameters(df: DataFrame, name: str, table: DataFrame, fields: Sequence[str]) -> DataFrame:
    """A table of one row per scaled column as a map in every row, from one scalar subquery."""
    entries = F.collect_list(F.struct("column", F.struct(*fields)))
    return df.withColumn(name, table.agg(F.map_from_entries(entries)).scalar())


def _standard_scaled(column: str) -> Column:
    fitted = F.col("_standard")[column]
    return F.when(fitted["std"] > 0, (F.col(column) - fitted["mean"]) / fitted["std"]).otherwise(F.lit(0.0))


def _minmax_scaled(column: str) -> Column:
    fitted = F.col("_minmax")[column]
    width = fitted["high"] - fitted["low"]
    return (F.col(column) - fitted["low"]) / F.when(width == 0, F.lit(1.0)).otherwise(width)


def _minmax_middle(column: str) -> Column:
    return F.when(F.col("_minmax")[column]["high"] == F.col("_minmax")[column]["low"], 0.0).otherwise(0.5)


def standard_scale(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Centred and scaled columns; a constant column becomes zero."""
    fitted = _with_parameters(df, "_standard", table, ("mean", "std"))
    return fitted.withColumns({c: _standard_scaled(c) for c in columns}).drop("_standard")


def minmax_scale(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to the fitted range; a constant column keeps its distance from the constant."""
    fitted = _with_parameters(df, "_minmax", table, ("low", "high"))
    return fitted.withColumns({c: _minmax_scaled(c) for c in columns}).drop("_minmax")


def _with_terms(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The vocabulary as an array in every row (at most max_features entries)."""
    terms = F.array_sort(F.collect_list(F.struct("idx", "term", "idf")))
    return df.withColumn("_terms", vocabulary.agg(terms).scalar())


def tfidf_vector(terms: Column, text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Unit-length TF-IDF weights in vocabulary order, row by row: for short texts such as tags."""

    def weighted(tokens: Column) -> Column:
        return F.transform(terms, lambda t: F.size(F.filter(tokens, lambda word: word == t["term"])) * t["idf"])

    return unit(let(words(text, pattern), weighted))


def _with_frequencies(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        fitted = table.filter(F.col("column") == c).select(
            F.col("value").alias(f"_{c}_value"), F.col("frequency").alias(f"_{c}_frequency")
        )
        df = df.join(fitted, category(c) == F.col(f"_{c}_value"), "left").drop(f"_{c}_value")
    return df


def _with_categories(df: DataFrame, table: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    if table is None:
        return df.withColumns({f"_{c}_category": category(c) for c in columns})
    for c in columns:
        fitted = table.filter(F.col("column") == c).select(F.col("value").alias(f"_{c}_category"))
        df = df.join(fitted, category(c) == F.col(f"_{c}_category"), "left")
    return df


def transform(
    df: DataFrame,
    encoder: Mapping[str, DataFrame],
    spec: EncoderSpec = EncoderSpec(),
    all_known: bool = False,
) -> DataFrame:
    """Feature row (key, dense, cats) of each row, with the parameters of the fitted catalogue.

    ``all_known`` skips looking the categories up: true for the rows the encoder was fitted on, or any
    subset of them.
    """
    if spec.missing not in ("keep", "impute"):
        raise ValueError(f"missing must be 'keep' or 'impute', got {spec.missing!r}")

    def known(column: str, value: Column, imputed: Column | float) -> Column:
        return value if spec.missing == "keep" else F.when(finite(column).isNull(), imputed).otherwise(value)

    rest = spec.rest(df)
    df = _with_categories(df, None if all_known else encoder["categories"], spec.onehot)
    if spec.year_encoding == "raw":
        frequencies = [known(c, F.col(c).cast("double"), 0.0) for c in spec.frequency]
    else:
        df = _with_frequencies(df, encoder["frequency"], spec.frequency)
        frequencies = [F.coalesce(F.col(f"_{c}_frequency"), F.lit(0.0)) for c in spec.frequency]
    df = _with_terms(df, encoder["vocabulary"])
    df = _with_parameters(df, "_standard", encoder["standard"], ("mean", "std"))
    df = _with_parameters(df, "_minmax", encoder["minmax"], ("low", "high"))
    dense = F.concat(
        F.array(*frequencies),
        tfidf_vector(F.col("_terms"), F.col(spec.tfidf), spec.word_pattern),
        F.array(
            *[known(c, _standard_scaled(c), 0.0) for c in spec.standard],
            *[known(c, _minmax_scaled(c), _minmax_middle(c)) for c in spec.minmax],
            *[known(c, F.col(c).cast("double"), 0.0) for c in rest],
        ),
    )
    cats = F.array(*[F.col(f"_{c}_category") for c in spec.onehot])
    return df.select(spec.key, dense.alias("dense"), cats.alias("cats"))


def fit_transform(df: DataFrame, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    return transform(df, fit_encoder(df, spec), spec, all_known=True)


def feature_names(df: DataFrame, encoder: Mapping[str, DataFrame], spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """(position, feature) of the widened matrix: each encoding's columns in turn, categories ascending."""

    def fixed(block: int, names: Sequence[str]) -> DataFrame:
        rows = [F.struct(F.lit(i).cast("long").alias("code"), F.lit(n).alias("feature")) for i, n in enumerate(names)]
        one = encoder["standard"].select("column").limit(1)
        return one.select(F.lit(block).alias("block"), F.inline(F.array(*rows)))

    def onehot(block: int, column: str) -> DataFrame:
        codes = dictionary(df, column)
        label = F.concat(F.lit(f"ohe__{column}_"), F.col(column).cast("string"))
        return codes.select(F.lit(block).alias("block"), F.col("code").cast("long"), label.alias("feature"))

    parts = [fixed(0, [f"frequency_encode__{c}" for c in spec.frequency])]
    parts += [onehot(1 + i, c) for i, c in enumerate(spec.onehot)]
    after = 1 + len(spec.onehot)
    parts.append(
        encoder["vocabulary"].select(
            F.lit(after).alias("block"),
            F.col("idx").cast("long").alias("code"),
            F.concat(F.lit("tfidf__"), "term").alias("feature"),
        )
    )
    scaled = (
        [f"standard_scale__{c}" for c in spec.standard]
        + [f"min_max_scale__{c}" for c in spec.minmax]
        + [f"remainder__{c}" for c in spec.rest(df)]
    )
    parts.append(fixed(after + 1, scaled))
    names = reduce(DataFrame.unionByName, parts)
    # one row per block
    widths = names.groupBy("block").agg(F.count("*").alias("width"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(widths.select("block", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("start")))
    return names.join(starts, "block").select((F.col("start") + F.col("code")).alias("position"), "feature")


def feature_stats(features: DataFrame, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """One row: n_samples, n_features, nnz and sparsity of the widened matrix."""
    per_row = F.size(F.filter("dense", lambda x: x != 0)) + F.size(F.filter("cats", lambda c: c.isNotNull()))
    totals = features.agg(
        F.count("*").alias("n_samples"), F.max(F.size("dense")).alias("_dense"), F.sum(per_row).alias("nnz")
    )
    categories = (
        features.select(F.posexplode("cats").alias("slot", "value"))
        .filter(F.col("value").isNotNull())
        .distinct()
        .agg(F.count("*"))
        .scalar()
    )
    return (
        totals.withColumn("n_features", F.col("_dense") + categories)
        .withColumn(
            "sparsity", 1 - F.col("nnz") / (F.col("n_samples").cast("double") * F.col("n_features"))
        )
        .drop("_dense")
    )
