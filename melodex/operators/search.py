"""Finding catalogue entries by approximate text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from melodex.functions.text import DISPLAY_SEPARATOR, display, strip

# How many matches a query returns, and the similarity they need.
LIMIT, CUTOFF = 10, 0.4

GRAM_LENGTH = 3
EDITS = 2


def song_index(tracks: DataFrame, separator: str = DISPLAY_SEPARATOR) -> DataFrame:
    """(key, name, artist, display): the lower-case display text and the first track showing it."""
    shown = tracks.withColumn("display", display(F.col("name"), F.col("artist"), separator))
    first = F.min(F.struct("track_id", "name", "artist", "display")).alias("first")
    return (
        shown.filter(F.col("display").isNotNull())
        .groupBy(F.lower("display").alias("key"))
        .agg(first)
        .select("key", "first.name", "first.artist", "first.display")
    )


def grams(text: Column) -> Column:
    """Distinct runs of three characters, with two blanks before the text and one after it."""
    padded = F.concat(F.lit("  "), text, F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(padded) - (GRAM_LENGTH - 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(padded, i, F.lit(GRAM_LENGTH))))


def fuzzy_matches(
    queries: DataFrame, index: DataFrame, limit: int = LIMIT, cutoff: float = CUTOFF
) -> DataFrame:
    """(query, key, ratio, rank) of the closest index keys of each distinct query; blank queries match nothing.

    The ratio is 2 S / T: S grams that both texts have, T grams of the two together. A key that reaches the
    cutoff shares a known number of the query's grams with it, so it has one at least of all but so many of
    them: queries are joined with keys on their rarest grams only, and no key that belongs to the result is
    lost. Equal ratios rank by key, descending.
    """
    asked = queries.select(F.lower(strip(F.col("query"))).alias("query")).filter("query != ''").distinct()
    asked = asked.withColumn("query_grams", grams(F.col("query")))
    keys = index.select("key", grams(F.col("key")).alias("key_grams"))
    by_gram = keys.select("key", "key_grams", F.explode("key_grams").alias("gram"))
    rarity = by_gram.groupBy("gram").agg(F.count("*").alias("n_keys"))
    needed = F.ceil(F.size("query_grams") * F.lit(cutoff / (2 - cutoff)) - 1e-9)
    ranked = (
        asked.select("query", "query_grams", F.explode("query_grams").alias("gram"))
        .join(rarity, "gram")  # grams that no key has can't be shared
        .groupBy("query")
        .agg(
            F.first("query_grams").alias("query_grams"),
            F.array_sort(F.collect_list(F.struct("n_keys", "gram"))).alias("known"),
        )
    )
    # the grams no key has are the rarest of all and take up places
    places = F.size("query_grams") - needed + 1 - (F.size("query_grams") - F.size("known"))
    rare = ranked.filter(places > 0).select(
        "query", "query_grams", F.explode(F.slice("known", F.lit(1), places.cast("int"))["gram"]).alias("gram")
    )
    pairs = rare.join(by_gram, "gram").select("query", "key", "query_grams", "key_grams").distinct()
    shared = F.size(F.array_intersect("query_grams", "key_grams"))
    ratio = 2.0 * shared / (F.size("query_grams") + F.size("key_grams"))
    matched = pairs.select("query", "key", ratio.alias("ratio")).filter(F.col("ratio") >= cutoff)
    best = Window.partitionBy("query").orderBy(F.desc("ratio"), F.desc("key"))
    return matched.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def _cuts(length: Column, parts: int) -> Column:
    """(part, start, size) of a text of some length cut into parts as equal as can be; starts count from 0."""
    border = lambda i: F.floor(i * length / F.lit(parts)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda i: F.struct(i.alias("part"), border(i).alias("start"), (border(i + 1) - border(i)).alias("size")),
    )


def _substring(text: Column, cut: Column, start: Column) -> Column:
    return F.substr(text, start + 1, cut["size"])


def edit_candidates(queries: DataFrame, keys: DataFrame, distance: int) -> DataFrame:
    """(query, key) pairs that may lie within an edit distance; no pair that does is missing.

    A key is cut into one part more than the distance allows edits, so one part at least stands unchanged in the query, and
    shifted by no more than the distance. Queries and keys meet on equal (key length, part, text of the part).
    """
    parts = distance + 1
    length = F.length("key")
    cut_keys = keys.select("key", length.alias("length"), F.explode(_cuts(length, parts)).alias("cut")).select(
        "key", "length", F.col("cut.part").alias("part"), _substring(F.col("key"), F.col("cut"), F.col("cut.start")).alias("piece")
    )
    n, query = F.length("query"), F.col("query")
    lengths = F.sequence(F.greatest(n - distance, F.lit(0)), n + distance)
    wanted = queries.select("query", F.explode(lengths).alias("length"))
    wanted = wanted.select("query", "length", F.explode(_cuts(F.col("length"), parts)).alias("cut"))
    first = F.greatest(F.col("cut.start") - distance, F.lit(0))
    last = F.least(F.col("cut.start") + distance, n - F.col("cut.size"))
    pieces = F.transform(F.sequence(first, last), lambda start: _substring(query, F.col("cut"), start))
    wanted = wanted.filter(first <= last).select(
        "query", "length", F.col("cut.part").alias("part"), F.explode(F.array_distinct(pieces)).alias("piece")
    )
    return wanted.join(cut_keys, ["length", "part", "piece"]).select("query", "key").distinct()


def edit_matches(queries: DataFrame, keys: DataFrame, distance: int = EDITS, limit: int = LIMIT) -> DataFrame:
    """(query, key, distance, rank) of the keys nearest to each distinct query by Levenshtein distance, in
    characters. Null texts and blank queries match nothing; equal distances rank by key."""
    asked = queries.select(F.lower(strip(F.col("query"))).alias("query")).filter("query != ''").distinct()
    known = keys.select("key").filter("key IS NOT NULL").distinct()
    pairs = edit_candidates(asked, known, distance)
    # beyond the bound the function gives -1
    measured = pairs.withColumn("distance", F.levenshtein("query", "key", distance)).filter("distance >= 0")
    best = Window.partitionBy("query").orderBy("distance", "key")
    return measured.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def search(
    queries: DataFrame, tracks: DataFrame, limit: int = LIMIT, cutoff: float = CUTOFF
) -> DataFrame:
    """Matches with the name, artist and display text of their song."""
    index = song_index(tracks)
    return fuzzy_matches(queries, index, limit, cutoff).join(index, "key")
