"""The given tables seen as a raw catalogue, a listening log and a request log.

* catalogue: every ``lineitem`` row is one listing of its ``part`` (a track), so a track is listed many
  times with different values and cleaning has to keep the first listing;
* log: the customer of an order plays the ordered part ``l_quantity`` times;
* radio log: every row of ``events`` is a user's plays of one track on air, which few tracks of the catalogue are, and
  some of which the catalogue lacks;
* requests: ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from melodex.operators.clean import clean_catalogue, first_per_key
from melodex.operators.interactions import build_interactions
from melodex.sources.files import read_table
from melodex.sources.schemas import PREVIEW_URL, SOURCE_ID

# total order of the listings of a track
LISTING_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw catalogue: the columns of the catalogue file, and the order columns."""
    return _listed(table(spark, folder, "lineitem"), table(spark, folder, "part"))


def first_listings(spark: SparkSession, folder: str) -> DataFrame:
    """The listings that cleaning may keep. All order columns come from ``lineitem``, so the first row of a track is found
    before the catalogue's columns are joined to it: what is sorted stays narrow."""
    lineitem = table(spark, folder, "lineitem").select("l_partkey", *LISTING_ORDER)
    return _listed(first_per_key(lineitem, ["l_partkey"], LISTING_ORDER), table(spark, folder, "part"))


def _listed(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    no_tags = F.col("l_returnflag") == "R"
    return joined.select(
        F.col("l_partkey").alias("track_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("artist"),
        F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias(PREVIEW_URL),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias(SOURCE_ID),
        F.when(~no_tags, F.concat("p_type", F.lit(", "), "p_name")).alias("tags"),
        F.col("l_linestatus").alias("genre"),
        (F.col("p_size") + 1970).alias("year"),
        F.floor("l_extendedprice").alias("duration_ms"),
        F.col("l_tax").alias("danceability"),
        (F.col("l_quantity") / F.lit(50.0)).alias("energy"),
        (F.col("p_size") % 12).alias("key"),
        F.col("l_discount").alias("loudness"),
        (F.col("l_linenumber") % 2).alias("mode"),
        (F.col("l_discount") * F.col("l_tax")).alias("speechiness"),
        (F.col("l_extendedprice") / F.lit(100000.0)).alias("acousticness"),
        (F.col("p_size") / F.lit(50.0)).alias("instrumentalness"),
        (F.col("p_retailprice") / F.lit(2000.0)).alias("liveness"),
        (F.col("l_quantity") * F.col("l_discount")).alias("valence"),
        F.col("l_quantity").alias("tempo"),
        F.col("l_linenumber").alias("time_signature"),
        *LISTING_ORDER,
    )


def raw_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The listings without the order columns."""
    return listings(spark, folder).drop(*LISTING_ORDER)


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    return clean_catalogue(first_listings(spark, folder), LISTING_ORDER).drop(*LISTING_ORDER)


def history(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_partkey").alias("track_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_quantity").alias("playcount"),
        )
    )


def radio_history(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.floor("value").alias("track_id"),
        "user_id",
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("playcount"),
    )


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    return build_interactions(history(spark, folder))


def radio_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return build_interactions(radio_history(spark, folder))


def _requests(events: DataFrame) -> DataFrame:
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("user_id") % 2 == 0, "hybrid").otherwise("content_based").alias("model_type"),
        F.when(failed, "error").otherwise("success").alias("status"),
        (F.col("value") / F.lit(1000.0)).alias("latency"),
        F.when(~failed, F.get_json_object("props", "$.k").cast("long")).alias("n_recs"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return _requests(table(spark, folder, "events"))


def request_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return _requests(stream)


def searches(spark: SparkSession, folder: str) -> DataFrame:
    """Search texts: every part name, as a user would type it."""
    return table(spark, folder, "part").select(F.col("p_name").alias("query"))
