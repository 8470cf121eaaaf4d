"""A training corpus made from raw documents: each stage works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from melodex.llm.line_dedup import deduplicate_lines
from melodex.llm.mixing import mixed_documents
from melodex.llm.pieces import encode_documents
from melodex.llm.quality import keep_by_quality
from melodex.llm.queries import QUALITY_THRESHOLD, SIMHASH, piece_model, quality_model, quality_weights
from melodex.llm.simhash import first_of_each_group
from melodex.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it has learned from labelled documents of this table."""
    return keep_by_quality(docs, quality_model(spark, docs, sf_dir), QUALITY_THRESHOLD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in one of them; ``n_chars`` follows the text."""
    kept = deduplicate_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; fingerprints link as in the operator's own query."""
    return first_of_each_group(docs, **SIMHASH)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs, quality_weights(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every use of a document, and the text they decode to."""
    encoded = encode_documents(docs, piece_model())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

# hashes, fitted models and a tokenizer decide: SQL cannot express the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
