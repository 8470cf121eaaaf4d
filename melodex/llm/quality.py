"""Quality of texts by a vote of the nearest labelled texts in a latent semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.llm.common import hash_sample, ship

ship(__name__)

TRIGRAM_TERMS = 2048  # a power of two: byte trigrams are hashed into so many terms
SHAPES = 5  # shares that are measured of a text's words
SHAPE_STEPS = 10
LENGTH_STEPS = 32
REPEAT_STEPS = (0.02, 0.1)  # share of words that repeat the word before
TERMS = TRIGRAM_TERMS + SHAPES * SHAPE_STEPS + LENGTH_STEPS + len(REPEAT_STEPS) + 1
SHAPE_WEIGHT = 1.5
TRAINING_TEXTS = 4_000  # labelled texts, chosen by hash
DIMENSIONS = 32
POWER_ROUNDS = 20
NEIGHBOURS = 11
BLOCK = 512  # documents compared with all labelled texts in one product


class QualityModel(NamedTuple):
    idf: np.ndarray  # TERMS
    axes: np.ndarray  # TERMS x DIMENSIONS
    vectors: np.ndarray  # labelled texts x DIMENSIONS
    labels: np.ndarray
    prior: float


def text_terms(text: str | None) -> np.ndarray:
    """Term weights of a text: byte trigrams, and terms that tell the shape of its words."""
    terms = np.zeros(TERMS, np.float32)
    words = (text or "").split()
    if not words:
        return terms
    codes = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    if len(codes) >= 3:
        mixed = codes[:-2] * np.uint32(0x9E3779B1)
        mixed ^= codes[1:-1] * np.uint32(0x85EBCA6B)
        mixed ^= codes[2:] * np.uint32(0xC2B2AE35)
        mixed >>= np.uint32(32 - TRIGRAM_TERMS.bit_length() + 1)
        terms[:TRIGRAM_TERMS] = np.log1p(np.bincount(mixed, minlength=TRIGRAM_TERMS))
    # a shape term weighs as much as a share of all trigram terms, however long the text is
    unit = 0.6 * np.sqrt(max(1, np.count_nonzero(terms)))
    count = len(words)
    shares = (
        len(set(words)) / count,
        sum(map(str.isupper, words)) / count,
        sum(map(str.isalpha, words)) / count,
        sum(not any(map(str.isalnum, word)) for word in words) / count,
        sum(word[:-1].isalpha() for word in words) / count,
    )
    for k, share in enumerate(shares):
        terms[TRIGRAM_TERMS + k * SHAPE_STEPS + min(SHAPE_STEPS - 1, int(share * SHAPE_STEPS))] = unit
    at = TRIGRAM_TERMS + SHAPES * SHAPE_STEPS
    terms[at + min(LENGTH_STEPS - 1, count.bit_length())] = 0.3 * unit
    bare = [word.lower().strip(".,") for word in words]
    repeats = sum(a == b for a, b in zip(bare, bare[1:])) / count
    terms[at + LENGTH_STEPS + sum(repeats >= step for step in REPEAT_STEPS)] = 2 * unit
    return terms


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)


def latent_vectors(terms: np.ndarray, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return _unit_rows(_unit_rows(terms * idf) @ axes)


def singular_axes(rows: np.ndarray, count: int) -> np.ndarray:
    """The strongest right singular vectors, as columns: a few more than wished for are turned towards the rows until they settle."""
    axes = np.random.default_rng(3).standard_normal((rows.shape[1], min(2 * count, *rows.shape))).astype(np.float32)
    for _ in range(POWER_ROUNDS):
        axes = np.linalg.qr(rows.T @ (rows @ axes))[0]
    turned = np.linalg.svd(rows @ axes, full_matrices=False)[2]
    return axes @ turned[:count].T


def fit_quality(terms: np.ndarray, labels: list[int], dimensions: int = DIMENSIONS) -> QualityModel:
    """Term weights, latent axes and the vectors of the labelled texts, given as one row of term weights each."""
    if not len(terms):
        return QualityModel(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1)), np.zeros(0), 0.5)
    idf = np.log((1 + len(terms)) / (1 + np.count_nonzero(terms, axis=0))).astype(np.float32)
    idf[TRIGRAM_TERMS:] = SHAPE_WEIGHT
    weighted = _unit_rows(terms * idf)
    axes = singular_axes(weighted, dimensions)
    votes = np.asarray(labels, np.float64)
    return QualityModel(idf, axes, latent_vectors(terms, idf, axes), votes, float(votes.mean()))


def score_texts(texts: list[str | None], model: QualityModel, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest labelled texts, each weighted by its cosine."""
    if not len(model.labels):
        return np.full(len(texts), model.prior)
    terms = np.stack([text_terms(text) for text in texts])
    vectors = latent_vectors(terms, model.idf, model.axes)
    cosines = vectors @ model.vectors.T
    count = min(neighbours, cosines.shape[1])
    nearest = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
    weights = np.take_along_axis(cosines, nearest, 1).clip(0).astype(np.float64)
    total = weights.sum(1)
    voted = (weights * model.labels[nearest]).sum(1) / np.maximum(total, 1e-12)
    return np.where(total > 0, voted, model.prior).clip(0, 1)


def _score_batches(sent, neighbours: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                scores = score_texts(block.column(1).to_pylist(), model, neighbours)
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), pa.array(scores, pa.float64())], names=["id", "score"]
                )

    return score


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [text_terms(batch.column(2)[i].as_py()).tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(terms, pa.binary())], names=["id", "label", "terms"]
        )


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    training_texts: int = TRAINING_TEXTS,
) -> tuple[np.ndarray, list[int]]:
    """Term weights and labels of about ``training_texts`` labelled texts, chosen by the hash of their id.

    Null labels don't count. A document with several labels teaches each once; of rows that share an id one
    teaches. Only the term weights, of fixed size, are brought together, not the texts.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.select(F.col(id_column).alias("__id"), F.col(label).cast("int").alias("__label")).distinct()
    # the ids are chosen before the texts are read, so that only chosen texts are moved
    present = known.join(docs.select(F.col(id_column).alias("__id")), "__id", "left_semi")
    chosen = F.broadcast(hash_sample(present, training_texts, "__id"))
    taught = docs.join(chosen, F.col(id_column) == F.col("__id")).select("__id", "__label", text)
    schema = T.StructType(
        [
            T.StructField("id", taught.schema["__id"].dataType),
            T.StructField("label", T.IntegerType()),
            T.StructField("terms", T.BinaryType()),
        ]
    )
    one_each = taught.mapInArrow(_term_batches, schema).groupBy("id", "label").agg(F.min("terms").alias("terms"))
    rows = sorted(one_each.collect(), key=lambda row: (row["id"], row["label"]))
    terms = [np.frombuffer(bytes(row["terms"]), np.float32) for row in rows]
    return np.stack(terms) if terms else np.zeros((0, TERMS), np.float32), [row["label"] for row in rows]


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    *,
    neighbours: int = NEIGHBOURS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: id and ``score`` between 0 and 1.

    Only the text is used. It becomes weights of terms (hashed byte trigrams and shape terms), then a vector in the
    latent space of the labelled texts, which are broadcast (a bounded number of short vectors); the cosines to all of them
    are computed in blocks, and the nearest vote with their cosine as weight. A text without words (null, empty,
    blank), and one with no similar labelled text, scores the share of label 1 among the labelled texts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_column].dataType), T.StructField("score", T.DoubleType())]
    )
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(_score_batches(sent, neighbours), schema).withColumnRenamed("id", id_column)


def _keep_batches(sent, column: int, threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                scores = score_texts(block.column(column).to_pylist(), model)
                yield block.filter(pa.array(scores >= threshold))

    return keep


def keep_by_quality(docs: DataFrame, model: QualityModel, threshold: float, *, text: str = "text") -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns; see ``score_quality``."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    return docs.mapInArrow(_keep_batches(sent, docs.columns.index(text), threshold), docs.schema)
