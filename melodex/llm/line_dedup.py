"""Removing lines that many documents share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.llm.common import ship
from melodex.session import materialise

ship(__name__)

BLANKS = b" \t\n\v\f\r"


def line_keys(text: str, least_length: int) -> dict[bytes, list[int]]:
    """Hash of each long enough normalised line, with the positions of its lines."""
    keys: dict[bytes, list[int]] = {}
    for position, line in enumerate(text.encode().split(b"\n")):
        if len(line) < least_length:  # fewer bytes, so fewer code points
            continue
        key = line.strip(BLANKS).lower()  # bytes: lowers A-Z only
        if len(key) >= least_length and len(key.decode()) >= least_length:
            keys.setdefault(xxhash.xxh3_128_digest(key), []).append(position)
    return keys


def _explode_lines(least_length: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, keys, positions = [], [], [], []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                for key, places in line_keys(text or "", least_length).items():
                    ids.append(i)
                    keys.append(key)
                    positions.append(places)
            rows = pa.array(ids, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(2).take(rows),
                    pa.array(keys, pa.binary()),
                    pa.array(positions, pa.list_(pa.int32())),
                ],
                names=["id", "version", "key", "positions"],
            )

    return explode


def deduplicate_lines(
    docs: DataFrame,
    *,
    least_length: int = 40,
    least_documents: int = 5,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with ``text`` cut, and the columns ``n_lines`` (before) and ``n_dropped``.

    A text is split at line feeds. A line's key is the line without white space at its ends and with A-Z
    lowered. Keys of ``least_length`` code points or more in ``least_documents`` documents or more lose all
    their lines except in the document of the largest id. The other lines stay in order. A null or empty text
    is one empty line; null becomes the empty text. A null id is one document, smaller than all others; rows
    that share an id are one document when documents are counted. Other columns are kept as they are, but an
    input column ``n_lines`` or ``n_dropped`` is replaced.
    """
    id_type = docs.schema[id_column].dataType
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("version"))
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("version", T.LongType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("positions", T.ArrayType(T.IntegerType())),
        ]
    )
    lines = materialise(slim.mapInArrow(_explode_lines(least_length), schema), "line-keys")
    shared = (
        lines.select("key", "id")
        .distinct()  # by key and document first: a line found everywhere is counted in all tasks
        .groupBy("key")
        .agg(F.count("*").alias("documents"), F.max("id").alias("keeper"))
        .filter(F.col("documents") >= least_documents)
        .select(F.col("key").alias("__key"), "keeper")
    )
    # stored, so that the join below can be split where a line is in very many documents
    shared = materialise(shared, "line-shared")
    dropped = (
        lines.join(shared, F.col("key") == F.col("__key"))
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("__id"), F.col("version").alias("__version"))
        .agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("__dropped"))  # positions of one text
        .hint("shuffle_hash")  # the short side: the texts need no sort
    )
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.withColumn("__text", F.coalesce(F.col(text), F.lit(""))).join(
        dropped,
        F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__version")),
        "left",
    )
    parts = F.split("__text", "\n", -1)
    n_lines = F.size(parts).cast("long")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__dropped"))
    cut = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    return joined.select(
        *[
            F.when(F.col("__dropped").isNull(), F.col("__text")).otherwise(cut).alias(c) if c == text else F.col(c)
            for c in columns
        ],
        n_lines.alias("n_lines"),
        F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
