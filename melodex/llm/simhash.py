"""Near duplicates by SimHash fingerprints and a covering family of bit masks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.llm.common import ship
from melodex.llm.components import connected_components
from melodex.session import materialise

ship(__name__)

BITS = 64
HASH_SEED = 42
# shingles hashed at a time, which bounds the memory a very long text takes
CHUNK = 1 << 16
# fingerprints of a bucket that are compared with each other; larger buckets are divided by further masks
BUCKET = 64


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of a text's word shingles, repeats included."""
    tokens = (text or "").encode().lower().split()  # bytes: lowers A-Z only and splits at the six blanks only
    if not tokens:
        return 0
    shingles = max(1, len(tokens) - words + 1)
    set_bits = np.zeros(BITS, np.int64)
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, shingles, CHUNK):
        stop = min(start + CHUNK, shingles)
        runs = zip(*[tokens[start + k : stop + k] for k in range(words)]) if len(tokens) >= words else [tokens]
        hashes = np.array([hashed(join(run), HASH_SEED) for run in runs], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    value = np.packbits(set_bits * 2 > shingles, bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def _fingerprints(words: int):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [fingerprint(texts[i].as_py(), words) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["id", "fingerprint"]
            )

    return per_batch


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bits, such that any ``radius`` of the bits are all outside one mask at least.

    Every bit is given, in turn, a vector of radius + 1 binary digits that is not zero. The mask of a vector v
    holds the bits whose vector has an odd product with v. The vectors of ``radius`` bits cannot span the
    space, so some v has an even product with all of them: values that differ in those bits agree under its
    mask.
    """
    vectors = list(product((0, 1), repeat=radius + 1))[1:]
    masks = []
    for v in vectors:
        mask = 0
        for place, bit in enumerate(bits):
            given = vectors[place % len(vectors)]
            if sum(a * b for a, b in zip(v, given)) % 2:
                mask |= 1 << bit
        masks.append(mask)
    return masks


def _long(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def fingerprint_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """All pairs (a, b), a < b, of different fingerprints that differ in at most ``radius`` bits.

    Each fingerprint goes into one bucket per mask, and the members of a bucket are compared. A bucket of more
    than ``BUCKET`` members is divided by the masks that cover the bits its own mask leaves out, again
    and again, until a bucket has few free bits and so few members; no pair is lost by that.
    """
    everything = (1 << BITS) - 1
    rows = prints.select(F.col("fingerprint").alias("value")).distinct()
    rows = rows.withColumn("fixed", F.lit(0).cast("long"))
    found = None
    for _ in range(3):
        rows = materialise(_divide(rows, radius, everything), "simhash-buckets")
        sizes = rows.groupBy("fixed", "key").agg(F.count("*").alias("members")).filter("members > 1")
        rows = rows.join(sizes, ["fixed", "key"])
        pairs = _compare(rows.filter(F.col("members") <= BUCKET), radius)
        found = pairs if found is None else found.union(pairs)
        rows = materialise(rows.filter(F.col("members") > BUCKET).select("value", "fixed"), "simhash-large")
        if rows.isEmpty():
            return found.distinct()
    # nearly all bits are fixed by now: a bucket has at most 2 ** 7 members
    last = rows.withColumn("key", F.col("value").bitwiseAND(F.col("fixed")))
    return found.union(_compare(last, radius)).distinct()


def _divide(rows: DataFrame, radius: int, everything: int) -> DataFrame:
    """Each row once per mask over the bits that ``fixed`` leaves free, with the bucket's key."""
    known = [row["fixed"] for row in rows.select("fixed").distinct().collect()]  # at most 7 ** 2 masks
    table = []
    for fixed in known:
        taken = fixed & everything
        free = [b for b in range(BITS) if not taken >> b & 1]
        table.append((fixed, [mask | taken for mask in covering_masks(free, radius)]))
    masks = F.lit(None).cast("array<long>")
    for fixed, options in table:
        masks = F.when(F.col("fixed") == F.lit(fixed), F.array(*[_long(m) for m in options])).otherwise(masks)
    divided = rows.select("value", F.explode(masks).alias("fixed"))
    return divided.withColumn("key", F.col("value").bitwiseAND(F.col("fixed"))).distinct()


def _compare(rows: DataFrame, radius: int) -> DataFrame:
    left = rows.select("fixed", "key", F.col("value").alias("a"))
    right = rows.select("fixed", "key", F.col("value").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return left.join(right, ["fixed", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def simhash_groups(
    docs: DataFrame, *, words: int = 3, radius: int = 2, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, fingerprint (long), and the smallest id its group reaches (``component_id``).

    Words are what lies between ASCII white space, A-Z lowered; shingles of ``words`` words keep repeats. A
    text of fewer words is one shingle; without words (null, empty, blank) the fingerprint is zero and links like any
    other. A bit is 1 if it is set in more than half the shingles' hashes. Documents link when at most
    ``radius`` bits differ. Ids that are null take no part in the choice of the smallest; a group of such rows
    alone has a null component.
    """
    id_type = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("fingerprint", T.LongType())])
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    marked = materialise(slim.mapInArrow(_fingerprints(words), schema), "simhash-prints")
    classes = materialise(marked.groupBy("fingerprint").agg(F.min("id").alias("first")), "simhash-classes")
    links = fingerprint_links(classes, radius)
    ends = connected_components(links)  # over fingerprints: far fewer rows than documents
    grouped = classes.join(ends, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = grouped.join(smallest, "component").select(F.col("fingerprint").alias("__print"), "component_id")
    named = materialise(named, "simhash-named")
    return marked.join(named, F.col("fingerprint") == F.col("__print")).select(
        F.col("id").alias(id_column), "fingerprint", "component_id"
    )


def first_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The documents with all their columns, one of each group: that of the smallest id.

    Rows that share that id are one document: one of them stays. Rows without an id stay.
    """
    id_column = options.get("id_column", "doc_id")
    groups = simhash_groups(docs, **options)
    first = groups.filter(F.col(id_column) == F.col("component_id")).groupBy(F.col(id_column).alias("__id"))
    first = materialise(first.agg((F.count("*") > 1).alias("__repeated")), "simhash-first").hint("shuffle_hash")
    kept = docs.join(first, F.col(id_column) == F.col("__id"))
    # only rows that share their id are sorted to find one of them
    once = kept.filter("not __repeated").select(*docs.columns)
    one_of = kept.filter("__repeated").select(*docs.columns).dropDuplicates([id_column])
    return once.unionByName(one_of).unionByName(docs.filter(F.col(id_column).isNull()))
