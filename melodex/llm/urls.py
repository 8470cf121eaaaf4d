"""Judging URLs by host rules and, where no rule fits, by a ratio of character language models."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.llm.common import as_list, narrow, ship, widen, with_entries
from melodex.session import materialise

ship(__name__)

ORDER = 4  # characters of context at most
CALIBRATION_PARTS = 5  # one part of the judged URLs is kept to calibrate the threshold
BINS = 1_024  # per unit of the ratio, in which the threshold is chosen
ALPHABET = 256  # the models run over UTF-8 bytes
VERDICTS = ("allow", "block")


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?>.*?://)[^/?#]*+(/[^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits, or null. A rule fits its host, all subdomains, and paths that
    start with its own; of two rules of equal length the first given wins."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, rule.name).otherwise(found)
    return found


def byte_grams(address: bytes) -> list[bytes]:
    """Each byte with up to ``ORDER`` bytes before it."""
    return [address[max(0, i - ORDER) : i + 1] for i in range(len(address))]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, accepted, rejected): how often the addresses of each verdict hold the grams of 1 to ``ORDER`` + 1
    bytes; those of addresses without a verdict to learn from are named with counts of 0."""
    for batch in batches:
        found: dict[str | None, Counter] = {"allow": Counter(), "block": Counter(), None: Counter()}
        for verdict, address in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = address.encode()
            for length in range(1, ORDER + 2):
                found[verdict].update([text[i : i + length] for i in range(len(text) - length + 1)])
        grams = list(found["allow"] | found["block"] | found[None])
        counts = [pa.array([found[verdict][gram] for gram in grams], pa.int64()) for verdict in ("allow", "block")]
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), *counts], names=["gram", "allow", "block"])


def gram_differences(addresses: DataFrame) -> DataFrame:
    """(entry, difference) for every gram of ``addresses`` (verdict: allow, block or null; address): the logarithm of the
    ratio of its last byte's probabilities in both models, given the bytes before it.

    A model mixes all context lengths: the more different bytes have followed a context, the more weight the next
    shorter one gets (Witten and Bell); below the empty context all bytes are equally likely. Every gram of every
    address counts, however rare. The probabilities of a length follow from those of the length before by one
    join on the gram's end; a gram has at most 256 longer ones, so no key is hot.
    """
    grams = addresses.select("verdict", "address").mapInArrow(_count_grams, "gram binary, allow long, block long")
    grams = grams.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    grams = grams.withColumn("context", F.expr("substring(gram, 1, octet_length(gram) - 1)"))
    grams = materialise(grams, "url-grams")
    contexts = grams.groupBy(F.col("context").alias("__context")).agg(
        *(F.sum(verdict).alias(f"{verdict}_total") for verdict in VERDICTS),
        *(F.count(F.when(F.col(verdict) > 0, 1)).alias(f"{verdict}_kinds") for verdict in VERDICTS),
    )
    counted = grams.join(contexts, F.col("context") == F.col("__context")).drop("__context")
    counted = materialise(counted, "url-contexts")
    lengths = []
    for length in range(1, ORDER + 2):
        level = counted.filter(F.octet_length("gram") == length)
        if length == 1:
            level = level.select("*", *(F.lit(1.0 / ALPHABET).alias(f"{verdict}_shorter") for verdict in VERDICTS))
        else:
            shorter = lengths[-1].select(
                F.col("gram").alias("__end"), *(F.col(f"p_{verdict}").alias(f"{verdict}_shorter") for verdict in VERDICTS)
            )
            level = level.join(shorter, F.expr("substring(gram, 2)") == F.col("__end"))
        level = level.select("gram", *(_mixed(verdict).alias(f"p_{verdict}") for verdict in VERDICTS))
        lengths.append(materialise(level, "url-probabilities"))
    every = reduce(DataFrame.union, lengths)
    return every.select(F.col("gram").alias("entry"), F.log(F.col("p_allow") / F.col("p_block")).alias("difference"))


def _mixed(verdict: str) -> Column:
    times, total, kinds, shorter = (F.col(f"{verdict}{part}") for part in ("", "_total", "_kinds", "_shorter"))
    return F.when(total > 0, (times + kinds * shorter) / (total + kinds)).otherwise(shorter)


def _address_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per batch: its columns as lists, the distinct grams of its addresses (the last column), and their uses."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        places: dict[bytes, int] = {}
        uses, lengths = [], []
        for address in batch.column(batch.num_columns - 1).to_pylist():
            grams = byte_grams(address.encode())
            uses += [places.setdefault(gram, len(places)) for gram in grams]
            lengths.append(len(grams))
        columns = [pa.array([block], pa.int64()), *(as_list(column) for column in batch.columns)]
        columns += [as_list(pa.array(lengths, pa.int64())), as_list(pa.array(list(places), pa.binary()))]
        columns.append(pa.array([narrow(np.array(uses, np.int64), len(places))], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=["block", *batch.schema.names, "lengths", "grams", "uses"])
        block += 1


def _block_ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            *columns, lengths = (batch.column(k)[row].values for k in range(1, batch.num_columns - 2))
            found = batch.column(batch.num_columns - 1)[row].values
            differences = np.zeros(0) if found is None else found.field("difference").to_numpy(zero_copy_only=False)
            uses = widen(batch.column(batch.num_columns - 2)[row].as_py(), len(differences))
            lengths = lengths.to_numpy()
            sums = np.diff(np.concatenate([[0.0], np.cumsum(differences[uses])])[np.concatenate([[0], np.cumsum(lengths)])])
            names = [batch.schema.names[k] for k in range(1, batch.num_columns - 3)]
            ratio = pa.array(sums / np.maximum(lengths, 1))
            yield pa.RecordBatch.from_arrays([*columns, ratio], names=[*names, "ratio"])


def with_ratio(rows: DataFrame, differences: DataFrame) -> DataFrame:
    """Add ``ratio``, the mean difference per byte of ``address``, which is the last column; 0 without bytes."""
    lists = [T.StructField(field.name, T.ArrayType(field.dataType)) for field in rows.schema.fields]
    numbers = [T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("grams", T.ArrayType(T.BinaryType()))]
    schema = T.StructType(
        [T.StructField("block", T.LongType()), *lists, *numbers, T.StructField("uses", T.BinaryType())]
    )
    blocks = materialise(rows.mapInArrow(_address_blocks, schema), "url-blocks")
    looked_up = with_entries(blocks, "grams", differences, "difference")
    return looked_up.mapInArrow(_block_ratios, T.StructType([*rows.schema.fields, T.StructField("ratio", T.DoubleType())]))


def best_threshold(bins: Sequence[tuple[int, int, int]]) -> float:
    """Border of bins (number, accepted, rejected) with the fewest wrong verdicts, both kinds weighing the same; the middle
    of the best ones. Without both kinds it is 0."""
    if not bins:
        return 0.0
    number, good, bad = np.array(sorted(bins), np.int64).T
    if not good.sum() or not bad.sum():
        return 0.0
    # wrong[i]: all bins before the i-th are rejected, it and all after it are accepted
    lost = np.concatenate([[0], good.cumsum()]) / good.sum()
    passed = 1 - np.concatenate([[0], bad.cumsum()]) / bad.sum()
    wrong = lost + passed
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    i = int(best[len(best) // 2])
    # in the middle of the empty bins before the i-th, if there are any
    below = number[i - 1] + 1 if i else number[0]
    above = number[i] if i < len(number) else number[-1] + 1
    return float((below + above) // 2 / BINS)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id_column: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits), verdict, ratio, threshold.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: from there up to
    ``?``, ``#`` or the end; both are empty for a null url or one without ``://``. The longest
    fitting rule decides. For the other URLs two models of bytes are counted over all distinct URLs that the rules
    allow and block (host and path); a URL is allowed if its ratio, the mean log-likelihood difference per byte, reaches the
    threshold. One judged URL in ``CALIBRATION_PARTS``, by hash, teaches nothing; the threshold is calibrated on all of these. An
    address without bytes has ratio 0. Without URLs of both kinds the missing model gives all bytes the same
    probability and the threshold is 0.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    slim = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    slim = slim.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.verdict)]) if rules else None
    ruled = F.lit(None).cast("string") if verdicts is None else F.element_at(verdicts, F.col("rule"))
    slim = slim.withColumn("verdict", F.when(F.col("rule").isNotNull(), ruled))
    slim = slim.withColumn("address", F.concat("host", "path"))
    kept_out = F.pmod(F.xxhash64(F.lit("part"), "address"), F.lit(CALIBRATION_PARTS)) == 0
    # what is kept out has grams to score, but teaches nothing
    addresses = slim.select(F.when(~kept_out, F.col("verdict")).alias("verdict"), "address").distinct()
    scored = materialise(with_ratio(slim, gram_differences(addresses)), "url-scored")
    judged = scored.filter(kept_out & F.col("verdict").isNotNull()).select("verdict", "address", "ratio").distinct()
    bins = judged.groupBy(F.floor(F.col("ratio") * BINS).alias("bin")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("good"),
        F.count(F.when(F.col("verdict") == "block", 1)).alias("bad"),
    )
    # a few thousand bins: a byte's log-likelihoods differ by the logarithm of the largest count at most
    threshold = best_threshold([tuple(row) for row in bins.collect()])
    by_ratio = F.when(F.col("ratio") >= threshold, "allow").otherwise("block")
    return scored.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", by_ratio).alias("verdict"),
        "ratio",
        F.lit(threshold).alias("threshold"),
    )
