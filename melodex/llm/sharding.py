"""Cutting an ordered table of atomic groups into shards of nearly equal size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from melodex.llm.common import root_of, total_before
from melodex.session import materialise

# capacities tried per round of the search; a round divides the interval by one more than this
TRIALS = 64


class _Prefix:
    """Sizes summed along the group order: each group's end, looked up by few small aggregates."""

    def __init__(self, ends: DataFrame, total: int, largest: int):
        self.ends, self.total, self.largest = ends, total, largest

    def last_up_to(self, positions: list[int]) -> list[int]:
        """For each position the last group end that is not after it (0 if there is none)."""
        low, high = min(positions), max(positions)
        limits = sorted(set(positions))
        place = F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x < F.col("end")))
        found = (
            self.ends.filter((F.col("end") > low - self.largest) & (F.col("end") <= high))
            .groupBy(place.alias("place"))
            .agg(F.max("end").alias("end"))
            .collect()  # at most one row per trial
        )
        best = {row["place"]: row["end"] for row in found}
        reached, at = {}, 0
        for k, limit in enumerate(limits):
            at = max(at, best.get(k, 0))
            reached[limit] = at
        return [reached[x] for x in positions]

    def first_from(self, position: int) -> int:
        """The first group end that is not before the position."""
        if position <= 0:
            return 0
        near = self.ends.filter((F.col("end") >= position) & (F.col("end") < position + self.largest))
        found = near.agg(F.min("end")).first()[0]
        return self.total if found is None else found

    def greedy(self, capacities: list[int], shards: int) -> list[bool]:
        """Whether filling shard after shard up to a capacity places every group."""
        at = [0] * len(capacities)
        for _ in range(shards):
            at = self.last_up_to([min(a + c, self.total) for a, c in zip(at, capacities)])
            if min(at) == self.total:
                break
        return [a == self.total for a in at]

    def smallest_capacity(self, shards: int) -> int:
        even = math.ceil(self.total / shards)
        low, high = max(even, self.largest) - 1, even + self.largest  # low can't do, high always does
        while high - low > 1:
            trials = sorted({low + (high - low) * (k + 1) // (TRIALS + 1) for k in range(TRIALS)} - {low, high})
            for capacity, fits in zip(trials, self.greedy(trials, shards)):
                if fits:
                    high = capacity
                    break
                low = capacity
        return high

    def cuts(self, shards: int) -> list[int]:
        """Ends of all shards but the last. Among the cuts that keep the smallest capacity, each shard ends
        as near as it can to an even share of what is left."""
        capacity = self.smallest_capacity(shards)
        least = [self.total]
        for _ in range(shards - 1):
            least.append(self.first_from(least[-1] - capacity))
        least = least[::-1]  # least[i]: where shard i must end at the latest start of the rest
        cuts, start = [], 0
        for i in range(shards - 1):
            wish = start + (self.total - start) // (shards - i)
            below, most = self.last_up_to([wish, min(start + capacity, self.total)])
            above = self.first_from(wish)
            end = below if wish - below <= above - wish and below > start else above
            end = min(max(end, least[i]), most)
            cuts.append(end)
            start = end
        return cuts


def shard_documents(
    docs: DataFrame, shards: int = 8, *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Give each document a shard and a slot in it, with shard sizes as near to equal as whole groups allow.

    A document's size is the UTF-8 bytes of its text plus one; a null text has none. Equal texts are one group
    and stay together; groups are ordered by the hash of their text. The smallest capacity is searched for which
    filling shard after shard places all groups; the cuts keep it. A group larger than an even share makes its
    shard larger than the others. Slots run from 0 without gaps, in an order drawn by hash; rows that are equal
    in all columns have slots of their own. With fewer groups than shards some shards stay empty.

    Returns id, size, text_crc32, shard, slot.
    """
    slim = docs.select(
        F.col(id_column).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )
    slim = materialise(slim, "shard-rows")
    placed = slim.withColumn("shard", _shard_of(_cut_groups(slim, shards)))
    buckets = root_of(slim.agg(F.count("*")).scalar() / shards)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("id", "group"), buckets))
    numbered = total_before(placed, ["shard"], "bucket", ["id", "group", "size"], F.lit(1), "slot")
    return numbered.select(
        F.col("id").alias(id_column), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )


def _shard_of(cuts: list[int]) -> Column:
    return sum(((F.col("group") > cut).cast("int") for cut in cuts), F.lit(0))


def _cut_groups(slim: DataFrame, shards: int) -> list[int]:
    """The last group of every shard but the last."""
    sizes = materialise(slim.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    groups, total, largest = sizes.agg(F.count("*"), F.sum("bytes"), F.max("bytes")).first()
    if not groups:
        return []
    bits = max(1, math.ceil(math.log2(groups) / 2))  # about the root of the groups in each bucket
    bucketed = sizes.withColumn("bucket", F.shiftright("group", 64 - bits))
    summed = total_before(bucketed, [], "bucket", ["group"], F.col("bytes"), "before")
    # in order, so that a lookup reads the few row groups around its position
    ends = summed.select("group", (F.col("before") + F.col("bytes")).alias("end"))
    ends = materialise(ends.repartitionByRange("group").sortWithinPartitions("group"), "shard-ends")
    cuts = _Prefix(ends, total, largest).cuts(shards)
    found = {row["end"]: row["group"] for row in ends.filter(F.col("end").isin(cuts)).collect()}
    return [found.get(cut, -(2**63)) for cut in cuts]
