"""Minimax contiguous sharding of atomic groups, in DataFrame operations only.

Atomic groups are the rows of equal text; they are ordered by the hash of their text.  The smallest
capacity with which a greedy cut of that order needs no more than the wished number of shards is
found by search between the bounds total / shards and that plus the largest group; each step checks
several capacities at once.  The cut points are hashes, so every row finds its shard from its own
text, without a join.

Prefix sums have two levels: the hash range is dealt into ``BUCKETS`` equal slots, whose sums are a
bounded table, and the groups of a slot have their own running sum.  Only the slots in which a
cut may fall are read again.

Defined results: null and empty texts have size 1 and are one group; repeated rows stay together;
an empty table gives an empty result; with fewer groups than shards the last shards are empty.
Other columns are left alone.
"""

from __future__ import annotations

import bisect
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, staged

#: Slots of the hash range: rows of the table of sums that the driver reads.
BUCKETS = 4096
#: Capacities checked together: a step leaves this part of the range.
TOGETHER = 16


def text_hash(text: str = "text"):
    """Order of the groups; equal texts have equal hashes.  Texts that share a hash by accident stay
    together too, which keeps groups whole."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def text_size(text: str = "text"):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def _bucket(hashed):
    return F.shiftrightunsigned(hashed.bitwiseXOR(F.lit(-1 << 63)), 64 - BUCKETS.bit_length() + 1).cast("int")


class _Cuts:
    """Greedy cuts of the ordered groups for several capacities at once."""

    def __init__(self, groups: DataFrame):
        self.groups = groups  # bucket, h, size, running sum in the bucket: upto
        sums = {r["bucket"]: (r["n"], r["h"]) for r in groups.groupBy("bucket").agg(F.sum("size").alias("n"), F.max("h").alias("h")).collect()}
        self.buckets = sorted(sums)
        self.before, self.last = [0], []
        for b in self.buckets:
            self.before.append(self.before[-1] + sums[b][0])
            self.last.append(sums[b][1])
        self.total = self.before[-1]

    def reach(self, limits: list[int]) -> list[tuple[int, int | None]]:
        """For each limit the largest prefix sum within it, and the hash of that group."""
        found: list[tuple[int, int | None]] = []
        inside: dict[int, list[int]] = {}
        for i, limit in enumerate(limits):
            k = bisect.bisect_right(self.before, limit) - 1  # whole buckets within the limit
            found.append((self.before[k], self.last[k - 1] if k else None))
            if k < len(self.buckets) and self.before[k] < limit:
                inside.setdefault(k, []).append(i)
        if inside:
            wish = [F.when((F.col("bucket") == self.buckets[k]) & (F.col("upto") <= limits[i] - self.before[k]), F.struct("upto", "h"))
                    for k, own in inside.items() for i in own]
            order = [(k, i) for k, own in inside.items() for i in own]
            row = (self.groups.where(F.col("bucket").isin([self.buckets[k] for k in inside]))
                   .agg(*[F.max(w).alias(f"m{j}") for j, w in enumerate(wish)]).first())
            for j, (k, i) in enumerate(order):
                if row[j] is not None:
                    found[i] = (self.before[k] + row[j]["upto"], row[j]["h"])
        return found

    def greedy(self, capacities: list[int], shards: int) -> list[tuple[bool, list[int]]]:
        """For each capacity whether ``shards`` suffice, and the hashes of the last groups of all shards but the last."""
        at, cuts = [0] * len(capacities), [[] for _ in capacities]
        for step in range(shards):
            for c, (upto, h) in enumerate(self.reach([a + cap for a, cap in zip(at, capacities)])):
                at[c] = max(at[c], upto)
                if step < shards - 1 and h is not None:
                    cuts[c].append(h)
        return [(a >= self.total, own) for a, own in zip(at, cuts)]


def cut_points(docs: DataFrame, shards: int, text: str = "text") -> tuple[int, list[int]]:
    """The smallest feasible capacity and the hashes after which to cut, at most shards - 1."""
    h = text_hash(text)
    sizes = docs.select(h.alias("h"), text_size(text).alias("size")).groupBy("h").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("bucket").orderBy("h")
    groups, path = staged(sizes.withColumn("bucket", _bucket(F.col("h"))).withColumn("upto", F.sum("size").over(order)), "shard-groups")
    cuts = _Cuts(groups)
    largest = groups.agg(F.max("size").alias("m")).first()["m"] or 0
    low = max(largest, -(-cuts.total // shards)) - 1  # taken as too small; checked with the rest
    high = -(-cuts.total // shards) + largest  # always enough
    best = cuts.greedy([high], shards)[0][1] if cuts.total else []
    while high - low > 1:
        tries = sorted({low + (high - low) * i // (TOGETHER + 1) for i in range(1, TOGETHER + 1)} - {low, high})
        for capacity, (enough, own) in zip(tries, cuts.greedy(tries, shards)):
            if enough:
                high, best = capacity, own
                break
            low = capacity
    release(docs.sparkSession, path)
    return high, sorted(set(best))


def assign(docs: DataFrame, shards: int = 8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless in the shard) of every row.

    Slots follow the id within a fixed number of hash parts of a shard, so one shard, or one text with
    a third of all rows, is numbered by many tasks; the counts before a part are a bounded table."""
    _, cuts = cut_points(docs, shards, text)
    shard = reduce(lambda a, b: a + b, [(text_hash(text) > F.lit(c)).cast("int") for c in cuts], F.lit(0))
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_size(text).alias("size"), F.crc32(raw).alias("text_crc32"),
                       text_hash(text).alias("h"), shard.alias("shard"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(max(1, 8 * BUCKETS // shards))).cast("int"))
    rows, _ = staged(rows, "shard-rows")
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "h", "text_crc32")
    numbered = rows.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(starts), ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("at")).alias("slot"))
