"""Sharding by best-fit-decreasing bin packing of indivisible groups (law "bytes": shard sizes near equal).

Rows with equal texts are one group and stay together. Groups above 1/FINE of a shard are items of their own (there
are at most shards * FINE of them, whatever the input); all smaller groups fall by their hash into shards * FINE
bundles, which are items too. Items sorted by size enter the open bin with the tightest remaining capacity, found in
a balanced tree; the capacity is the least one for which no more bins than shards are needed. So the driver sees a
bounded table of items, and the rows only its result. Slots are numbered in two steps, so that no shard's rows meet
in one task: rows inside small sub-shards, sub-shards by running sums of their counts.

Defined cases: a null text has no bytes and counts as an empty text; a group larger than a shard's even share makes
its shard larger, as it cannot be cut; repeated rows and null ids are rows of their own and get their own slots; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import parts_for, stored

SHARDS, OVERHEAD = 24, 8
#: Items per shard: single groups above 1/FINE of a shard, and FINE bundles of smaller ones.
FINE = 256
#: Rows in a sub-shard, whose slots one task numbers.
SUB_ROWS = 100_000


class Bins:
    """Open bins in a balanced search tree (treap) by remaining capacity; the tightest bin that fits is a lower bound."""

    class Node:
        __slots__ = ("key", "rank", "left", "right")

        def __init__(self, key: tuple[int, int]):
            self.key, self.left, self.right = key, None, None
            self.rank = hash((key[0] * 2654435761 + key[1]) & 0xFFFFFFFFFFFF)

    def __init__(self):
        self.root = None

    def _split(self, node, key):
        if node is None:
            return None, None
        if node.key < key:
            node.right, right = self._split(node.right, key)
            return node, right
        left, node.left = self._split(node.left, key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a.rank < b.rank:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def add(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, self.Node(key)), right)

    def remove(self, key: tuple[int, int]) -> None:
        left, rest = self._split(self.root, key)
        _, right = self._split(rest, (key[0], key[1] + 1))
        self.root = self._merge(left, right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        node, best = self.root, None
        while node is not None:
            if node.key[0] >= size:
                best, node = node.key, node.left
            else:
                node = node.right
        return best


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; ``sizes`` must be in decreasing order. An item above the capacity has a bin of its own."""
    bins, place, opened = Bins(), [], 0
    for size in sizes:
        found = bins.tightest(size)
        if found is None:
            found = (max(capacity, size), opened)
            opened += 1
        else:
            bins.remove(found)
        bins.add((found[0] - size, found[1]))
        place.append(found[1])
    return place


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Bin of each item with the least capacity that needs at most ``shards`` bins; sizes in decreasing order."""
    if not sizes:
        return []
    low = max(sizes[0], -(-sum(sizes) // shards))
    high = low + sizes[0]
    while max(best_fit_decreasing(sizes, high)) >= shards:
        high *= 2
    capacity = bisect.bisect_left(range(low, high), True, key=lambda c: max(best_fit_decreasing(sizes, c)) < shards) + low
    return best_fit_decreasing(sizes, capacity)


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(F.lit(1), text).alias("g1"), F.xxhash64(F.lit(2), text).alias("g2"))
    rows = stored(rows, "shard-rows")
    groups = stored(rows.groupBy("g1", "g2").agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "shard-groups")
    total = groups.agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).first()
    bound = (total["size"] or 0) / (shards * FINE)
    bundle = F.pmod("g1", F.lit(shards * FINE))
    large = groups.where(F.col("size") > bound).collect()  # at most shards * FINE groups
    bundles = groups.where(F.col("size") <= bound).groupBy(bundle.alias("bundle")).agg(F.sum("size").alias("size")).collect()
    items = sorted([(r["size"], 1, r["g1"], r["g2"]) for r in large] + [(r["size"], 0, r["bundle"], 0) for r in bundles], key=lambda x: (-x[0], *x[1:]))
    place = pack_into([x[0] for x in items], shards)
    single = spark.createDataFrame([(x[2], x[3], s) for x, s in zip(items, place) if x[1]], "g1 long, g2 long, own int")
    many = spark.createDataFrame([(x[2], s) for x, s in zip(items, place) if not x[1]], "bundle long, common int")
    rows = rows.withColumn("bundle", bundle).join(F.broadcast(single), ["g1", "g2"], "left").join(F.broadcast(many), "bundle", "left")
    rows = rows.select("doc_id", "size", "text_crc32", F.coalesce("own", "common").alias("shard"))

    subs = parts_for(total["rows"] or 0, shards * SUB_ROWS)
    rows = stored(rows.withColumn("sub", F.pmod(F.xxhash64(F.lit(9), "doc_id", F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(subs))), "shard-placed")
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offset = rows.groupBy("shard", "sub").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("doc_id", "text_crc32", "size"))
    rows = rows.withColumn("inside", inside).join(offset, ["shard", "sub"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("inside") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
