"""Helpers for linking candidates: exact bounds on bitmaps, and components in two steps. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a set's bitmap of element hashes.
MAP_WORDS = 16


def may_link(a: str, b: str, similarity: int) -> Column:
    """False only for pairs of sets (columns prefixed ``a`` and ``b``) that cannot be ``similarity`` percent alike.

    Each bit that one bitmap has and the other lacks stands for an element that the other set lacks, which bounds the
    intersection from above: no link is left out.
    """
    def most(x, y):
        return F.col(f"{x}n") - sum(F.bit_count(F.col(f"{x}w{k}").bitwiseAND(F.bitwise_not(f"{y}w{k}"))) for k in range(MAP_WORDS))

    common = F.least(most(a, b), most(b, a))
    return 100 * common >= similarity * (F.col(f"{a}n") + F.col(f"{b}n") - common)


def contract(found: DataFrame, more: DataFrame) -> DataFrame:
    """Links (a, b) between the components that ``found`` (id, component) gives to both ends; unlinked ends are their own."""
    side = found.select(F.col("id"), F.col("component"))
    x = more.join(side.withColumnRenamed("id", "a").withColumnRenamed("component", "ca"), "a", "left")
    x = x.join(side.withColumnRenamed("id", "b").withColumnRenamed("component", "cb"), "b", "left")
    return x.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))


def merged(found: DataFrame, over: DataFrame) -> DataFrame:
    """Components after ``over`` (id, component) has merged components of ``found``."""
    up = over.select(F.col("id").alias("component"), F.col("component").alias("top"))
    old = found.join(up, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    new = over.join(found, "id", "left_anti").select("id", "component")
    return old.union(new)
