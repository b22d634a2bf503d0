"""Connected components of a link table by alternating star contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import stored


def _ordered(df: DataFrame) -> DataFrame:
    return df.where("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _ordered(both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi")
    return _ordered(moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least.select("hi", F.col("m").alias("lo"))))


def _state(edges: DataFrame) -> tuple:
    mark = F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 40))
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def connected_components(links: DataFrame, a: str, b: str, name: str = "cc") -> DataFrame:
    """Return (id, component) for every node of ``links``; the component is its smallest node.

    Each round is two star contractions, written to the shared folder. A hub shared by very many links is
    reduced by partial aggregation, and its join is an ordinary equi-join that adaptive execution may split.
    An empty link table gives an empty result; self-links, repeated and reversed links change nothing.
    """
    edges = stored(_ordered(links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("hi"), F.col(b).alias("lo"))).distinct(), name)
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)).distinct(), name)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
