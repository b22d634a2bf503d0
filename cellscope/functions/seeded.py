"""Seeded, partition-independent random numbers as Column expressions.

A value depends only on (tag, key), never on partitioning or task order, so a
re-run after a lost executor reproduces it and a SQL engine with ``md5`` can
compute the same number: the first 8 hex digits of md5("tag:key") read as an
unsigned integer and divided by 2^32.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def seeded_uniform(tag, key) -> Column:
    """Uniform in [0, 1) from md5 of ``tag:key``; ``tag`` may be a str or Column."""
    tag_col = F.lit(tag) if isinstance(tag, str) else tag
    key_col = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(tag_col, F.lit(":"), key_col.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(TWO_32)


def seeded_normal(tag: str, key) -> Column:
    """Standard normal by Box-Muller over two seeded uniforms (u1 in (0, 1])."""
    u1 = F.lit(1.0) - seeded_uniform(f"{tag}-a", key)
    u2 = seeded_uniform(f"{tag}-b", key)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def py_uniform(tag: str, key) -> float:
    """Driver-side twin of :func:`seeded_uniform` for scalar draws."""
    h = hashlib.md5(f"{tag}:{key}".encode()).hexdigest()
    return int(h[:8], 16) / TWO_32


def py_normal(tag: str, key) -> float:
    u1 = 1.0 - py_uniform(f"{tag}-a", key)
    u2 = py_uniform(f"{tag}-b", key)
    return math.sqrt(-2.0 * math.log(u1)) * math.cos(2.0 * math.pi * u2)


def sql_uniform(tag: str, key_sql: str) -> str:
    """DuckDB text of :func:`seeded_uniform` (used by the SQL oracles)."""
    return (f"(('0x' || substr(md5('{tag}:' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"
            f" / CAST(4294967296 AS DOUBLE))")


def sql_normal(tag: str, key_sql: str) -> str:
    u1 = f"(CAST(1 AS DOUBLE) - {sql_uniform(tag + '-a', key_sql)})"
    u2 = sql_uniform(tag + "-b", key_sql)
    return f"(sqrt(CAST(-2 AS DOUBLE) * ln({u1})) * cos({sql_lit(2.0 * math.pi)} * {u2}))"


def sql_lit(x: float) -> str:
    """A double literal DuckDB reads as DOUBLE (bare decimals parse as DECIMAL)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"
