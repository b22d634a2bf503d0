"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.session import materialize

#: A side is broadcast explicitly only when a count proves it has at most this many short rows.
BROADCAST_ROWS = 500_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (a lost executor re-reads the files)."""
    return materialize(df, f"llm-{name}")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table of short rows for broadcast when its row count is within ``limit``; else leave the join to the planner."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and everything else unchanged."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(_LOWER)


def pieces(data: bytes, size: int = 1 << 20):
    """Cut ``data`` at spaces into pieces of about ``size`` bytes, so that a very long text never becomes one huge word list."""
    start, n = 0, len(data)
    while start < n:
        end = start + size
        if end < n:
            end = data.find(b" ", end)
            end = n if end < 0 else end
        else:
            end = n
        yield data[start:end]
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit integers (wraps on purpose)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
