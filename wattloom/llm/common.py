"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side with at most this many rows may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 200_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone.  ``lower`` does the same on pure ASCII, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has few enough rows, else as it is (a shuffled join)."""
    limit = BROADCAST_ROWS if rows is None else rows
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else df


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes (empty if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    x = np.full(n, np.uint64(size))
    for j in range(size):
        x = x * _MULTIPLIER + hashes[j:j + n]
    return mixed(x)


def as_bytes(column) -> list:
    """UTF-8 bytes of an Arrow string column; null stays None."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
