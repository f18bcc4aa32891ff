"""What the corpus operators share: reading tables, cutting lineage, small vector helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import cut, discard, shared_dir

__all__ = ["cut", "discard", "shared_dir"]

#: Words as the contracts of the operators define them.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the folder `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: at least the cores, at most what the session sets for shuffles."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(col) -> F.Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the murmur3 finaliser), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each of many ranges, joined."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each starts (and the last ends); null is empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `size` bytes, or of one row."""
    at, lo = utf8(texts)[1], 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi
