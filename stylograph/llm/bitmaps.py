"""Bitmaps of hashes: small filters that let few others pass, of a size that is bounded whatever the data."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_BITS = 15  # a row of ``bitmap_construct_agg`` holds 32,768 bits
LEAST, MOST = 20, 29  # a bitmap has from 128 KB to 64 MB
PER_HASH = 16  # bits for each hash, while the bound allows


def size_for(hashes: int) -> int:
    """Binary logarithm of the bits of a bitmap."""
    return min(MOST, max(LEAST, math.ceil(math.log2(PER_HASH * max(1, hashes)))))


def build(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap of a long column: aggregated on the executors, at most 64 MB when it comes to the driver."""
    bits = size_for(hashes.count())
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = hashes.groupBy(F.shiftright(at, ROW_BITS).cast("int").alias("row")).agg(
        F.call_function("bitmap_construct_agg", at.bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("bits")
    )
    out = np.zeros((1 << bits - ROW_BITS, 1 << ROW_BITS - 3), np.uint8)
    for r in rows.toLocalIterator():
        out[r.row] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the bitmap; no one that is gets lost."""
    at = hashes.view(np.uint64) & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
