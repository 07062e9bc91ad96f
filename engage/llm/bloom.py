"""Blocked Bloom filters of 64-bit keys that travel to tasks: bounded in size, no false negatives."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BLOCKS = 1 << 18  # 256-bit blocks, at most: 8 MiB, however many keys
PER_BLOCK = 16


def blocked_filter(keys: DataFrame) -> np.ndarray:
    """The filter of the only column of ``keys`` (bigint): blocks x 4 words, one bit set in each word of a key's block.

    Blocks are put together by an aggregation; at most ``BLOCKS`` rows come to the driver.
    """
    (name,) = keys.columns
    blocks = min(BLOCKS, 1 << max(4, (keys.count() // PER_BLOCK).bit_length()))
    h = F.xxhash64(name)
    place = lambda k: F.shiftrightunsigned(F.col("h"), 36 + 6 * k).bitwiseAND(F.lit(63)).cast("int")
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), place(k))
    rows = (
        keys.select(h.alias("h"))
        .groupBy(F.pmod(F.col("h"), F.lit(blocks)).alias("block"))
        .agg(*[F.bit_or(bit(k)).alias(f"w{k}") for k in range(4)])
        .toArrow()
    )
    table = np.zeros((blocks, 4), dtype=np.uint64)
    for k in range(4):
        table[rows.column(0).to_numpy(), k] = rows.column(k + 1).to_numpy().view(np.uint64)
    return table


def _rotate(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxhash64(keys: np.ndarray, seed: int = 42) -> np.ndarray:
    """The hash that the SQL function of the same name gives for one bigint."""
    p1, p2, p3, p4, p5 = (  # fixed values: the primes of the published algorithm
        np.uint64(0x9E3779B185EBCA87),
        np.uint64(0xC2B2AE3D27D4EB4F),
        np.uint64(0x165667B19E3779F9),
        np.uint64(0x85EBCA77C2B2AE63),
        np.uint64(0x27D4EB2F165667C5),
    )
    h = np.uint64(seed) + p5 + np.uint64(8)
    h = h ^ (_rotate(keys.view(np.uint64) * p2, 31) * p1)
    h = _rotate(h, 27) * p1 + p4
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    return h ^ (h >> np.uint64(32))


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (int64) may be in the filter."""
    h = xxhash64(np.ascontiguousarray(keys))
    block = (h & np.uint64(len(table) - 1)).astype(np.int64)
    hit = np.ones(len(h), dtype=bool)
    for k in range(4):
        hit &= (table[block, k] >> ((h >> np.uint64(36 + 6 * k)) & np.uint64(63))) & np.uint64(1) == 1
    return hit


