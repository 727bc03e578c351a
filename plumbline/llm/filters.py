"""A membership filter of fixed size: a bitmap over hashes, built by Spark's bitmap aggregates, that lets a scan drop most rows that cannot
matter before they are shuffled. It may let others through, never the other way, so an exact join always follows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: 16 MB, whatever the data hold.
LOG_BITS = 27
PROBES = 2


def spot(value: Column, probe: int, log_bits: int = LOG_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value, F.lit(probe)), 64 - log_bits)


def member_bits(values: DataFrame, hashed: bool = False, log_bits: int = LOG_BITS) -> Broadcast:
    """The filter of a one-column frame, of hashes already if `hashed`; what reaches the driver is at most the bitmap itself."""
    value = F.col(values.columns[0])
    if hashed:
        probes = [F.shiftrightunsigned(value, 64 - log_bits), value.bitwiseAND((1 << log_bits) - 1)]
    else:
        probes = [spot(value, p, log_bits) for p in range(PROBES)]
    spots = values.select(F.explode(F.array(*probes)).alias("s"))
    parts = spots.groupBy(F.bitmap_bucket_number(F.col("s") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("s") + 1)).alias("bits"))
    whole = np.zeros((1 << log_bits) // 8, np.uint8)
    for row in parts.toLocalIterator():
        at = (row["bucket"] - 1) * 4096  # buckets of 32768 positions count from 1
        whole[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(whole) - at]
    return values.sparkSession.sparkContext.broadcast(whole)


def has_hash(whole: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes may be members of a filter made with `hashed`."""
    bits = (len(whole) * 8).bit_length() - 1
    return has(whole, [(hashes >> np.uint64(64 - bits)).astype(np.int64), (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)])


def xxhash_longs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64(first, second) gives for two columns of whole 64-bit numbers."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    seed = np.full(len(first), 42, np.uint64)
    for value in (first, second):
        h = seed + p5 + np.uint64(8)
        h ^= turned(value.astype(np.int64).view(np.uint64) * p2, 31) * p1
        h = turned(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        seed = h ^ (h >> np.uint64(32))
    return seed


def has(whole: np.ndarray, spots: list[np.ndarray]) -> np.ndarray:
    keep = np.ones(len(spots[0]), bool)
    for s in spots:
        keep &= (whole[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
    return keep


def bit_table(values: DataFrame, log_bits: int = LOG_BITS) -> DataFrame:
    """The filter of a one-column frame as rows of 4 KB bitmaps: at most 2^log_bits bits in all, so it can be broadcast."""
    s = values.select(spot(F.col(values.columns[0]), 0, log_bits).alias("s"))
    return s.groupBy(F.bitmap_bucket_number(F.col("s") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("s") + 1)).alias("bits"))


def where_bit(df: DataFrame, value: Column, table: DataFrame, log_bits: int = LOG_BITS) -> DataFrame:
    """Rows of `df` whose value may be a member, without leaving the JVM."""
    columns = df.columns
    at = spot(value, 0, log_bits)
    asked = df.select(*columns, F.bitmap_bucket_number(at + 1).alias("bucket"), F.bitmap_bit_position(at + 1).alias("position"))
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(position DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    found = asked.join(F.broadcast(table), "bucket").where(F.getbit(byte, F.pmod("position", F.lit(8)).cast("int")) == 1)
    return found.select(*columns)
