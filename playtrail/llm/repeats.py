"""Which hashes occur twice or more: a bit map of bounded size, counted in Spark and broadcast."""

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FILTER_BYTES = 1 << 25
# Bits of one `bitmap_construct_agg`, a fixed value of Spark.
_BITMAP_BITS = 32768


def filter_bits(n_rows: int, bits_per_row: int, max_bytes: int = MAX_FILTER_BYTES) -> int:
    """A power of two: so many bits a row, up to the bound."""
    wanted = max(n_rows * bits_per_row, _BITMAP_BITS)
    return min(1 << (wanted - 1).bit_length(), 1 << ((max_bytes * 8).bit_length() - 1))


def cell(hashed: Column, bits: int) -> Column:
    return hashed.bitwiseAND(F.lit(bits - 1))


def bit_map(cells: DataFrame, bits: int) -> Broadcast:
    """The cells of a one-column table as a broadcast array of bits. Its size is that of the filter."""
    (name,) = cells.columns
    maps = cells.groupBy(F.bitmap_bucket_number(name).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias("bits")
    )
    # Bucket 0 has cell 0 alone; bucket b, from 1 on, has the cells from (b - 1) * 32768 + 1 to b * 32768.
    packed = np.zeros(bits // 8 + _BITMAP_BITS // 8, np.uint8)
    for row in maps.toLocalIterator():
        start = row.bucket * _BITMAP_BITS // 8
        packed[start : start + len(row.bits)] |= np.frombuffer(row.bits, np.uint8)
    return cells.sparkSession.sparkContext.broadcast(packed)


def in_map(packed: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """For each cell whether its bit is set."""
    cells = cells.astype(np.int64)
    bucket = np.where(cells > 0, 1 + (cells - 1) // _BITMAP_BITS, 0)
    position = np.where(cells > 0, (cells - 1) % _BITMAP_BITS, 0)
    return (packed[bucket * (_BITMAP_BITS // 8) + (position >> 3)] >> (position & 7).astype(np.uint8)) & 1 == 1
