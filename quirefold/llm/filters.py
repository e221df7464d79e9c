"""Bit filters that readers use to pass on only what a join can need.

A filter never drops a row that the join matches; what it passes too much the join drops. It is built on the executors
as bitmaps. It has 2 MB, or where more values are announced ``SPARSE`` bits for each, up to a bound, whatever the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter as a power of two: 2 MB; and of the largest one: 64 MB.
FILTER_BITS, MOST_BITS = 24, 29
#: Bits for each value of a filter, so that few others pass it.
SPARSE = 32


def filter_bits(n: int) -> int:
    """The power of two of the bits of a filter for ``n`` values."""
    return min(max(FILTER_BITS, (n * SPARSE - 1).bit_length()), MOST_BITS)


def bit_filter(values: DataFrame, column: str, n: int = 0) -> np.ndarray:
    """A filter in which the highest bits of each 64-bit hash in ``column`` are set; ``n``: of how many values, about."""
    bits = filter_bits(n)
    bit = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    rows = values.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect()  # rows of 4 kB: 512, or 16,384 of the largest filter
    out = np.zeros(2**bits // 8, np.uint8)
    for r in rows:
        held = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["bucket"] - 1) * len(held)
        out[at : at + len(held)] = held
    return out


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be among those of the filter."""
    bit = hashes.view(np.uint64) >> np.uint64(64 - (len(bits) * 8 - 1).bit_length())
    return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
