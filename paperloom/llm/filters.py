"""Bit filters of bounded size: a set of 64-bit hashes as a broadcast array.

A member always passes; others pass with a small chance that grows with the
set. Whatever passes is decided exactly later, so the size of the filter
changes the work and never the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (16 MB), whatever the data.
BITS = 1 << 27


def text_hash(text: str) -> int:
    """A signed 64-bit hash of a text."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def build(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter of a column of 64-bit hashes; its words, at most bits / 64,
    come to the driver."""
    mask = bits - 1
    places = hashes.select(F.explode(F.array(F.col(column).bitwiseAND(mask), F.shiftrightunsigned(column, 32).bitwiseAND(mask))).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("x")).toArrow()
    marks = np.zeros(bits // 64, np.uint64)
    marks[words["w"].to_numpy()] = words["x"].to_numpy().view(np.uint64)
    return marks


def passes(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the (unsigned) hashes pass."""
    mask = np.uint64(len(marks) * 64 - 1)
    out = np.ones(len(hashes), bool)
    for p in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        out &= (marks[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


class TextFilter:
    """A filter asked for one text at a time, with a memory."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.known = marks, {}

    def __contains__(self, text: str) -> bool:
        hit = self.known.get(text)
        if hit is None:
            mask, h = len(self.marks) * 64 - 1, text_hash(text) & 0xFFFFFFFFFFFFFFFF
            hit = all(int(self.marks[p >> 6]) >> (p & 63) & 1 for p in (h & mask, h >> 32 & mask))
            if len(self.known) >= 1 << 18:
                self.known.clear()
            self.known[text] = hit
        return hit
