"""Hashes of word runs of a stated small set, looked for in all documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.words import Bitmap

_BUCKET = 32_768  # bits of one piece of Spark's bitmap aggregate


def bitmap_of(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of a `Bitmap` in which every hash of the column sets two bits.

    At most Bitmap.BITS / 32,768 rows of 4 KB reach the driver, whatever the number of hashes.
    """
    mask = Bitmap.BITS - 1
    h = F.col(column)
    place = F.explode(F.array(h.bitwiseAND(F.lit(mask)) + 1, F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask)) + 1))
    rows = (hashes.select(place.alias("place"))
            .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))).collect()
    bits = np.zeros(Bitmap.BITS // 8, np.uint8)
    for bucket, piece in rows:
        at = (bucket - 1) * _BUCKET // 8
        bits[at:at + len(piece)] = np.frombuffer(bytes(piece), np.uint8)
    return bits


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only where a hash is not among those the bits were made of."""
    bitmap = Bitmap(bits)
    found = bitmap[hashes]
    at = np.flatnonzero(found)
    found[at] = bitmap[hashes[at] >> np.uint64(32)]
    return found
