"""A Bloom filter of fixed size: what is sent to the executors has a proven bound, whatever the size of the data.

It only spares work: what it lets through by mistake is sorted out by the exact step behind it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits; as 64-bit words, an eighth of that many bytes reach the driver.
BITS = 1 << 22


def build(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """Bit words over the long column `key`, two bits a key, merged by aggregates of at most bits / 64 rows."""
    places = F.array(F.pmod(F.col(key), F.lit(bits)), F.pmod(F.shiftrightunsigned(F.col(key), 32), F.lit(bits)))
    rows = keys.where(F.col(key).isNotNull()).select(F.explode(places).alias("p"))
    words = rows.groupBy(F.shiftrightunsigned("p", 6).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("b"))
    out, got = np.zeros(bits // 64, np.int64), words.toArrow()
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out


def contains(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (int64) may be in the filter."""
    bits = len(words) * 64
    inside = np.ones(len(keys), bool)
    for p in (keys % bits, (keys.view(np.uint64) >> np.uint64(32)).astype(np.int64) % bits):
        inside &= (words[p >> 6] >> (p & 63)) & 1 == 1
    return inside
