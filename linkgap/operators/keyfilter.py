"""Semi joins with a key set of any size, without moving the large side.

A key set that the planner can broadcast is left to it. A larger one is first
folded into a bitmap of its keys' hashes, one row per 64 bits, whose number of
rows is bounded by ``MAX_FILTER_BITS``; the large side is tested against
the broadcast bitmap where it is scanned, and only the rows that pass go through
the exchange of the exact semi join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key that the bitmap is sized for (a few percent of other rows pass).
BITS_PER_KEY = 16
#: The bitmap has at most 2 ** 28 bits: 4 million rows of 16 bytes.
MAX_FILTER_BITS = 28


def plan_bytes(df: DataFrame) -> int:
    """The planner's estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's size up to which the planner broadcasts a join side, in bytes."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def filter_bits(keys: DataFrame) -> int:
    """Bits of the bitmap for the estimated number of keys (8 bytes and more each), a power of two."""
    return min(MAX_FILTER_BITS, max(16, (BITS_PER_KEY * plan_bytes(keys) // 8).bit_length()))


def _place(h: Column) -> Column:
    """Place of a hash in its 64-bit word: its highest 6 bits."""
    return F.shiftrightunsigned(h, 58).cast("int")


def key_bitmap(keys: DataFrame, on: str, bits: int) -> DataFrame:
    """(_word, _bits): at most 2 ** (bits - 6) rows."""
    h = F.xxhash64(on)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _place(h))
    return (keys.select(h.bitwiseAND(F.lit((1 << bits - 6) - 1)).alias("_word"), bit.alias("_bit"))
            .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))


def semi_join(large: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``large`` whose ``on`` is among those of ``keys`` (repeated or null keys change
    nothing; a null ``on`` never matches)."""
    keys = keys.select(on).distinct()
    if plan_bytes(keys) <= broadcast_limit(large):
        return large.join(keys, on, "left_semi")
    bits = filter_bits(keys)
    h = F.xxhash64(on)
    passed = (large.withColumn("_word", h.bitwiseAND(F.lit((1 << bits - 6) - 1)))
              .join(F.broadcast(key_bitmap(keys, on, bits)), "_word")  # rows bounded by the bits
              .where(F.call_function("shiftrightunsigned", F.col("_bits"), _place(h)).bitwiseAND(F.lit(1)) == 1))
    # an inner join with distinct keys: the optimizer would move a semi join below the bitmap's
    return passed.select(*large.columns).join(keys.where(F.col(on).isNotNull()), on).select(*large.columns)
