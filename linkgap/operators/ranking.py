"""Positions by a total order without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead: range-partition and sort (``orderBy``), tag every row with its
partition index and its index inside the partition
(``monotonically_increasing_id`` = partition << 33 | row), and WRITE the
tagged rows once under the shared folder. Counts per (partition, group)
and the final rows are both read from that written copy, so the two can
never disagree about a partition number (a recomputed range sort samples its
bounds anew, and adaptive execution may merge partitions differently).
The counts become offsets with a window over the small counts table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir

_LOW_BITS = (1 << 33) - 1

#: Offsets are broadcast up to this many rows; beyond it they are joined by a shuffle.
MAX_BROADCAST_OFFSETS = 100_000


def tag_order(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``df`` sorted by ``keys``, with ``_part`` (range partition) and ``_row``
    (0-based place in it) written once and read back: both are stored values."""
    out = new_run_dir(df.sparkSession, "ranked")
    mid = F.col("_mid")
    (df.orderBy(*keys).withColumn("_mid", F.monotonically_increasing_id())
     .withColumn("_part", F.shiftright(mid, 33)).withColumn("_row", mid.bitwiseAND(F.lit(_LOW_BITS)))
     .drop("_mid").write.parquet(out))
    return df.sparkSession.read.parquet(out)


def rank_positions(df: DataFrame, order: list[Column], name: str = "pos",
                   group: str | None = None) -> DataFrame:
    """Append a 1-based ``name`` column numbering rows by ``order``
    (restarting per ``group`` value when given; nulls are one group).

    Runs one job when called (the tagged write). Rows in = rows out and the
    positions are exactly 1..n whatever the partition count; rows that tie on
    every key are numbered in an unspecified but fixed order.
    """
    keys = ([F.col(group).asc_nulls_first()] if group else []) + list(order)
    tagged = tag_order(df, keys)
    g = [F.col(group).alias("_g")] if group else [F.lit(0).alias("_g")]
    counts = tagged.groupBy("_part", *g).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    w = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_op"), F.col("_g").alias("_og"), "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    if offsets.limit(MAX_BROADCAST_OFFSETS + 1).count() <= MAX_BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    on = tagged["_part"] == offsets["_op"]
    if group:
        on = on & tagged[group].eqNullSafe(offsets["_og"])
    pos = F.col("_offset") + F.col("_row") - F.col("_first") + F.lit(1)
    return (tagged.join(offsets, on, "inner").withColumn(name, pos)
            .drop("_part", "_row", "_op", "_og", "_offset", "_first"))
