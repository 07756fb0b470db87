"""Sharding by sampled splitters (DataFrame functions only).

Records are ordered by a key made of the text's hash and a salt, so equal
texts stand together. Size-weighted key samples give quantile boundaries, and
records are range-partitioned by them. A range that one group of equal texts
overfills is subdivided by the salt; another overfull range by its own key
interval. Exact byte sums per range and running sums inside a range then give
every record its place in the whole order, and the order is cut into shards of
equal bytes. Samples are drawn by hash, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_positions
from .common import hash60, stored

#: Ranges of near equal bytes; a range is the unit of sorting.
RANGES = 4096
#: Expected key samples per range.
SAMPLES = 16
#: Key cells by which a record finds its splitters (the key's top 12 bits).
_CELL_SHIFT = 60 - 12
_KEY_SPACE = 1 << 60


def _splitters(keys: DataFrame, total: int, ranges: int) -> DataFrame:
    """(cell, base, bounds): by key cell, the range in which the cell begins
    and the boundaries inside it. At most 4096 rows and ``2 * ranges`` boundaries."""
    u = F.pmod(F.col("salt"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    draws = F.floor(F.col("size") * F.lit(ranges * SAMPLES / max(total, 1)) + u).cast("int")
    sample = keys.select("key", "salt", draws.alias("draws")).where("draws > 0").select(
        "key", "salt", F.explode(F.sequence(F.lit(1), F.col("draws"))).alias("draw"))
    picks = (rank_positions(sample, [F.col("key").asc(), F.col("salt").asc(), F.col("draw").asc()], "pos")
             .where(F.pmod(F.col("pos"), F.lit(SAMPLES)) == 0).groupBy("key").agg(F.count("*").alias("n")))
    # a key that fills two or more quantiles gets a range of its own: [key, key + 1)
    bounds = picks.select(F.explode(F.when(F.col("n") > 1, F.array(F.col("key"), F.col("key") + 1))
                                    .otherwise(F.array("key"))).alias("bound")).distinct()
    cells = (bounds.groupBy(F.shiftright("bound", _CELL_SHIFT).alias("cell"))
             .agg(F.sort_array(F.collect_list("bound")).alias("bounds")))
    every = keys.sparkSession.range(1 << 12).select(F.col("id").alias("cell")).join(cells, "cell", "left")
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows
    bounds = F.coalesce("bounds", F.array().cast("array<bigint>"))
    return every.select("cell", bounds.alias("bounds")).select(
        "cell", "bounds", F.coalesce(F.sum(F.size("bounds")).over(before), F.lit(0)).alias("base"))


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
          ranges: int = RANGES) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: shards 0 to ``shards - 1`` of
    near equal bytes, slots gapless from 0 in each.

    ``size`` is the text's UTF-8 bytes plus 1. A group of equal texts of at
    most ``1 / ranges`` of all bytes stays in one shard; a larger one may be
    cut. A shard's bytes differ from the even share by at most such a group or
    one document. A null text is empty; null ids are allowed; repeated rows
    each get a slot (an overfull run of them is dealt by a stored row number);
    other columns are ignored; an empty table gives no rows.
    Runs jobs when called (keys, sample and places are written).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = stored(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        hash60(text).alias("key"), hash60(F.lit("salt"), F.col(id_col), text).alias("salt"),
        hash60(F.lit("copy"), F.monotonically_increasing_id()).alias("copy")), "shard-keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    split = _splitters(keys, total, ranges)
    low = F.expr("size(filter(bounds, b -> b <= key))")
    # the splitter table has 4096 rows and at most 2 * ranges boundaries by construction
    placed = (keys.withColumn("cell", F.shiftright("key", _CELL_SHIFT)).join(F.broadcast(split), "cell")
              .withColumn("range", F.col("base") + low).drop("cell", "bounds", "base"))
    fill = stored(placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.min("key").alias("from"),
                                              F.max("key").alias("to")), "shard-ranges")
    cap = 1.5 * total / ranges
    parts = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(max(cap, 1.0)))).cast("long")
    # one row per range: at most 2 * ranges + 1, as above
    subdivided = F.broadcast(fill.select("range", "from", "to", parts.alias("parts")).where("parts > 1"))
    placed = placed.join(subdivided, "range", "left")
    one_group = F.col("from") == F.col("to")
    share = F.when(one_group, F.col("salt") / F.lit(float(_KEY_SPACE))).otherwise(
        (F.col("key") - F.col("from")) / (F.col("to") - F.col("from") + 1))
    sub = F.least(F.floor(share * F.col("parts")).cast("long"), F.col("parts") - 1)
    placed = placed.withColumn("sub", F.coalesce(sub, F.lit(0)))
    # rows that repeat wholly share their salt: such a run of more than `cap` bytes is a spot of its own,
    # dealt by row number. A run fills a range or more, so there are at most `ranges` of them.
    runs = (placed.where(F.col("parts").isNotNull() & one_group).groupBy("range", "sub", "salt")
            .agg(F.sum("size").alias("bytes")).where(F.col("bytes") > F.lit(cap)))
    runs = runs.groupBy("range", "sub").agg(F.sort_array(F.collect_list(F.struct(
        "salt", F.ceil(F.col("bytes") / F.lit(max(cap, 1.0))).alias("parts")))).alias("runs"))
    placed = placed.join(F.broadcast(runs), ["range", "sub"], "left")
    mine = F.get(F.expr("filter(runs, r -> r.salt = salt)"), F.lit(0))["parts"]
    lower = F.coalesce(F.size(F.expr("filter(runs, r -> r.salt < salt)")), F.lit(0))
    lower = F.when(F.col("runs").isNull(), 0).otherwise(lower)
    dealt = F.floor(F.col("copy") / F.lit(float(_KEY_SPACE)) * mine).cast("long")
    placed = placed.withColumn("run", 2 * lower + F.when(mine.isNotNull(), 1).otherwise(0)).withColumn(
        "deal", F.coalesce(F.least(dealt, mine - 1), F.lit(0))).select(
        "doc_id", "size", "text_crc32", "key", "salt", "copy", "range", "sub", "run", "deal")
    spot = ["range", "sub", "run", "deal"]
    before = Window.orderBy(*spot).rowsBetween(Window.unboundedPreceding, -1)  # a few thousand rows
    starts = (placed.groupBy(*spot).agg(F.sum("size").alias("bytes"))
              .select(*spot, F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("spot_start")))
    order = ["key", "salt", "doc_id", "copy"]
    inside = Window.partitionBy(*spot).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*spot, "key")
    rows = (placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .withColumn("group_bytes", F.sum("size").over(group)).withColumn("group_start", F.min("inside").over(group))
            .join(starts, spot))
    # small groups go by their middle, larger ones record by record
    whole = F.col("group_bytes") <= F.lit(total // ranges)
    twice_middle = F.when(whole, 2 * (F.col("spot_start") + F.col("group_start")) + F.col("group_bytes")).otherwise(
        2 * (F.col("spot_start") + F.col("inside")) + F.col("size"))
    number = F.least(F.lit(shards - 1), F.floor(twice_middle * shards / F.lit(2 * max(total, 1))).cast("int"))
    rows = stored(rows.select("doc_id", "size", "text_crc32", "key", "salt", "copy", *spot, number.alias("shard")), "shard-rows")
    counts = rows.groupBy("shard", *spot).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(*spot).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", *spot, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = Window.partitionBy("shard", *spot).orderBy(*order)
    return (rows.withColumn("place", F.row_number().over(place)).join(firsts, ["shard", *spot])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place") - 1).alias("slot")))
