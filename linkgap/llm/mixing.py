"""Mixing sources to target weights.

Every document gets a hash-random key; the documents of a source, taken in
key order, form one epoch of the source. A source's target is a share of all
words by weight, at most ``max_repeats`` times its size, with the excess
given to the others by weight. Its budget (the target, rounded) is then cut
out of its epochs exactly: whole epochs first, and of the last one the words
before the cut.

Keys are uniform, so equal key intervals are ranges of near equal size in
every source, however large the source: sorting and running sums happen
inside a (source, range) cell, and the cells' totals give each cell's start.
No task ever holds a source, and no range bounds have to be sampled. Only
rows that repeat wholly share a key: a cell that they overfill is sorted by
sampled bounds over many tasks instead, with a row number after the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_positions, tag_order
from .common import SPACE, WORD, hash60, stored, word_count

#: Key intervals per source. 4096 keep a source of 10 billion documents at
#: 2.5 million narrow rows a cell.
RANGES = 4096
_RANGE_SHIFT = 60 - 12
#: A cell of more rows than this is hot; cells of distinct rows stay far below.
HOT_ROWS = 4_000_000
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3


def source_targets(sources: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(skey, source, source_size, target) from (skey, source, source_size).

    Sources take the weights in code-point order, null last, repeating the
    list. All targets add up to the sum of the sizes; none is above
    ``max_repeats`` times its source's size. The level (words per unit of
    weight) is found by rounds of one aggregate over the sources: sources at
    their ceiling are fixed and the rest is shared again, until no more reach it.
    """
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    ranked = rank_positions(sources, order, "pos")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    table = stored(ranked.select("skey", "source", "source_size", w.alias("weight"),
                                 (F.col("source_size") * max_repeats).alias("ceiling")), "mix-sources")
    words = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("ceiling")
        if capped < 0:
            full = F.lit(False)
        fixed, rest, n = table.agg(F.sum(F.when(full, F.col("ceiling")).otherwise(0)),
                                   F.sum(F.when(full, 0).otherwise(F.col("weight"))),
                                   F.sum(F.when(full, 1).otherwise(0))).first()
        if not rest or n == capped:
            break
        level, capped = (words - fixed) / rest, n
    full = F.col("weight") * F.lit(level) >= F.col("ceiling")
    return table.select("skey", "source", "source_size",
                        F.when(full, F.col("ceiling").cast("double"))
                        .otherwise(F.col("weight") * F.lit(level)).alias("target"))


def _running(rows: DataFrame, cells: DataFrame, hot_rows: int) -> DataFrame:
    """``rows`` plus ``inside``: the words before each row in its cell, by (key, doc_id, size)."""
    cell, order = ["skey", "range"], ["key", "doc_id", "size"]
    before = Window.unboundedPreceding
    inside = Window.partitionBy(*cell).orderBy(*order).rowsBetween(before, -1)
    hot = cells.where(F.col("rows") > hot_rows).select(*cell)
    if not hot.limit(1).count():
        return rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    cold = rows.join(hot, cell, "left_anti").withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # the row number is the last sort key: range bounds fall between equal rows too
    tagged = tag_order(rows.join(hot, cell, "left_semi").withColumn("_copy", F.monotonically_increasing_id()),
                       [F.col(c) for c in (*cell, *order, "_copy")])
    parts = tagged.groupBy(*cell, "_part").agg(F.sum("size").alias("_words"))
    offset = F.sum("_words").over(Window.partitionBy(*cell).orderBy("_part").rowsBetween(before, -1))
    offsets = parts.select(*cell, "_part", F.coalesce(offset, F.lit(0)).alias("_offset"))
    place = Window.partitionBy("_part", *cell).orderBy("_row").rowsBetween(before, -1)
    spread = (tagged.withColumn("inside", F.coalesce(F.sum("size").over(place), F.lit(0)))
              .join(offsets, [*cell, "_part"]).withColumn("inside", F.col("inside") + F.col("_offset"))
              .drop("_part", "_row", "_copy", "_offset"))
    return cold.unionByName(spread)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS, carry: tuple[str, ...] = (),
        hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per document with what the mix takes of it.

    Returns ``doc_id, source, size, source_size, target, taken`` (all in
    words), ``epochs`` (whole copies), ``part`` (words of the copy cut at the
    budget) and ``in_part`` (whether that last copy begins before the cut),
    then the columns named in ``carry`` as a struct ``carried``.

    A null text is empty: size 0, nothing taken. A null source is a source of
    its own; null ids are told apart by their texts. Rows that repeat entirely
    share a key and follow each other. Other columns of ``docs`` are ignored,
    whatever their names. An empty table gives no rows. Runs a first pass over
    the documents (totals by source and range) when called.
    """
    text, source = F.col(text_col), F.col(source_col).cast("string")
    key = hash60(F.lit("mix"), F.col(id_col), text)
    base = docs.select(
        F.col(id_col).alias("doc_id"), source.alias("source"),
        F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("skey"),
        word_count(text).alias("size"), key.alias("key"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    ).withColumn("range", F.shiftright("key", _RANGE_SHIFT))
    totals = stored(base.groupBy("skey", "range").agg(F.first("source").alias("source"),
                                                      F.sum("size").alias("words"),
                                                      F.count("*").alias("rows")), "mix-totals")
    per_source = totals.groupBy("skey").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    targets = source_targets(per_source, weights, max_repeats).drop("source")
    before = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cells = totals.select("skey", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("cell_start"))
    cells = cells.join(targets, "skey")
    rows = _running(base, totals, hot_rows).join(cells, ["skey", "range"])
    size, all_words = F.col("size"), F.col("source_size")
    budget = F.least(F.floor(F.col("target") + 0.5).cast("long"), all_words * max_repeats)
    rows = rows.withColumn("budget", budget).withColumn("start", F.col("cell_start") + F.col("inside"))
    some = all_words > 0
    epochs = F.when(some, F.expr("budget div source_size")).otherwise(0).cast("long")
    left = F.when(some, F.expr("budget % source_size")).otherwise(0).cast("long")
    part = F.greatest(F.lit(0), F.least(size, left - F.col("start"))).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       (epochs * size + part).alias("taken"), epochs.alias("epochs"), part.alias("part"),
                       (F.col("start") < left).alias("in_part"), *(["carried"] if carry else []))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[{SPACE}]*{WORD}"), F.lit(0)),
                                F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: ``docs``' own columns, a row per copy taken.

    A document taken for several epochs comes back as several rows; the copy at
    a source's cut keeps its first words only (at most one document a source).
    Documents without words come with the epochs of their source. Null texts stay null, null ids and
    sources pass through, rows that repeat are taken like others; columns may have any names; an empty table gives no rows.
    """
    cols = docs.columns
    mixed = mix(docs, carry=tuple(cols), **options)
    text_col = options.get("text_col", "text")
    copies = F.concat(F.array_repeat(F.col("size"), F.col("epochs").cast("int")),
                      F.when(F.col("in_part"), F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")))
    rows = mixed.select("carried", "size", F.explode(copies).alias("words"))
    whole = F.col("words") >= F.col("size")
    text = F.col("carried")[text_col]
    out = [F.col("carried")[c].alias(c) for c in cols if c not in (text_col, "n_chars")]
    cut = F.when(whole, text).otherwise(first_words(text, F.col("words")))
    rows = rows.withColumn("cut", cut)
    n_chars = [F.when(whole, F.col("carried")["n_chars"]).otherwise(F.length("cut").cast("long")).alias("n_chars")
               ] if "n_chars" in cols else []
    return rows.select(*out, F.col("cut").alias(text_col), *n_chars).select(*cols)
