"""Connected components of a link table, by hooking and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long, no nulls); ``root``
    is the smallest node of its component. No links, no rows.

    Each round every node looks at its neighbours' grandparents, hooks its
    parent (and itself) to the smallest one, and jumps to its grandparent: the
    number of rounds grows with the logarithm of a component's length. Every
    table is written under the shared folder, so a lost executor costs a round's tasks.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = stored(both.toDF("node", "other"), "cc-edges")
    parents = stored(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("parent")), "cc-parents")
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        grand = stored(parents.join(up, "parent", "left").select("node", "parent", "grand"), "cc-grand")
        near = grand.select(F.col("node").alias("other"), "grand")
        low = stored(edges.join(near, "other").groupBy("node").agg(F.min("grand").alias("low"))
                     .join(grand, "node"), "cc-low")
        offers = (low.select("node", F.least("low", "grand", "parent").alias("offer"))
                  .union(low.select("parent", "low")))
        new = stored(offers.groupBy("node").agg(F.min("offer").alias("parent")), "cc-parents")
        changed = new.join(grand.select("node", F.col("parent").alias("old"), "grand"), "node").where(
            "parent <> old or grand <> old").limit(1).count()
        parents = new
        if not changed:
            return parents.select("node", F.col("parent").alias("root"))
