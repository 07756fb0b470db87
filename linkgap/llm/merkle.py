"""Merkle manifest of a dataset: a content-addressed DAG and descents in it.

Rows are leaves, ordered by id inside their group; every ``fanout`` consecutive
nodes become the digest of their concatenated hex digests until one is left (the
group's subroot), and the subroots become the root in the same way. The DAG is
stored as records of a digest and its children, one table a layer. A layer is
``SEGMENT_LEVELS`` levels of the tree, cut into segments of consecutive nodes, so
a task works on one segment and no level of a tree lies in one task.

Leaf requests descend from the root: in every segment the digits of the rank
choose the child by its digest's record, the children not chosen are collected,
and the path segment is reversed. A leaf's proof is its segments from the
bottom up. Digests are lower-case hex SHA-256.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import rank_positions
from .common import stored

FANOUT = 2
#: Levels of the tree in one layer's segments (1024 nodes a segment at a fan-out of 2).
SEGMENT_LEVELS = 10
#: Most nodes of a segment, for larger fan-outs.
SEGMENT_NODES = 1024

PATH = "array<struct<digit:int,siblings:array<string>>>"
_STEP = pa.struct([("digit", pa.int32()), ("siblings", pa.list_(pa.string()))])
_RECORDS = "grp string, segment long, digest string, children array<string>, top boolean"


def field(value: Column) -> Column:
    """A value in a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Digest of the values as ``field`` writes them, one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def join_digests(digests: Column) -> Column:
    """Digest of an array of digests, concatenated as hex text."""
    return F.sha2(F.array_join(digests, ""), 256)


def proof_digest(path: Column) -> Column:
    """Digest of a proof's siblings, level by level."""
    return join_digests(F.flatten(F.transform(path, lambda s: s["siblings"])))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along its proof ``path``."""
    def up(digest, step):
        before = F.array_join(F.slice(step["siblings"], 1, step["digit"]), "")
        after = F.array_join(F.slice(step["siblings"], step["digit"] + 1, F.greatest(F.size(step["siblings"]), F.lit(1))), "")
        return F.sha2(F.concat(before, digest, after), 256)
    return F.aggregate(path, leaf, up)


def _levels(fanout: int) -> int:
    levels = 1
    while levels < SEGMENT_LEVELS and fanout ** (levels + 1) <= SEGMENT_NODES:
        levels += 1
    return levels


def _records_of(fanout: int, levels: int):
    """A segment's nodes to the records above them. The segment of a layer that has others is
    raised by all ``levels``, the only one of its group until one node is left."""
    def records(key: tuple, nodes: pa.Table) -> pa.Table:
        grp, segment = (k.as_py() for k in key)
        nodes = nodes.sort_by("idx")
        row, whole = nodes["digest"].to_pylist(), nodes["n"][0].as_py() <= fanout ** levels
        out, height = [], 0
        while len(row) > 1 if whole else height < levels:
            runs = [row[k:k + fanout] for k in range(0, len(row), fanout)]
            row = [hashlib.sha256("".join(r).encode()).hexdigest() for r in runs]
            out += [(grp, segment, d, r, False) for d, r in zip(row, runs)]
            height += 1
        out.append((grp, segment, row[0], [], True))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (
            pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.bool_()))],
            names=["grp", "segment", "digest", "children", "top"])
    return records


def _descend(fanout: int, levels: int):
    """Requests of a segment (idx, n, any others) down from the segment's node, which comes as an entry with a tag and the
    path above it. Adds digest, tag and path to the requests."""
    def requested(key: tuple, requests: pa.Table, records: pa.Table) -> pa.Table:
        segment = key[1].as_py()
        entry = records.filter(pc.is_valid(records["tag"])).slice(0, 1).to_pylist()
        nodes = records.filter(pc.and_(pc.is_null(records["tag"]), pc.invert(records["top"])))
        children = dict(zip(nodes["digest"].to_pylist(), nodes["children"].to_pylist()))
        n = requests["n"][0].as_py() if requests.num_rows else 0
        height = levels
        if n <= fanout ** levels:
            height = 0
            while fanout ** height < n:
                height += 1
        digests, paths = [], []
        for idx in requests["idx"].to_pylist():
            rank, at, steps = idx - segment * fanout ** levels, entry[0]["digest"], []
            for level in range(height - 1, -1, -1):
                digit = rank // fanout ** level % fanout
                row = children[at]
                steps.append({"digit": digit, "siblings": row[:digit] + row[digit + 1:]})
                at = row[digit]
            digests.append(at)
            paths.append(steps[::-1] + entry[0]["path"])
        tags = [entry[0]["tag"]] * len(digests)
        for name, column, kind in (("digest", digests, pa.string()), ("tag", tags, pa.list_(pa.string())), ("path", paths, pa.list_(_STEP))):
            requests = requests.append_column(name, pa.array(column, kind))
        return requests
    return requested


@dataclass
class Layer:
    """Nodes of one layer (grp, idx, digest, n in the group) and the records above them."""

    nodes: DataFrame
    records: DataFrame


def build(leaves: DataFrame, fanout: int = FANOUT) -> tuple[list[Layer], DataFrame]:
    """The layers above ``leaves`` (grp, idx from 0 in the group, digest, n in the group, any further columns),
    stored, and the groups' roots (grp, digest)."""
    levels = _levels(fanout)
    width = fanout ** levels
    layers, nodes = [], leaves
    while True:
        segment = F.expr(f"idx div {width}")
        records = stored(nodes.select("grp", segment.alias("segment"), "idx", "digest", "n").groupBy("grp", "segment")
                         .applyInArrow(_records_of(fanout, levels), _RECORDS), "merkle-records")
        layers.append(Layer(nodes, records))
        tops = records.where("top")
        if not nodes.where(F.col("n") > width).limit(1).count():
            return layers, tops.select("grp", "digest")
        # a group that is done stays its only node; the next layer leaves it as it is
        sizes = nodes.where("idx = 0").select("grp", "n")
        nodes = stored(tops.join(sizes, "grp").select("grp", F.col("segment").alias("idx"), "digest",
                                                      F.ceil(F.col("n") / F.lit(width)).cast("long").alias("n")), "merkle-nodes")


def descend(layers: list[Layer], entries: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The lowest layer's nodes (grp, idx, n and any further columns) plus ``digest, tag, path``; ``entries``
    are the groups' own (grp, digest, tag, path above) to start from."""
    levels = _levels(fanout)
    found = entries.select("grp", F.lit(0).cast("long").alias("segment"), "digest", "tag", "path")
    for k, layer in enumerate(reversed(layers)):
        requests = layer.nodes.drop("digest").withColumn("segment", F.expr(f"idx div {fanout ** levels}"))
        records = layer.records.select("grp", "segment", "digest", "children", "top",
                                       F.lit(None).cast("array<string>").alias("tag"), F.lit(None).cast(PATH).alias("path"))
        here = found.select("grp", "segment", "digest", F.lit(None).cast("array<string>").alias("children"),
                            F.lit(False).alias("top"), "tag", "path")
        schema = T.StructType(requests.schema.fields + T.StructType.fromDDL(f"digest string, tag array<string>, path {PATH}").fields)
        found = (requests.groupBy("grp", "segment").cogroup(records.unionByName(here).groupBy("grp", "segment"))
                 .applyInArrow(_descend(fanout, levels), schema))
        if k < len(layers) - 1:  # the lowest layer's is the result; the others hold a thousandth and less
            found = stored(found.select("grp", F.col("idx").alias("segment"), "digest", "tag", "path"), "merkle-paths")
    return found


def manifest(docs: DataFrame, group_col: str = "lang", id_col: str = "doc_id",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), fanout: int = FANOUT,
             extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, grp, idx, leaf, subroot, root, path`` and the ``extra``
    columns, computed in the pass over ``docs`` that digests the leaves.

    ``grp`` is the group as text with ``+`` before it, empty for null (which comes first). Leaves ascend by
    id (null first), then by digest; rows that repeat wholly have equal digests and each is a leaf. ``path`` is
    the proof from the bottom up: the place among its siblings and their digests at each level. Empty texts are leaves like others, a text of any length is digested
    whole by the JVM. Columns not named are ignored, whatever their names. An empty
    table gives no rows. Layers and records are stored under the shared folder when called, so a lost executor
    costs its tasks only.
    """
    if fanout < 2:
        raise ValueError("a fan-out of at least 2 is needed")
    group = F.col(group_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.when(group.isNull(), "").otherwise(F.concat(F.lit("+"), group)).alias("grp"),
                       leaf_digest(*[F.col(c) for c in columns]).alias("leaf"),
                       *[c.alias(f"x_{name}") for name, c in (extra or {}).items()])
    rows = stored(rows, "merkle-leaves").withColumn("copy", F.monotonically_increasing_id())
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n"))
    ranked = rank_positions(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("copy").asc()], "pos", group="grp")
    # stored: rows joined by group would stay dealt by group, and one group's segments lie in one task
    leaves = stored(ranked.join(sizes, "grp").withColumn("idx", F.col("pos") - 1).drop("pos", "copy")
                    .withColumnRenamed("leaf", "digest"), "merkle-ranked")
    layers, subroots = build(leaves, fanout)
    tops = rank_positions(subroots.select(F.col("grp").alias("sub"), "digest"), [F.col("sub").asc()], "pos")
    tops = stored(tops.select(F.lit("").alias("grp"), "sub", (F.col("pos") - 1).alias("idx"), "digest"), "merkle-subroots")
    upper, root = build(tops.withColumn("n", F.lit(tops.count()).cast("long")), fanout)
    start = root.select("grp", "digest", F.array("digest").alias("tag"), F.array().cast(PATH).alias("path"))
    entries = descend(upper, start, fanout).select(F.col("sub").alias("grp"), "digest",
                                                   F.array(F.col("digest"), F.col("tag")[0]).alias("tag"), "path")
    found = descend(layers, stored(entries, "merkle-entries"), fanout)
    return found.select("doc_id", "grp", "idx", F.col("digest").alias("leaf"), F.col("tag")[0].alias("subroot"),
                        F.col("tag")[1].alias("root"), "path", *[F.col(f"x_{n}").alias(n) for n in extra or {}])
