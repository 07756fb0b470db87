"""SimHash near-duplicates with a Gray-order hierarchical index.

A text's fingerprint takes each of its 64 bits by majority over the hashes of
its word shingles. Two fingerprints link when at most ``max_distance`` bits
differ; documents whose fingerprints are joined by links form a component.

Search: fingerprints that differ in at most d bits agree on all but d of any
d + 1 or more bit blocks, so every distinct fingerprint is sent to one bucket
per choice of blocks (the blocks' number grows with the fingerprints, keeping
buckets small) and no linked pair is missed. Inside the buckets the
fingerprints are sorted by Gray rank and indexed by a hierarchy of runs: a
node keeps the bits on which all its fingerprints agree, less those its parent
already holds. A search adds up differing bits on the way down and leaves a
group as soon as they exceed d; it also leaves groups that already belong to
the searcher's component, and takes groups whose free bits are at most d whole.

A bucket of many near copies is dealt into chunks. What the chunks join is one
component; only fingerprints outside a bucket's largest component are then
compared with the whole bucket, in cells of bounded size. Tasks return trees
of bounded degree, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, stored
from .components import connected_components

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
#: Fingerprints of a bucket that one chunk or cell side holds.
CHUNK = 2048
#: Rows indexed together by a task (several small buckets).
_ROWS = 1 << 16
_FAN = 8
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# -- fingerprints -------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint (unsigned): A-Z lowered, words between ASCII white
    space, ``shingle`` words joined by a space (a shorter text: all its words),
    XXH64 of each, repeats included. A bit is set if over half the hashes have
    it. No words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = (ends - lengths)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED)
                           for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _add_fingerprints(batches: Iterator[pa.RecordBatch], at: int, shingle: int, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t, shingle) for t in batch.column(at).to_pylist()]
        signed = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, signed], names=[*batch.schema.names, name])


def with_fingerprints(rows: DataFrame, text_col: str, shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """``rows`` with the fingerprint's bits as signed long ``name``."""
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())])
    at = rows.columns.index(text_col)
    return rows.mapInArrow(lambda it: _add_fingerprints(it, at, shingle, name), schema)


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# -- the index ----------------------------------------------------------------

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the Gray code's order."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Levels:
    """Runs of ``_FAN ** level`` sorted rows: their shared bits and patterns."""

    def __init__(self, bucket: np.ndarray, fp: np.ndarray):
        same_and, same_or, low, high = fp, fp, bucket, bucket
        fixed = np.full(len(fp), _ALL)
        self.pattern, self.fixed, self.own = [fp], [fixed], []
        while len(same_and) > 1:
            at = np.arange(0, len(same_and), _FAN)
            same_and, same_or = np.bitwise_and.reduceat(same_and, at), np.bitwise_or.reduceat(same_or, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            # a run over two buckets keeps no shared bits
            self.fixed.append(np.where(low == high, ~(same_and ^ same_or), np.uint64(0)))
            self.pattern.append(same_and)
        for level, fixed in enumerate(self.fixed):
            above = self.fixed[level + 1][np.arange(len(fixed)) // _FAN] if level + 1 < len(self.fixed) else np.uint64(0)
            self.own.append(fixed & ~above)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the rows a[i] and b[i] one label, in place; labels are row numbers."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label[:] = label[label]


def _uniform(levels: _Levels, label: np.ndarray) -> list[np.ndarray]:
    """Per level, the label that all of a run's rows have, or -1."""
    out, low, high = [label], label, label
    for pattern in levels.pattern[1:]:
        at = np.arange(0, len(low), _FAN)
        low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        out.append(np.where(low == high, low, -1))
    return out


def link_rows(bucket: np.ndarray, fp: np.ndarray, label: np.ndarray, distance: int) -> np.ndarray:
    """Labels (row numbers) after joining all rows of a bucket that differ in at
    most ``distance`` bits. Rows are sorted by bucket and Gray rank; ``label``
    holds what is joined already."""
    n = len(fp)
    levels = _Levels(bucket, fp)
    label = label.copy()
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    size_of = np.diff(edges)
    start, end = np.repeat(edges[:-1], size_of), np.repeat(edges[1:], size_of)
    for level in range(1, len(levels.fixed)):  # runs that differ in few bits altogether
        tight = np.flatnonzero(np.bitwise_count(~levels.fixed[level]) <= distance)
        first = tight * _FAN ** level
        rows = (first[:, None] + np.arange(_FAN ** level)).ravel()
        inside = rows < n
        _join(label, np.repeat(first, _FAN ** level)[inside], rows[inside])
    size, at = end - start, 0
    cost = np.cumsum(size)
    while at < n:
        # as many searchers as may meet two million rows
        stop = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + 2_000_000)))
        q = np.arange(at, min(stop, n))
        at = q[-1] + 1
        uniform = _uniform(levels, label)
        q = q[(size[q] > 1) & (q + 1 < end[q])]
        depth = np.zeros(len(q), np.int64)
        while ((_FAN ** depth < size[q]) & (depth < len(levels.fixed) - 1)).any():
            depth += (_FAN ** depth < size[q]) & (depth < len(levels.fixed) - 1)
        for level in np.unique(depth):
            _search(levels, uniform, label, q[depth == level], end, int(level), distance)
    return label


def _search(levels: _Levels, uniform, label, q, end, level: int, distance: int) -> None:
    fp = levels.pattern[0]
    span = _FAN ** level
    first, last = (q + 1) // span, (end[q] - 1) // span  # at most two or three runs
    who = np.repeat(q, last - first + 1)
    node = np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist())]) if len(q) else q
    acc = np.bitwise_count((fp[who] ^ levels.pattern[level][node]) & levels.fixed[level][node]).astype(np.int64)
    while True:
        keep = (acc <= distance) & (uniform[level][node] != label[who])
        who, node, acc = who[keep], node[keep], acc[keep]
        if not level or not len(who):
            break
        level -= 1
        span = _FAN ** level
        who, acc = np.repeat(who, _FAN), np.repeat(acc, _FAN)
        node = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
        there = (node < len(levels.fixed[level])) & (node * span < end[who]) & ((node + 1) * span > who + 1)
        who, node, acc = who[there], node[there], acc[there]
        acc = acc + np.bitwise_count((fp[who] ^ levels.pattern[level][node]) & levels.own[level][node])
    _join(label, who, node)


def _trees(bucket: np.ndarray, fp: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between one row of each former label, as trees of degree 65 at most."""
    rows = np.unique(before)  # a label is a row number: its own first row
    order = np.lexsort((rows, after[rows]))
    rows = rows[order]
    root = after[rows]
    begin = np.flatnonzero(np.r_[True, root[1:] != root[:-1]])
    first = np.repeat(begin, np.diff(np.r_[begin, len(rows)]))
    k = np.arange(len(rows)) - first
    child = np.flatnonzero(k > 0)
    parent = first[child] + (k[child] - 1) // 64
    return fp[rows[child]], fp[rows[parent]]


def _link_batches(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (k, v, cell, fp, label) come sorted by bucket (k, v, cell)."""
    held: list[np.ndarray] = []

    def run(rows: np.ndarray) -> pa.RecordBatch:
        key, fp, known = rows[:, :3], rows[:, 3].view(np.uint64), rows[:, 4]
        bucket = np.cumsum(np.r_[False, (key[1:] != key[:-1]).any(1)])
        order = np.lexsort((gray_rank(fp), bucket))
        bucket, fp, known = bucket[order], fp[order], known[order]
        # rows of one bucket and known component start with one label: the first such row
        by = np.lexsort((known, bucket))
        new = np.r_[True, (bucket[by][1:] != bucket[by][:-1]) | (known[by][1:] != known[by][:-1])]
        before = np.empty(len(fp), np.int64)
        before[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(fp)), 0))]
        a, b = _trees(bucket, fp, before, link_rows(bucket, fp, before, distance))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        if batch.num_rows:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
        if sum(map(len, held)) >= _ROWS:
            rows = np.concatenate(held)
            cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1))
            if len(cuts):
                held = [rows[cuts[-1] + 1:]]
                yield run(rows[:cuts[-1] + 1])
            else:
                held = [rows]
    if held and sum(map(len, held)):
        yield run(np.concatenate(held))


# -- the distributed join -----------------------------------------------------

def block_masks(blocks: int, distance: int) -> list[int]:
    """Bit masks of every choice of ``blocks - distance`` blocks of 64 bits."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(single, blocks - distance)]


def choose_blocks(n: int, distance: int) -> int:
    """Fewest blocks that keep an even bucket at 256 fingerprints or fewer."""
    blocks = distance + 1
    while blocks < distance + 4 and n > 256 << (64 * (blocks - distance) // blocks):
        blocks += 1
    return blocks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _link(rows: DataFrame, distance: int) -> DataFrame:
    keys = ["k", "v", "cell"]
    return (rows.select(*keys, "fp", "label").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda it: _link_batches(it, distance), "a long, b long"))


def fingerprint_components(prints: DataFrame, distance: int = MAX_DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """(node, root) of the distinct fingerprints in ``prints`` (``fp``: long,
    distinct) that link to another; ``root`` names the component."""
    masks = block_masks(choose_blocks(prints.count(), distance), distance)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
        for k, m in enumerate(masks)])).alias("key")).select("key.k", "key.v", "fp")
    hot = stored(keyed.groupBy("k", "v").agg(F.count("*").alias("n")).where(F.col("n") > chunk), "simhash-hot")
    if hot.limit(1).count() == 0:
        links = _link(keyed.select("*", F.lit(0).alias("cell"), F.col("fp").alias("label")), distance)
        return connected_components(links)
    keyed = keyed.join(hot, ["k", "v"], "left")
    chunks = F.coalesce(F.ceil(F.col("n") / F.lit(chunk)), F.lit(1)).cast("long")
    cell = F.pmod(F.xxhash64("fp"), chunks)
    links = stored(_link(keyed.select("k", "v", "fp", cell.alias("cell"), F.col("fp").alias("label")), distance),
                   "simhash-links")
    known = connected_components(links).withColumnRenamed("node", "fp")
    labelled = stored(keyed.where("n is not null").join(known, "fp", "left")
                      .select("k", "v", "n", "fp", F.coalesce("root", "fp").alias("label")), "simhash-labelled")
    main = (labelled.groupBy("k", "v", "label").agg(F.count("*").alias("c")).groupBy("k", "v")
            .agg(F.max_by("label", F.struct("c", "label")).alias("main"),
                 (F.sum("c") - F.max("c")).alias("others")).where("others > 0"))
    main = stored(main, "simhash-main")
    rows = labelled.join(main, ["k", "v"])
    left = F.ceil(F.col("others") / F.lit(chunk)).cast("int")
    right = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    i, j = F.pmod(F.xxhash64("fp"), left).cast("int"), F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), right).cast("int")
    cells = rows.select("k", "v", "fp", "label", F.explode(F.array_union(
        F.transform(F.sequence(F.lit(0), left - 1), lambda x: x * right + j),
        F.when(F.col("label") != F.col("main"), F.transform(F.sequence(F.lit(0), right - 1), lambda x: i * right + x))
        .otherwise(F.array().cast("array<int>")))).alias("cell"))
    more = _link(cells, distance)
    return connected_components(links.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``doc_id, fp, root, component_id`` per row of ``docs``.

    ``component_id`` is the smallest id among all documents joined to the row's
    by links, ``root`` a fingerprint that names the component. Null and empty
    texts have fingerprint 0; null ids are passed over in ``component_id`` (null only if
    the whole component has none); repeated rows stay rows of their own; other
    columns are ignored; an empty table gives no rows. Runs jobs when called.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return classes(stored(with_fingerprints(rows, "text", shingle).select("doc_id", "fp"), "simhash"), max_distance)


def classes(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``near_duplicates`` from stored (doc_id, fp) rows."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    comps = fingerprint_components(nodes.select("fp"), max_distance)
    nodes = nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    nodes = stored(nodes, "simhash-roots")
    least = stored(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    of = stored(nodes.join(least, "root").select("fp", "root", "component_id"), "simhash-classes")
    return prints.join(of, "fp").select("doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component, ``docs``' own columns: the one of smallest id
    (of several rows with that id: one of them; ids all null: one of them).

    Null and empty texts are one component (fingerprint 0); texts of any length are read whole; columns of ``docs`` may have any
    names; an empty table gives no rows. Runs jobs when called."""
    fp, print_, id_ = fresh_name(docs, "fp"), fresh_name(docs, "keep_fp"), fresh_name(docs, "keep_id")
    rows = stored(with_fingerprints(docs, text_col, shingle, fp), "simhash-docs")
    found = classes(rows.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp")), max_distance)
    least = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    per_print = least.groupBy("root", "fp").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    keep = stored(per_print.groupBy("root").agg(F.min_by(F.struct("fp", "keep_id", "n"), "fp").alias("keep"))
                  .select(F.col("keep.fp").alias(print_), F.col("keep.keep_id").alias(id_), F.col("keep.n").alias("n")), "simhash-keep")
    out = rows.join(keep.drop("n"), (rows[fp] == keep[print_]) & rows[id_col].eqNullSafe(keep[id_]))
    if keep.where("n > 1").limit(1).count():  # rows that repeat id and fingerprint
        out = out.dropDuplicates([print_])
    return out.select(*[rows[c] for c in docs.columns])
