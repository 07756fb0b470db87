"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets one long bit string per tree (signs of random
projections, after the map that turns the largest inner product into the
smallest angle). A tree of a chunk of rows is the sorted array of their strings: the
rows that share a prefix with a query's string are a run of it, found by two
binary searches. The forest is built and stored once. A query descends to its longest
prefix and ascends, level by level and in all trees at once, until the runs
of all trees of all chunks hold the wanted number of candidates; each query stops
at its own level. The candidates are scored exactly and the best are merged.

The number of candidates is set by measurement: a bounded sample of the
queries is searched by brute force, and the smallest number is taken that
finds the wanted share of their true neighbours. Rows are indexed where they lie, so
a vector that many rows share is a run in every task and no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_run_dir
from .common import stored
from .vectors import chunks, query_blocks, table, top_rows, vector_rows

TREES = 32
BITS = 60
#: Prefix lengths at which an ascent may stop.
LEVELS = np.array([*range(0, 25), 28, 32, 40, 50, BITS])
#: Rows of a chunk of the forest.
CHUNK = 8192
#: Queries searched by brute force to set the number of candidates, and the recall they are to reach.
CALIBRATION_QUERIES = 256
CALIBRATION_RECALL = 0.95
_SEED = 7


def _planes(d: int, trees: int) -> np.ndarray:
    return np.random.default_rng([_SEED, d]).standard_normal((d + 1, trees * BITS))


def _strings(m: np.ndarray, planes: np.ndarray, extra: np.ndarray, trees: int) -> np.ndarray:
    """(trees, rows) bit strings as integers, first bit highest."""
    bits = (np.column_stack([m, extra]) @ planes > 0).reshape(len(m), trees, BITS)
    return (bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).T


def _row_strings(m: np.ndarray, longest: float, trees: int) -> np.ndarray:
    scaled = m / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(1)))
    return _strings(scaled, _planes(m.shape[1], trees), rest, trees)


def _query_strings(m: np.ndarray, trees: int) -> np.ndarray:
    unit = m / np.abs(m).max(1, keepdims=True)  # the direction alone counts
    return _strings(unit, _planes(m.shape[1], trees), np.zeros(len(m)), trees)


def _runs(sorted_strings: np.ndarray, q: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs that share ``level`` bits with the queries' strings."""
    shift = BITS - level
    low = (q >> shift) << shift
    return (np.searchsorted(sorted_strings, low, "left"),
            np.searchsorted(sorted_strings, low + (np.int64(1) << shift), "left"))


_FOREST = "d int, ids binary, rows binary, strings binary, places binary"


def _forest(batches, longest: float, trees: int) -> Iterator[pa.RecordBatch]:
    """Per chunk and vector length: row ids, rows, sorted strings by tree, the order that sorts them."""
    for chunk in chunks(batches, CHUNK):
        for d, (ids, rows) in chunk.items():
            strings = _row_strings(rows, longest, trees)
            order = np.argsort(strings, axis=1, kind="stable")
            parts = (ids.astype("<i8"), rows.astype("<f8"), np.take_along_axis(strings, order, 1).astype("<i8"), order.astype("<u2"))
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)],
                                             names=["d", "ids", "rows", "strings", "places"])


def build_forest(rows: DataFrame, longest: float, trees: int = TREES) -> DataFrame:
    """The stored forest of (id, vec) rows, none of them longer than ``longest``: one row a chunk."""
    return stored(rows.mapInArrow(lambda it: _forest(it, longest, trees), _FOREST), "ann-forest")


def _indexed(batches, block: dict, trees: int):
    """Per chunk: (places of queries, queries, row ids, rows, sorted strings by tree, the order that sorts them)."""
    first, starts = 0, {}
    for d, (query_ids, _) in block.items():
        starts[d] = first
        first += len(query_ids)
    for batch in batches:
        for row in range(batch.num_rows):
            d = batch.column(0)[row].as_py()
            if d not in block:
                continue
            ids, rows, strings, order = (np.frombuffer(batch.column(k)[row].as_buffer(), t) for k, t in (
                (1, "<i8"), (2, "<f8"), (3, "<i8"), (4, "<u2")))
            queries = block[d][1]
            yield (np.arange(starts[d], starts[d] + len(queries)), queries, ids, rows.reshape(len(ids), d),
                   strings.reshape(trees, len(ids)), order.reshape(trees, len(ids)))


def _count(batches, block, trees, own) -> Iterator[pa.RecordBatch]:
    """Rows that share a prefix, by query and level, summed over a task's trees."""
    counts = np.zeros((len(own), len(LEVELS)), np.int64)
    for q, queries, _, _, strings, _ in _indexed(batches, block, trees):
        mine = _query_strings(queries, trees)
        for tree in range(trees):
            for at, level in enumerate(LEVELS):
                a, b = _runs(strings[tree], mine[tree], level)
                counts[q, at] += b - a
    query, level = np.nonzero(counts)
    yield table([query, level, counts[query, level]], ["query", "level", "n"])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score, then smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    return (rows * query).sum(1)  # equal rows get equal sums


def _marked(queries, strings, order, level, trees: int, n: int) -> Iterator[np.ndarray]:
    """Places of the rows in any tree's run, by query."""
    mine = _query_strings(queries, trees)
    runs = [_runs(strings[t], mine[t], level) for t in range(trees)]
    for i in range(len(queries)):
        mark = np.zeros(n, bool)
        for t in range(trees):
            mark[order[t, runs[t][0][i]:runs[t][1][i]]] = True
        yield np.flatnonzero(mark)


def _search(batches, block, trees, own, level, k) -> Iterator[pa.RecordBatch]:
    for q, queries, ids, rows, strings, order in _indexed(batches, block, trees):
        out = []
        for i, at in enumerate(_marked(queries, strings, order, level[q], trees, len(ids))):
            at = at[ids[at] != own[q[i]]]
            scores = _exact(rows[at], queries[i])
            best = _best(scores, ids[at], k)
            out.append((np.full(len(best), q[i]), np.full(len(best), own[q[i]]), ids[at][best], scores[best]))
        if out:
            yield table([np.concatenate(c) for c in zip(*out)], ["query", "query_id", "vec_id", "score"])


def _scored(batches, block, trees, own, level) -> Iterator[pa.RecordBatch]:
    for q, queries, ids, _, strings, order in _indexed(batches, block, trees):
        n = [len(at) for at in _marked(queries, strings, order, level[q], trees, len(ids))]
        yield table([own[q], np.array(n, np.int64)], ["query_id", "n"])


def _brute(batches, block, trees, own, k) -> Iterator[pa.RecordBatch]:
    """A task's k best for each sample query, with the longest prefix they share in any tree."""
    for q, queries, ids, rows, strings, order in _indexed(batches, block, trees):
        plain = np.empty_like(strings)
        np.put_along_axis(plain, order.astype(np.int64), strings, 1)
        mine = _query_strings(queries, trees)
        out = []
        for i in range(len(q)):
            at = np.flatnonzero(ids != own[q[i]])
            scores = _exact(rows[at], queries[i])
            best = _best(scores, ids[at], k)
            apart = plain[:, at[best]] ^ mine[:, i:i + 1]
            shared = BITS - np.frexp(apart.astype(np.float64))[1]  # bits before the first that differs
            out.append((np.full(len(best), q[i]), ids[at][best], scores[best], shared.max(0, initial=0).astype(np.int64)))
        if out:
            yield table([np.concatenate(c) for c in zip(*out)], ["query", "vec_id", "score", "level"])


def _levels(forest: DataFrame, shared, trees: int, n: int) -> np.ndarray:
    """(queries, levels) rows reached at each of ``LEVELS`` over all trees and chunks."""
    def count(batches):
        block, own = shared.value
        return _count(batches, block, trees, own)

    # at most one row a query of the block and level
    found = forest.mapInArrow(count, "query long, level long, n long").groupBy("query", "level").agg(
        F.sum("n").alias("n")).collect()
    reached = np.zeros((n, len(LEVELS)), np.int64)
    for r in found:
        reached[r["query"], r["level"]] = r["n"]
    return reached


def _level_for(reached: np.ndarray, wanted: int) -> np.ndarray:
    """Each query's longest prefix whose runs hold ``wanted`` rows; 0 if none does."""
    enough = reached >= wanted
    return np.where(enough.any(1), LEVELS[len(LEVELS) - 1 - enough[:, ::-1].argmax(1)], 0)


def calibrate(forest: DataFrame, queries: DataFrame, k: int, trees: int = TREES,
              sample: int = CALIBRATION_QUERIES, recall: float = CALIBRATION_RECALL) -> int:
    """Candidates to ask for: the fewest with which the sample queries (by a hash
    of the id, at most ``sample``) find the share ``recall`` of their true neighbours."""
    few = queries.orderBy(F.xxhash64("id"), "id").limit(sample)
    for block in query_blocks(few, max(sample, 1)):
        own = np.concatenate([ids for ids, _ in block.values()])
        shared = forest.sparkSession.sparkContext.broadcast((block, own))
        reached = _levels(forest, shared, trees, len(own))

        def brute(batches, shared=shared):
            block, own = shared.value
            return _brute(batches, block, trees, own, k)

        found = forest.mapInArrow(brute, "query long, vec_id long, score double, level long")
        from pyspark.sql import Window
        w = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
        true = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query", "level").collect()
        at, level = np.array([r["query"] for r in true], int), np.array([r["level"] for r in true], int)
        for wanted in np.unique(reached):
            if len(at) and (level >= _level_for(reached, wanted)[at]).mean() >= recall:
                return int(wanted)
        return int(reached.max(initial=0))
    return 0


@dataclass
class Index:
    """A stored forest, its trees, and the candidates that its queries ask for."""

    forest: DataFrame
    trees: int
    wanted: int


def build_index(candidates: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
                trees: int = TREES, wanted: int | None = None) -> Index:
    """The forest over ``candidates``; ``wanted`` is measured on ``queries`` when not given."""
    some = F.exists("vec", lambda x: x != 0)
    rows = stored(vector_rows(candidates.where(F.col(id_col).isNotNull()), id_col, vec_col).where(some), "ann-rows")
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    longest = float(rows.agg(F.max(F.sqrt(squares))).first()[0] or 1.0)
    forest = build_forest(rows, longest, trees)
    if wanted is None:
        wanted = calibrate(forest, _asked(queries, id_col, vec_col), k, trees)
    # each row counts once a tree at most, so this many reach k rows and the query's own
    return Index(forest, trees, max(wanted, trees * (k + 1)))


def _asked(queries: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return vector_rows(queries.where(F.col(id_col).isNotNull()), id_col, vec_col).where(F.exists("vec", lambda x: x != 0)).distinct()


def _by_block(index: Index, asked: DataFrame, run, schema: str) -> Iterator[DataFrame]:
    """``run(batches, block, own, level)`` over the forest, for each block of queries."""
    sc = asked.sparkSession.sparkContext
    for block in query_blocks(asked):
        own = np.concatenate([ids for ids, _ in block.values()])
        shared = sc.broadcast((block, own))
        level = sc.broadcast(_level_for(_levels(index.forest, shared, index.trees, len(own)), index.wanted))
        yield index.forest.mapInArrow(lambda it, shared=shared, level=level: run(it, *shared.value, level.value), schema)


def scored_counts(index: Index, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, n): the rows that each query's search scores."""
    n_trees = index.trees  # the tasks' function must not hold the index, which holds DataFrames
    parts = _by_block(index, _asked(queries, id_col, vec_col),
                      lambda it, block, own, level: _scored(it, block, n_trees, own, level), "query_id long, n long")
    return stored(reduce(DataFrame.union, parts), "ann-scored").groupBy("query_id").agg(F.sum("n").alias("n"))


def search(candidates: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           trees: int = TREES, wanted: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best found for each query by inner
    product (double, original vectors), best first, ties to the smaller id.

    ``wanted``: candidates to reach, over all trees; measured when not given. A query's own id is no
    candidate of its own. Vectors that are null, zero or hold null or non-finite
    numbers take no part, nor do null ids; a candidate of another length than
    the query is none of its candidates. A query always gets k rows if there are as many. Rows that repeat an id are candidates each.
    Queries that repeat wholly are asked once; two vectors under one id are two queries, each with its own ranks.
    Other columns are ignored; empty tables give no rows. Queries are searched
    in blocks of bounded size; runs jobs when called.
    """
    spark = candidates.sparkSession
    index = build_index(candidates, queries, k, id_col, vec_col, trees, wanted)
    n_trees = index.trees
    out = new_run_dir(spark, "ann")
    schema = "query_id long, rank int, vec_id long, score double"
    spark.createDataFrame([], schema).write.parquet(out)
    for found in _by_block(index, _asked(queries, id_col, vec_col),
                           lambda it, block, own, level: _search(it, block, n_trees, own, level, k),
                           "query long, query_id long, vec_id long, score double"):
        top_rows(found, k).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)
