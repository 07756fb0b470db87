"""Exact top-k search by distributed histogram selection.

Every query is scored against every row. Instead of sorting scores, each
round counts them into bins of the range that still holds the query's k-th
score, adds the counts up over all tasks and narrows the range to one bin,
until the k-th value itself is known. A last round lets through the scores above it, and of
those equal to it the smallest ids that are still needed.

A task reports only its top bins that hold the scores still needed: the k-th
score of all rows cannot lie below a task's own, so nothing is lost and a
report has at most k rows a query. Rows tied at the k-th value are cut inside each task the
same way, so a vector that a third of all rows share costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir
from .vectors import chunks, query_blocks, stored, table, top_rows, vector_rows

SCALE = 256
BINS = 1024
#: Scores beyond it count as it, and components beyond ``LARGEST`` as that.
MOST = (1 << 62) - 1
LARGEST = 1e300
#: Scores a task holds at once.
_CELLS = 1 << 21


def _integers(m: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * np.clip(m, -LARGEST, LARGEST))


def _exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products as integers of any size, then cut at ``MOST``."""
    whole = [np.array([int(x) for x in m.ravel()], object).reshape(m.shape) for m in (queries, rows)]
    return np.clip(whole[0] @ whole[1].T, -MOST, MOST).astype(np.int64) if rows.shape[1] else np.zeros(
        (len(queries), len(rows)), np.int64)


def _scores(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products, a row per query. Doubles carry those of vectors whose products
    stay under 2**53, integers of any size the others."""
    limit = 2 ** 26 / max(1, rows.shape[1]) ** 0.5
    big_rows = np.flatnonzero(np.abs(rows).max(1, initial=0) >= limit)
    big_queries = np.flatnonzero(np.abs(queries).max(1, initial=0) >= limit)
    small = [np.where(np.abs(m).max(1, initial=0)[:, None] < limit, m, 0) for m in (queries, rows)]
    out = (small[0] @ small[1].T).astype(np.int64)
    if len(big_rows):
        out[:, big_rows] = _exact(rows[big_rows], queries)
    if len(big_queries):
        out[big_queries] = _exact(rows, queries[big_queries])
    return out


def _parts(batches, block: dict, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places of queries in the block, row ids, scores) for pieces of the score matrix;
    the places count through the block's lengths in order."""
    for chunk in chunks(batches):
        first = 0
        for d, (query_ids, queries) in block.items():
            if d in chunk:
                ids, rows = chunk[d]
                rows, queries = _integers(rows, scale), _integers(queries, scale)
                step = max(1, _CELLS // max(1, len(queries)))
                for at in range(0, len(ids), step):
                    yield np.arange(first, first + len(queries)), ids[at:at + step], _scores(rows[at:at + step], queries)
            first += len(query_ids)


def _count(batches, block, scale, low, high, width, need, own) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((len(low), BINS), np.int64)
    for q, ids, scores in _parts(batches, block, scale):
        bins = (scores - low[q][:, None]) // width[q][:, None]
        inside = (scores >= low[q][:, None]) & (scores < high[q][:, None]) & (ids[None, :] != own[q][:, None])
        at = (np.arange(len(q))[:, None] * BINS + np.clip(bins, 0, BINS - 1))[inside]
        counts[q[0]:q[-1] + 1] += np.bincount(at, minlength=len(q) * BINS).reshape(len(q), BINS)
    above = counts[:, ::-1].cumsum(1)[:, ::-1] - counts  # in this task, in higher bins
    query, bin_ = np.nonzero((counts > 0) & (above < need[:, None]))
    yield table([query, bin_, counts[query, bin_]], ["query", "bin", "n"])


def _select(batches, block, scale, value, need, own) -> Iterator[pa.RecordBatch]:
    ties: dict[int, np.ndarray] = {}
    for q, ids, scores in _parts(batches, block, scale):
        mine = ids[None, :] != own[q][:, None]
        row, col = np.nonzero((scores > value[q][:, None]) & mine)
        yield table([q[row], own[q[row]], ids[col], scores[row, col]], ["query", "query_id", "vec_id", "score"])
        row, col = np.nonzero((scores == value[q][:, None]) & mine)
        for r in np.unique(row):
            i = int(q[r])
            ties[i] = np.sort(np.concatenate([ties.get(i, ids[:0]), ids[col[row == r]]]))[:need[i]]
    for i, kept in ties.items():
        yield table([np.full(len(kept), i), np.full(len(kept), own[i]), kept, np.full(len(kept), value[i])],
                    ["query", "query_id", "vec_id", "score"])


def _search_block(rows: DataFrame, block: dict, k: int, scale: int, bound: float) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    own = np.concatenate([ids for ids, _ in block.values()])
    lengths = [np.abs(_integers(m, scale)).sum(1) for _, m in block.values()]
    reach = np.concatenate(lengths) * bound + 1  # no score is farther from 0
    reach = np.minimum(reach, float(MOST - 1024))  # a double's step there is 512
    # the k-th best score of a query lies in [low, high), or it has fewer rows than needed
    low = np.where(reach >= MOST - 1024, -MOST, -np.ceil(reach).astype(np.int64))
    high = 1 - low
    need = np.full(len(own), k, np.int64)
    shared = sc.broadcast((block, own))
    value = np.full(len(own), np.iinfo(np.int64).min)  # of queries with fewer rows: everything is above it
    while (high > low).any():
        width = np.maximum(1, -(-(high - low) // BINS))
        state = sc.broadcast((low, high, width, need))

        def count(batches, shared=shared, state=state):
            block, own = shared.value
            return _count(batches, block, scale, *state.value, own)

        counts = rows.mapInArrow(count, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("bin")))
        # the one bin that holds the needed score: one row a query of the block
        found = (counts.withColumn("upto", upto).join(_needs(rows, need), "query")
                 .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
                 .select("query", "bin", (F.col("upto") - F.col("n")).alias("above")).collect())
        at = np.array([r["query"] for r in found], np.int64)
        bins, above = np.array([r["bin"] for r in found], np.int64), np.array([r["above"] for r in found], np.int64)
        missed = high > low
        missed[at] = False
        need[at] -= above
        low[at] += bins * width[at]
        high[at] = np.minimum(high[at], low[at] + width[at])
        known = at[width[at] == 1]
        value[known] = low[known]
        high[known], high[missed] = low[known], low[missed]
    state = sc.broadcast((value, need))

    def select(batches, shared=shared, state=state):
        block, own = shared.value
        return _select(batches, block, scale, *state.value, own)

    return top_rows(rows.mapInArrow(select, "query long, query_id long, vec_id long, score long"), k)


def _needs(rows: DataFrame, need: np.ndarray) -> DataFrame:
    """(query, need): one row per query of a block, broadcast (bounded by the block)."""
    import pandas as pd
    return F.broadcast(rows.sparkSession.createDataFrame(pd.DataFrame({"query": np.arange(len(need)), "need": need})))


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
               vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best candidates by the
    integer inner product of ``floor(scale * x)``, ties to the smaller id.

    A query's own id is no candidate of its own. Vectors that are null or hold
    null or non-finite numbers take no part; a candidate of another length than the
    query is none of its candidates. Null ids take no part. Rows that repeat an id
    are candidates each. Queries that repeat wholly are asked once; two vectors under one id are two queries,
    each with its own ranks. Fewer candidates than k: all of them. Other columns are
    ignored; empty tables give no rows. Scores are exact up to 2**62; a score beyond counts as ``MOST``. Queries are
    searched in blocks of bounded size; runs jobs when called.
    """
    rows = stored(vector_rows(candidates.where(F.col(id_col).isNotNull()), id_col, vec_col), "topk-rows")
    wanted = vector_rows(queries.where(F.col(id_col).isNotNull()), id_col, vec_col).distinct()
    bound = rows.agg(F.max(F.array_max(F.transform("vec", lambda x: F.abs(x * scale) + 1)))).first()[0]
    out = new_run_dir(rows.sparkSession, "topk")
    schema = "query_id long, rank int, vec_id long, score long"
    rows.sparkSession.createDataFrame([], schema).write.parquet(out)
    for block in query_blocks(wanted):
        _search_block(rows, block, k, scale, bound or 0.0).write.mode("append").parquet(out)
    return rows.sparkSession.read.schema(schema).parquet(out)
