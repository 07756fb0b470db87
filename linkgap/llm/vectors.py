"""Vector tables in tasks: validity, query blocks, matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_positions
from .common import stored

#: Queries of one block: they are broadcast together, so this bounds a broadcast
#: (times the vector length, 8 bytes a number).
QUERY_BLOCK = 4096
#: Vectors a task holds at once.
CHUNK = 16384


def finite(vec: Column) -> Column:
    """No null and only finite numbers in it."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def vector_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows whose vector is whole; other columns are left out."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        finite(F.col("vec")))


def query_blocks(queries: DataFrame, block: int = QUERY_BLOCK) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Blocks of at most ``block`` queries, each {length: (ids, matrix)}. Only one block
    at a time is on the driver."""
    ranked = stored(rank_positions(queries, [F.col("id").asc(), F.col("vec").asc()], "pos")
                    .withColumn("block", F.expr(f"(pos - 1) div {block}")), "query-blocks")
    n = ranked.agg(F.max("block")).first()[0]
    for at in range(0 if n is None else n + 1):
        rows = ranked.where(F.col("block") == at).orderBy("pos").collect()
        yield by_length(np.array([-1 if r["id"] is None else r["id"] for r in rows], np.int64), [r["vec"] for r in rows])


def by_length(ids: np.ndarray, vectors: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    lengths = np.array([len(v) for v in vectors], np.int64)
    return {int(d): (ids[lengths == d], np.array([v for v in vectors if len(v) == d], np.float64).reshape(
        int((lengths == d).sum()), int(d))) for d in np.unique(lengths)}


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """{length: (ids, matrix)} of up to ``size`` rows of (id, vec) at a time."""
    held, n = [], 0

    def merged():
        parts: dict[int, list] = {}
        for batch in held:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            vec = batch.column(1)
            lengths = np.diff(vec.offsets.to_numpy())
            flat = vec.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            for d in np.unique(lengths):
                mine = np.flatnonzero(lengths == d)
                at = (ends[mine] - d)[:, None] + np.arange(d)
                parts.setdefault(int(d), []).append((ids[mine], flat[at.astype(np.int64)]))
        return {d: (np.concatenate([i for i, _ in p]), np.concatenate([m for _, m in p])) for d, p in parts.items()}

    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            if n and n + part.num_rows > size:
                yield merged()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield merged()


def table(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def top_rows(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (score, then smaller vec_id) of each ``query`` (its place in the block: two queries may
    share an id), with rank from 1."""
    from pyspark.sql import Window
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
