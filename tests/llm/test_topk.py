import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkgap.llm import topk
from linkgap.llm.topk import exact_topk

V = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ids = {i for i, _ in queries}
    out = []
    for q, a in whole:
        if q in ids:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, queries, k, **more):
    df = spark.createDataFrame(rows, V).withColumn("score", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(6)
    ask = df.where(F.col("vec_id").isin([i for i, _ in queries])) if queries else df.limit(0)
    return sorted(tuple(r) for r in exact_topk(df, ask, k, **more).collect())


def vectors(n, d, seed, copies=0):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(d)]) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(copies)]


@pytest.mark.parametrize("k", [1, 5])
def test_equals_brute_force_with_a_hot_vector(spark, k):
    rows = vectors(150, 6, k, copies=120)  # ties: one vector is nearly half of all rows
    ask = rows[::25]
    assert run(spark, rows, ask, k) == brute(rows, ask, k)


def test_several_blocks_and_narrow_bins(spark, monkeypatch):
    rows = vectors(60, 4, 9, copies=10)
    whole = topk.query_blocks
    monkeypatch.setattr(topk, "query_blocks", lambda q: whole(q, 7))
    monkeypatch.setattr(topk, "BINS", 16)
    assert run(spark, rows, rows, 3) == brute(rows, rows, 3)


def test_odd_vectors_lengths_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.0, 0.0]),
            (6, [3.0, -1.0]), (7, [1.0, 1.0, 1.0]), (8, []), (None, [9.0, 9.0]), (9, [2.0 ** 30, 1.0])]
    assert run(spark, rows, rows[:9], 5) == brute(rows, rows[:9], 5)
    assert run(spark, rows, [], 5) == [] and run(spark, [], [], 5) == []


def test_scores_beyond_doubles_stay_exact_and_those_beyond_longs_are_cut(spark):
    rows = [(0, [2.0 ** 20 + 0.5, 3.0]), (1, [2.0 ** 21, 1.0]), (2, [2.0 ** 21, 1.25]), (3, [-(2.0 ** 20), 0.25])]
    assert run(spark, rows, rows, 3) == brute(rows, rows, 3)
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-3e38, 0.0]), (3, [0.5, 0.25]), (4, [0.5, 0.125]), (5, [0.0, 3.0])]
    assert run(spark, rows, rows, 5) == sorted((q, r, i, max(-topk.MOST, min(topk.MOST, s))) for q, r, i, s in cut_brute(rows, 5))


def cut_brute(rows, k):
    """Brute force with scores cut before they are ranked."""
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    for q, a in whole:
        found = sorted((-max(-topk.MOST, min(topk.MOST, sum(x * y for x, y in zip(a, b)))), i) for i, b in whole if i != q)
        yield from ((q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k]))


def test_two_vectors_under_one_id_are_two_queries(spark):
    rows = vectors(30, 4, 3)
    df = spark.createDataFrame(rows, V)
    ask = spark.createDataFrame([(3, [1.0, 0.0, 0.0, 0.0]), (3, [0.0, -1.0, 0.0, 0.0]), (3, [0.0, -1.0, 0.0, 0.0])], V)
    got = sorted(tuple(r) for r in exact_topk(df, ask, 4).collect())
    want = []
    for a in ([256, 0, 0, 0], [0, -256, 0, 0]):
        found = sorted((-sum(x * math.floor(256 * float(np.float32(y))) for x, y in zip(a, v)), i) for i, v in rows if i != 3)
        want += [(3, r + 1, i, -s) for r, (s, i) in enumerate(found[:4])]
    assert got == sorted(want)
