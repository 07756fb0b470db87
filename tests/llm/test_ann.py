import random

import numpy as np
from conftest import has_data
from pyspark.sql import functions as F

from linkgap.llm import ann

V = "vec_id long, embedding array<float>"
SF1 = "/root/testdata/sf0.1"


def frame(spark, rows):
    return spark.createDataFrame(rows, V).withColumn("score", F.lit("x")).withColumn("level", F.lit("x")).repartition(5)


def test_runs_are_prefix_matches():
    rng = np.random.default_rng(0)
    strings = np.sort(rng.integers(0, 1 << ann.BITS, 500))
    q = rng.integers(0, 1 << ann.BITS, 20)
    for level in (0, 1, 7, ann.BITS):
        a, b = ann._runs(strings, q, level)
        shift = ann.BITS - level
        assert [list(strings[x:y]) for x, y in zip(a, b)] == [[s for s in strings if s >> shift == i >> shift] for i in q]


def test_small_tables_are_searched_whole_and_ties_go_to_smaller_ids(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(40)] + [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(30)]
    ask = frame(spark, rows).where("vec_id in (0, 105)")
    got = sorted(tuple(r) for r in ann.search(frame(spark, rows), ask, k=20, wanted=10 ** 9).collect())
    want = []
    for q in (0, 105):
        a = np.array(dict(rows)[q], np.float32).astype(float)
        best = sorted((-(np.array(v, np.float32).astype(float) * a).sum(), i) for i, v in rows if i != q)[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_always_k_rows_if_there_are_as_many(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    got = ann.search(frame(spark, rows), frame(spark, rows).where("vec_id % 20 = 0"), k=20, wanted=1)
    assert {r["count"] for r in got.groupBy("query_id").count().collect()} == {20}


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.0, 0.0]),
            (6, [3.0, -1.0]), (7, [1.0, 1.0, 1.0]), (8, []), (None, [9.0, 9.0])]
    got = sorted(tuple(r) for r in ann.search(frame(spark, rows), frame(spark, rows)).collect())
    assert got == [(0, 1, 6, 1.0), (6, 1, 0, 1.0)]
    assert ann.search(frame(spark, rows).limit(0), frame(spark, rows).limit(0)).count() == 0


def test_two_vectors_under_one_id_are_two_queries(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(50)]
    ask = spark.createDataFrame([(3, [1.0, 0.0, 0.0, 0.0]), (3, [0.0, -2.0, 0.0, 0.0]), (3, [0.0, -2.0, 0.0, 0.0])], V)
    got = [tuple(r)[1:3] for r in ann.search(frame(spark, rows), ask, k=5, wanted=10 ** 9).collect()]
    want = []
    for a in ((0, 1.0), (1, -2.0)):
        best = sorted((-np.float32(v[a[0]]) * a[1], i) for i, v in rows if i != 3)[:5]
        want += [(r + 1, i) for r, (_, i) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_clustered_vectors_score_few_rows(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((100, 16)) * 4
    rows = [(int(i), [float(x) for x in centres[i % 100] + rng.standard_normal(16) * 0.15]) for i in range(6000)]
    df = frame(spark, rows)
    ask = df.where("vec_id % 60 = 0")
    index = ann.build_index(df, ask, k=10)
    scored = [r.n for r in ann.scored_counts(index, ask).collect()]
    assert len(scored) == 100 and np.mean(scored) < 0.1 * len(rows)
    found = {}
    for r in ann.search(df, ask, k=10).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    m = np.array([v for _, v in rows], np.float32).astype(float)
    hits = 0
    for q, near in found.items():
        s = m @ m[q]
        s[q] = -np.inf
        hits += len(near & set(np.argsort(-s)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(found)


@has_data
def test_recall_against_brute_force(spark):
    from linkgap.llm.queries import QUERIES
    got = QUERIES["op8_ann"](spark, SF1).collect()
    rows = spark.read.parquet(f"{SF1}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], float)
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
        assert abs(r.score - m[ids == r.query_id][0] @ m[ids == r.vec_id][0]) < 1e-9
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, near in found.items():
        s = m @ m[ids == q][0]
        s[ids == q] = -np.inf
        hits += len(near & set(ids[np.argsort(-s)[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(found)
