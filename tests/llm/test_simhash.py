import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SF001, has_data
from llm_rows import docs_frame, odd_docs  # noqa: F401

from linkgap.llm import simhash as S
from linkgap.llm.components import connected_components


def plain_fingerprint(text, shingle=4):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in data))
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    """{node: smallest node} by comparing all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def clustered(n, seed, flips=3, centres=6):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    for _ in range(3 * n):
        if len(out) == n:
            break
        p = rng.choice(base)
        for _ in range(rng.randint(0, flips)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("text", ["", None, "a", "a b c", "A b\tC d", "É ß x y Z q", " one  two\x0bthree\r\nfour five " * 40,
                                  "w " * 70_000])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_gray_rank_inverts_the_code():
    x = np.arange(1 << 12, dtype=np.uint64)
    assert (S.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


@pytest.mark.parametrize("seed", range(12))
def test_index_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    fp = np.array(clustered(n, seed, flips=seed % 7), np.uint64)
    n = len(fp)
    bucket = np.sort(rng.integers(0, 1 + seed % 4, n))
    order = np.lexsort((S.gray_rank(fp), bucket))
    bucket, fp = bucket[order], fp[order]
    got = S.link_rows(bucket, fp, np.arange(n), 4)
    want = np.arange(n)
    for i in range(n):
        near = np.flatnonzero((bucket == bucket[i]) & (np.bitwise_count(fp ^ fp[i]) <= 4))
        S._join(want, np.full(len(near), i), near)
    assert (got == want).all()


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_some_choice_of_blocks_agrees(blocks):
    rng = random.Random(blocks)
    masks = S.block_masks(blocks, 4)
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("chunk", [2048, 16])
def test_components_equal_all_pairs_also_with_hot_buckets(spark, chunk):
    prints = clustered(260, 3, flips=5, centres=3)
    df = spark.createDataFrame([(S._signed(p),) for p in prints], "fp long")
    got = {r.node & (2 ** 64 - 1): r.root for r in S.fingerprint_components(df, 4, chunk).collect()}
    want = plain_components(prints)
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(got.get(p, ("alone", p)))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_connected_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 999), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999}
    assert connected_components(df.limit(0)).count() == 0


def test_documents_and_kept_rows(spark, odd_docs):  # noqa: F811
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(10, base), (11, base + " tail"), (12, base.upper()), (13, "other text altogether, quite another one"), (14, None), (15, "")]
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == {10: 10, 11: 10, 12: 10, 13: 13, 14: 14, 15: 14}
    kept = S.drop_near_duplicates(docs_frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [10, 13, 14]
    found = S.near_duplicates(odd_docs)
    assert found.count() == odd_docs.count()
    kept = S.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == found.select("root").distinct().count()
    assert S.near_duplicates(odd_docs.limit(0)).count() == 0 and S.drop_near_duplicates(odd_docs.limit(0)).count() == 0


def test_null_and_repeated_ids_keep_one_row_a_group(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (3, "f g h i j k"), (3, "f g h i j k"), (3, "one more text of its own")]
    kept = S.drop_near_duplicates(docs_frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == ["a b c d e", "f g h i j k", "one more text of its own"]


@has_data
def test_query_equals_brute_force(spark):
    from linkgap.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = plain_components(sorted(set(prints.values())))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    want = sorted((i, f"{p:016x}", least[root[p]]) for i, p in prints.items())
    assert sorted(tuple(r) for r in QUERIES["op7_simhash"](spark, SF001).collect()) == want


def test_dropping_duplicates_with_columns_named_like_its_own(spark):
    from pyspark.sql import functions as F
    rows = [(1, "some words of a text here"), (1, "some words of a text here"), (2, "some words of a text here"), (3, None), (None, "")]
    df = docs_frame(spark, rows)
    for name in ("keep_fp", "keep_id", "n", "fp", "root"):
        df = df.withColumn(name, F.lit(7))
    got = S.drop_near_duplicates(df)
    assert got.columns == df.columns and sorted((r.doc_id or 0, r.keep_fp) for r in got.collect()) == [(1, 7), (3, 7)]
    assert S.drop_near_duplicates(df.limit(0)).count() == 0
