import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001, has_data
from llm_rows import docs_frame, has_vocabularies, odd_docs  # noqa: F401

from linkgap.llm import token_ids
from linkgap.llm.packing import _fullest, pack, pack_documents, plan_patterns
from linkgap.llm.token_ids import TokenIds


def test_fullest_combination_equals_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        items = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        room = rng.randint(0, 60)
        counts = {n: items.count(n) for n in items}
        got = _fullest(room, sorted(counts, reverse=True), counts)
        best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k) if sum(c) <= room)
        assert sum(n * k for n, k in got.items()) == best and all(k <= counts[n] for n, k in got.items())


def test_plan_places_every_piece_once():
    rng = random.Random(6)
    for _ in range(30):
        cap = rng.choice([10, 64, 4096])
        counts = {rng.randint(1, cap): rng.randint(1, 500) for _ in range(rng.randint(1, 40))}
        used = defaultdict(int)
        for fill, bins in plan_patterns(counts, cap):
            assert bins > 0 and sum(n * k for n, k in fill.items()) <= cap
            for n, k in fill.items():
                used[n] += k * bins
        assert dict(used) == counts


def test_work_depends_on_lengths_not_on_pieces():
    small = plan_patterns({n: 3 for n in range(1, 200)}, 512)
    large = plan_patterns({n: 3_000_000_000 for n in range(1, 200)}, 512)
    assert len(large) <= 3 * len(small) + 200


def _check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_hot_length_and_bound(spark):
    rows = [(i, 0, 7 if i % 3 else 1 + i % 97) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    got = pack(df, 100).collect()
    free = []  # first fit of the longest first
    for n in sorted((r[2] for r in rows), reverse=True):
        k = next((k for k, room in enumerate(free) if room >= n), None)
        if k is None:
            free.append(100 - n)
        else:
            free[k] -= n
    bound = -(-sum(r[2] for r in rows) // 100)
    assert len(got) == 6000 and bound <= _check(got, 100) <= min(len(free), 1.01 * bound)


def test_bad_lengths_raise_and_empty_packs_to_nothing(spark):
    for n in (0, 101, None):
        with pytest.raises(ValueError):
            pack(spark.createDataFrame([(1, 0, n)], "doc_id long, piece int, length long"), 100)
    assert pack(spark.createDataFrame([], "doc_id long, piece int, length long"), 100).count() == 0


def _plain(ids, texts):
    return [ids.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def _batched(ids, texts):
    flat, at = ids.of(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(at, at[1:])]


ODD = ["<|endoftext|> x", "İstanbul ẞ ﬁ", "áb é ", "don't he'll it's 'S", "a\x1cb \x85 \xa0z", "", "  \n\t ", None,
       "Ünï.cødé,,", "ß.", "ǅ x² 12ab", "　日本語 テスト", "a" * 5000 + " " + "ab." * 300, "x|y||### a- -b", "été,, l'été É́", "J̌ ǰ Å"]


@has_vocabularies
def test_batched_ids_equal_the_tokenizer():
    from linkgap.llm.queries import tokenizer_path
    ids = TokenIds(tokenizer_path())
    rng = random.Random(8)
    alphabet = list("abcXYZ éÉàßİıſ'’s t\t\n\r\x0b\x85  .,!?&$#`~{}[]0189日本\u0301\u030cJjİΣς\xad") + ["'s", "'ll", "n't", "<|endoftext|>", "</w>"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(5000)]
    assert _batched(ids, texts) == _plain(ids, texts)
    assert _batched(ids, []) == [] and _batched(ids, [None, ""]) == [[], []]


@has_vocabularies
def test_cache_that_starts_anew_and_rounds(monkeypatch):
    from linkgap.llm.queries import tokenizer_path
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 3)
    monkeypatch.setattr(token_ids, "ROUND_BYTES", 40)
    ids = TokenIds(tokenizer_path())
    texts = [f"w{i} same words again {i}" for i in range(20)] + ["long " * 30, None, "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    parts = list(token_ids.rounds(batch, 0))
    assert len(parts) > 3 and [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert [x for p in parts for x in _batched(ids, p.column(0).to_pylist())] == _plain(ids, texts)


@has_vocabularies
def test_documents_pieces_and_crc(spark, odd_docs):  # noqa: F811
    from linkgap.llm.queries import tokenizer_path
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = [(1, "many words " * 60), (2, None), (3, "short")]
    got = pack_documents(docs_frame(spark, rows), tokenizer_path(), capacity=50).collect()
    _check(got, 50)
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in mine] == [
            (k, 50 * k, len(ids[50 * k:50 * k + 50])) for k in range(-(-len(ids) // 50))]
        assert [r.ids_crc32 for r in mine] == [
            zlib.crc32(np.array(ids[r.start:r.start + 50], "<u4").tobytes()) for r in mine]
    odd = pack_documents(odd_docs, tokenizer_path()).collect()
    assert len({r.doc_id for r in odd}) == 10 and _check(odd, 4096) >= 1
    assert pack_documents(odd_docs.limit(0), tokenizer_path()).count() == 0


def test_rows_that_repeat_wholly_are_sorted_by_many_tasks(spark, monkeypatch):
    from linkgap.operators import ranking
    kept, tag = [], ranking.tag_order
    monkeypatch.setattr(ranking, "tag_order", lambda *a: kept.append(t := tag(*a)) or t)
    rows = [(7, 0, 33)] * 8000 + [(i, 0, 1 + i % 90) for i in range(16000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would come together again
    try:
        got = pack(spark.createDataFrame(rows, "doc_id long, piece int, length long").repartition(6), 100).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    _check(got, 100)
    parts = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert max(parts) <= 2 * len(rows) / 8


@has_vocabularies
@has_data
def test_query_equals_a_plain_loop(spark):
    import pyarrow.parquet as pq
    from linkgap.llm.queries import op4_packing, tokenizer_path
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = set()
    for d in docs:
        ids = np.array(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        want |= {(d["doc_id"], k, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes()))
                 for k, a in enumerate(range(0, len(ids), 4096))}
    got = op4_packing(spark, SF001).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    total = sum(r.length for r in got)
    assert -(-total // 4096) <= _check(got, 4096) <= 1.02 * total / 4096 + 1
