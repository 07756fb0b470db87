import zlib
from collections import defaultdict

from conftest import SF01, has_data
from llm_rows import docs_frame, odd_docs  # noqa: F401

from linkgap.llm.sharding import shard


def _check(rows, got, shards):
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(t or "")
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert any(r["size"] == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode()) for t in texts[r.doc_id])
        slots[r["shard"]].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_even_and_slots_gapless(spark):
    rows = [(i, f"{i} " + "é" * (i * 37 % 400)) for i in range(3000)]
    got = shard(docs_frame(spark, rows), 8).collect()
    _check(rows, got, 8)
    by = defaultdict(int)
    for r in got:
        by[r["shard"]] += r["size"]
    share = sum(by.values()) / 8
    assert all(abs(b - share) <= 810 for b in by.values())
    again = {(r.doc_id, r["shard"], r.slot) for r in shard(docs_frame(spark, rows).repartition(7), 8).collect()}
    assert again == {(r.doc_id, r["shard"], r.slot) for r in got}


def test_small_groups_stay_and_a_hot_group_is_split(spark):
    rows = [(i, "copy " * 20) for i in range(1500)] + [(i, f"text {i % 1490 // 2} " + "w" * 40) for i in range(1500, 4480)]
    got = shard(docs_frame(spark, rows), 8, ranges=1024).collect()
    _check(rows, got, 8)
    by, hot, places = defaultdict(int), set(), defaultdict(set)
    for r in got:
        by[r["shard"]] += r["size"]
        if r.doc_id < 1500:
            hot.add(r["shard"])
        else:
            places[r.text_crc32].add(r["shard"])
    share = sum(by.values()) / 8
    assert max(by.values()) <= 1.01 * share and min(by.values()) >= 0.99 * share
    assert len(hot) >= 4 and all(len(p) == 1 for p in places.values())


def test_one_huge_document_and_odd_rows(spark, odd_docs):  # noqa: F811
    rows = [(0, "z" * 100_000)] + [(i, "ab") for i in range(1, 50)]
    _check(rows, shard(docs_frame(spark, rows), 8).collect(), 8)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    _check(odd, shard(odd_docs, 8).collect(), 8)
    assert shard(odd_docs.limit(0), 8).count() == 0


def test_main_path_runs_no_python(spark):
    df = shard(docs_frame(spark, [(1, "a"), (2, "b")]), 8)
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_rows_that_repeat_wholly_are_spread_over_spots(spark, monkeypatch):
    from linkgap.llm import sharding
    rows = [(7, "same text")] * 6000 + [(i, "same text") for i in range(3000)] + [(i, f"text {i}") for i in range(9000)]
    kept = []
    write = sharding.stored
    monkeypatch.setattr(sharding, "stored", lambda df, name: kept.append((name, out := write(df, name))) or out)
    got = shard(docs_frame(spark, rows).repartition(6), 8, ranges=256).collect()
    _check(rows, got, 8)
    by = defaultdict(int)
    for r in got:
        by[r["shard"]] += r["size"]
    share = sum(by.values()) / 8
    assert max(by.values()) <= 1.01 * share and min(by.values()) >= 0.99 * share
    placed = dict(kept)["shard-rows"]
    cells = [r["count"] for r in placed.groupBy("range", "sub", "run", "deal").count().collect()]
    assert max(cells) <= 4 * len(rows) / 256


@has_data
def test_query_equals_a_plain_loop(spark):
    import pyarrow.parquet as pq
    from linkgap.llm.queries import op5_sharding
    want = {d["doc_id"]: (len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode()))
            for d in pq.read_table(f"{SF01}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    rows = op5_sharding(spark, SF01).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == want and len(rows) == len(want)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    slots, total = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    share, largest = sum(total.values()) / 8, max(s for s, _ in want.values())
    assert all(abs(t - share) <= largest for t in total.values())
