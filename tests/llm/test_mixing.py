import re
from collections import defaultdict

import pytest
from conftest import SF001, has_data
from pyspark.sql import functions as F

from linkgap.llm.mixing import first_words, mix, mixed_documents, source_targets

from llm_rows import docs_frame, odd_docs  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, most=3):
    """Targets by reshares of the excess until none is above its ceiling."""
    total, full = sum(sizes), set()
    while True:
        rest = sum(w for i, w in enumerate(weights) if i not in full)
        left = total - sum(most * sizes[i] for i in full)
        out = [most * s if i in full else left * weights[i] / rest for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(out) if t >= most * sizes[i] and i not in full}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1, 2, 5], [5], [0, 7, 0, 100, 3, 3, 3], [1, 10 ** 9, 10 ** 6, 4]])
def test_targets_are_a_water_fill(spark, sizes):
    rows = [(f"+{i:02d}", f"{i:02d}", s) for i, s in enumerate(sizes)]
    got = {r["source"]: r["target"] for r in source_targets(
        spark.createDataFrame(rows, "skey string, source string, source_size long")).collect()}
    want = water_fill(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert [got[f"{i:02d}"] for i in range(len(sizes))] == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_budgets_are_met_exactly_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{i % 4}" if i % 9 else None) for i in range(400)]
    df = docs_frame(spark, rows)
    got = mix(df).collect()
    again = mix(df.repartition(5)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r["size"] == len(WORD.findall(rows[r.doc_id][1]))
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert {s: round(t) for s, t in target.items()} == pytest.approx(dict(taken), abs=1)
    # nulls come last: weights 1, 2, 3, 1 for s0..s3 and 2 for null
    assert target["s1"] == pytest.approx(2 * target["s0"]) and target[None] == pytest.approx(2 * target["s0"])


def test_hot_source_and_single_document_source(spark):
    rows = [(i, "a b c", "hot") for i in range(300)] + [(1000, "x y", "tiny")]
    got = {r.doc_id: r for r in mix(docs_frame(spark, rows)).collect()}
    assert got[1000].target == 6 and got[1000].taken == 6 and got[1000].epochs == 3
    assert sum(r.taken for r in got.values()) == 902


def test_mixed_documents_hold_the_taken_words(spark):
    rows = [(i, f"d{i} " + "w " * (i % 11), f"s{i % 3}") for i in range(120)]
    df = docs_frame(spark, rows)
    taken = {r.doc_id: r.taken for r in mix(df).collect()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text) and rows[r.doc_id][1].startswith(r.text)
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}


def test_first_words_keep_the_white_space_between(spark):
    df = spark.createDataFrame([(" a\t b\nc d ", 2), ("a b", 9), ("a b", 0)], "t string, n long")
    assert [r[0] for r in df.select(first_words(F.col("t"), F.col("n"))).collect()] == [" a\t b", "a b", ""]


def test_odd_rows_and_empty_table(spark, odd_docs):
    got = mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.taken == 0 for r in got if r["size"] == 0) and sum(r.taken for r in got) == sum(r["size"] for r in got)
    assert mixed_documents(odd_docs).columns == odd_docs.columns
    assert mix(odd_docs.limit(0)).count() == 0 and mixed_documents(odd_docs.limit(0)).count() == 0
    blank = docs_frame(spark, [(1, "", "a"), (2, None, "b")])
    assert [r.taken for r in mix(blank).collect()] == [0, 0]


@has_data
def test_query_equals_its_sql(spark):
    import duckdb

    from linkgap.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    cols = ["doc_id", "source", "size", "source_size", "target", "taken"]
    want = sorted(map(tuple, con.execute(ORACLE["op2_mixing"]).df()[cols].values.tolist()))
    got = sorted(tuple(r) for r in QUERIES["op2_mixing"](spark, SF001).select(*cols).collect())
    assert got == want


def test_repeated_rows_spread_over_tasks_and_keep_the_running_sums(spark, monkeypatch):
    from linkgap.llm import mixing
    rows = [(7, "one two three", "s0")] * 3000 + [(100 + i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(6000)]
    df = docs_frame(spark, rows).repartition(6)
    cells = []
    tag = mixing.tag_order
    monkeypatch.setattr(mixing, "tag_order", lambda *a: cells.append(t := tag(*a)) or t)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would come together again
    try:
        spread = sorted((r.doc_id, r["size"], r.taken) for r in mix(df, hot_rows=50).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread == sorted((r.doc_id, r["size"], r.taken) for r in mix(df).collect())
    counts = [r["count"] for r in cells[0].groupBy("_part", "skey", "range").count().collect()]
    assert sum(counts) >= 3000 and max(counts) <= 2 * 3000 / 8  # 8 tasks
