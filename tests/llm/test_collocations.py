import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF01, has_data
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import DOCS, docs_frame, odd_docs  # noqa: F401

from linkgap.llm import collocations as co

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER))]


def plain(rows, max_words=3, min_count=10, percent=50, top=2000):
    """Rows (lang, text) by the definition."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    out = {}
    for (lang, w), a in candidates.items():
        longer = any(g == lang and len(v) > len(w) and 100 * b >= percent * a and any(
            v[i:i + len(w)] == w for i in range(len(v))) for (g, v), b in candidates.items()) if len(w) < max_words else False
        if longer:
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for k, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def mined(df, **options):
    return sorted(tuple(r) for r in co.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB .,\n\té!\x0b日", max_size=30)), max_size=12))
@settings(max_examples=100, deadline=None)
def test_words_and_pieces(texts):
    words, text, new = co.split_words(pa.array(texts, pa.string()))
    got = []
    for w, t, first in zip(words.to_pylist(), text.tolist(), new.tolist()):
        if first:
            got.append((t, []))
        got[-1][1].append(w)
    assert got == [(k, p) for k, t in enumerate(texts) for p in pieces(t) if p]


def test_relations_join_at_adjacent_positions():
    seq = np.array([0, 1, 2, 1, 2, 0, 2, 1, 2, 0], "<u4")
    longer, keys, n = co._longer(seq, [np.array([70, 80])])
    assert [tuple(int(k[c - 1]) for k in keys) if c else None for c in longer] == [
        None, (70, 80), (80, 70), (70, 80), None, None, (80, 70), (70, 80), None, None]
    assert sorted(zip(*(k.tolist() for k in keys), n.tolist())) == [(70, 80, 3), (80, 70, 2)]


def test_shares_of_phrases_are_dealt_by_hash():
    rng = np.random.default_rng(4)
    hashes = rng.integers(-2 ** 63, 2 ** 63, 60)
    seq, keys = rng.integers(0, 61, 20_000).astype("<u4"), [hashes]
    for _ in range(2):
        longer, found, n = co._longer(seq, keys)
        whole = sorted(zip(*(k.tolist() for k in found), n.tolist()))
        shares = [co._longer(seq, keys, share, 3) for share in range(3)]
        for share, (_, own, _) in enumerate(shares):
            assert ((co._mixed(own) >> np.uint64(32)) % np.uint64(3) == share).all() and len(own[0]) > len(whole) / 4
        assert sorted(r for _, own, m in shares for r in zip(*(k.tolist() for k in own), m.tolist())) == whole
        seq, keys = longer, found


def test_a_relation_is_held_a_block_at_a_time(spark, monkeypatch):
    import pyarrow.parquet as pq
    df = docs_frame(spark, [(i, "red green blue. red green " * 8) for i in range(60)]).coalesce(1)
    monkeypatch.setattr(co, "BLOCK_BYTES", 500)
    kept, write = [], co._written
    monkeypatch.setattr(co, "_written", lambda d, name: kept.append(write(d, name)) or kept[-1])
    assert mined(df) == plain([("en", "red green blue. red green " * 8)] * 60) and len(kept) == 2
    for relation in kept:
        files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in relation.inputFiles()]
        assert sum(m.num_rows for m in files) > 20 and all(m.num_row_groups == m.num_rows for m in files)


def test_a_count_leaves_no_shuffle_files(spark, monkeypatch):
    import time
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_(\d+)_", disk.getAllBlocks().mkString(" ")))

    before, own, inside, store = spark.conf.get(name, None), shuffles(), [], co.stored

    def storing(df, folder):
        out = store(df, folder)
        if folder == "phrase-groups":
            end = time.time() + 20
            while shuffles() - own and time.time() < end:  # they go in the background
                time.sleep(0.1)
            inside.append(shuffles() - own)
        return out
    monkeypatch.setattr(co, "stored", storing)
    # all words are frequent (4 passes); words of pairs that are: 36 of 54 (3 passes)
    rows = [(i, "red green red blue") for i in range(12)] + [(20 + i, "red") for i in range(6)]
    assert mined(docs_frame(spark, rows).repartition(3)) == plain([("en", text) for _, text in rows])
    assert inside == [set()] * (4 + 3) and spark.conf.get(name, None) == before


def test_filter_keeps_every_frequent_group(spark):
    rng = random.Random(2)
    rows = [tuple(rng.randrange(-2 ** 63, 2 ** 63) for _ in range(3)) for _ in range(500)]
    bitmap = co.frequent_filter(spark.createDataFrame(rows, "a long, b long, c long"), ["a", "b", "c"], bits=14)
    keys = [np.array(c, np.int64) for c in zip(*rows)]
    assert co._passes(keys, bitmap).all()
    other = [np.array([rng.randrange(-2 ** 63, 2 ** 63) for _ in range(5000)]) for _ in range(3)]
    assert co._passes(other, bitmap).mean() < 0.06


@pytest.mark.parametrize("max_words,bits", [(2, 26), (3, 8), (4, 26)])
def test_phrases_equal_a_plain_count(spark, monkeypatch, max_words, bits):
    monkeypatch.setattr(co, "FILTER_BITS", bits)  # 8 bits: the filter lets nearly all pass, the counts decide
    rng = random.Random(max_words)
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(["new", "York", "city", "of", "the", "aa", "b,", "c.", "Été", "x\t"], [9, 9, 6, 5, 9, 1, 2, 2, 1, 1], k=rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "fr", None, "und"]), "s", 1))
    rows += [(900 + i, "hot phrase in every row", "en", "s", 1) for i in range(200)] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    want = plain([(r[2], r[1]) for r in rows], max_words, 10, 50, 40)
    assert mined(df, max_words=max_words, top=40) == want and len(want) > 20


def test_odd_rows_no_rows_and_exact_large_numbers(spark, odd_docs):  # noqa: F811
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert mined(odd_docs, min_count=2) == plain(rows, min_count=2)
    assert mined(odd_docs.limit(0)) == [] and mined(docs_frame(spark, [(1, None), (2, " .. ")])) == []
    a, l, r = 3_999_999_999_999, 4_000_000_000_001, 4_000_000_000_007
    big = spark.createDataFrame([("en", ["x", "y"], a), ("en", ["x"], l), ("en", ["y"], r)], "lang string, words array<string>, f long")
    total = spark.createDataFrame([("en", l + r)], "lang string, n long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(co, "frequent_phrases", lambda *x: (big, total))
        assert mined(big.limit(0)) == [("en", 1, "x y", a, l, r, l + r, 1_000_000 * a * a // (l * r))]


def test_word_hashes_that_collide_take_another_seed(spark, monkeypatch):
    import xxhash
    df = docs_frame(spark, [(i, "red green red blue") for i in range(12)])
    kept, write = [], co._written
    monkeypatch.setattr(co, "_written", lambda d, name: kept.append(name) or write(d, name))
    real = co._blocks

    def weak(seed):
        if seed:
            return real(seed)

        def run(batches):
            for b in real(0)(batches):
                yield b.set_column(4, "hash", pa.array([[7] * len(b.column(3)[0].as_py())], pa.list_(pa.int64())))
        return run
    monkeypatch.setattr(co, "_blocks", weak)
    assert mined(df) == plain([("en", "red green red blue")] * 12) and kept.count("phrase-words") == 2 and xxhash


@has_data
def test_query_and_sql_equal_a_plain_count(spark):
    import duckdb
    import pyarrow.parquet as pq
    from linkgap.llm.queries import ORACLE, op12_collocations
    rows = pq.read_table(f"{SF01}/documents.parquet", columns=["lang", "text"]).to_pylist()
    want = plain([(r["lang"], r["text"]) for r in rows])
    got = sorted(tuple(r) for r in op12_collocations(spark, SF01).collect())
    assert got == want and len(got) > 50
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF01}/documents.parquet'")
    assert sorted(db.execute(ORACLE["op12_collocations"]).fetchall()) == want
