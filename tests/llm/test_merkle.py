import hashlib
import zlib

import pytest
from conftest import SF001, has_data
from llm_rows import docs_frame, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from linkgap.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(row, fanout=2):
    """Levels of a tree, from the leaves to the one node left."""
    levels = [row]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H(*row[k:k + fanout]) for k in range(0, len(row), fanout)])
    return levels


def siblings(levels, at, fanout=2):
    out = []
    for row in levels[:-1]:
        k = at // fanout * fanout
        out.append((at - k, [d for j, d in enumerate(row[k:k + fanout]) if j != at - k]))
        at //= fanout
    return out


def climb(digest, path):
    for digit, others in path:
        digest = H(*others[:digit], digest, *others[digit:])
    return digest


def plain(rows, fanout=2):
    """[(row, leaf, subroot, root, proof)] of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((leaf(r[0], r[3], r[2], r[4], r[1]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([d for d, _ in sorted(groups[g], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))], fanout) for g in names}
    top = tree([trees[g][-1][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for at, (d, r) in enumerate(sorted(groups[g], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))):
            out.append((r, d, trees[g][-1][0], top[-1][0], siblings(trees[g], at, fanout) + siblings(top, k, fanout)))
    return out


def _same(df, rows, fanout):
    got = merkle.manifest(df, fanout=fanout).withColumn("up", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    want = plain(rows, fanout)
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, [(s.digit, list(s.siblings)) for s in r.path]) for r in got), key=key) == sorted(
        ((r[0], d, sub, root, p) for r, d, sub, root, p in want), key=key)
    assert all(r.up == r.root for r in got)
    assert all(climb(d, p) == root for _, d, _, root, p in want)


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_proofs_equal_a_plain_tree(spark, monkeypatch, fanout):
    monkeypatch.setattr(merkle, "SEGMENT_LEVELS", 2)  # several layers with few rows
    rows = [(i, f"text {i}", ["en", "de", None, "", "zz"][min(i % 11, 4)] if i % 5 else "en", "s", i) for i in range(90)]
    rows += [(200, "lone", "xx", None, None), (None, None, "en", "s", 3), (7, "text 7", "de", "s", 7), (7, "text 7", "de", "s", 7)]
    _same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows, fanout)


def test_odd_rows_one_row_and_none(spark, odd_docs):  # noqa: F811
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd_docs.collect()]
    _same(odd_docs, rows, 2)
    _same(odd_docs.where("doc_id = 3"), [r for r in rows if r[0] == 3], 2)
    assert merkle.manifest(odd_docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(odd_docs, fanout=1)


def test_a_changed_row_does_not_fold_to_the_root(spark):
    df = docs_frame(spark, [(i, f"t{i}") for i in range(20)])
    got = merkle.manifest(df, extra={"other": merkle.leaf_digest(F.lit("other"))})
    assert got.where(merkle.fold(F.col("other"), F.col("path")) == F.col("root")).count() == 0


@has_data
def test_query_equals_a_plain_loop(spark):
    import pyarrow.parquet as pq
    from linkgap.llm.queries import op11_merkle
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in
            pq.read_table(f"{SF001}/documents.parquet").to_pylist()]
    want = set()
    for r, d, sub, root, path in plain(rows):
        hit = zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
        up = climb(leaf(r[0], r[3], r[2], r[4] + 1, r[1]) if hit else d, path)
        want.add((r[0], d, sub, root, H(*[x for _, s in path for x in s]), up, up == root))
    got = [tuple(r) for r in op11_merkle(spark, SF001).collect()]
    assert len(got) == len(rows) and set(got) == want and 0 < sum(not r[-1] for r in got) < len(got) / 3
