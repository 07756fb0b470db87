from collections import Counter, defaultdict

import numpy as np
from conftest import SF001, has_data
from llm_rows import docs_frame, has_vocabularies, odd_docs  # noqa: F401

import corpus_pipeline as P

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "SimHash near-dedup", "mixing", "packing"] and P.ORACLE_SQL is None


@has_data
@has_vocabularies
def test_every_stage_takes_effect(spark, tmp_path):
    """The stages' results against plain versions, one after the other."""
    import test_simhash as S
    from linkgap.llm.mixing import WORD, mix
    import re

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = P.toxicity_stage(spark, docs, SF001)
    assert kept.columns == COLUMNS
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    from linkgap.llm.queries import QUERIES
    scored = {r.doc_id: r.predicted for r in QUERIES["op10_toxicity"](spark, SF001).collect()}
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, p in scored.items() if not p)
    clean = [i for i, t in labels.items() if not t]
    assert sum(scored[i] for i in clean) <= 0.05 * len(clean)

    unique = P.dedup_stage(spark, kept, SF001)
    assert unique.columns == COLUMNS
    prints = {r.doc_id: S.plain_fingerprint(r.text) for r in rows}
    root = S.plain_components(sorted(set(prints.values())))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    assert sorted(r.doc_id for r in unique.collect()) == sorted(least.values())

    mixed = P.mix_stage(spark, unique, SF001)
    assert mixed.columns == COLUMNS
    want = {r.doc_id: r.taken for r in mix(unique).collect() if r.taken}
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.doc_id] += len(re.findall(WORD, r.text))
    assert {i: n for i, n in words.items() if n} == want

    packed = P.pack_stage(spark, mixed, SF001).collect()
    copies = Counter(r.doc_id for r in mixed.collect())
    assert Counter(r.doc_id for r in packed if r.piece == 0) == copies
    bins = defaultdict(int)
    for r in packed:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 4096 and len(bins) == -(-sum(bins.values()) // 4096)


@has_vocabularies
def test_run_on_a_folder_of_its_own(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(300))
    docs_frame(spark, [(1, text), (2, text + " end"), (3, "you idiot"), (4, None), (5, "fine words here")]).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} - {4} == {1, 5} and np.all([r.offset >= 0 for r in got])


@has_vocabularies
def test_stages_on_odd_rows_and_no_rows(spark, tmp_path, odd_docs):  # noqa: F811
    spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    n = odd_docs.count()
    for name, stage in P.STAGES:
        out = stage(spark, odd_docs, str(tmp_path))
        rows = out.collect()
        assert name == "packing" or out.columns == odd_docs.columns
        if name == "toxicity":
            assert len(rows) == n
        if name == "SimHash near-dedup":  # empty texts, the two equal texts and each other text
            assert len(rows) < n and len({r.text for r in rows if r.text and r.text.strip()}) == len(rows) - 1
        assert stage(spark, odd_docs.limit(0), str(tmp_path)).count() == 0
