import pytest
from pyspark.sql import functions as F

from linkgap.config import REFERENCE_TARGETS
from linkgap.operators import load as ld
from linkgap.plans import pipeline as pl
from linkgap.sources import graph_files as gf


def _inputs(spark, files, label="2026-05", edges_path=None):
    return pl.ReleaseInputs(
        label,
        vertices=lambda: gf.read_vertices(spark, files["vertices"]),
        edges=lambda: gf.read_edges(spark, edges_path or files["edges"]),
        ranks=lambda: gf.read_ranks(spark, files["ranks"]),
        stats=lambda: gf.read_stats(spark, files["stats"]),
        identity=files["dir"])


def test_pipeline_end_to_end(spark, root, toy_files):
    counts = pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS)
    assert counts == {"raw_backlink_edges": 8, "raw_domain_ranks": 4, "raw_graph_stats": 1}
    e = ld.published(spark, root, "raw_backlink_edges")
    assert e.where(F.col("target_domain") == "omni.co").count() == 1
    assert pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS) == counts


def test_rerun_skips_finished_extract(spark, root, toy_files, tmp_path):
    counts = pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS)
    broken = _inputs(spark, toy_files, edges_path=str(tmp_path / "does-not-exist.txt.gz"))
    assert pl.run_release(spark, root, broken, REFERENCE_TARGETS) == counts


def test_changed_targets_rerun_extract(spark, root, toy_files, tmp_path):
    pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS)
    planned = pl.planned_steps(spark, [_inputs(spark, toy_files)], REFERENCE_TARGETS)
    assert pl.pending_steps_for(spark, root, planned).count() == 0
    from linkgap.config import Targets
    other = Targets(REFERENCE_TARGETS.own, REFERENCE_TARGETS.competitors[:2])
    planned2 = pl.planned_steps(spark, [_inputs(spark, toy_files)], other)
    assert pl.pending_steps_for(spark, root, planned2).count() == len(pl.STEPS)


def test_failed_release_stops_run_earlier_stay(spark, root, toy_files, tmp_path):
    good = _inputs(spark, toy_files, label="2026-05")
    bad = _inputs(spark, toy_files, label="2026-06", edges_path=str(tmp_path / "nope.gz"))
    with pytest.raises(Exception):
        pl.run_releases(spark, root, [good, bad], REFERENCE_TARGETS)
    rel = {r["release"] for r in ld.published(spark, root, "raw_graph_stats").collect()}
    assert rel == {"2026-05"}


def test_golden_mart(spark, root, toy_files):
    pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS)
    mart = pl.mart_from_root(spark, root, REFERENCE_TARGETS)
    rows = {r["source_domain"]: r.asDict() for r in mart.collect()}
    assert set(rows) == {"chart-notes.com", "row-digest.io"}
    a, b = rows["chart-notes.com"], rows["row-digest.io"]
    assert (a["links_sigma"], a["links_hex"], a["links_mode"], a["links_lightdash"], a["links_own"]) == (1, 1, 0, 1, 0)
    assert (a["competitor_count"], a["releases_seen"], a["present_in_both"]) == (3, 1, 1)
    assert a["authority_percentile"] == 0.9 and a["opportunity_score"] == 0.845
    assert a["category"] == "other"
    assert (b["competitor_count"], b["authority_percentile"]) == (2, 0.4)
    assert b["opportunity_score"] == 0.5700000000000001
    assert b["category"] == "other"


def test_empty_release_keeps_present_in_both(spark, root, toy_files, tmp_path):
    pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS)
    empty = {k: str(tmp_path / f"{k}.txt") for k in ("edges",)}
    (tmp_path / "edges.txt").write_text("")
    pl.run_release(spark, root, _inputs(spark, toy_files, label="2026-07", edges_path=empty["edges"]),
                   REFERENCE_TARGETS)
    mart = pl.mart_from_root(spark, root, REFERENCE_TARGETS)
    assert {r["present_in_both"] for r in mart.collect()} == {1}


def test_release_select_prunes(spark, root, toy_files):
    pl.run_release(spark, root, _inputs(spark, toy_files), REFERENCE_TARGETS)
    df = pl.release_select(spark, root, "2026-05")
    assert df.count() == 8
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()


def test_each_target_list_keeps_its_own_slices(spark, root, toy_files):
    """A, then B, then A again publishes A's edges: slices of other inputs are never read."""
    from linkgap.config import Targets
    few = Targets(REFERENCE_TARGETS.own, REFERENCE_TARGETS.competitors[:1])
    seen = []
    for targets in (REFERENCE_TARGETS, few, REFERENCE_TARGETS):
        pl.run_release(spark, root, _inputs(spark, toy_files), targets)
        seen.append(sorted(tuple(r) for r in ld.published(spark, root, "raw_backlink_edges").collect()))
    assert seen[0] == seen[2] != seen[1] and len(seen[1]) == 3


def test_a_replaced_file_is_extracted_again(spark, root, toy_files, tmp_path):
    from linkgap.streaming.ingest import release_from_files
    edges = tmp_path / "edges.tsv"
    names = [toy_files[k] for k in ("vertices", "ranks", "stats")]
    counts = []
    for text in ("1\t9\n", "1\t9\n6\t9\n"):
        edges.write_text(text)
        rel = release_from_files(spark, "2026-05", names[0], str(edges), names[1], names[2])
        counts.append(pl.run_release(spark, root, rel, REFERENCE_TARGETS)["raw_backlink_edges"])
    assert counts == [1, 2]


def test_conversion_deals_an_unsplittable_file_out(spark, tmp_path, monkeypatch):
    import gzip
    with gzip.open(tmp_path / "e.txt.gz", "wt") as f:
        f.writelines(f"{i}\t{i % 3}\n" for i in range(20_000))
    monkeypatch.setattr(pl, "SPREAD_BYTES", 8 << 10)
    df = gf.read_edges(spark, str(tmp_path / "e.txt.gz"))
    assert df.rdd.getNumPartitions() == 1
    plan = pl.spread(df)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan and "hashpartitioning" not in plan
    empty = spark.createDataFrame([], "id long, rev_domain string")
    rel = pl.ReleaseInputs("r", empty, df, spark.createDataFrame([], "rev_domain string, hc_pos long, pr_pos long"),
                           spark.createDataFrame([("nodes", 1)], "key string, value long"))
    out = pl.convert_release(spark, rel, str(tmp_path / "out"))
    assert out.edges.count() == 20_000 and len(list((tmp_path / "out" / "edges").glob("part-*"))) > 1
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["edges", "ranks", "stats", "vertices"]  # no staged copy stays


def test_converted_files_hold_narrow_ranges_and_a_popular_destination_is_spread(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq
    import random
    rng = random.Random(9)
    rows = [(rng.randrange(100_000), 777 if i % 3 == 0 else rng.randrange(1000)) for i in range(60_000)]
    spark.createDataFrame(rows, "src long, dst long").repartition(4).write.parquet(str(tmp_path / "e"))
    names = [(i, f"com.n{i:05d}") for i in range(20_000)]
    rng.shuffle(names)
    spark.createDataFrame(names, "id long, rev_domain string").repartition(3).write.parquet(str(tmp_path / "v"))
    edges, vertices = (spark.read.parquet(str(tmp_path / x)) for x in "ev")
    monkeypatch.setattr(pl, "SPREAD_BYTES", 32 << 10)
    rel = pl.ReleaseInputs("r", vertices, edges, spark.createDataFrame([], "rev_domain string, hc_pos long, pr_pos long"),
                           spark.createDataFrame([("nodes", 1)], "key string, value long"))
    out = pl.convert_release(spark, rel, str(tmp_path / "out"))
    assert sorted(map(tuple, out.edges.collect())) == sorted(rows) and out.vertices.count() == 20_000

    def footers(kind, column):
        found = []
        for path in sorted((tmp_path / "out" / kind).glob("part-*")):
            meta = pq.ParquetFile(path).metadata
            stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
            if meta.num_rows:
                found.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
        return found

    found = footers("edges", 1)
    assert len(found) >= 10 and max(n for *_, n in found) <= 2 * 60_000 / len(found)
    assert all(sum(lo <= dst <= hi for lo, hi, _ in found) <= 2 for dst in (3, 500, 999))  # a target filter opens two files at most
    popular = [n for lo, hi, n in found if lo <= 777 <= hi]
    assert len(popular) >= len(found) / 4 and sum(popular) >= 20_000
    found = footers("vertices", 1)
    assert len(found) > 3 and all(a[1] < b[0] for a, b in zip(sorted(found), sorted(found)[1:]))
