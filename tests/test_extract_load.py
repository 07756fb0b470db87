import pytest
from pyspark.sql import functions as F

from linkgap import schemas
from linkgap.config import REFERENCE_TARGETS, Target, Targets
from linkgap.operators import extract as ex
from linkgap.operators import load as ld
from linkgap.sources import graph_files as gf


def test_find_target_ids(spark, toy_files):
    v = gf.read_vertices(spark, toy_files["vertices"])
    ids = ex.find_target_ids(v, REFERENCE_TARGETS)
    assert len(ids) == 5
    assert set(ids.values()) == {t.domain for t in REFERENCE_TARGETS.all}
    assert ids == {0: "omni.co", 4: "sigmacomputing.com", 9: "hex.tech", 3: "mode.com", 2: "lightdash.com"}


def test_missing_target_raises(spark, toy_files):
    v = gf.read_vertices(spark, toy_files["vertices"])
    with pytest.raises(ex.ExtractError):
        ex.find_target_ids(v, Targets(Target("own", "nope.zz"), ()))
    missing = ex.missing_targets(ex.target_ids(v, Targets(Target("own", "nope.zz"), (Target("h", "hex.tech"),))),
                                 Targets(Target("own", "nope.zz"), (Target("h", "hex.tech"),)))
    assert [r[0] for r in missing.collect()] == ["nope.zz"]


def test_filter_edges_and_resolve(spark, toy_files):
    v = gf.read_vertices(spark, toy_files["vertices"])
    e = gf.read_edges(spark, toy_files["edges"])
    inbound = ex.inbound_edges(e, ex.find_target_ids(v, REFERENCE_TARGETS))
    rows = inbound.collect()
    assert len(rows) == 8  # elsewhere.org -> lone-link.net is not into a target
    assert sum(r["target_domain"] == "omni.co" for r in rows) == 1
    src = ex.source_domains(v, inbound)
    assert sorted(r["source_id"] for r in src.collect()) == [1, 5, 6, 7]
    assert "com.chart-notes" in {r["rev_domain"] for r in src.collect()}


def test_empty_key_set_matches_nothing(spark, toy_files):
    e = gf.read_edges(spark, toy_files["edges"])
    assert ex.inbound_edges(e, {}).count() == 0


def test_filter_ranks_and_stats(spark, toy_files):
    r = gf.read_ranks(spark, toy_files["ranks"])
    names = spark.createDataFrame([("com.chart-notes",)], "rev_domain string")
    out = ex.source_ranks(r, names).collect()
    assert len(out) == 1 and out[0]["hc_pos"] == 2
    assert gf.nodes_total(gf.read_stats(spark, toy_files["stats"])) == 10


def test_stats_formats(spark, tmp_path):
    p = tmp_path / "x.stats"
    p.write_text("nodes=121\narcs=5\navg=3.5\nlist=1,2,3\nnodes = 122\n")
    kv = {r["key"]: r["value"] for r in gf.read_stats(spark, str(p)).collect()}
    assert kv == {"nodes": 122, "arcs": 5}  # floats/lists dropped, last wins
    p2 = tmp_path / "y.stats"
    p2.write_text("arcs=5\n")
    with pytest.raises(ValueError):
        gf.nodes_total(gf.read_stats(spark, str(p2)))


def test_more_columns_are_ignored_and_missing_ones_abort(spark, tmp_path):
    (tmp_path / "v").write_text("1\tcom.a\t17\n\n2\tcom.b\t3\n")
    (tmp_path / "e").write_text("1\t2\tx\ty\n2\t1\n")
    (tmp_path / "r").write_text("#hc_pos\t#v\t#pr_pos\t#w\t#name\n5\t0.1\t6\t0.2\tcom.a\t99\n")
    assert [tuple(x) for x in gf.read_vertices(spark, str(tmp_path / "v")).collect()] == [(1, "com.a"), (2, "com.b")]
    assert [tuple(x) for x in gf.read_edges(spark, str(tmp_path / "e")).collect()] == [(1, 2), (2, 1)]
    assert [tuple(x) for x in gf.read_ranks(spark, str(tmp_path / "r")).collect()] == [("com.a", 5, 6)]
    (tmp_path / "short").write_text("1\n")
    with pytest.raises(Exception, match="missing or malformed"):
        gf.read_edges(spark, str(tmp_path / "short")).collect()


def test_stats_lines_without_separator_are_skipped(spark, tmp_path):
    (tmp_path / "s").write_text("\nnodes\njunk line\nnodes=12\n=\n")
    assert [tuple(r) for r in gf.read_stats(spark, str(tmp_path / "s")).collect()] == [("nodes", 12)]


def test_repeated_target_name_raises_with_its_count(spark):
    v = spark.createDataFrame([(i, "tech.hex") for i in range(3)] + [(9, "co.omni")], "id long, rev_domain string")
    with pytest.raises(ex.ExtractError, match="hex.tech \\(3 vertices\\)"):
        ex.find_target_ids(v, Targets(Target("own", "omni.co"), (Target("hex", "hex.tech"),)))


def test_bad_number_fails_fast(spark, tmp_path):
    p = tmp_path / "edges.tsv"
    p.write_text("1\t2\nx\t3\n")
    with pytest.raises(Exception):
        gf.read_edges(spark, str(p)).collect()


# --- load ------------------------------------------------------------------

def _slices(spark, d, edges="7\tomni.co\n8\thex.tech\n", sources="7\tdev.kindhost\n8\tnet.lone-link\n",
            ranks="dev.kindhost\t100\t200\n"):
    d.mkdir(parents=True, exist_ok=True)
    (d / "edges.tsv").write_text(edges)
    (d / "sources.tsv").write_text(sources)
    (d / "ranks.tsv").write_text(ranks)
    return (gf.read_slice(spark, str(d / "edges.tsv"), schemas.SLICE_EDGES),
            gf.read_slice(spark, str(d / "sources.tsv"), schemas.SLICE_SOURCES),
            gf.read_slice(spark, str(d / "ranks.tsv"), schemas.SLICE_RANKS))


def _count(spark, root, table, release):
    return ld.published(spark, root, table).where(F.col("release") == release).count()


def test_load_and_idempotent_rerun(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "s")
    c1 = ld.load_release(spark, root, "2026-05", e, s, r, 1000)
    c2 = ld.load_release(spark, root, "2026-05", e, s, r, 1000)
    assert c1 == c2 == {"raw_backlink_edges": 2, "raw_domain_ranks": 1, "raw_graph_stats": 1}
    edges = ld.published(spark, root, "raw_backlink_edges")
    assert edges.count() == 2
    row = edges.where("source_id = 7").select("source_rev_domain", "target_domain").first()
    assert tuple(row) == ("dev.kindhost", "omni.co")
    assert ld.published(spark, root, "raw_graph_stats").first()["nodes_total"] == 1000
    counts = {(x["release"], x["table_name"]): x["row_count"] for x in ld.release_counts(spark, root).collect()}
    assert counts == {("2026-05", "raw_backlink_edges"): 2, ("2026-05", "raw_domain_ranks"): 1,
                      ("2026-05", "raw_graph_stats"): 1}


def test_failed_rerun_keeps_previous_release(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "good")
    ld.load_release(spark, root, "2026-05", e, s, r, 1000)
    # The ranks slice holds a bad number: the failure comes mid-write, after
    # the edges of the new run are already on disk.
    e2, s2, r2 = _slices(spark, tmp_path / "bad", ranks="dev.kindhost\tabc\t200\n")
    with pytest.raises(Exception):
        ld.load_release(spark, root, "2026-05", e2, s2, r2, 9999)
    assert _count(spark, root, "raw_backlink_edges", "2026-05") == 2
    assert _count(spark, root, "raw_domain_ranks", "2026-05") == 1
    assert ld.published(spark, root, "raw_graph_stats").first()["nodes_total"] == 1000
    # a missing slice file fails before anything is written
    with pytest.raises(Exception):
        gf.read_slice(spark, str(tmp_path / "missing.tsv"), schemas.SLICE_RANKS).collect()


def test_load_empty_slices(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "empty", edges="", sources="", ranks="")
    c = ld.load_release(spark, root, "2026-07", e, s, r, 0)
    assert c == {"raw_backlink_edges": 0, "raw_domain_ranks": 0, "raw_graph_stats": 1}
    assert ld.load_release(spark, root, "2026-07", e, s, r, 0) == c
    assert _count(spark, root, "raw_graph_stats", "2026-07") == 1


def test_empty_rerun_replaces_release(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "good")
    ld.load_release(spark, root, "2026-05", e, s, r, 1000)
    e0, s0, r0 = _slices(spark, tmp_path / "empty", edges="", sources="", ranks="")
    ld.load_release(spark, root, "2026-05", e0, s0, r0, 1000)
    assert _count(spark, root, "raw_backlink_edges", "2026-05") == 0


def test_load_fails_on_unresolved_source_id(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "u", edges="7\tomni.co\n8\thex.tech\n9\tacme.io\n")
    with pytest.raises(ld.LoadError, match="smallest such ids"):
        ld.load_release(spark, root, "2026-06", e, s, r, 500)
    for t in ld.TABLES:
        assert _count(spark, root, t, "2026-06") == 0


def test_unresolved_null_id_counts(spark):
    e = spark.createDataFrame([(None, "hex.tech"), (1, "hex.tech")], "source_id long, target_domain string")
    s = spark.createDataFrame([(1, "a.b")], "source_id long, rev_domain string")
    assert ld.unresolved_edges(e, s).count() == 1


def test_blank_slice_lines_ignored(spark, tmp_path):
    e, _, _ = _slices(spark, tmp_path / "b", edges="7\tomni.co\n\n8\thex.tech\n\n")
    assert e.count() == 2


def test_extract_release_slices(spark, toy_files):
    vertices = gf.read_vertices(spark, toy_files["vertices"])
    edges = ex.inbound_edges(gf.read_edges(spark, toy_files["edges"]), ex.find_target_ids(vertices, REFERENCE_TARGETS))
    sources = ex.source_domains(vertices, edges)
    ranks = ex.source_ranks(gf.read_ranks(spark, toy_files["ranks"]), sources)
    assert (edges.count(), sources.count(), ranks.count()) == (8, 4, 4)


def test_vacuum_keeps_published_rows(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "v")
    ld.load_release(spark, root, "2026-05", e, s, r, 1000)
    eu, su, ru = _slices(spark, tmp_path / "vu", edges="7\tomni.co\n9\tacme.io\n")
    with pytest.raises(ld.LoadError):  # leaves an uncommitted edges folder behind
        ld.load_release(spark, root, "2026-05", eu, su, ru, 1000)
    ld.load_release(spark, root, "2026-05", e, s, r, 1000)
    before = {t: ld.published(spark, root, t).count() for t in ld.TABLES}
    deleted = ld.vacuum(spark, root)
    # first committed run: 3 tables and its coverage; failed run: its edges folder
    assert len(deleted) == 5
    assert {t: ld.published(spark, root, t).count() for t in ld.TABLES} == before
    assert ld.vacuum(spark, root) == []
    assert ld.read_table(spark, root, "raw_backlink_edges").select("run").distinct().count() == 1


def test_null_names_refuse_the_release_with_their_own_message(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "n")
    null_name = spark.createDataFrame([(7, "dev.kindhost"), (8, None)], "source_id long, rev_domain string")
    with pytest.raises(ld.LoadError, match="1 of its edges come from a source without a name"):
        ld.load_release(spark, root, "2026-05", e, null_name, r, 1)
    # the operator agrees: a source without a name is a source
    assert ld.unresolved_edges(e, null_name).count() == 0 and ld.resolve_edges(e, null_name).count() == 2
    null_target = spark.createDataFrame([(7, None), (8, "hex.tech")], "source_id long, target_domain string")
    with pytest.raises(ld.LoadError, match="1 of its edges have no target domain"):
        ld.load_release(spark, root, "2026-05", null_target, s, r, 1)
    null_rank = spark.createDataFrame([(None, 1, 2), ("dev.kindhost", None, None)], "rev_domain string, hc_pos long, pr_pos long")
    with pytest.raises(ld.LoadError, match="1 of its ranks have no domain name"):
        ld.load_release(spark, root, "2026-05", e, s, null_rank, 1)
    assert all(_count(spark, root, t, "2026-05") == 0 for t in ld.TABLES)
    ld.load_release(spark, root, "2026-05", e, s, null_rank.where("rev_domain is not null"), 1)  # positions may be null
    assert _count(spark, root, "raw_domain_ranks", "2026-05") == 1


def test_only_committed_folders_are_opened(spark, root, tmp_path):
    e, s, r = _slices(spark, tmp_path / "p")
    ld.load_release(spark, root, "2026-05", e, s, r, 1)
    old = ld.committed_pairs(spark, root)[0]
    ld.load_release(spark, root, "2026-05", e, s, r, 2)
    for t in (*ld.TABLES, ld.COVERAGE):
        folder = tmp_path / "warehouse" / t / f"release={old[0]}" / f"run={old[1]}"
        for part in folder.glob("part-*"):
            part.write_bytes(b"broken")
    assert {t: _count(spark, root, t, "2026-05") for t in ld.TABLES} == {
        "raw_backlink_edges": 2, "raw_domain_ranks": 1, "raw_graph_stats": 1}
    assert all(p.count(f"run={old[1]}") == 0 for p in ld.published(spark, root, "raw_backlink_edges").inputFiles())


def test_coverage_of_releases_equals_the_full_aggregation(spark, root, tmp_path):
    from linkgap.operators import transform as tr

    def same():
        n = ld.staged_releases(spark, root)
        state = tr.coverage_of_releases(ld.published(spark, root, ld.COVERAGE), REFERENCE_TARGETS, n)
        full = tr.competitor_coverage(tr.staged_edges_all(ld.published(spark, root, "raw_backlink_edges")), REFERENCE_TARGETS)
        columns = sorted(full.columns)
        rows = sorted(tuple(x) for x in state.select(columns).collect())
        assert rows == sorted(tuple(x) for x in full.select(columns).collect())
        assert state.select(columns).dtypes == full.select(columns).dtypes
        return rows

    assert same() == []
    ld.load_release(spark, root, "2026-05", *_slices(spark, tmp_path / "a"), 1)
    first = same()
    # a second release with other links, a repeated edge and a self link
    two = _slices(spark, tmp_path / "b", edges="7\thex.tech\n7\thex.tech\n9\tmode.com\n5\tmode.com\n", sources="7\tdev.kindhost\n9\tio.row\n5\tcom.mode\n")
    ld.load_release(spark, root, "2026-06", *two, 1)
    added = same()
    assert len(first) == 2 and len(added) == 3
    ld.load_release(spark, root, "2026-06", *_slices(spark, tmp_path / "c"), 1)
    assert same() != added
    empty = _slices(spark, tmp_path / "d", edges="", sources="", ranks="")
    ld.load_release(spark, root, "2026-06", *empty, 1)
    assert same() == first and ld.staged_releases(spark, root) == 1


def test_aliases_count_for_their_target(spark):
    targets = Targets(Target("own", "omni.co", ("omni-app.co",)), (Target("hex", "hex.tech", ("hex.example", "absent.example")),))
    v = spark.createDataFrame([(1, "co.omni"), (2, "co.omni-app"), (3, "tech.hex"), (4, "example.hex"), (5, "com.some")], "id long, rev_domain string")
    ids = ex.find_target_ids(v, targets)
    assert ids == {1: "omni.co", 2: "omni.co", 3: "hex.tech", 4: "hex.tech"}  # an alias without a vertex is no error
    e = spark.createDataFrame([(5, 4), (5, 2), (5, 5)], "src long, dst long")
    assert sorted(tuple(x) for x in ex.inbound_edges(e, ids).collect()) == [(5, "hex.tech"), (5, "omni.co")]
    with pytest.raises(ex.ExtractError, match="hex.example \\(2 vertices\\)"):
        ex.find_target_ids(v.union(spark.createDataFrame([(6, "example.hex")], v.schema)), targets)
    with pytest.raises(ex.ExtractError, match="hex.tech"):  # the alias does not stand for the domain's own vertex
        ex.find_target_ids(v.where("id <> 3"), targets)
