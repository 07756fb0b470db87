import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from linkgap.config import REFERENCE_TARGETS
from linkgap.operators import quality as dq
from linkgap.operators import report as rp
from linkgap.operators import transform as tr
from linkgap.operators.ranking import rank_positions

T = REFERENCE_TARGETS
COLS = ("source_domain string, links_sigma int, links_hex int, links_mode int, links_lightdash int, "
        "links_own int, competitor_count int, present_in_both int, releases_seen long, "
        "authority_percentile double, opportunity_score double, category string")


def _mart(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_merge_duplicates_semantics(spark):
    mart = _mart(spark, [
        ("a.com", 1, 1, 0, 0, 0, 2, 0, 1, 0.5, 0.5 * 2 / 4 + 0.3 * 0.5 + 0.0, "directory"),
        ("b.com", 0, 1, 1, 0, 0, 2, 1, 2, 0.9, 0.5 * 2 / 4 + 0.3 * 0.9 + 0.2, "news/media"),
        ("c.com", 1, 1, 1, 0, 0, 3, 1, 2, 0.1, 0.5 * 3 / 4 + 0.3 * 0.1 + 0.2, "other"),
    ])
    dups = spark.createDataFrame([("a.com", "b.com", "x")], "canonical_domain string, duplicate_domain string, note string")
    merged = rp.merge_duplicates(mart, dups, T)
    out = {r["source_domain"]: r.asDict() for r in merged.collect()}
    assert set(out) == {"a.com", "c.com"}
    a = out["a.com"]
    assert (a["links_sigma"], a["links_hex"], a["links_mode"]) == (1, 1, 1)
    assert a["competitor_count"] == 3 and a["present_in_both"] == 1 and a["authority_percentile"] == 0.9
    assert a["opportunity_score"] == 0.5 * 3 / 4 + 0.3 * 0.9 + 0.2 * 1
    assert a["category"] == "directory" and a["merged_from"] == "b.com" and a["n_merged"] == 1
    c = out["c.com"]
    assert c["opportunity_score"] == 0.5 * 3 / 4 + 0.3 * 0.1 + 0.2 and c["n_merged"] == 0 and c["merged_from"] == ""


def test_top_k_refuses_to_pad(spark):
    mart = _mart(spark, [("a.com", 1, 1, 0, 0, 0, 2, 0, 1, 0.5, 0.4, "other")])
    assert "merged_from" in rp.merge_duplicates(mart, mart.limit(0).select(
        F.col("source_domain").alias("canonical_domain"), F.col("source_domain").alias("duplicate_domain")), T).columns
    with pytest.raises(rp.ReportError):
        rp.top_k(mart.withColumn("n_merged", F.lit(0)), 25)
    top = rp.top_k(mart.withColumn("n_merged", F.lit(0)), 1)
    assert top.first()["rank"] == 1


def test_report_rows_need_actions(spark):
    mart = _mart(spark, [("a.com", 1, 1, 0, 0, 0, 2, 1, 2, 0.5, 0.6, "dev-tooling/data-content")])
    top = rp.top_k(mart.withColumn("n_merged", F.lit(1)).withColumn("merged_from", F.lit("z.com")), 1)
    acts = spark.createDataFrame([("a.com", 'Say "hi", then go.')], "source_domain string, action string")
    r = rp.report_rows(top, acts, T).first()
    assert r["links_to"] == "Sigma, Hex" and r["present_label"] == "Yes"
    assert r["category_title"] == "Dev-Tooling/Data-Content"
    assert r["action"] == 'Say "hi", then go. Also linked via z.com.'
    with pytest.raises(rp.ReportError):
        rp.report_rows(top, acts.where("false"), T)
    with pytest.raises(rp.ReportError, match="duplicate"):
        rp.report_rows(top, acts.unionByName(acts), T)
    ov = spark.createDataFrame([("b.com", "other")], "source_domain string, category string")
    with pytest.raises(rp.ReportError, match="curated"):
        rp.report_rows(top, acts, T, curated=ov)
    assert rp.report_rows(top, acts, T, curated=ov.unionByName(
        spark.createDataFrame([("a.com", "x")], "source_domain string, category string"))).count() == 1


def test_category_sections_order(spark):
    top = spark.createDataFrame([
        (1, "a", "x", 0.9), (2, "b", "y", 0.9), (3, "c", "x", 0.5), (4, "d", "z", 0.95)],
        "rank int, source_domain string, category string, opportunity_score double")
    s = {r["category"]: r["section_order"] for r in rp.category_sections(top).collect()}
    assert s == {"z": 1, "x": 2, "y": 3}


def test_nodes_total_zero_gives_zero_authority(spark):
    ranks = spark.createDataFrame([("2026-07", "com.a", 1, 1)], "release string, source_rev_domain string, hc_pos long, pr_pos long")
    stats = spark.createDataFrame([("2026-07", 0)], "release string, nodes_total long")
    staged = tr.stage_ranks(ranks, stats)
    assert staged.first()["authority_percentile"] is None


def test_keyword_rules_first_hit_wins(spark):
    df = spark.createDataFrame([(d,) for d in ["best-data.com", "x.edu", "mydevblog.io", "dailynews.net",
                                               "saasdirectory.org", "plain.com", "unicourse.com"]], "source_domain string")
    cats = {r[0]: r[1] for r in tr.categorise(df, None).collect()}
    assert cats == {"best-data.com": "listicle/review", "x.edu": "community/education",
                    "mydevblog.io": "dev-tooling/data-content", "dailynews.net": "news/media",
                    "saasdirectory.org": "directory", "plain.com": "other", "unicourse.com": "community/education"}


def test_override_beats_heuristic_and_unique_check(spark):
    df = spark.createDataFrame([("best.com",), ("x.com",)], "source_domain string")
    ov = spark.createDataFrame([("best.com", "community/platform")], "source_domain string, category string")
    cats = {r[0]: r[1] for r in tr.categorise(df, ov).collect()}
    assert cats == {"best.com": "community/platform", "x.com": "other"}
    dup_ov = ov.unionByName(ov)
    assert dq.check_unique(dup_ov, "source_domain").count() == 1


def test_duplicate_chain_rejected(spark):
    d = spark.createDataFrame([("b", "a", ""), ("c", "b", "")], "canonical_domain string, duplicate_domain string, note string")
    assert dq.check_chains(d).count() == 1


def test_rank_positions_matches_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    ours = rank_positions(df.repartition(13), [F.col("v").desc(), F.col("id").asc()], "pos", group="g")
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id").asc())
    ref = df.withColumn("pos", F.row_number().over(w).cast("long"))
    assert ours.select("g", "v", "id", "pos").exceptAll(ref.select("g", "v", "id", "pos")).count() == 0
    assert ours.count() == 5000
    glob = rank_positions(df, [F.col("id").desc()], "p")
    assert sorted(r["p"] for r in glob.collect()) == list(range(1, 5001))
    assert glob.where("p = 1").first()["id"] == 4999


RAW = "source_id long, source_rev_domain string, target_domain string, release string"


def _mini_mart(spark, edges, ranks=None, nodes=10):
    e = spark.createDataFrame(edges, RAW)
    r = spark.createDataFrame(ranks or [], "source_rev_domain string, hc_pos long, pr_pos long, release string")
    s = spark.createDataFrame([(rel, nodes) for rel in {x[3] for x in edges}], "release string, nodes_total long")
    return {x["source_domain"]: x.asDict() for x in tr.opportunity_mart(e, r, s, T).collect()}


def test_own_link_in_any_release_excludes(spark):
    m = _mini_mart(spark, [(1, "com.a", "hex.tech", "r1"), (1, "com.a", "mode.com", "r1"),
                           (1, "com.a", "omni.co", "r2"), (2, "com.b", "hex.tech", "r1"),
                           (2, "com.b", "mode.com", "r2")])
    assert set(m) == {"b.com"} and m["b.com"]["present_in_both"] == 1


def test_competitor_can_be_a_source_and_unranked_is_zero(spark):
    m = _mini_mart(spark, [(1, "tech.hex", "mode.com", "r1"), (1, "tech.hex", "lightdash.com", "r1"),
                           (1, "tech.hex", "hex.tech", "r1")],
                   ranks=[("tech.hex", None, 5, "r1")])
    row = m["hex.tech"]  # the self link is dropped, the two others count
    assert row["competitor_count"] == 2 and row["links_hex"] == 0
    assert row["authority_percentile"] == 0.0


def test_write_report_roundtrip(spark, tmp_path):
    top = spark.createDataFrame([(1, "a.com", "x", 0.9), (2, "b.com", "y", 0.8)],
                                "rank long, source_domain string, category string, opportunity_score double")
    acts = spark.createDataFrame([("a.com", "Say, hi"), ("b.com", "Go")], "source_domain string, action string")
    rows = top.join(acts, "source_domain")
    rp.write_report(rows, rp.category_sections(top), spark.createDataFrame([(2,)], "shown long"), str(tmp_path / "r"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "r" / "rows"))
    assert sorted(r["action"] for r in back.collect()) == ["Go", "Say, hi"]
    assert spark.read.option("header", "true").csv(str(tmp_path / "r" / "sections")).count() == 2


def test_unsafe_duplicate_lists_stop_the_merge(spark):
    row = lambda d: (d, 1, 1, 0, 0, 0, 2, 0, 1, 0.5, 0.4, "x")
    mart = _mart(spark, [row("a.com"), row("b.com"), row("c.com")])
    pairs = "canonical_domain string, duplicate_domain string, note string"
    for bad, what in (([("a.com", "b.com", ""), ("a.com", "b.com", "")], "more than once: 1"),
                      ([("a.com", "b.com", ""), ("c.com", "b.com", "")], "more than once: 1"),
                      ([("z.com", "b.com", "")], "missing from the mart: 1"),
                      ([("a.com", "b.com", ""), ("b.com", "c.com", "")], "duplicates themselves: 1")):
        with pytest.raises(rp.ReportError, match=what):
            rp.merge_duplicates(mart, spark.createDataFrame(bad, pairs), T)
    none = spark.createDataFrame([], pairs)
    with pytest.raises(rp.ReportError, match="mart is empty"):
        rp.merge_duplicates(mart.limit(0), none, T)
    with pytest.raises(rp.ReportError, match="graph statistics"):
        rp.release_nodes(spark.createDataFrame([], "release string, nodes_total long"))
    both = rp.merge_duplicates(mart, spark.createDataFrame([("a.com", "c.com", ""), ("a.com", "b.com", "")], pairs), T)
    assert [r["merged_from"] for r in both.collect()] == ["b.com, c.com"]


def test_fixed_formats_round_by_the_binary_value(spark):
    from linkgap.functions.labels import fmt_fixed, fmt_percent
    values = [0.0, 0.0005, 0.00049999, 0.0009, 0.001, 0.0015, 0.0025, 0.125, 0.5, 0.9995, 1.0005, 1234.5675, 0.00025, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2, 3):
        got = [r[0] for r in df.select(fmt_fixed("v", digits)).collect()]
        assert got == [f"{v:,.{digits}f}" for v in values], digits
    assert df.select(fmt_percent("v")).first()[0] == "0.0%"


def test_one_pass_tells_the_same_violations_as_the_checks(spark):
    mart = spark.createDataFrame([(d, 1.0) for d in ("a", "b", "c", "d", "e")], "source_domain string, opportunity_score double")
    pairs = [("a", "b"), ("a", "b"), ("b", "c"), ("x", "d"), ("a", "y"), ("b", "e")]
    dups = spark.createDataFrame([(c, d, "") for c, d in pairs], "canonical_domain string, duplicate_domain string, note string")
    rows, seen = rp.observed_pairs(mart, dups)
    assert seen == {
        "domains listed as a duplicate more than once": (dq.check_unique(dups, "duplicate_domain").count(), "b"),
        "domains of duplicate pairs missing from the mart": (dq.check_pairs_in_mart(dups, mart).count(), "x"),
        "canonical domains that are duplicates themselves": (dq.check_chains(dups).count(), "b"),
        "the mart is empty": (0, None)}
    assert {(r.source_domain, r.canonical_domain) for r in rows.collect()} == {("a", "a"), ("b", "a"), ("c", "b"), ("d", "x"), ("e", "b")}
    with pytest.raises(rp.ReportError, match="more than once: 1 .first: b.; .*missing from the mart: 2 .first: x.; .*themselves: 2 .first: b."):
        rp.checked_pairs(mart, dups)
    with pytest.raises(rp.ReportError, match="the mart is empty"):
        rp.checked_pairs(mart.limit(0), dups.limit(0))
