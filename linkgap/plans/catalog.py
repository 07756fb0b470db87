"""Registered queries over the link graph derived from the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. The extract+load stage
(and the curated files, the mart table and the graph text files) is run
once per (session, data folder) into a fresh folder under the shared
checkpoint folder and read by later queries, as a materialised raw layer
is in production; the returned DataFrames read those tables.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_PARAMS, TOP_N, Targets
from ..functions.domains import normalize_domain, reverse_domain, unreverse_domain, url_host
from ..functions.labels import category_title, fmt_fixed, fmt_percent, links_to_label
from ..operators import extract as ex
from ..operators import load as ld
from ..operators import quality as dq
from ..operators import report as rp
from ..operators import semantic as sem
from ..operators import transform as tr
from ..session import new_run_dir
from ..sources import curated
from ..sources import derived_graph as dg
from ..sources import graph_files as gf
from . import pipeline as pl

_CONTEXTS: dict[tuple[str, int, str], "GraphContext"] = {}


class GraphContext:
    """Lazily built layers of one derived graph.

    ``build`` derives the graph (Parquet inputs), runs extract+load of every
    release, writes the curated files, the mart table and the duplicate
    list into a fresh folder: once per session and data folder, never
    across sessions."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.tables = dg.Tables.read(spark, self.sf_dir)
        self.targets: Targets = dg.GRAPH_TARGETS
        self.params = DEFAULT_PARAMS
        self._root: str | None = None
        self._files: dict[str, dict[str, str]] | None = None
        self._graph: dict[bool, list[pl.ReleaseInputs]] = {}

    # -- inputs --------------------------------------------------------------
    def releases(self, broken: bool = False) -> list[pl.ReleaseInputs]:
        """The graph releases as converted Parquet inputs."""
        _ = self.root
        return self._graph[broken]

    # -- materialised layers -------------------------------------------------
    def build(self, timings: dict[str, float] | None = None) -> str:
        t0 = time.perf_counter()
        root = new_run_dir(self.spark, "graph")
        self._graph = dg.convert_graph(self.spark, self.tables, f"{root}/input", self.sf_dir)
        t1 = time.perf_counter()
        pl.run_releases(self.spark, root, self._graph[False], self.targets)
        curated.write_curated(dg.overrides(self.tables), f"{root}/curated/overrides")
        curated.write_curated(dg.actions(self.tables), f"{root}/curated/actions")
        self._root = root
        mart = pl.write_mart(self.mart_plan(), f"{root}/mart")
        curated.write_curated(dg.duplicates(mart), f"{root}/curated/duplicates")
        if timings is not None:
            timings["graph_convert"] = round(t1 - t0, 3)
            timings["etl_load"] = round(time.perf_counter() - t1, 3)
        return root

    @property
    def root(self) -> str:
        if self._root is None:
            self.build()
        return self._root

    def graph_files(self) -> dict[str, dict[str, str]]:
        if self._files is None:
            base = f"{self.root}/files-{uuid.uuid4().hex[:8]}"
            self._files = {g.label: gf.write_graph_files(g.vertices, g.edges, g.ranks, g.stats,
                                                         f"{base}/release={g.label}")
                           for g in self.releases()}
        return self._files

    def raw(self):
        return pl.raw_tables(self.spark, self.root)

    def overrides(self) -> DataFrame:
        return curated.read_overrides(self.spark, f"{self.root}/curated/overrides")

    def actions(self) -> DataFrame:
        return curated.read_actions(self.spark, f"{self.root}/curated/actions")

    def duplicates(self) -> DataFrame:
        return curated.read_duplicates(self.spark, f"{self.root}/curated/duplicates")

    def mart_plan(self) -> DataFrame:
        """The mart as one plan from the published raw tables and the releases' coverage."""
        return pl.mart_from_root(self.spark, self.root, self.targets, self.params, self.overrides())

    def mart(self) -> DataFrame:
        """The materialised mart table."""
        return self.spark.read.parquet(f"{self.root}/mart")

    def merged(self, check: bool = True) -> DataFrame:
        return rp.merge_duplicates(self.mart(), self.duplicates(), self.targets, self.params, check)

    def top(self, n: int = TOP_N) -> DataFrame:
        """Top-n companies; every call does its own work."""
        return rp.top_k(self.merged(), n)

    def staged(self) -> DataFrame:
        return tr.stage_edges(self.raw()[0])

    def coverage(self) -> DataFrame:
        return tr.competitor_coverage(tr.staged_edges_all(self.raw()[0]), self.targets,
                                      ld.staged_releases(self.spark, self.root))

    def staged_ranks(self) -> DataFrame:
        _, r, s = self.raw()
        return tr.stage_ranks(r, s)

    def scored(self) -> DataFrame:
        return tr.score(self.coverage(), tr.domain_authority(self.staged_ranks()), self.targets, self.params)


def ctx(spark: SparkSession, sf_dir: str, reuse: bool = True) -> GraphContext:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    if key not in _CONTEXTS or not reuse:
        _CONTEXTS[key] = GraphContext(spark, sf_dir)
    return _CONTEXTS[key]


def _per_release(c: GraphContext, fn, broken: bool = False) -> DataFrame:
    parts = [fn(r).withColumn("release", F.lit(r.label)) for r in c.releases(broken)]
    df = reduce(DataFrame.unionByName, parts)
    return df.select("release", *[x for x in df.columns if x != "release"])


# --- A: scans ----------------------------------------------------------------

def q_scan_vertices(spark, sf_dir):
    c = ctx(spark, sf_dir)
    parts = [gf.read_vertices(spark, p["vertices"]).withColumn("release", F.lit(lbl))
             for lbl, p in c.graph_files().items()]
    return reduce(DataFrame.unionByName, parts).select("release", "id", "rev_domain")


def q_scan_edges(spark, sf_dir):
    c = ctx(spark, sf_dir)
    parts = [gf.read_edges(spark, p["edges"]).withColumn("release", F.lit(lbl))
             for lbl, p in c.graph_files().items()]
    return reduce(DataFrame.unionByName, parts).select("release", "src", "dst")


def q_scan_ranks(spark, sf_dir):
    c = ctx(spark, sf_dir)
    parts = [gf.read_ranks(spark, p["ranks"]).withColumn("release", F.lit(lbl))
             for lbl, p in c.graph_files().items()]
    return reduce(DataFrame.unionByName, parts).select("release", "rev_domain", "hc_pos", "pr_pos")


def q_graph_stats(spark, sf_dir):
    c = ctx(spark, sf_dir)
    parts = [gf.read_stats(spark, p["stats"]).withColumn("release", F.lit(lbl))
             for lbl, p in c.graph_files().items()]
    return reduce(DataFrame.unionByName, parts).select("release", "key", "value")


# --- D: extraction joins -----------------------------------------------------

def q_target_ids(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return _per_release(c, lambda r: ex.target_ids(r.vertices, c.targets))


def q_missing_targets(spark, sf_dir):
    """Every brand sold in ``part`` as a target, looked up in the broken
    vertex file: the brands whose vertex is missing."""
    c = ctx(spark, sf_dir)
    n = dg.brand_number()
    brands = c.tables.part.select(
        F.concat(F.lit("brand-"), n.cast("string"), F.lit(".co")).alias("target_domain"),
        F.concat(F.lit("co.brand-"), n.cast("string")).alias("rev_domain")).distinct()
    return _per_release(c, lambda r: ex.missing_targets_df(r.vertices, brands), broken=True)


def q_inbound_edges(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return _per_release(c, lambda r: ex.inbound_edges(r.edges, ex.find_target_ids(r.vertices, c.targets)))


def q_source_domains(spark, sf_dir):
    c = ctx(spark, sf_dir)

    def one(r):
        inbound = ex.inbound_edges(r.edges, ex.find_target_ids(r.vertices, c.targets))
        return ex.source_domains(r.vertices, inbound)
    return _per_release(c, one)


def q_source_ranks(spark, sf_dir):
    c = ctx(spark, sf_dir)

    def one(r):
        inbound = ex.inbound_edges(r.edges, ex.find_target_ids(r.vertices, c.targets))
        return ex.source_ranks(r.ranks, ex.source_domains(r.vertices, inbound))
    return _per_release(c, one)


def q_resolve_edges(spark, sf_dir):
    e = ctx(spark, sf_dir).raw()[0]
    return e.select("release", "source_id", "source_rev_domain", "target_domain")


def _unresolved(c: GraphContext):
    def one(r):
        inbound = ex.inbound_edges(r.edges, ex.find_target_ids(r.vertices, c.targets))
        return ld.unresolved_edges(inbound, ex.source_domains(r.vertices, inbound))
    return one


def q_unresolved_edges(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return _per_release(c, _unresolved(c), broken=True).select("release", "source_id", "target_domain")


def q_unresolved_examples(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return _per_release(c, lambda r: ld.unresolved_examples(_unresolved(c)(r)), broken=True)


def q_load_release_counts(spark, sf_dir):
    """Extracts and loads every release into a folder of its own, loads them
    again (finished extraction steps are skipped, the load replaces each release)
    and reports the published counts."""
    c = ctx(spark, sf_dir)
    root = new_run_dir(spark, "reload")
    pl.run_releases(spark, root, c.releases(), c.targets)
    pl.run_releases(spark, root, c.releases(), c.targets)
    return ld.release_counts(spark, root)


def q_release_select(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return (pl.release_select(spark, c.root, "2026-06").groupBy("release", "target_domain")
            .agg(F.count(F.lit(1)).alias("edges")))


# --- C/H/E: staging, coverage, mart -----------------------------------------

def q_staged_edges(spark, sf_dir):
    return ctx(spark, sf_dir).staged()


def q_unreverse_domain(spark, sf_dir):
    r = ctx(spark, sf_dir).raw()[1]
    return r.select("release", "source_rev_domain", unreverse_domain("source_rev_domain").alias("source_domain"))


def q_authority_percentile(spark, sf_dir):
    return ctx(spark, sf_dir).staged_ranks()


def q_domain_authority(spark, sf_dir):
    return tr.domain_authority(ctx(spark, sf_dir).staged_ranks())


def q_loaded_releases(spark, sf_dir):
    return tr.loaded_releases(ctx(spark, sf_dir).staged())


def q_competitor_coverage(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return c.coverage().select("source_domain", *["links_own"] + c.targets.competitor_flags,
                               "releases_seen", "present_in_both")


def q_releases_seen(spark, sf_dir):
    return ctx(spark, sf_dir).coverage().select("source_domain", "releases_seen")


def q_opportunity_score(spark, sf_dir):
    return ctx(spark, sf_dir).scored()


def q_competitor_count(spark, sf_dir):
    return ctx(spark, sf_dir).scored().select("source_domain", "competitor_count")


def q_self_link_filter(spark, sf_dir):
    """Per release: un-reversed edges in, self links dropped, edges kept."""
    e = ctx(spark, sf_dir).raw()[0]
    u = e.select("release", unreverse_domain("source_rev_domain").alias("s"), F.lower("target_domain").alias("t"))
    return u.groupBy("release").agg(
        F.count(F.lit(1)).alias("edges_in"),
        F.count(F.when(~(F.col("s") != F.col("t")), 1)).alias("self_or_null"),
        F.count(F.when(F.col("s") != F.col("t"), 1)).alias("edges_kept"))


def q_keyword_category(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return tr.categorise(c.coverage().select("source_domain"), None)


def q_category_override(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return tr.categorise(c.scored(), c.overrides()).select("source_domain", "category")


def q_gap_filter(spark, sf_dir):
    c = ctx(spark, sf_dir)
    cov = c.coverage()
    g = tr.gap_filter(cov, c.params, c.targets)
    return g.select("source_domain", "links_own", *c.targets.competitor_flags,
                    tr.competitor_count(c.targets.competitor_flags).alias("competitor_count"))


def q_opportunity_mart(spark, sf_dir):
    return ctx(spark, sf_dir).mart_plan()


def q_ranked_opportunities(spark, sf_dir):
    return rp.ranked(ctx(spark, sf_dir).mart())


# --- report -------------------------------------------------------------------

def q_canonical_domain(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rp.canonical_domain(c.mart(), c.duplicates())


def q_merge_duplicates(spark, sf_dir):
    return ctx(spark, sf_dir).merged()


def q_top_opportunities(spark, sf_dir):
    return ctx(spark, sf_dir).top()


def q_report_rows(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rp.report_rows(c.top(), c.actions(), c.targets)


def q_category_sections(spark, sf_dir):
    return rp.category_sections(ctx(spark, sf_dir).top())


def q_report_totals(spark, sf_dir):
    c = ctx(spark, sf_dir)
    merged = c.merged()
    return rp.report_totals(c.mart(), merged, rp.top_k(merged, TOP_N))


def q_release_nodes(spark, sf_dir):
    return rp.release_nodes(ctx(spark, sf_dir).raw()[2])


def q_links_to_label(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return c.mart().select("source_domain", links_to_label(c.targets.competitor_flags, c.targets.names).alias("links_to"))


def q_category_title(spark, sf_dir):
    return ctx(spark, sf_dir).mart().select("category").distinct().select(
        "category", category_title("category").alias("title"))


def q_display_formats(spark, sf_dir):
    return ctx(spark, sf_dir).mart().select(
        "source_domain",
        fmt_fixed("authority_percentile", 3).alias("authority_fmt"),
        fmt_fixed("opportunity_score", 3).alias("score_fmt"),
        fmt_percent("authority_percentile", 1).alias("authority_pct1"),
        fmt_fixed("opportunity_score", 2).alias("score_num2"))


def q_uncurated_top(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rp.missing_keys(c.top().select("rank", "source_domain"), c.overrides(), "source_domain")


def q_dq_summary(spark, sf_dir):
    """Every check as (check, violations); diagnostics never raise, so a
    shortage of companies for the report is itself a reported violation."""
    c = ctx(spark, sf_dir)
    e, _, s = c.raw()
    mart = c.mart()
    # one pass over mart and duplicate list tells the list's violations and feeds the merge; the N best companies are
    # checkpointed, and fewer rows than N are a shortage of the merged mart
    pairs, seen = rp.observed_pairs(mart, c.duplicates())
    merged = rp.merge_duplicates(mart, c.duplicates(), c.targets, c.params, pairs=pairs)
    shown = rp.top_k(merged, TOP_N, require_full=False).select("source_domain")
    listed = spark.createDataFrame([("duplicates_in_mart", seen["domains of duplicate pairs missing from the mart"][0]),
                                    ("duplicates_no_chain", seen["canonical domains that are duplicates themselves"][0])],
                                   "check string, violations long")
    raw = dq.row_check_counts(e, {
        "raw_edges_release_not_null": F.col("release").isNull(),
        "raw_edges_target_not_null": F.col("target_domain").isNull(),
        "raw_edges_target_accepted": ~F.col("target_domain").isin([t.domain for t in c.targets.all]),
    })
    def absent(r):
        return ex.missing_targets(ex.target_ids(r.vertices, c.targets), c.targets)

    checks = [
        ("edges_resolved", _per_release(c, _unresolved(c))),
        ("targets_present", _per_release(c, absent)),
        ("node_count_known", s.where(F.col("nodes_total").isNull())),
        ("stats_not_empty", dq.check_empty(s)),
        ("overrides_unique", dq.check_unique(c.overrides(), "source_domain")),
        ("actions_unique", dq.check_unique(c.actions(), "source_domain")),
        ("report_has_n_companies", dq.check_min_rows(shown, TOP_N)),
        ("top_without_action", rp.missing_keys(shown, c.actions(), "source_domain")),
        ("top_uncurated", rp.missing_keys(shown, c.overrides(), "source_domain")),
    ]
    return dq.dq_summary(checks, [raw, listed, dq.mart_check_counts(mart, c.targets, c.params)])


# --- K: semantic layer --------------------------------------------------------

def q_topic_top25(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return sem.top_opportunities_query(c.mart(), sem.topic_model(c.targets, c.params.min_competitors))


def q_opportunities_by_category(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return sem.by_category_query(c.mart(), sem.topic_model(c.targets, c.params.min_competitors))


def q_topic_query(spark, sf_dir):
    c = ctx(spark, sf_dir)
    model = sem.topic_model(c.targets, c.params.min_competitors)
    return sem.topic_query(c.mart(), model, ["present_in_both", "competitor_count", "opportunity_count",
                                             "avg_competitor_coverage", "avg_opportunity_score"],
                           sorts=(sem.Sort("present_in_both", True), sem.Sort("competitor_count", True)))


# --- pages: domain functions on real URLs --------------------------------------

def _pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")


def q_normalize_domain(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", url_host("url").alias("host"))
    return p.select("page_id", "host", normalize_domain("host").alias("domain"))


def q_reverse_domain(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", normalize_domain(url_host("url")).alias("domain"))
    return p.select("page_id", "domain", reverse_domain("domain").alias("rev_domain"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_vertices": q_scan_vertices,
    "scan_edges": q_scan_edges,
    "scan_ranks": q_scan_ranks,
    "graph_stats": q_graph_stats,
    "target_ids": q_target_ids,
    "missing_targets": q_missing_targets,
    "inbound_edges": q_inbound_edges,
    "source_domains": q_source_domains,
    "source_ranks": q_source_ranks,
    "resolve_edges": q_resolve_edges,
    "unresolved_edges": q_unresolved_edges,
    "unresolved_examples": q_unresolved_examples,
    "load_release_counts": q_load_release_counts,
    "release_select": q_release_select,
    "staged_edges": q_staged_edges,
    "unreverse_domain": q_unreverse_domain,
    "authority_percentile": q_authority_percentile,
    "domain_authority": q_domain_authority,
    "loaded_releases": q_loaded_releases,
    "competitor_coverage": q_competitor_coverage,
    "releases_seen": q_releases_seen,
    "opportunity_score": q_opportunity_score,
    "competitor_count": q_competitor_count,
    "self_link_filter": q_self_link_filter,
    "keyword_category": q_keyword_category,
    "category_override": q_category_override,
    "gap_filter": q_gap_filter,
    "opportunity_mart": q_opportunity_mart,
    "ranked_opportunities": q_ranked_opportunities,
    "canonical_domain": q_canonical_domain,
    "merge_duplicates": q_merge_duplicates,
    "top_opportunities": q_top_opportunities,
    "report_rows": q_report_rows,
    "category_sections": q_category_sections,
    "report_totals": q_report_totals,
    "release_nodes": q_release_nodes,
    "links_to_label": q_links_to_label,
    "category_title": q_category_title,
    "display_formats": q_display_formats,
    "uncurated_top": q_uncurated_top,
    "dq_summary": q_dq_summary,
    "topic_top25": q_topic_top25,
    "opportunities_by_category": q_opportunities_by_category,
    "topic_query": q_topic_query,
    "normalize_domain": q_normalize_domain,
    "reverse_domain": q_reverse_domain,
}
