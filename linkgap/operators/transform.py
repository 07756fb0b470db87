"""Raw tables -> staged -> coverage/authority -> scored -> categorised ->
opportunity mart. Each step is ``DataFrame -> DataFrame``, so Catalyst sees
one plan from the raw scans to the mart.

Shuffles: coverage aggregates by ``source_domain`` with map-side partial
aggregation (a domain has at most targets x releases distinct rows, and a
hot domain's duplicates collapse before the exchange); authority aggregates
the same way. The coverage ⟕ authority join is a shuffle join on
``source_domain`` that reuses both aggregations' hash partitioning (both
sides are one row per domain; AQE may broadcast the smaller at runtime).
The override list is joined by the planner's choice (broadcast from its
file size when small).
The gap filter runs right after the aggregation, before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY_RULES, DEFAULT_PARAMS, ScoreParams, Targets
from ..functions.domains import unreverse_domain
from ..functions.scoring import (authority_percentile, competitor_count, keyword_category,
                                 opportunity_score)


def total_order() -> list:
    """Score desc, competitor count desc, authority desc, domain asc."""
    return [F.col("opportunity_score").desc(), F.col("competitor_count").desc(),
            F.col("authority_percentile").desc(), F.col("source_domain").asc()]


def staged_edges_all(raw_edges: DataFrame) -> DataFrame:
    """Un-reversed, lowercased, self links dropped — duplicates still in.
    Coverage only needs max() and count(distinct), which ignore
    duplicates, so it reads this and dedupes in its own map-side combine."""
    e = raw_edges.select(
        "release",
        unreverse_domain("source_rev_domain").alias("source_domain"),
        F.lower("target_domain").alias("target_domain"))
    return e.where(F.col("source_domain") != F.col("target_domain"))


def stage_edges(raw_edges: DataFrame) -> DataFrame:
    """One row per (release, source_domain, target_domain)."""
    return staged_edges_all(raw_edges).distinct()


def stage_ranks(raw_ranks: DataFrame, raw_stats: DataFrame) -> DataFrame:
    """(release, source_domain, hc_pos, nodes_total, authority_percentile).
    The stats side holds one row per release (a release without stats drops
    out); from its file size the planner broadcasts it."""
    stats = raw_stats.select("release", "nodes_total")
    r = raw_ranks.join(stats, "release")
    return r.select(
        "release",
        unreverse_domain("source_rev_domain").alias("source_domain"),
        "hc_pos", "nodes_total",
        authority_percentile("hc_pos", "nodes_total").alias("authority_percentile"))


def loaded_releases(staged: DataFrame) -> DataFrame:
    """(n_releases): releases that have staged edges (an empty release
    does not count)."""
    return staged.agg(F.count_distinct("release").alias("n_releases"))


def release_coverage(raw_edges: DataFrame) -> DataFrame:
    """(source_domain, targets) of one release: the targets that each domain links to. A domain
    has at most as many as there are tracked targets. This is the state that coverage over
    releases is merged from."""
    edges = raw_edges.withColumn("release", F.lit("")) if "release" not in raw_edges.columns else raw_edges
    return staged_edges_all(edges).groupBy("source_domain").agg(F.collect_set("target_domain").alias("targets"))


def coverage_of_releases(state: DataFrame, targets: Targets, n_releases: int) -> DataFrame:
    """``competitor_coverage`` merged from the releases' states (release, source_domain, targets):
    one row per domain and release is read, no edges. ``n_releases``: releases that have staged edges."""
    flags = [F.max(F.array_contains("targets", t.domain).cast("int")).alias(f"links_{t.key}") for t in targets.all]
    cov = state.groupBy("source_domain").agg(*flags, F.count(F.lit(1)).alias("releases_seen"))
    return cov.withColumn("present_in_both", (F.col("releases_seen") == F.lit(n_releases)).cast("int"))


def competitor_coverage(staged: DataFrame, targets: Targets, n_releases: int | None = None) -> DataFrame:
    """Per source domain: one 0/1 flag per target, releases_seen and
    present_in_both (seen in every release that has edges). ``n_releases``, known from the commits, spares
    the pass that counts those."""
    flags = [F.max(F.when(F.col("target_domain") == t.domain, 1).otherwise(0)).alias(f"links_{t.key}")
             for t in targets.all]
    # A set of releases (a few short strings) instead of a distinct count: one
    # exchange by domain serves the flags and the count.
    cov = staged.groupBy("source_domain").agg(*flags, F.collect_set("release").alias("_releases"))
    # Scalar subquery, run once: a second, column-pruned pass over the staged edges
    # that shuffles a few release names. (Taken from `cov` it would aggregate by
    # domain again: column pruning keeps the two exchanges from being one.)
    n_releases = loaded_releases(staged).scalar() if n_releases is None else F.lit(n_releases)
    seen = F.size("_releases").cast("long")
    return (cov.withColumn("releases_seen", seen)
            .withColumn("present_in_both", (F.col("releases_seen") == n_releases).cast("int")).drop("_releases"))


def domain_authority(staged_ranks: DataFrame) -> DataFrame:
    """Best (max) percentile across releases; nulls ignored."""
    return staged_ranks.groupBy("source_domain").agg(F.max("authority_percentile").alias("authority_percentile"))


def gap_filter(df: DataFrame, params: ScoreParams = DEFAULT_PARAMS,
               targets: Targets | None = None) -> DataFrame:
    """Own flag 0 and at least ``min_competitors`` competitors."""
    count = F.col("competitor_count") if "competitor_count" in df.columns else competitor_count(targets.competitor_flags)
    return df.where((F.col("links_own") == 0) & (count >= F.lit(params.min_competitors)))


def score(coverage: DataFrame, authority: DataFrame, targets: Targets,
          params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """coverage ⟕ authority -> count, authority (null -> 0), score."""
    comp = targets.competitor_flags
    cnt = competitor_count(comp)
    auth = F.coalesce(F.col("authority_percentile"), F.lit(0.0))
    j = coverage.join(authority, "source_domain", "left")
    return j.select(
        "source_domain", *comp, "links_own",
        cnt.alias("competitor_count"),
        "present_in_both", "releases_seen",
        auth.alias("authority_percentile"),
        opportunity_score(cnt, len(comp), auth, F.col("present_in_both"), params).alias("opportunity_score"))


def categorise(scored: DataFrame, overrides: DataFrame | None, rules=CATEGORY_RULES) -> DataFrame:
    """Curated category if present, else the first keyword rule that hits.
    Override keys must be unique (``quality.check_unique``). The planner
    broadcasts the list or not, by its size."""
    heuristic = keyword_category("source_domain", rules)
    if overrides is None:
        return scored.withColumn("category", heuristic)
    ov = overrides.select("source_domain", F.col("category").alias("_override"))
    j = scored.join(ov, "source_domain", "left")
    return j.withColumn("category", F.coalesce(F.col("_override"), heuristic)).drop("_override")


def opportunity_mart(raw_edges: DataFrame, raw_ranks: DataFrame, raw_stats: DataFrame,
                     targets: Targets, params: ScoreParams = DEFAULT_PARAMS,
                     overrides: DataFrame | None = None, coverage: DataFrame | None = None) -> DataFrame:
    """The mart: one row per gap domain (own flag 0, >= min competitors). ``coverage``, when
    given, stands for the aggregation of the raw edges.

    The gap filter only needs coverage columns, so it is applied before the
    authority and override joins (Catalyst would push it there as well)."""
    if coverage is None:
        coverage = competitor_coverage(staged_edges_all(raw_edges), targets)
    cov = gap_filter(coverage, params, targets)
    auth = domain_authority(stage_ranks(raw_ranks, raw_stats))
    scored = score(cov, auth, targets, params)
    return categorise(scored, overrides).select(*mart_columns(targets))


def mart_columns(targets: Targets) -> list[str]:
    return (["source_domain"] + targets.competitor_flags + ["links_own", "competitor_count",
            "present_in_both", "releases_seen", "authority_percentile", "opportunity_score", "category"])
